"""Driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as e


def test_entry_smoke(spark):
    df = e.entry(spark)
    assert df.count() > 0
    assert len(df.columns) >= 10


def test_registry_consistency():
    qs, sql = e.queries(), e.oracle_sql()
    assert len(qs) >= 80
    assert set(sql) <= set(qs)
    for name in qs:
        assert name.isidentifier()
