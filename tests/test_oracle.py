"""Every plan with an oracle matches DuckDB on the smallest driver tables
(row count, column names and exact values after the shared rounding)."""

import math

import duckdb
import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False)),
                        key=repr)


@pytest.mark.parametrize("name", sorted(e.oracle_sql()))
def test_plan_matches_oracle(spark, con, name):
    got = e.queries()[name](spark, SF).toPandas()
    exp = con.execute(e.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er
