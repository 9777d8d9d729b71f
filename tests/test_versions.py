"""Versioned tables, key fingerprints, and the customer aggregate's plan."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import customers as cu
from tillroll.operators import inventory as iv
from tillroll.sources.versions import Versions


def table(spark, n, extra=0):
    return spark.range(n).withColumn("v", F.col("id") + extra)


def test_commits_updates_and_rollback(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    assert store.versions() == [] and store.manifest() == {"version": 0, "tables": {}}
    assert store.commit({"a": table(spark, 5), "b": table(spark, 7)}) == 1
    assert store.commit({"c": table(spark, 2)}, "csv") == 2
    seen = store.read("a")  # a reader of version 2
    assert store.update("a", lambda df: df.withColumn("w", F.col("v") * 2).where("id < 3")) == 3
    assert store.read("a").columns == ["id", "v", "w"] and store.read("a").count() == 3 and seen.count() == 5
    assert store.read("b").count() == 7 and store.read("c").count() == 2 and store.read("c").schema["id"].dataType.simpleString() == "bigint"
    assert store.rollback(1) == 4 and set(store.manifest()["tables"]) == {"a", "b"} and store.read("a").columns == ["id", "v"]
    assert store.versions() == [1, 2, 3, 4]
    with pytest.raises(KeyError):
        store.read("a", 9)


@pytest.mark.parametrize("step", ["second table", "manifest", "pointer"])
def test_a_writer_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch, step):
    store = Versions(spark, str(tmp_path / "store"))
    store.commit({"a": table(spark, 5), "b": table(spark, 5)})
    broken = table(spark, 6).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    if step == "second table":
        with pytest.raises(Exception, match="lost"):
            store.commit({"a": table(spark, 6), "b": broken})
    else:
        def dies(version, tables):
            if step == "pointer":  # the manifest is written, but not yet in place
                (tmp_path / "store" / "manifests" / ".half").write_text("{}")
            raise KeyboardInterrupt
        monkeypatch.setattr(store, "_publish", dies)
        with pytest.raises(KeyboardInterrupt):
            store.commit({"a": table(spark, 6), "b": table(spark, 6)})
    other = Versions(spark, str(tmp_path / "store"))
    assert other.versions() == [1] and other.read("a").count() == 5 and other.read("b").count() == 5
    assert other.commit({"a": table(spark, 8)}) == 2 and other.read("a").count() == 8 and other.read("b").count() == 5


def test_of_two_writers_the_later_fails(spark, tmp_path):
    one, two = (Versions(spark, str(tmp_path / "store")) for _ in range(2))
    one.commit({"a": table(spark, 5)})

    def meanwhile(df):
        two.commit({"a": table(spark, 9)})
        return df.limit(1)

    with pytest.raises(RuntimeError, match="meanwhile"):
        one.update("a", meanwhile)
    assert one.read("a").count() == 9


def test_vacuum_keeps_what_is_named(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    store.commit({"a": table(spark, 1), "b": table(spark, 1)})
    for n in (2, 3, 4):
        store.commit({"a": table(spark, n)})
    assert store.vacuum(keep=2) == 2 and store.versions() == [3, 4]
    assert store.read("a").count() == 4 and store.read("a", 3).count() == 3 and store.read("b").count() == 1
    assert store.commit({"a": table(spark, 5)}) == 5


def test_same_keys_sees_equal_counts_of_different_ids(spark):
    a = spark.createDataFrame([(x,) for x in ("p1", "p2", "p2", "p3")], "product_id string")
    cases = {("p3", "p2", "p1", "p1"): (3, 3, True), ("p1", "p2", "p4"): (3, 3, False), ("p1", "p2"): (3, 2, False), (): (3, 0, False)}
    for keys, want in cases.items():
        b = spark.createDataFrame([(x,) for x in keys], "product_id string")
        assert tuple(iv.same_keys(a, b, "product_id").first()) == want
    b = spark.createDataFrame([("p1",), ("p2",), ("p4",)], "product_id string")
    assert sorted(tuple(r) for r in iv.key_differences(a, b, "product_id").collect()) == [("p3", "a"), ("p4", "b")]


def test_customer_aggregate_counts_without_copies(spark):
    rows = [("c1", "t1", "2024-01-31 10:00:00", 2.0), ("c1", "t1", "2024-02-01 10:00:00", 1.0), ("c1", "t2", "2024-02-03 09:00:00", 5.0),
            ("c1", None, "2024-03-09 09:00:00", 1.0), ("c2", "t3", "2023-02-03 09:00:00", 4.0)]
    sales = spark.createDataFrame(rows, "customer_id string, transaction_id string, ts string, quantity_sold double").select(
        "customer_id", "transaction_id", F.col("ts").cast("timestamp_ntz").alias("date"), "quantity_sold",
        F.lit("1.5").cast("decimal(18,4)").alias("sales_amount"))
    base = cu.customer_base(sales)
    got = {r.customer_id: r for r in base.collect()}
    assert (got["c1"].frequency, got["c1"].active_months, got["c1"].monetary) == (2, 3, 6.0)
    assert (got["c2"].frequency, got["c2"].active_months) == (1, 1)
    assert "Expand" not in base._jdf.queryExecution().executedPlan().toString()
