"""What must not grow faster than the tables: shuffles, task memory, jobs."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import customers
from tillroll.session import partitions_for
from tillroll.sources import ledger


def _orders(spark, folder, orders=200, lines=20):
    days = [dt.datetime(2020, 1, 1) + dt.timedelta(days=i) for i in range(orders)]
    spark.createDataFrame([(i, i % 7, d) for i, d in enumerate(days)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    rows = [(i, j, 2.0, 10.0, 0.1, "R" if j == 0 else "N") for j in range(lines) for i in range(orders)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, k % 3) for k in (0, 1, 2, 3, 3)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")


def test_lines_of_an_order_stay_together_in_the_ledger(spark, tmp_path, monkeypatch):
    _orders(spark, tmp_path)
    monkeypatch.setattr(ledger, "checkpoint_dir", lambda s: str(tmp_path))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        led = ledger.sales_ledger(spark, str(tmp_path))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert led.count() == 4000
    files = led.select("transaction_id", F.input_file_name().alias("f")).groupBy("transaction_id").agg(F.countDistinct("f").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1


def test_ledger_files_are_packed(spark, tmp_path, monkeypatch):
    _orders(spark, tmp_path)
    monkeypatch.setattr(ledger, "checkpoint_dir", lambda s: str(tmp_path))
    ledger.sales_ledger(spark, str(tmp_path))
    files = list(tmp_path.glob("tillroll-ledger-*/*.parquet"))
    assert files and all(".zstd." in f.name for f in files)


def test_region_joins_orders_not_lines(spark, tmp_path):
    _orders(spark, tmp_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        led = ledger.build_ledger(spark, str(tmp_path), with_region=True)
        plan = led._jdf.queryExecution().optimizedPlan().toString()
        rows = led.groupBy("customer_id", "region").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the lines are on one side of the outermost join, the customers below its other side
    depth = {name: min(line.index("Relation") for line in plan.splitlines() if name in line and "Relation" in line)
             for name in ("l_orderkey", "c_custkey")}
    assert depth["l_orderkey"] < depth["c_custkey"]
    got = {(r["customer_id"], r["region"]): r["count"] for r in rows}
    assert got[("0", "A")] == 29 * 20 and got[("1", "B")] == 29 * 20
    assert got[("2", None)] == 29 * 20  # a nation that is not there
    assert got[("3", "A")] == 2 * 29 * 20  # a customer that is there twice
    assert got[("6", None)] == 28 * 20  # a customer that is not there


def _ledger(spark, rows):
    schema = T.StructType([T.StructField("transaction_id", T.StringType()), T.StructField("customer_id", T.StringType()),
                           T.StructField("date", T.TimestampNTZType()), T.StructField("quantity_sold", T.DoubleType()),
                           T.StructField("sales_amount", T.DecimalType(18, 4))])
    from decimal import Decimal
    return spark.createDataFrame([(t, c, d, q, Decimal(a)) for t, c, d, q, a in rows], schema)


def test_customer_base_aggregates_without_objects(spark):
    d = dt.datetime
    led = _ledger(spark, [("1", "A", d(2020, 1, 31), 1.0, 10), ("1", "A", d(2020, 2, 1), 2.0, 5), ("2", "A", d(2020, 2, 9), 1.0, 1),
                          ("3", "B", None, 1.0, 1), ("4", None, d(2020, 2, 9), 1.0, 1)])
    base = customers.customer_base(led)
    got = {r.customer_id: r for r in base.collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].frequency, got["A"].active_months, got["A"].monetary) == (2, 2, 16.0)
    assert (got["B"].frequency, got["B"].active_months) == (1, 0)
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_partitions_follow_the_rows(spark):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(spark.range(10), rows=10) == own
    assert partitions_for(spark.range(own * 30 + 1), rows=10) == own * 3 + 1


def test_unit_roots_of_sparse_series(spark, monkeypatch):
    import numpy as np

    from tillroll.operators import ml

    rng = np.random.default_rng(1)
    start = dt.date(2020, 1, 5)
    rows = [(k, start + dt.timedelta(days=7 * i), float(rng.integers(1, 9))) for k in "AB" for i in range(120)
            if i in (0, 119) or rng.random() < 0.3]
    have = {(k, d): v for k, d, v in rows}
    dense = [(k, start + dt.timedelta(days=7 * i), have.get((k, start + dt.timedelta(days=7 * i)), 0.0)) for k in "AB" for i in range(120)]
    rows += [(None, start, 1.0), ("N", start, None)]
    schema = "k string, date date, v double"
    got = {r.k: r for r in ml.adf_by_series(spark.createDataFrame(rows, schema), "k", "v", step_days=7).collect()}
    exp = {r.k: r for r in ml.adf_by_series(spark.createDataFrame(dense, schema), "k", "v").collect()}
    for k in "AB":
        assert got[k] == exp[k] and got[k].nobs == 120 and got[k].adf_stat is not None
    assert (got[None].nobs, got[None].adf_stat) == (1, None) and (got["N"].nobs, got["N"].adf_stat) == (0, None)
    # all lag orders from one decomposition; only the chosen one is fitted by itself
    calls, lstsq = [], np.linalg.lstsq
    monkeypatch.setattr(np.linalg, "lstsq", lambda *a, **k: calls.append(1) or lstsq(*a, **k))
    assert ml.adf_statistic(rng.normal(size=120)) is not None and len(calls) == 1


def test_independent_fits_run_together(spark):
    import threading

    from tillroll.operators import ml

    met = threading.Barrier(2, timeout=60)  # passes only if two jobs are under way at once
    assert ml.together([lambda: (met.wait(), spark.range(3).count())[1], lambda: (met.wait(), spark.range(4).count())[1]]) == [3, 4]
    pts = spark.createDataFrame([(str(i), float(i % 3 * 10), float(i % 5) / 10) for i in range(60)], "customer_id string, a double, b double")
    seg, cost = ml.kmeans_segments(pts, ["a", "b"], k=3, restarts=3)
    rows = seg.collect()
    assert len({(r.a, r.cluster) for r in rows}) == 3 and cost < 60 * 0.05
