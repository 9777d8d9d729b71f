"""Streaming extensions and learner plans (rows and invariants)."""

import datetime

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as e
from tillroll.operators import ml
from tillroll.streaming import events as ev

SF = "/root/testdata/sf0.001"


def test_stream_windows_close_with_watermark(spark):
    out = ev.run_to_table(ev.windowed_totals(ev.event_stream(spark, SF)), "t")
    mx = spark.read.parquet(f"{SF}/events.parquet").agg(F.max("ts")).first()[0]
    rows = out.collect()
    assert rows and all(r.window_end.replace(tzinfo=None) <= mx.replace(tzinfo=None) for r in rows)


def test_stream_dedup_keeps_every_id_once(spark):
    out = ev.run_to_table(ev.dedupe_events(ev.event_stream(spark, SF)), "d")
    src = spark.read.parquet(f"{SF}/events.parquet")
    assert out.count() == src.select("event_id").distinct().count()


def test_surge_alerts_chain_previous_window(spark):
    out = ev.run_surge_alerts(ev.windowed_totals(ev.event_stream(spark, SF)), "s").orderBy("event_type", "window_start")
    rows = out.collect()
    by = {}
    for r in rows:
        if r.event_type in by:
            assert r.previous_total == by[r.event_type]
        by[r.event_type] = r.total_value


def _event_files(spark, folder):
    """Files read one a batch: a late row of a closed day (Spark drops by the watermark of
    the batch before), a repeated id, a last open day."""
    day = lambda d, h: f"2024-01-{d:02d} {h:02d}:00:00"
    files = [[(1, day(1, 1), "a", 1.0), (2, day(1, 2), "a", 2.0), (2, day(1, 2), "a", 2.0)],
             [(3, day(5, 1), "a", 4.0), (1, day(5, 2), "b", 1.0)],
             [(6, day(6, 1), "b", 1.0)],
             [(4, day(1, 3), "a", 100.0), (5, day(9, 1), "a", 8.0), (3, day(5, 1), "a", 4.0)]]
    for k, rows in enumerate(files):
        df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("event_id long, ts timestamp, event_type string, value double").option(
        "maxFilesPerTrigger", 1).parquet(folder), spark.read.parquet(folder)


def test_late_rows_and_open_windows_over_several_files(spark, tmp_path):
    stream, batch = _event_files(spark, str(tmp_path / "events"))
    closed = ev.run_to_table(ev.windowed_totals(stream), "late")
    out = closed.unionByName(ev.open_windows(batch)).orderBy("window_start", "event_type").collect()
    assert [(r.window_start.day, r.event_type, r.events, r.total_value) for r in out] == [
        (1, "a", 3, 5.0), (5, "a", 2, 8.0), (5, "b", 1, 1.0), (6, "b", 1, 1.0), (9, "a", 1, 8.0)]


def test_alerts_hand_over_between_batches(spark, tmp_path):
    stream, batch = _event_files(spark, str(tmp_path / "events"))
    out = ev.run_surge_alerts(ev.windowed_totals(stream), "several", ev.open_windows(batch)).orderBy("window_start")
    own = [(r.window_start.day, r.previous_total is None) for r in out.collect() if r.event_type == "a"]
    assert own == [(1, True), (5, False), (9, False)]


def test_alerts_go_on_after_a_restart(spark, tmp_path):
    """Files that come after a stop are alerted on against the last window before it; each batch
    reads its own files only."""
    source, folder = tmp_path / "events", str(tmp_path / "run")
    day = lambda d: f"2024-01-{d:02d} 05:00:00"

    def more(*rows):
        df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = spark.readStream.schema("event_id long, ts timestamp, event_type string, value double").option(
            "maxFilesPerTrigger", 1).parquet(str(source))
        return ev.run_surge_alerts(ev.windowed_totals(stream), "again", folder=folder).orderBy("event_type", "window_start").collect()

    more((1, day(1), "a", 10.0), (2, day(1), "b", 4.0))
    more((3, day(2), "a", 13.0))
    more((4, day(5), "a", 5.0))
    before = run()
    assert [(r.event_type, r.window_start.day, r.previous_total, r.alert) for r in before] == [
        ("a", 1, None, None), ("a", 2, 10.0, "surge"), ("b", 1, None, None)]
    more((5, day(8), "b", 4.5))
    more((6, day(12), "a", 5.0))
    after = run()
    assert [(r.event_type, r.window_start.day, r.previous_total, r.alert) for r in after] == [
        ("a", 1, None, None), ("a", 2, 10.0, "surge"), ("a", 5, 13.0, "drop"), ("b", 1, None, None), ("b", 8, 4.0, None)]
    assert run() == after


def test_adf_decides_and_declines(spark):
    assert [round(ml.adf_p_value(s), 2) for s in (-3.43035, -2.86154, -2.56677)] == [0.01, 0.05, 0.1]
    assert ml.adf_p_value(3) == 1 and ml.adf_p_value(-30) == 0 and abs(ml.adf_p_value(-1.61) - 0.478) < 0.01
    rng = np.random.default_rng(4)
    noise, steps = rng.normal(size=200), np.cumsum(rng.normal(size=200))
    series = {"noise": noise, "walk": steps, "line": np.arange(40.0), "flat": np.full(40, 3.0), "short": noise[:10],
              "cycle": np.tile([0.0, 1.0], 30), "impulse": np.eye(1, 60, 30)[0]}
    rows = [(k, datetime.date(2020, 1, 1) + datetime.timedelta(days=i), float(v)) for k, y in series.items() for i, v in enumerate(y)]
    rows += [("noise", datetime.date(2030, 1, 1), None)]
    got = {r.k: r for r in ml.adf_by_series(spark.createDataFrame(rows, "k string, date date, v double"), "k", "v").collect()}
    assert got["noise"].stationary == 1 and got["noise"].p_value < 1e-6 and got["noise"].nobs == 200
    assert got["walk"].stationary == 0 and got["walk"].p_value > 0.05
    for k in ("line", "flat", "short", "cycle"):
        assert (got[k].adf_stat, got[k].p_value, got[k].stationary) == (None, None, None), k
    # by the definition, for the order that was chosen
    for k in ("noise", "walk", "impulse"):
        y, p = series[k], got[k].used_lag
        d = np.diff(y)
        x = np.column_stack([np.ones(len(d) - p), y[p:-1], *[d[p - j:-j] for j in range(1, p + 1)]])
        beta = np.linalg.pinv(x) @ d[p:]
        resid = d[p:] - x @ beta
        se = np.sqrt(resid @ resid / (len(x) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
        assert abs(got[k].adf_stat - beta[1] / se) < 1e-6, k


def test_repeated_ids_over_several_files(spark, tmp_path):
    stream, _ = _event_files(spark, str(tmp_path / "events"))
    ids = [r.event_id for r in ev.run_to_table(ev.dedupe_events(stream, delay="30 days"), "ids").collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6]


def test_binary_metrics_auc_matches_pairwise(spark):
    df = spark.createDataFrame([(f"c{i}", y, p) for i, (y, p) in enumerate(
        [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.4), (0, 0.4)])], "customer_id string, y int, p double")
    got = ml.binary_metrics(df, "y", "p").first()
    pos = [0.9, 0.8, 0.4]
    neg = [0.8, 0.1, 0.4]
    pairs = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / 9
    assert abs(got.roc_auc - pairs) < 1e-12 and got.tp == 2 and got.fp == 1


def test_kmeans_and_recursive_forecast_plans(spark):
    qs = e.queries()
    seg = qs["kmeans_segments"](spark, SF)
    assert seg.select("cluster").distinct().count() == 3
    fc = qs["forecast_recursive_products"](spark, SF)
    g = fc.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.min("forecast").alias("lo")).collect()
    assert all(r.n == 30 and r.lo >= 0 for r in g)


def test_churn_models_are_fitted_at_the_same_time(spark, monkeypatch):
    import threading
    from pyspark.ml.classification import LogisticRegression
    from tillroll.operators import ml
    met = threading.Barrier(2)

    class Waits:
        def fit(self, train):
            met.wait(120)  # for the other model's fit
            return LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=5).fit(train)
    monkeypatch.setattr(ml, "CHURN_MODELS", {"one": Waits, "two": Waits})
    df = spark.createDataFrame([(f"c{i}", float(i % 7), int(i % 7 > 3)) for i in range(60)], "customer_id string, x double, true_churn_flag int")
    metrics, fitted = ml.train_churn(df, ["x"], models=("one", "two"))
    assert list(fitted) == ["one", "two"] and {r.model for r in metrics.collect()} == {"one", "two"}
