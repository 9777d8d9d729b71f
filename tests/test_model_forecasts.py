"""The booster, the search, served forecasts and the product panel against plain versions."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as e
from tillroll.operators import boosting
from tillroll.operators import model_forecasts as mf
from tillroll.operators import panel_forecast as pf
from tillroll.operators import timeseries as ts
from tillroll.operators.boosting import Settings

SF = "/root/testdata/sf0.001"
DAY = datetime.date(2024, 1, 1)


# ------------------------------------------------------------------ booster
def plain_tree(x, g, s, depth=0):
    """Exact greedy recursion: (value) or (feature, threshold, left, right)."""
    soft = lambda v: np.sign(v) * max(abs(v) - s.reg_alpha, 0.0)
    score = lambda v: soft(v.sum()) ** 2 / max(len(v) + s.reg_lambda, 1e-12)
    best = (1e-9, None)
    if depth < s.max_depth:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                if min(low.sum(), (~low).sum()) < max(1.0, s.min_child_weight):
                    continue
                gain = score(g[low]) + score(g[~low]) - score(g)
                if gain > best[0] + 1e-12:
                    best = (gain, (f, cut, low))
    if best[1] is None:
        return -soft(g.sum()) / (len(g) + s.reg_lambda) * s.step_size
    f, cut, low = best[1]
    return f, cut, plain_tree(x[low], g[low], s, depth + 1), plain_tree(x[~low], g[~low], s, depth + 1)


def plain_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize("s", [Settings(6, 0.3, 3), Settings(5, 0.2, 4, 5.0, reg_alpha=0.4, reg_lambda=2.0), Settings(4, 0.5, 6, reg_lambda=0.0)])
def test_booster_is_exact_greedy(s):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.random(70), rng.integers(0, 4, 70), rng.normal(size=70), np.ones(70)])
    y = 3 * x[:, 0] + (x[:, 1] > 1) * 2 + rng.normal(0, 0.2, 70)
    now = np.full(70, y.mean())
    for _ in range(s.rounds):
        tree = plain_tree(x, now - y, s)
        now = now + np.array([plain_predict(tree, r) for r in x])
    assert np.allclose(boosting.fit(x, y, s).predict(x), now)


def test_booster_stops_early_and_draws_shares():
    rng = np.random.default_rng(3)
    x = rng.random((200, 5))
    y = x[:, 0] + rng.normal(0, 0.5, 200)
    s = Settings(300, 0.3, 5, row_share=0.6, feature_share=0.5)
    whole = boosting.fit(x[:150], y[:150], s)
    short = boosting.fit(x[:150], y[:150], s, (x[150:], y[150:]), 20)
    assert len(whole.trees) == 300 and 0 < len(short.trees) < 280
    assert [t.value for t in whole.trees[:len(short.trees)]] == [t.value for t in short.trees]
    errors = []
    for k in range(len(short.trees) + 20):
        errors.append(np.sqrt(np.mean((boosting.Booster(whole.base, whole.trees[:k + 1]).predict(x[150:]) - y[150:]) ** 2)))
    assert int(np.argmin(errors)) + 1 == len(short.trees)
    assert boosting.fit(x, np.full(200, 4.0), s).predict(x).tolist() == [4.0] * 200


def test_leaf_wise_keeps_the_best_leaves():
    rng = np.random.default_rng(5)
    x = rng.random((300, 3))
    y = np.sin(8 * x[:, 0]) + x[:, 1] * x[:, 2]
    for leaves in (2, 5, 9):
        tree = boosting.fit(x, y, Settings(1, 1.0, 6, leaves=leaves, reg_lambda=0.0)).trees[0]
        reached = {0}
        for k in range(len(tree.value)):
            if k in reached and tree.left[k] != k:
                reached |= {tree.left[k], tree.right[k]}
        assert sum(tree.left[k] == k for k in reached) == leaves


# ------------------------------------------------------------------- search
def test_search_settings_cover_the_eight_ranges():
    settings = mf.search_settings(100)
    assert settings == mf.search_settings(100) and len(set(settings)) == 100
    for name, lo, hi in (("rounds", 50, 500), ("max_depth", 2, 8), ("min_child_weight", 1, 10), ("row_share", 0.5, 1.0), ("feature_share", 0.5, 1.0)):
        seen = [getattr(s, name) for s in settings]
        assert lo <= min(seen) < lo + 0.2 * (hi - lo) and hi - 0.2 * (hi - lo) < max(seen) <= hi, name
    for name, lo, hi in (("step_size", 0.01, 0.3), ("reg_alpha", 1e-8, 10.0), ("reg_lambda", 1e-8, 10.0)):
        seen = np.log([getattr(s, name) for s in settings])
        span = np.log(hi) - np.log(lo)
        assert np.log(lo) <= min(seen) < np.log(lo) + 0.2 * span and np.log(hi) - 0.2 * span < max(seen) <= np.log(hi), name


def test_registered_search_runs_all_trials(spark):
    rows = e.queries()["forecast_search"](spark, SF).orderBy("trial").collect()
    assert [r.trial for r in rows] == list(range(100)) and [r.rounds for r in rows] == [s.rounds for s in mf.search_settings(100)]
    best = min(rows, key=lambda r: (r.val_mape, r.trial))
    assert all(r.val_mape > 0 for r in rows) and len({r.val_mape for r in rows}) > 90
    assert [r.trial for r in rows if r.is_best] == [best.trial]


def weekly(spark):
    from tillroll.sources.ledger import sales_ledger
    return mf.weekly_table(ts.densify_daily(ts.daily_sales(sales_ledger(spark, SF)), ["sales_amount", "quantity_sold"]))


def test_trials_in_tasks_are_the_plain_fits(spark):
    table = weekly(spark)
    t = table.orderBy("date").toPandas()
    settings = mf.search_settings(100)[:3]
    got = mf.search(spark, table, settings).orderBy("trial").collect()
    for s, r in zip(settings, got, strict=True):
        train, val = t[t.split == "Train"], t[t.split == "Validation"]
        model = boosting.fit(train[mf.WEEKLY_FEATURES].to_numpy(float), train["actual"].to_numpy(float), s)
        told = model.predict(val[mf.WEEKLY_FEATURES].to_numpy(float))
        want = np.mean(np.abs((val["actual"] - told) / val["actual"])) * 100
        assert abs(r.val_mape - want) < 1e-9


def test_weekly_forecast_steps_on_its_own_forecasts(spark):
    table = weekly(spark)
    got = mf.weekly_forecast(table, mf.served_job(spark)).orderBy("step").toPandas()
    t = table.orderBy("date").toPandas()
    known = t[t.split != "Dropped"]
    model = boosting.fit(known[mf.WEEKLY_FEATURES].to_numpy(float), known["actual"].to_numpy(float), mf.SERVED)
    sales, date = list(t["actual"]), t["date"].iloc[-1]
    for k in range(8):
        date += datetime.timedelta(days=7)
        told = max(0.0, model.predict(np.array([mf.week_inputs(date, sales)]))[0])
        assert got["date"][k] == date and abs(got["forecast"][k] - told) < 1e-6
        sales.append(told)
    assert (got["last_actual"] == t["actual"].iloc[-1]).all()


def test_step_inputs_equal_the_feature_tables(spark):
    """Inputs that a recursion makes for a known day or week are those of the tables."""
    table = weekly(spark).orderBy("date").toPandas()
    k = max(i for i in range(len(table) - 20) if table["weeks_until_christmas"][i] > 0 and table["split"][i] == "Train")
    mine = mf.week_inputs(table["date"][k], list(table["actual"][:k]))
    assert np.allclose(mine, table.loc[k, mf.WEEKLY_FEATURES].to_numpy(float), rtol=1e-6)
    from tillroll.sources.ledger import sales_ledger
    d = mf.daily_table(ts.daily_features(sales_ledger(spark, SF))).orderBy("date").toPandas()
    k = 400
    months = {}
    for day, v in zip(d["date"][:k], d["sales_amount"][:k], strict=True):
        months[day.year, day.month] = months.get((day.year, day.month), 0.0) + v
    index = {x.weekday(): v for x, v in zip(d["date"], d["weekday_seasonality_index"], strict=True)}
    mine = mf.day_inputs(d["date"][k], list(d["sales_amount"][:k]), list(d["quantity_sold"][:k]), index, months)
    assert np.allclose(mine, d.loc[k, mf.DAILY_FEATURES].to_numpy(float), rtol=1e-6)


def test_model_plans(spark):
    qs = e.queries()
    got = qs["forecast_gbt_metrics"](spark, SF).collect()
    assert {(r.model, r.target, r.split) for r in got} == {(m, t, s) for m in mf.DAILY_MODELS for t in mf.DAILY_TARGETS
                                                          for s in ("Train", "Validation", "Test")}
    assert all(0 < r.rounds <= 500 for r in got)
    winner = qs["forecast_gbt_comparison"](spark, SF).first()
    own = {r.model: r.mape for r in got if r.split == "Test" and r.target == "sales"}
    assert winner.winner == min(own, key=own.get) and winner.meets_target == int(min(own.values()) <= 12)
    days = qs["forecast_daily_recursive"](spark, SF).orderBy("step").collect()
    assert [r.step for r in days] == list(range(1, 31)) and {r.model for r in days} == {winner.winner}
    history = qs["weekly_model_history"](spark, SF).collect()
    assert sum(r.split == "Test" for r in history) == 4 and all((r.predicted is None) == (r.split == "Dropped") for r in history)
    metrics = {r.split: r for r in qs["weekly_model_metrics"](spark, SF).collect()}
    test = [r for r in history if r.split == "Test"]
    assert abs(metrics["Test"].mae - np.mean([abs(r.actual - r.predicted) for r in test])) < 1e-3
    assert metrics["Test without last period"].n == 3
    doc = qs["weekly_model_document"](spark, SF).collect()
    assert sum(r.kind == "future" for r in doc) == 8 and sum(r.kind == "historical" for r in doc) == len(history)


def test_empty_ledger_gives_no_forecast(spark):
    none = spark.createDataFrame([], f"date date, actual double, split string, {', '.join(c + ' double' for c in mf.WEEKLY_FEATURES)}")
    assert mf.weekly_forecast(none, mf.served_job(spark)).count() == 0
    assert mf.search(spark, none, mf.search_settings(2)).where("val_mape is not null").count() == 0


# -------------------------------------------------------------------- panel
def sold(rng):
    rows = [("often", DAY + datetime.timedelta(days=i), 10.0) for i in range(120)]
    rows += [("weekly", DAY + datetime.timedelta(days=i), 10.0) for i in range(0, 120, 7)]
    rows += [("ended", DAY + datetime.timedelta(days=i), 10.0) for i in range(40)]
    rows += [("young", DAY + datetime.timedelta(days=i), 3.0) for i in (109, 111)]
    rows += [("last day", DAY + datetime.timedelta(days=119), 5.0)]
    for p in range(25):
        rows += [(f"p{p}", DAY + datetime.timedelta(days=int(d)), float(q)) for d, q in zip(rng.integers(0, 120, 6), rng.integers(1, 4, 6), strict=True)]
    return rows


def dense_rows(df):
    """The panel with every day, and its inputs."""
    panel = ts.densify_panel(df.groupBy("product_id", "date").agg(F.sum("qty").alias("qty")), "product_id", ("qty",), to_last=True)
    w = Window.partitionBy("product_id").orderBy("date")
    return panel.select(F.lag("qty", 1).over(w).alias("lag_1"), F.lag("qty", 7).over(w).alias("lag_7"),
                        F.avg("qty").over(w.rowsBetween(-7, -1)).alias("mean_7"), F.avg("qty").over(w.rowsBetween(-28, -1)).alias("mean_28"),
                        F.col("qty").alias("y")).na.drop()


def test_weighted_rows_are_the_dense_panel(spark):
    df = spark.createDataFrame(sold(np.random.default_rng(1)), "product_id string, date date, qty double")
    key = [*pf.FEATURES, "y"]
    rounded = lambda t: t.select(*[F.round(c, 9).alias(c) for c in key], *[c for c in t.columns if c == "weight"])
    want = rounded(dense_rows(df)).groupBy(*key).count().toPandas().sort_values(key)
    got = rounded(pf.training_rows(df)).toPandas().sort_values(key)
    assert np.array_equal(got[key].to_numpy(), want[key].to_numpy()) and (got["weight"].to_numpy() == want["count"].to_numpy()).all()
    assert len(got) < want["count"].sum() / 2


def test_changes_of_a_sale_do_not_travel(spark):
    df = spark.createDataFrame(sold(np.random.default_rng(1)), "product_id string, date date, qty double")
    plan = pf.training_rows(df)._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan"):]
    assert physical[:physical.index("Generate")].count("Exchange") == 1  # the distinct rows only
    # quantities whose sums are no whole doubles keep their decimals
    big = pf.training_rows(df.withColumn("qty", F.col("qty") * 1e14)).agg(F.max("y"), F.sum("weight")).first()
    small = pf.training_rows(df).agg(F.max("y"), F.sum("weight")).first()
    assert big[0] == small[0] * 1e14 and big[1] == small[1]


def test_weighted_fit_is_the_dense_fit(spark):
    df = spark.createDataFrame(sold(np.random.default_rng(1)), "product_id string, date date, qty double")
    table = VectorAssembler(inputCols=pf.FEATURES, outputCol="features").transform(dense_rows(df))
    dense = GBTRegressor(featuresCol="features", labelCol="y", maxIter=5, maxDepth=4, stepSize=0.1, seed=42).fit(table.coalesce(1))
    x = np.array(table.select(*pf.FEATURES).distinct().collect(), float)
    told = pf.boosted(pf.tree_arrays(pf.fit(df, rounds=5)), x)
    assert np.allclose(told, pf.boosted(pf.tree_arrays(dense), x), atol=1e-8)
    by_spark = {tuple(r.features.toArray()): r.prediction for r in dense.transform(table).collect()}
    assert np.allclose(pf.boosted(pf.tree_arrays(dense), x), [by_spark[tuple(r)] for r in x], atol=1e-9)


def test_recursive_forecast_counts_days_without_sales(spark):
    df = spark.createDataFrame(sold(np.random.default_rng(1)) + [("none", None, 1.0), ("none", DAY, None)],
                               "product_id string, date date, qty double")
    out = pf.forecast_recursive(df, rounds=20).toPandas()
    mean = out.groupby("product_id")["forecast"].mean()
    assert len(out) == 30 * 30 and set(out["date"]) == {DAY + datetime.timedelta(days=120 + i) for i in range(30)}
    assert 9 < mean["often"] < 11 and 0.5 < mean["weekly"] < 3 and mean["ended"] < 0.5 and (out["forecast"] >= 0).all()
    arrays = pf.tree_arrays(pf.fit(df.where("qty is not null and date is not null"), rounds=20))
    hist = {p: [0.0] * 120 for p in ("weekly", "young")}
    for p, d, q in sold(np.random.default_rng(1)):
        if p in hist:
            hist[p][(d - DAY).days] += q
    for p, first in (("weekly", 0), ("young", 109)):
        h = hist[p][first:]
        for step in range(30):
            got = out[(out.product_id == p) & (out.step == step + 1)]["forecast"].iloc[0]
            want = max(0.0, pf.boosted(arrays, np.array([[h[-1], h[-7], np.mean(h[-7:]), np.mean(h[-28:])]]))[0])
            assert abs(got - want) < 1e-9, (p, step)
            h.append(want)
    assert pf.forecast_recursive(df.limit(0)).count() == 0


def test_registered_product_forecast(spark):
    out = e.queries()["forecast_recursive_products"](spark, SF)
    g = out.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.min("forecast").alias("lo")).collect()
    assert g and all(r.n == 30 and r.lo >= 0 for r in g)
    assert isinstance(out.toPandas(), pd.DataFrame)
