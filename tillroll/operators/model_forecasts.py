"""Model-backed forecasts of the daily and weekly totals (D6q–D11q).

The series is calendar-sized however many sales there are: Spark sums the ledger to it,
and it travels once, as one row of arrays, to the tasks.  The work that grows is the
number of fits; each job (a search trial, a model and target, a served forecast) is a row
of its own and runs in a task of its own.  Every result is a DataFrame.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions import calendar as cal
from tillroll.operators import boosting
from tillroll.operators import timeseries as ts
from tillroll.operators.boosting import Settings
from tillroll.session import cut_lineage

SEED = 42

# The models' inputs and splits.
WEEKLY_FEATURES = ["lag_1_weekly_sales", "lag_2_weekly_sales", "lag_4_weekly_sales", "rolling_4_week_sales_lag1",
                   "weekly_sales_growth_rate", "weekly_sales_volatility", "week_of_year", "month", "quarter",
                   "weeks_until_christmas", "weeks_since_christmas", "q4_flag", "holiday_proximity_score", "year_end_flag"]
DAILY_FEATURES = ["lag_1_sales", "lag_1_qty", "lag_7_sales", "lag_7_qty", "lag_30_sales", "lag_30_qty",
                  "weekday_seasonality_index", "sales_growth_rate", "day_of_week", "month", "quarter", "week_of_year",
                  "rolling_7_day_sales_lag1", "rolling_30_day_sales_lag1", "rolling_7_day_quantity_lag1",
                  "rolling_30_day_quantity_lag1", "sales_volatility_30_day_lag1", "demand_momentum_lag1",
                  "quantity_momentum_lag1"]
WEEKLY_SPLIT, DAILY_SPLIT = 4, 30

# The served weekly model, and the two daily ones (level by level as the first
# booster's defaults have it, leaf by leaf as the second's).
SERVED = Settings(rounds=451, step_size=0.052, max_depth=5, min_child_weight=9, row_share=0.888, feature_share=0.751)
DAILY_MODELS = {
    "level_wise": (Settings(rounds=500, step_size=0.05, max_depth=5), "rmse"),
    "leaf_wise": (Settings(rounds=500, step_size=0.05, max_depth=5, min_child_weight=20, reg_lambda=0.0, leaves=31), "mape"),
}
DAILY_TARGETS = {"sales": "sales_amount", "quantity": "quantity_sold"}
PATIENCE = 20


# ------------------------------------------------------------ tables and jobs
def weekly_table(daily: DataFrame) -> DataFrame:
    """date, actual, the 14 inputs in training form (no weeks until Christmas after it), split."""
    w = ts.weekly_features(daily, wrap_christmas=False)
    w = w.withColumn("holiday_proximity_score", 1.0 / (F.col("weeks_until_christmas") + 1))
    w = w.select("date", F.col("weekly_sales_amount").cast("double").alias("actual"),
                 *[F.col(c).cast("double").alias(c) for c in WEEKLY_FEATURES])
    return ts.chrono_split(w, WEEKLY_SPLIT, WEEKLY_SPLIT, required=WEEKLY_FEATURES)


def daily_table(daily_feats: DataFrame) -> DataFrame:
    """date, both targets, the 19 inputs free of same-day values, split."""
    shift = ["rolling_7_day_sales", "rolling_30_day_sales", "rolling_7_day_quantity", "rolling_30_day_quantity",
             "sales_volatility_30_day", "demand_momentum", "quantity_momentum"]
    t = ts.remediate_leakage(daily_feats, (), shift)
    t = t.withColumns({"day_of_week": cal.day_of_week("date"), "month": F.month("date"), "quarter": F.quarter("date"),
                       "week_of_year": cal.iso_week("date")})
    t = t.select("date", *[F.col(c).cast("double").alias(c) for c in [*DAILY_TARGETS.values(), *DAILY_FEATURES]])
    return ts.chrono_split(t, DAILY_SPLIT, DAILY_SPLIT, required=DAILY_FEATURES)


def on_each(table: DataFrame, jobs: DataFrame, run: Callable[[dict, pd.DataFrame], pd.DataFrame], schema: str, tasks: int) -> DataFrame:
    """``run(job, table)`` for every row of ``jobs``, spread over ``tasks`` tasks.  ``table`` is
    calendar-sized and has a ``date``; it is broadcast as one row of arrays in date order."""
    names = table.columns
    rest = [c for c in names if c != "date"]
    whole = table.agg(F.sort_array(F.collect_list(F.struct("date", *rest))).alias("t")).select(
        *[F.col(f"t.{c}").alias(f"_{c}") for c in names])
    met = jobs.repartition(tasks).crossJoin(F.broadcast(whole))
    kept = jobs.columns

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                yield run({c: row[c] for c in kept}, pd.DataFrame({c: list(row[f"_{c}"]) for c in names}))

    return met.mapInPandas(each, schema)


def _parts(t: pd.DataFrame, features: Sequence[str], target: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    own = {s: t[t["split"] == s] for s in ("Train", "Validation", "Test")}
    own["All"] = t[t["split"] != "Dropped"]
    return {s: (p[list(features)].to_numpy(float), p[target].to_numpy(float)) for s, p in own.items()}


def measures(actual: np.ndarray, predicted: np.ndarray) -> tuple:
    """n, MAPE, MAE, RMSE, R² (D4q; null without spread)."""
    if not len(actual):
        return 0, None, None, None, None
    err = actual - predicted
    spread = float(((actual - actual.mean()) ** 2).sum())
    return (len(actual), boosting.mape(actual, predicted), float(np.abs(err).mean()), float(np.sqrt((err ** 2).mean())),
            1 - float((err ** 2).sum()) / spread if spread > 0 else None)


METRICS = "n long, mape double, mae double, rmse double, r2 double"


# ------------------------------------------------------------------- search
def search_settings(trials: int, seed: int = SEED) -> list[Settings]:
    """D7q seeded random settings over the reference's eight ranges; the step size and both
    penalties on a log scale."""
    rng = np.random.default_rng(seed)
    log = lambda lo, hi: float(np.exp(rng.uniform(np.log(lo), np.log(hi))))
    return [Settings(rounds=int(rng.integers(50, 501)), step_size=log(0.01, 0.3), max_depth=int(rng.integers(2, 9)),
                     min_child_weight=float(rng.integers(1, 11)), row_share=float(rng.uniform(0.5, 1.0)),
                     feature_share=float(rng.uniform(0.5, 1.0)), reg_alpha=log(1e-8, 10.0), reg_lambda=log(1e-8, 10.0))
            for _ in range(trials)]


SETTING = ("rounds long, step_size double, max_depth long, min_child_weight double, row_share double, feature_share double, "
           "reg_alpha double, reg_lambda double")
SETTING_NAMES = [c.split()[0] for c in SETTING.split(", ")]


def setting_row(s: Settings) -> tuple:
    return tuple(getattr(s, n) if n in ("rounds", "max_depth") else float(getattr(s, n)) for n in SETTING_NAMES)


def _settings(job: dict) -> Settings:
    whole = ("rounds", "max_depth")
    return Settings(**{k: int(job[k]) if k in whole else float(job[k]) for k in SETTING_NAMES})


def search(spark: SparkSession, table: DataFrame, settings: Sequence[Settings], features: Sequence[str] = WEEKLY_FEATURES,
           target: str = "actual") -> DataFrame:
    """D7q one row for each trial: its settings and the MAPE on the validation split of a fit on
    the training split with all its rounds; ``is_best`` has the lowest, the first among equals."""
    jobs = spark.createDataFrame([(i, *setting_row(s)) for i, s in enumerate(settings)], f"trial long, {SETTING}")

    def trial(job: dict, t: pd.DataFrame) -> pd.DataFrame:
        parts = _parts(t, features, target)
        score = None
        if len(parts["Train"][1]) and len(parts["Validation"][1]):
            score = boosting.mape(parts["Validation"][1], boosting.fit(*parts["Train"], _settings(job)).predict(parts["Validation"][0]))
        return pd.DataFrame([{**job, "val_mape": score}])

    out = cut_lineage(on_each(table, jobs, trial, f"trial long, {SETTING}, val_mape double", len(settings)))
    best = out.agg(F.min(F.struct(F.col("val_mape").isNull(), "val_mape", "trial"))["trial"].alias("_best"))  # one row
    return out.crossJoin(F.broadcast(best)).withColumn("is_best", (F.col("trial") == F.col("_best")).cast("long")).drop("_best")


def split_metrics(table: DataFrame, jobs: DataFrame) -> DataFrame:
    """D4q, D5q for each row of ``jobs`` (``SETTING``): metrics of a fit on the training split on
    every split, and on the test split without its last, maybe partial, period."""
    def run(job: dict, t: pd.DataFrame) -> pd.DataFrame:
        parts = _parts(t, WEEKLY_FEATURES, "actual")
        rows = []
        if len(parts["Train"][1]):
            model = boosting.fit(*parts["Train"], _settings(job))
            for name in ("Train", "Validation", "Test"):
                rows.append((name, *measures(parts[name][1], model.predict(parts[name][0]))))
            x, y = parts["Test"]
            rows.append(("Test without last period", *measures(y[:-1], model.predict(x[:-1]))))
        return pd.DataFrame(rows, columns=["split", *[c.split()[0] for c in METRICS.split(", ")]])

    return on_each(table, jobs, run, f"split string, {METRICS}", 1)


def served_job(spark: SparkSession, settings: Settings = SERVED) -> DataFrame:
    return spark.createDataFrame([setting_row(settings)], SETTING)


# ---------------------------------------------------------- weekly forecasts
def weekly_history(table: DataFrame, jobs: DataFrame) -> DataFrame:
    """D11q every week: actual, fitted value (null where an input is missing) and split."""
    def run(job: dict, t: pd.DataFrame) -> pd.DataFrame:
        parts = _parts(t, WEEKLY_FEATURES, "actual")
        out = t[["date", "actual", "split"]].copy()
        out["predicted"] = None
        if len(parts["Train"][1]):
            model = boosting.fit(*parts["Train"], _settings(job))
            out.loc[t["split"] != "Dropped", "predicted"] = model.predict(parts["All"][0])
        return out[["date", "actual", "predicted", "split"]]

    return on_each(table, jobs, run, "date date, actual double, predicted double, split string", 1)


def week_inputs(date: datetime.date, sales: Sequence[float]) -> list[float]:
    """``WEEKLY_FEATURES`` of a week that follows ``sales``; Christmas wraps to the next one."""
    xmas = datetime.date(date.year, 12, 25)
    if xmas < date:
        xmas = datetime.date(date.year + 1, 12, 25)
    until = (xmas - date).days // 7
    since = (date - datetime.date(date.year - 1, 12, 25)).days // 7
    start = date - datetime.timedelta(days=6)
    quarter = (start.month + 2) // 3
    last = np.asarray(sales[-4:], float)
    return [last[-1], last[-2], last[-4], last.mean(), (last[-1] - last[-2]) / (last[-2] + ts.EPS), last.std(ddof=1),
            date.isocalendar().week, start.month, quarter, until, since, float(quarter == 4), 1.0 / (until + 1), float(start.month == 12)]


def weekly_forecast(table: DataFrame, jobs: DataFrame, horizon: int = 8) -> DataFrame:
    """D10q the model is fitted on all complete weeks, then each week's inputs come from the weeks
    before it, forecasts included; floored at 0.  Growth is from the last actual week."""
    def run(job: dict, t: pd.DataFrame) -> pd.DataFrame:
        x, y = _parts(t, WEEKLY_FEATURES, "actual")["All"]
        rows = []
        if len(y) >= 4:
            model = boosting.fit(x, y, _settings(job))
            sales, date = list(t["actual"]), t["date"].iloc[-1]
            for step in range(1, horizon + 1):
                date = date + datetime.timedelta(days=7)
                told = max(0.0, float(model.predict(np.array([week_inputs(date, sales)]))[0]))
                sales.append(told)
                rows.append((step, date, told, float(y[-1]), (told - y[-1]) / y[-1] * 100.0 if y[-1] else None))
        return pd.DataFrame(rows, columns=["step", "date", "forecast", "last_actual", "growth_from_last_historical"])

    return on_each(table, jobs, run, "step long, date date, forecast double, last_actual double, growth_from_last_historical double", 1)


# ----------------------------------------------------------- daily forecasts
def daily_jobs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, t) for m in DAILY_MODELS for t in DAILY_TARGETS], "model string, target string")


def _daily_fit(model: str, parts: dict) -> boosting.Booster:
    settings, metric = DAILY_MODELS[model]
    x, y = parts["Validation"]
    return boosting.fit(*parts["Train"], settings, (x, y), PATIENCE, metric)


def daily_metrics(spark: SparkSession, table: DataFrame) -> DataFrame:
    """D6q both boosters on both targets, stopped early on the validation split: metrics of every split."""
    def run(job: dict, t: pd.DataFrame) -> pd.DataFrame:
        parts = _parts(t, DAILY_FEATURES, DAILY_TARGETS[job["target"]])
        rows = []
        if len(parts["Train"][1]) and len(parts["Validation"][1]):
            model = _daily_fit(job["model"], parts)
            rows = [(job["model"], job["target"], s, len(model.trees), *measures(parts[s][1], model.predict(parts[s][0])))
                    for s in ("Train", "Validation", "Test")]
        return pd.DataFrame(rows, columns=["model", "target", "split", "rounds", *[c.split()[0] for c in METRICS.split(", ")]])

    return on_each(table, daily_jobs(spark), run, f"model string, target string, split string, rounds long, {METRICS}",
                   len(DAILY_MODELS) * len(DAILY_TARGETS))


def day_inputs(date: datetime.date, sales: list[float], qty: list[float], weekday_index: dict[int, float],
               months: dict[tuple[int, int], float]) -> list[float]:
    """``DAILY_FEATURES`` of the day after ``sales`` and ``qty``."""
    mean = lambda v, n: float(np.mean(v[-n:]))
    s7, s30, q7, q30 = mean(sales, 7), mean(sales, 30), mean(qty, 7), mean(qty, 30)
    back = lambda k: ((date.year * 12 + date.month - 1 - k) // 12, (date.month - 1 - k) % 12 + 1)
    m1, m2 = months.get(back(1), 0.0), months.get(back(2), 0.0)
    return [sales[-1], qty[-1], sales[-7], qty[-7], sales[-30], qty[-30], weekday_index.get(date.weekday(), 1.0),
            (m1 - m2) / m2 if m2 > 0 else 0.0, date.weekday(), date.month, (date.month + 2) // 3, date.isocalendar().week,
            s7, s30, q7, q30, float(np.std(sales[-30:], ddof=1)), s7 / s30 if s30 > 0 else 1.0, q7 / q30 if q30 > 0 else 1.0]


def daily_forecast(spark: SparkSession, table: DataFrame, horizon: int = 30) -> DataFrame:
    """D9q the booster with the lower test MAPE on sales forecasts sales and quantity day by day:
    every input of a day comes from the days before it, forecasts included; floored at 0."""
    def run(job: dict, t: pd.DataFrame) -> pd.DataFrame:
        parts = {k: _parts(t, DAILY_FEATURES, c) for k, c in DAILY_TARGETS.items()}
        rows = []
        if len(t) >= 30 and all(len(p[s][1]) for p in parts.values() for s in ("Train", "Validation", "Test")):
            model = _daily_fit(job["model"], parts["sales"])
            score = boosting.mape(parts["sales"]["Test"][1], model.predict(parts["sales"]["Test"][0]))
            of_qty = _daily_fit(job["model"], parts["quantity"])
            sales, qty, date = list(t["sales_amount"]), list(t["quantity_sold"]), t["date"].iloc[-1]
            index = {d.weekday(): v for d, v in zip(t["date"], t["weekday_seasonality_index"], strict=True)}
            months: dict[tuple[int, int], float] = {}
            for d, v in zip(t["date"], sales, strict=True):
                months[d.year, d.month] = months.get((d.year, d.month), 0.0) + v
            for step in range(1, horizon + 1):
                date = date + datetime.timedelta(days=1)
                x = np.array([day_inputs(date, sales, qty, index, months)])
                s, q = max(0.0, float(model.predict(x)[0])), max(0.0, float(of_qty.predict(x)[0]))
                sales.append(s)
                qty.append(q)
                months[date.year, date.month] = months.get((date.year, date.month), 0.0) + s
                rows.append((job["model"], score, step, date, s, q))
        return pd.DataFrame(rows, columns=["model", "test_mape", "step", "date", "sales_forecast", "quantity_forecast"])

    jobs = spark.createDataFrame([(m,) for m in DAILY_MODELS], "model string")
    out = on_each(table, jobs, run, "model string, test_mape double, step long, date date, sales_forecast double, quantity_forecast double",
                  len(DAILY_MODELS))
    first = F.dense_rank().over(Window.partitionBy("step").orderBy("test_mape", "model"))  # two rows a step
    return out.withColumn("_r", first).where("_r = 1").drop("_r")


def series_metric_winner(metrics: DataFrame, target: str = "sales") -> DataFrame:
    """D8q of ``daily_metrics``: the model with the lower test MAPE on ``target`` and the 12 % check."""
    from tillroll.operators.forecasting import compare_models
    return compare_models(metrics.where(F.col("target") == target))
