"""Forecast evaluation and serving (D4q–D15q, W18, W22–W25, E3, E4, E12).

Evaluation works on any table of (date, actual, predicted, split).  The
deterministic forecaster here is a seasonal naive one (value of the same
period one season earlier, falling back to the last actual); the model-based
forecasters live in :mod:`tillroll.operators.ml`.  Forecast tables are
calendar-sized, so their windows are plain ordered windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import exact_mean, exact_mean_over, exact_sum
from tillroll.operators.timeseries import chrono_split

MAPE_TARGET = 12.0
# Week labels by days after Christmas of the week-ending date
# (inclusive ranges), default label otherwise.
WEEK_LABELS = [(-6, 0, "Holiday restocking peak"), (1, 7, "Post-Christmas taper"),
               (8, 14, "New Year demand drop"), (15, 21, "Seasonal winter bottom"),
               (22, 35, "Post-holiday recovery")]
DEFAULT_WEEK_LABEL = "Winter stabilization"


def forecast_metrics(df: DataFrame, actual: str = "actual", pred: str = "predicted",
                     by: str | None = "split") -> DataFrame:
    """D4q MAPE over non-zero actuals (%), MAE, RMSE, R² (null when the
    actuals are constant) per ``by`` group."""
    err = F.col(actual) - F.col(pred)
    ape = F.when(F.col(actual) != 0, F.abs(err / F.col(actual)))
    keys = [by] if by else []
    mean_y = exact_mean_over(actual, Window.partitionBy(*keys))
    x = df.withColumn("_dev2", (F.col(actual) - mean_y) * (F.col(actual) - mean_y)).withColumn("_ape", ape).withColumn(
        "_ae", F.abs(err)).withColumn("_se", err * err)
    g = x.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(exact_mean("_ape") * 100.0, F.lit(0.0)).alias("mape"),
        exact_mean("_ae").alias("mae"), F.sqrt(exact_mean("_se")).alias("rmse"),
        exact_sum("_se").alias("_sse"), exact_sum("_dev2").alias("_sst"))
    return g.withColumn("r2", F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst"))).drop("_sse", "_sst")


def naive_daily_predictions(daily: DataFrame, season: int = 7, val: int = 30, test: int = 30) -> DataFrame:
    """Seasonal-naive daily predictions (value ``season`` days earlier) with
    the chronological split (W25); rows without a prediction are Dropped."""
    w = Window.orderBy("date")
    x = daily.select("date", F.col("sales_amount").cast("double").alias("actual"),
                     F.lag(F.col("sales_amount").cast("double"), season).over(w).alias("predicted"))
    return chrono_split(x, val, test, required=["predicted"])


def compare_models(metrics: DataFrame, model_col: str = "model", split: str = "Test") -> DataFrame:
    """D8q lower test MAPE wins; flag whether it meets the target."""
    t = metrics.filter(F.col("split") == split)
    best = t.agg(F.min_by(model_col, F.struct("mape", model_col)).alias("winner"),
                 F.min("mape").alias("winner_mape"))
    return best.withColumn("meets_target", F.when(F.col("winner_mape") <= MAPE_TARGET, 1).otherwise(0))


def residual_report(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """D12q mean residual, population std, counts of over / under forecasts."""
    r = F.col(actual) - F.col(predicted)
    x = pred.withColumn("_r", r)
    return x.agg(F.count(F.lit(1)).alias("n"), exact_mean("_r").alias("mean_residual"),
                 F.stddev_pop("_r").alias("std_residual"),
                 F.sum(F.when(F.col("_r") < 0, 1).otherwise(0)).alias("over_forecasts"),
                 F.sum(F.when(F.col("_r") > 0, 1).otherwise(0)).alias("under_forecasts"))


def prediction_errors(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """D13q per-row error and % error."""
    e = F.col(actual) - F.col(predicted)
    return pred.withColumn("error", e).withColumn(
        "pct_error", F.when(F.col(actual) != 0, e / F.col(actual) * 100.0))


def largest_misses(pred: DataFrame, k: int = 5, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """T6 k largest absolute residuals (tie-break date)."""
    x = prediction_errors(pred, actual, predicted).withColumn("abs_error", F.abs("error"))
    return x.orderBy(F.col("abs_error").desc(), F.col("date")).limit(k)


def seasonal_naive_future(weekly: DataFrame, horizon: int = 8, season_days: int = 364,
                          value: str = "weekly_sales_amount") -> DataFrame:
    """Future weeks after the last observed week: forecast = the value one
    season earlier (else the last actual), floored at 0; growth from the
    last historical value (%)."""
    last = weekly.agg(F.max_by(value, "date").alias("_last_val"), F.max("date").alias("_last_date"))
    fut = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    fut = fut.withColumn("date", F.date_add("_last_date", F.col("step") * 7)).withColumn(
        "_src", F.date_sub(F.col("date"), season_days))
    hist = weekly.select(F.col("date").alias("_src"), F.col(value).alias("_season"))
    fut = fut.join(hist, "_src", "left")  # both sides calendar-sized
    f = F.greatest(F.lit(0.0), F.coalesce("_season", "_last_val"))
    return fut.select("step", "date", f.alias("forecast"), F.col("_last_val").alias("last_actual"),
                      F.when(F.col("_last_val") != 0, (f - F.col("_last_val")) / F.col("_last_val") * 100.0)
                      .alias("growth_from_last_historical"))


def wow_growth(future: DataFrame) -> DataFrame:
    """W18 first row vs last actual, then each row vs the previous forecast (%)."""
    w = Window.orderBy("date")
    prev = F.lag("forecast").over(w)
    g = F.when(prev.isNull(), F.col("growth_from_last_historical")).otherwise(
        F.when(prev != 0, (F.col("forecast") - prev) / prev * 100.0))
    return future.withColumn("wow_growth", g)


def demand_alerts(future: DataFrame, pct: float = 15.0) -> DataFrame:
    """E3 per future week: surge / drop beyond ±pct, holiday-peak week
    (week ending 12-19..12-22)."""
    x = wow_growth(future)
    md = F.date_format("date", "MM-dd")
    return x.withColumn("alert", F.when(F.col("wow_growth") > pct, "surge").when(F.col("wow_growth") < -pct, "drop")
    ).withColumn("holiday_peak", F.when(md.isin("12-19", "12-20", "12-21", "12-22"), 1).otherwise(0))


def trend_label(future: DataFrame) -> DataFrame:
    """E4 (W23) least-squares slope over the horizon → label; W22 percent
    change of the last 4 vs the first 4 forecasts → up / down / flat."""
    w = Window.orderBy("date")
    n = F.count(F.lit(1)).over(Window.partitionBy())
    x = future.withColumn("_t", (F.row_number().over(w) - 1).cast("double")).withColumn("_n", n)
    g = x.agg(F.regr_slope("forecast", "_t").alias("slope"), F.regr_intercept("forecast", "_t").alias("intercept"),
              exact_mean(F.when(F.col("_t") < 4, F.col("forecast"))).alias("_first4"),
              exact_mean(F.when(F.col("_t") >= F.col("_n") - 4, F.col("forecast"))).alias("_last4"))
    s = F.col("slope")
    lab = (F.when(s > 5000, "Strong Growth").when(s > 1000, "Moderate Growth").when(s < -5000, "Strong Decline")
            .when(s < -1000, "Moderate Decline").otherwise("Stable"))
    chg = F.when(F.col("_first4") != 0, (F.col("_last4") - F.col("_first4")) / F.col("_first4") * 100.0)
    return g.select("slope", "intercept", lab.alias("trend"), chg.alias("pct_change_ahead"),
                    F.when(chg > 5, "up").when(chg < -5, "down").otherwise("flat").alias("direction"))


def forecast_summary(future: DataFrame) -> DataFrame:
    """D15q total, mean, peak, peak week (T8 arg-max)."""
    return future.agg(exact_sum("forecast").alias("total_forecast"), exact_mean("forecast").alias("mean_forecast"),
                      F.max("forecast").alias("peak_forecast"),
                      F.max_by("date", F.struct("forecast", "date")).alias("peak_date"))


def label_weeks(future: DataFrame) -> DataFrame:
    """E12 phase label by days after the season's Christmas (fixed ranges)."""
    d = F.col("date")
    xmas = F.when(F.month(d) >= 7, F.make_date(F.year(d), F.lit(12), F.lit(25))).otherwise(
        F.make_date(F.year(d) - 1, F.lit(12), F.lit(25)))
    off = F.datediff(d, xmas)
    lab = F.lit(DEFAULT_WEEK_LABEL)
    for lo, hi, name in reversed(WEEK_LABELS):
        lab = F.when((off >= lo) & (off <= hi), F.lit(name)).otherwise(lab)
    return future.withColumn("days_after_christmas", off).withColumn("label", lab)


def tail_series(df: DataFrame, n: int = 16, order: str = "date") -> DataFrame:
    """T7 last n rows of a series, back in ascending order."""
    return df.orderBy(F.col(order).desc()).limit(n).orderBy(order)


def append_history_future(hist: DataFrame, future: DataFrame) -> DataFrame:
    """U3 chart rows: history and forecast stacked (``unionByName`` with
    missing columns allowed)."""
    h = hist.select("date", F.col("weekly_sales_amount").alias("actual"), F.lit("historical").alias("kind"))
    f = future.select("date", "forecast", F.lit("forecast").alias("kind"))
    return h.unionByName(f, allowMissingColumns=True)


def forecast_document(history: DataFrame, future: DataFrame, info: dict) -> DataFrame:
    """D14q/S4 one nested row: model_info struct + historical and future
    arrays of structs (calendar-sized arrays)."""
    hist = history.agg(F.sort_array(F.collect_list(F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("actual").cast("double").alias("actual"),
        F.col("predicted").cast("double").alias("predicted"), F.col("split")))).alias("historical"))
    fut = future.agg(F.sort_array(F.collect_list(F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("forecast").cast("double").alias("forecast"),
        F.col("growth_from_last_historical").cast("double").alias("growth_from_last_historical")))).alias("future"))
    mi = F.struct(*[F.lit(v).alias(k) for k, v in info.items()]).alias("model_info")
    return hist.crossJoin(fut).select(mi, "historical", "future")

