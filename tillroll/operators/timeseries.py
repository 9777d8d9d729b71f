"""Time-series features and audits (A5–A8, J9, W4–W26, D1q–D3q).

Series at calendar grain (one row per day / week / month) are bounded by the
calendar, not by the data, so they use ordinary ordered windows.  Panel
series (one per product) are windowed with ``partitionBy(product_id)``.
The line-level work (the day or day×product sums) is a partial aggregation
before the only shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import calendar as cal
from tillroll.functions.numeric import safe_corr
from tillroll.session import cut_lineage

EPS = 1e-5


# ---------------------------------------------------------------- aggregates
def daily_sales(sales: DataFrame) -> DataFrame:
    """A5 total amount and quantity per calendar day (trading days only).

    One row per day — bounded by the calendar, not the data — and read by
    several branches (spine, windows, growth, seasonality), so it is
    materialised once with a reliable checkpoint instead of re-aggregating
    the ledger per branch."""
    return cut_lineage(sales.groupBy(cal.day("date").alias("date")).agg(
        F.sum("sales_amount").alias("sales_amount"),
        F.sum("quantity_sold").alias("quantity_sold")))


def product_daily(sales: DataFrame) -> DataFrame:
    """A6 amount and quantity per (day, product)."""
    return sales.groupBy(cal.day("date").alias("date"), "product_id").agg(
        F.sum("sales_amount").alias("daily_sales_amount"),
        F.sum("quantity_sold").alias("daily_quantity_sold"))


def monthly_sales(sales: DataFrame, value: str = "sales_amount") -> DataFrame:
    """A8 sum per month, keyed by month end."""
    return sales.groupBy(cal.month_end("date").alias("month_end")).agg(
        F.sum(value).alias(value))


def calendar_spine(df: DataFrame, date_col: str = "date", step: str = "1 day") -> DataFrame:
    """Every date between the min and max of ``date_col`` (one row per day)."""
    bounds = df.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(date_col))


def densify_daily(daily: DataFrame, cols: Sequence[str], date_col: str = "date",
                  fill: float = 0.0) -> DataFrame:
    """J9 calendar spine left join: absent days get ``fill``."""
    spine = calendar_spine(daily, date_col)
    return spine.join(daily, date_col, "left").select(
        date_col, *[F.coalesce(F.col(c), F.lit(fill)).alias(c) for c in cols])


def weekly_sales(daily: DataFrame) -> DataFrame:
    """A7 weeks ending Sunday: sums and number of days observed; weeks with no
    observed day inside the span come back as zero rows."""
    wk = daily.groupBy(cal.week_ending_sunday("date").alias("date")).agg(
        F.sum("sales_amount").alias("weekly_sales_amount"),
        F.sum("quantity_sold").alias("weekly_quantity_sold"),
        F.count(F.lit(1)).alias("days_observed"))
    spine = calendar_spine(wk, "date", "7 days")
    return spine.join(wk, "date", "left").select(
        "date",
        F.coalesce("weekly_sales_amount", F.lit(0.0)).alias("weekly_sales_amount"),
        F.coalesce("weekly_quantity_sold", F.lit(0.0)).alias("weekly_quantity_sold"),
        F.coalesce("days_observed", F.lit(0)).cast("long").alias("days_observed"))


# ------------------------------------------------------------------ windows
def _w(order: str, partition: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*partition).orderBy(order) if partition else Window.orderBy(order)


def window_mean(col: str, w: Window) -> Column:
    """(exact window sum) / count — decimal inputs give engine-independent means."""
    return F.sum(col).over(w).cast("double") / F.count(col).over(w)


def rolling_mean(col: str, n: int, order: str = "date", partition: Sequence[str] = (),
                 min_periods: int = 1) -> Column:
    """W6/W7/W8 trailing mean over ``n`` rows incl. the current one; null
    until ``min_periods`` rows are present."""
    w = _w(order, partition).rowsBetween(-(n - 1), 0)
    m = window_mean(col, w)
    if min_periods <= 1:
        return m
    return F.when(F.count(col).over(w) >= min_periods, m)


def rolling_std(col: str, n: int, order: str = "date", partition: Sequence[str] = (),
                min_periods: int = 1, fill: float | None = 0.0) -> Column:
    """W8/W9 trailing sample std; a single observation gives ``fill``."""
    w = _w(order, partition).rowsBetween(-(n - 1), 0)
    s = F.stddev_samp(col).over(w)
    if min_periods > 1:
        s = F.when(F.count(col).over(w) >= min_periods, s)
    return F.coalesce(s, F.lit(fill)) if fill is not None else s


def lag(col: str, k: int, order: str = "date", partition: Sequence[str] = ()) -> Column:
    """W4/W5 value ``k`` rows back (rows, not days, for sparse panels)."""
    return F.lag(col, k).over(_w(order, partition))


def momentum(short: Column, long: Column) -> Column:
    """W10 short / long mean; 1.0 when the long mean is not positive."""
    return F.when(long > 0, short / long).otherwise(F.lit(1.0))


def seasonality_index(value: str, key: Column) -> Column:
    """W12 mean of ``value`` within ``key`` ÷ (overall mean + 1e-5)."""
    return window_mean(value, Window.partitionBy(key)) / (window_mean(value, Window.partitionBy()) + EPS)


# ------------------------------------------------------------ feature tables
def monthly_growth(daily: DataFrame, mode: str = "lagged") -> DataFrame:
    """W15/W16 month-over-month growth per calendar month.

    ``lagged``: growth of M−1 over M−2 (0 when M−2 ≤ 0), leak-free.
    ``current``: M over M−1 − 1 (first month and zero denominators → 0)."""
    m = daily.groupBy(cal.month_start("date").alias("month")).agg(
        F.sum("sales_amount").cast("double").alias("monthly_sales"))
    w = Window.orderBy("month")
    p1, p2 = F.lag("monthly_sales", 1).over(w), F.lag("monthly_sales", 2).over(w)
    if mode == "lagged":
        g = F.when(p2 > 0, (p1 - p2) / p2).otherwise(F.lit(0.0))
    elif mode == "current":
        g = F.coalesce(F.when(p1 != 0, F.col("monthly_sales") / p1 - 1), F.lit(0.0))
    else:
        raise ValueError(mode)
    return m.select("month", "monthly_sales", g.alias("sales_growth_rate"))


def daily_features(sales: DataFrame, growth_mode: str = "lagged") -> DataFrame:
    """D1q: the 22-column daily forecasting table."""
    d = densify_daily(daily_sales(sales), ["sales_amount", "quantity_sold"])
    d = d.withColumn("sales_amount", F.col("sales_amount").cast("decimal(28,4)"))
    growth = monthly_growth(d, growth_mode).select("month", "sales_growth_rate")
    d = d.withColumn("_month", cal.month_start("date")).withColumn(
        "_amt", F.col("sales_amount").cast("double"))
    feats = d.select(
        "date", "_month", "sales_amount", "quantity_sold",
        rolling_mean("sales_amount", 7).alias("rolling_7_day_sales"),
        rolling_mean("sales_amount", 30).alias("rolling_30_day_sales"),
        rolling_mean("sales_amount", 90).alias("rolling_90_day_sales"),
        rolling_mean("quantity_sold", 7).alias("rolling_7_day_quantity"),
        rolling_mean("quantity_sold", 30).alias("rolling_30_day_quantity"),
        rolling_mean("quantity_sold", 90).alias("rolling_90_day_quantity"),
        *[lag("sales_amount", k).cast("double").alias(f"lag_{k}_sales") for k in (1, 7, 30)],
        *[lag("quantity_sold", k).alias(f"lag_{k}_qty") for k in (1, 7, 30)],
        seasonality_index("sales_amount", cal.day_of_week("date")).alias("weekday_seasonality_index"),
        seasonality_index("sales_amount", F.month("date")).alias("monthly_seasonality_index"),
        rolling_std("_amt", 30).alias("sales_volatility_30_day"),
    )
    feats = feats.withColumn(
        "seasonality_index", F.col("weekday_seasonality_index") * F.col("monthly_seasonality_index")
    ).withColumn("demand_momentum", momentum(F.col("rolling_7_day_sales"), F.col("rolling_30_day_sales"))
    ).withColumn("quantity_momentum", momentum(F.col("rolling_7_day_quantity"), F.col("rolling_30_day_quantity")))
    out = feats.join(F.broadcast(growth), feats._month == growth.month, "left")
    return out.select(
        "date", F.col("sales_amount").cast("double").alias("sales_amount"), "quantity_sold",
        "rolling_7_day_sales", "rolling_30_day_sales", "rolling_90_day_sales",
        "rolling_7_day_quantity", "rolling_30_day_quantity", "rolling_90_day_quantity",
        "lag_1_sales", "lag_7_sales", "lag_30_sales", "lag_1_qty", "lag_7_qty", "lag_30_qty",
        "weekday_seasonality_index", "monthly_seasonality_index", "seasonality_index",
        F.coalesce("sales_growth_rate", F.lit(0.0)).alias("sales_growth_rate"),
        "sales_volatility_30_day", "demand_momentum", "quantity_momentum")


def remediate_leakage(df: DataFrame, drop: Sequence[str], shift: Sequence[str],
                      order: str = "date") -> DataFrame:
    """P17 drop listed features and replace each unsafe one by its lag-1
    (renamed ``<name>_lag1``)."""
    w = Window.orderBy(order)
    out = df.drop(*drop)
    for c in shift:
        out = out.withColumn(f"{c}_lag1", F.lag(c, 1).over(w)).drop(c)
    return out


def ensure_calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """P16 add only the calendar columns that are absent."""
    wanted = {
        "day_of_week": cal.day_of_week(date_col), "month": F.month(date_col),
        "quarter": F.quarter(date_col), "week_of_year": cal.iso_week(date_col),
    }
    for name, expr in wanted.items():
        if name not in df.columns:
            df = df.withColumn(name, expr)
    return df


def weekly_features(daily: DataFrame, wrap_christmas: bool = True) -> DataFrame:
    """D3q: weekly (Sunday-ending) table with lags, lag-1 rolling stats,
    growth and holiday calendar features."""
    wk = weekly_sales(daily)
    w = Window.orderBy("date")
    # exact (decimal) lag-1 values feed the rolling mean; doubles elsewhere
    wk = wk.withColumn("_l1dec", F.lag(F.col("weekly_sales_amount").cast("decimal(38,4)"), 1).over(w))
    wk = wk.withColumn("weekly_sales_amount", F.col("weekly_sales_amount").cast("double"))
    l1 = F.lag("weekly_sales_amount", 1).over(w)
    wk = wk.withColumn("lag_1_weekly_sales", l1).withColumn(
        "lag_2_weekly_sales", F.lag("weekly_sales_amount", 2).over(w)).withColumn(
        "lag_4_weekly_sales", F.lag("weekly_sales_amount", 4).over(w))
    w4 = w.rowsBetween(-3, 0)
    full = F.count("lag_1_weekly_sales").over(w4) == 4
    ws = cal.week_start("date")
    return wk.select(
        "date", "weekly_sales_amount", "weekly_quantity_sold", "days_observed",
        "lag_1_weekly_sales", "lag_2_weekly_sales", "lag_4_weekly_sales",
        F.when(full, window_mean("_l1dec", w4)).alias("rolling_4_week_sales_lag1"),
        ((F.col("lag_1_weekly_sales") - F.col("lag_2_weekly_sales"))
         / (F.col("lag_2_weekly_sales") + EPS)).alias("weekly_sales_growth_rate"),
        F.when(full, F.stddev_samp("lag_1_weekly_sales").over(w4)).alias("weekly_sales_volatility"),
        cal.iso_week("date").alias("week_of_year"),
        ws.alias("week_start_date"), F.month(ws).alias("month"), F.quarter(ws).alias("quarter"),
        cal.weeks_until_christmas("date", wrap=wrap_christmas).alias("weeks_until_christmas"),
        cal.weeks_since_christmas("date").alias("weeks_since_christmas"),
        *cal.holiday_flags("date"),
    )


def flag_partial_weeks(weekly: DataFrame, daily: DataFrame) -> DataFrame:
    """W26 weeks with fewer than 7 calendar days inside the observed span."""
    span = daily.agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    wk = weekly.crossJoin(F.broadcast(span))  # one-row scalar
    lo = F.greatest(cal.week_start("date"), F.col("_lo"))
    hi = F.least(F.col("date"), F.col("_hi"))
    days = F.datediff(hi, lo) + 1
    return wk.select(
        "date", "weekly_sales_amount", days.cast("long").alias("days_in_span"),
        F.when(days < 7, 1).otherwise(0).alias("is_partial_week"))


def densify_panel(pdy: DataFrame, key: str = "product_id", cols: Sequence[str] = (
        "daily_sales_amount", "daily_quantity_sold"), to_last: bool = False) -> DataFrame:
    """J9 per series: every day between the series' own first and last day
    (``to_last``: the last day of all series), absent days filled with 0
    (output is linear in the spans)."""
    span = pdy.groupBy(key).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    if to_last:
        span = span.drop("_hi").crossJoin(F.broadcast(pdy.agg(F.max("date").alias("_hi"))))
    spine = span.select(key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    j = spine.join(pdy, [key, "date"], "left")
    return j.select("date", key, *[F.coalesce(F.col(c), F.lit(0).cast(pdy.schema[c].dataType)).alias(c) for c in cols])


def product_daily_features(sales: DataFrame, calendar: bool = False) -> DataFrame:
    """D2q: product-day panel with per-product lags / rolling means and
    global weekday / month seasonality.  Rows are selling days (D17, the
    reference's choice); ``calendar=True`` densifies each product's own span
    first so lags and windows count calendar days."""
    pdy = product_daily(sales)
    if calendar:
        pdy = densify_panel(pdy)
    pw = ("product_id",)
    r7 = rolling_mean("daily_sales_amount", 7, partition=pw)
    r30 = rolling_mean("daily_sales_amount", 30, partition=pw)
    panel = pdy.select(
        "date", "product_id", "daily_sales_amount", "daily_quantity_sold",
        lag("daily_sales_amount", 1, partition=pw).alias("product_lag_1_sales"),
        lag("daily_sales_amount", 7, partition=pw).alias("product_lag_7_sales"),
        lag("daily_quantity_sold", 1, partition=pw).alias("product_lag_1_qty"),
        lag("daily_quantity_sold", 7, partition=pw).alias("product_lag_7_qty"),
        r7.alias("product_rolling_7_sales"), r30.alias("product_rolling_30_sales"),
        rolling_mean("daily_quantity_sold", 7, partition=pw).alias("product_rolling_7_qty"),
        rolling_mean("daily_quantity_sold", 30, partition=pw).alias("product_rolling_30_qty"),
        momentum(r7, r30).alias("product_demand_momentum"))
    seas = global_seasonality(sales)
    wd = seas.filter(F.col("kind") == "weekday").select(
        F.col("key").alias("_dow"), F.col("index").alias("global_weekday_seasonality"))
    mo = seas.filter(F.col("kind") == "month").select(
        F.col("key").alias("_mo"), F.col("index").alias("global_monthly_seasonality"))
    panel = panel.withColumn("_dow", cal.day_of_week("date")).withColumn("_mo", F.month("date"))
    # both index tables have at most 7 / 12 rows
    return (panel.join(F.broadcast(wd), "_dow", "left")
                 .join(F.broadcast(mo), "_mo", "left")
                 .drop("_dow", "_mo"))


def global_seasonality(sales: DataFrame) -> DataFrame:
    """Σ amount ÷ distinct trading days per weekday / month, divided
    by the mean trading-day total (no epsilon).  Long form: kind, key, index."""
    d = daily_sales(sales).select("date", "sales_amount")
    overall = d.agg((F.sum("sales_amount").cast("double") / F.count("sales_amount")).alias("_m"))
    by = d.select(
        F.explode(F.array(
            F.struct(F.lit("weekday").alias("kind"), cal.day_of_week("date").alias("key")),
            F.struct(F.lit("month").alias("kind"), F.month("date").alias("key")))).alias("k"),
        "sales_amount", "date")
    g = by.groupBy("k.kind", "k.key").agg(
        (F.sum("sales_amount").cast("double") / F.countDistinct("date")).alias("_mean"))
    return g.crossJoin(F.broadcast(overall)).select(
        "kind", "key", (F.col("_mean") / F.col("_m")).alias("index"))


# -------------------------------------------------------------------- audits
def gap_audit(df: DataFrame, date_col: str = "date", step_days: int = 1,
              group: Sequence[str] = (), sequence: str | None = None) -> DataFrame:
    """W19/W20 per series: rows, span, distinct dates, missing dates in the
    span, steps different from ``step_days``, and, in the order of the column
    ``sequence`` (not of the date under audit), the steps back in time."""
    step = F.datediff(F.col(date_col), F.lag(date_col, 1).over(_w(date_col, group)))
    back = F.lit(False) if sequence is None else F.lag(date_col, 1).over(_w(sequence, group)) > F.col(date_col)
    x = df.select(*group, date_col, step.alias("_step"), back.alias("_back"))
    g = x.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
        F.countDistinct(date_col).alias("distinct_dates"),
        F.sum(F.when(F.col("_step") != step_days, 1).otherwise(0)).alias("irregular_steps"),
        F.sum(F.when(F.col("_back"), 1).otherwise(0)).alias("out_of_order"))
    expected = F.floor(F.datediff("last_date", "first_date") / step_days) + 1
    return g.withColumn("missing_dates", (expected - F.col("distinct_dates")).cast("long"))


def decompose_additive(series: DataFrame, value: str, period: int = 7,
                       date_col: str = "date") -> DataFrame:
    """W21 additive decomposition (odd period): centred moving-average trend,
    seasonal = phase mean of the detrended series, centred to mean 0,
    residual = value − trend − seasonal."""
    half = period // 2
    w = Window.orderBy(date_col)
    wc = w.rowsBetween(-half, half)
    x = series.select(date_col, value,
                      F.when(F.count(value).over(wc) == period, F.avg(value).over(wc)).alias("trend"),
                      F.pmod(F.row_number().over(w) - 1, F.lit(period)).alias("phase"))
    x = x.withColumn("_detr", F.col(value) - F.col("trend"))
    ph = x.groupBy("phase").agg(F.avg("_detr").alias("_pm"))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy()))
    out = x.join(F.broadcast(ph.select("phase", "seasonal")), "phase")
    return out.select(date_col, value, "trend", "seasonal",
                      (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"))


def chrono_split(df: DataFrame, val: int, test: int, order: str = "date",
                 required: Sequence[str] = ()) -> DataFrame:
    """W25 last ``test`` complete rows → test, the ``val`` before → val, the
    rest → train; rows with a null in ``required`` → Dropped."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    x = df.withColumn("_ok", complete)
    w = Window.partitionBy("_ok").orderBy(F.col(order).desc())
    rn = F.row_number().over(w)
    split = (F.when(~F.col("_ok"), "Dropped").when(rn <= test, "Test")
              .when(rn <= test + val, "Validation").otherwise("Train"))
    return x.withColumn("split", split).drop("_ok")


def trend_slope(df: DataFrame, value: str, order: str = "date") -> DataFrame:
    """W23/W24 least-squares slope and intercept of ``value`` on 0..n−1 and
    the correlation with the time index."""
    x = df.withColumn("_t", (F.row_number().over(Window.orderBy(order)) - 1).cast("double"))
    return x.agg(F.regr_slope(value, "_t").alias("slope"),
                 F.regr_intercept(value, "_t").alias("intercept"),
                 safe_corr(value, "_t").alias("time_corr"),
                 F.count(F.lit(1)).alias("n"))
