"""Demand time-series plans (D1q–D3q, W12–W26, A5–A8)."""

from __future__ import annotations

from tillroll.operators import timeseries as ts
from tillroll.plans.catalog import register
from tillroll.sources.ledger import ledger_sql, sales_ledger

SALES = ledger_sql()

DAILY_COLS = ("date date, sales_amount double, quantity_sold double, "
              "rolling_7_day_sales double, rolling_30_day_sales double, rolling_90_day_sales double, "
              "rolling_7_day_quantity double, rolling_30_day_quantity double, rolling_90_day_quantity double, "
              "lag_1_sales double, lag_7_sales double, lag_30_sales double, "
              "lag_1_qty double, lag_7_qty double, lag_30_qty double, "
              "weekday_seasonality_index double, monthly_seasonality_index double, seasonality_index double, "
              "sales_growth_rate double, sales_volatility_30_day double, demand_momentum double, "
              "quantity_momentum double")

DAILY_SQL_CTE = f"""
sales AS ({SALES}),
d0 AS (SELECT CAST(date AS DATE) AS date, sum(sales_amount) AS sales_amount,
              sum(quantity_sold) AS quantity_sold FROM sales GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d0),
d AS (SELECT s.date, coalesce(d0.sales_amount, 0.0) AS sales_amount,
             coalesce(d0.quantity_sold, 0.0) AS quantity_sold
      FROM spine s LEFT JOIN d0 ON s.date = d0.date)
"""


@register("daily_features", "A5 J9 W4 W6 W9 W10 W12 W13 W15 D1q", DAILY_COLS, sql=f"""
WITH {DAILY_SQL_CTE},
m AS (SELECT date_trunc('month', date) AS month, CAST(sum(sales_amount) AS DOUBLE) AS ms FROM d GROUP BY 1),
g AS (SELECT month,
             CASE WHEN lag(ms, 2) OVER (ORDER BY month) > 0
                  THEN (lag(ms, 1) OVER (ORDER BY month) - lag(ms, 2) OVER (ORDER BY month))
                       / lag(ms, 2) OVER (ORDER BY month)
                  ELSE 0.0 END AS sales_growth_rate
      FROM m),
f AS (
  SELECT date, sales_amount, quantity_sold,
    CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7_day_sales,
    CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30_day_sales,
    CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS rolling_90_day_sales,
    CAST(sum(quantity_sold) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(quantity_sold) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7_day_quantity,
    CAST(sum(quantity_sold) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(quantity_sold) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30_day_quantity,
    CAST(sum(quantity_sold) OVER (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(quantity_sold) OVER (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS rolling_90_day_quantity,
    lag(sales_amount, 1) OVER (ORDER BY date) AS lag_1_sales,
    lag(sales_amount, 7) OVER (ORDER BY date) AS lag_7_sales,
    lag(sales_amount, 30) OVER (ORDER BY date) AS lag_30_sales,
    lag(quantity_sold, 1) OVER (ORDER BY date) AS lag_1_qty,
    lag(quantity_sold, 7) OVER (ORDER BY date) AS lag_7_qty,
    lag(quantity_sold, 30) OVER (ORDER BY date) AS lag_30_qty,
    (CAST(sum(sales_amount) OVER (PARTITION BY isodow(date)) AS DOUBLE) / count(sales_amount) OVER (PARTITION BY isodow(date))) / (CAST(sum(sales_amount) OVER () AS DOUBLE) / count(sales_amount) OVER () + 1e-5) AS weekday_seasonality_index,
    (CAST(sum(sales_amount) OVER (PARTITION BY month(date)) AS DOUBLE) / count(sales_amount) OVER (PARTITION BY month(date))) / (CAST(sum(sales_amount) OVER () AS DOUBLE) / count(sales_amount) OVER () + 1e-5) AS monthly_seasonality_index,
    coalesce(stddev_samp(CAST(sales_amount AS DOUBLE)) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0.0) AS sales_volatility_30_day
  FROM d)
SELECT f.*, weekday_seasonality_index * monthly_seasonality_index AS seasonality_index,
       coalesce(g.sales_growth_rate, 0.0) AS sales_growth_rate,
       CASE WHEN rolling_30_day_sales > 0 THEN rolling_7_day_sales / rolling_30_day_sales ELSE 1.0 END AS demand_momentum,
       CASE WHEN rolling_30_day_quantity > 0 THEN rolling_7_day_quantity / rolling_30_day_quantity ELSE 1.0 END AS quantity_momentum
FROM f LEFT JOIN g ON date_trunc('month', f.date) = g.month
""")
def daily_features(spark, sf_dir):
    return ts.daily_features(sales_ledger(spark, sf_dir))


WEEKLY_SCHEMA = ("date date, weekly_sales_amount double, weekly_quantity_sold double, days_observed bigint, "
                 "lag_1_weekly_sales double, lag_2_weekly_sales double, lag_4_weekly_sales double, "
                 "rolling_4_week_sales_lag1 double, weekly_sales_growth_rate double, weekly_sales_volatility double, "
                 "week_of_year bigint, week_start_date date, month bigint, quarter bigint, "
                 "weeks_until_christmas bigint, weeks_since_christmas bigint, q4_flag bigint, year_end_flag bigint, "
                 "holiday_proximity_score double")

WEEKLY_SQL_CTE = DAILY_SQL_CTE + """,
wk0 AS (SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS date, sum(sales_amount) AS s,
               sum(quantity_sold) AS q, count(*) AS n FROM d GROUP BY 1),
wspine AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE) AS date FROM wk0),
wk AS (SELECT w.date, CAST(coalesce(s, 0) AS DOUBLE) AS weekly_sales_amount, CAST(coalesce(s, 0) AS DECIMAL(38,4)) AS s_dec, coalesce(q, 0.0) AS weekly_quantity_sold,
              coalesce(n, 0) AS days_observed FROM wspine w LEFT JOIN wk0 ON w.date = wk0.date)"""

XMAS_UNTIL = ("CASE WHEN date_diff('day', date, make_date(year(date), 12, 25)) < 0 "
              "THEN floor(date_diff('day', date, make_date(year(date) + 1, 12, 25)) / 7) "
              "ELSE floor(date_diff('day', date, make_date(year(date), 12, 25)) / 7) END")


def weekly_sql() -> str:
    return f"""
WITH {WEEKLY_SQL_CTE},
l AS (SELECT *, lag(weekly_sales_amount, 1) OVER (ORDER BY date) AS lag_1_weekly_sales,
             lag(weekly_sales_amount, 2) OVER (ORDER BY date) AS lag_2_weekly_sales,
             lag(weekly_sales_amount, 4) OVER (ORDER BY date) AS lag_4_weekly_sales,
             lag(s_dec, 1) OVER (ORDER BY date) AS l1dec FROM wk)
SELECT date, weekly_sales_amount, weekly_quantity_sold, days_observed, lag_1_weekly_sales, lag_2_weekly_sales,
       lag_4_weekly_sales,
       CASE WHEN count(lag_1_weekly_sales) OVER w4 = 4 THEN CAST(sum(l1dec) OVER w4 AS DOUBLE) / count(l1dec) OVER w4 END AS rolling_4_week_sales_lag1,
       (lag_1_weekly_sales - lag_2_weekly_sales) / (lag_2_weekly_sales + 1e-5) AS weekly_sales_growth_rate,
       CASE WHEN count(lag_1_weekly_sales) OVER w4 = 4 THEN stddev_samp(lag_1_weekly_sales) OVER w4 END AS weekly_sales_volatility,
       weekofyear(date) AS week_of_year, date - 6 AS week_start_date, month(date - 6) AS month,
       quarter(date - 6) AS quarter, {XMAS_UNTIL} AS weeks_until_christmas,
       floor(date_diff('day', make_date(year(date) - 1, 12, 25), date) / 7) AS weeks_since_christmas,
       CASE WHEN quarter(date - 6) = 4 THEN 1 ELSE 0 END AS q4_flag,
       CASE WHEN month(date - 6) = 12 THEN 1 ELSE 0 END AS year_end_flag,
       1.0::DOUBLE / ({XMAS_UNTIL} + 1) AS holiday_proximity_score
FROM l WINDOW w4 AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""


@register("weekly_features", "A7 W4 W8 W17 F2 F7 F8 F9 F10 D3q", WEEKLY_SCHEMA, sql=weekly_sql())
def weekly_features(spark, sf_dir):
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return ts.weekly_features(daily)


@register("partial_weeks", "W26 A7 D5q",
          "date date, weekly_sales_amount double, days_in_span bigint, is_partial_week bigint",
          sql=f"""WITH {WEEKLY_SQL_CTE},
sp AS (SELECT min(date) AS lo, max(date) AS hi FROM d)
SELECT date, weekly_sales_amount,
       date_diff('day', greatest(date - 6, lo), least(date, hi)) + 1 AS days_in_span,
       CASE WHEN date_diff('day', greatest(date - 6, lo), least(date, hi)) + 1 < 7 THEN 1 ELSE 0 END AS is_partial_week
FROM wk, sp""")
def partial_weeks(spark, sf_dir):
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return ts.flag_partial_weeks(ts.weekly_features(daily), daily)


@register("monthly_growth_current", "W16 A8",
          "month date, monthly_sales double, sales_growth_rate double",
          sql=f"""WITH {DAILY_SQL_CTE},
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(sales_amount) AS DOUBLE) AS monthly_sales FROM d GROUP BY 1)
SELECT month, monthly_sales,
       coalesce(CASE WHEN lag(monthly_sales) OVER (ORDER BY month) <> 0
                     THEN monthly_sales / lag(monthly_sales) OVER (ORDER BY month) - 1 END, 0.0) AS sales_growth_rate
FROM m""")
def monthly_growth_current(spark, sf_dir):
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return ts.monthly_growth(daily, "current")


@register("monthly_growth_lagged", "W15 A8",
          "month date, monthly_sales double, sales_growth_rate double",
          sql=f"""WITH {DAILY_SQL_CTE},
m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(sum(sales_amount) AS DOUBLE) AS ms FROM d GROUP BY 1)
SELECT month, ms AS monthly_sales,
       CASE WHEN lag(ms, 2) OVER (ORDER BY month) > 0
            THEN (lag(ms, 1) OVER (ORDER BY month) - lag(ms, 2) OVER (ORDER BY month)) / lag(ms, 2) OVER (ORDER BY month)
            ELSE 0.0 END AS sales_growth_rate
FROM m""")
def monthly_growth_lagged(spark, sf_dir):
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return ts.monthly_growth(daily, "lagged")


PDF_SCHEMA = ("date date, product_id string, daily_sales_amount double, daily_quantity_sold double, "
              "product_lag_1_sales double, product_lag_7_sales double, product_lag_1_qty double, "
              "product_lag_7_qty double, product_rolling_7_sales double, product_rolling_30_sales double, "
              "product_rolling_7_qty double, product_rolling_30_qty double, product_demand_momentum double, "
              "global_weekday_seasonality double, global_monthly_seasonality double")


def _pw(k: int) -> str:
    return f"(PARTITION BY product_id ORDER BY date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


@register("product_daily_features", "A6 W5 W7 W10 W14 A20 J2 D2q", PDF_SCHEMA, sql=f"""
WITH sales AS ({SALES}),
pd AS (SELECT CAST(date AS DATE) AS date, product_id, sum(sales_amount) AS s, sum(quantity_sold) AS q
       FROM sales GROUP BY 1, 2),
dd AS (SELECT CAST(date AS DATE) AS date, sum(sales_amount) AS s FROM sales GROUP BY 1),
gm AS (SELECT CAST(sum(s) AS DOUBLE) / count(s) AS m FROM dd),
wd AS (SELECT isodow(date) - 1 AS k, CAST(sum(s) AS DOUBLE) / count(DISTINCT date) AS mean FROM dd GROUP BY 1),
mo AS (SELECT month(date) AS k, CAST(sum(s) AS DOUBLE) / count(DISTINCT date) AS mean FROM dd GROUP BY 1),
f AS (
  SELECT date, product_id, CAST(s AS DOUBLE) AS daily_sales_amount, q AS daily_quantity_sold,
    CAST(lag(s, 1) OVER (PARTITION BY product_id ORDER BY date) AS DOUBLE) AS product_lag_1_sales,
    CAST(lag(s, 7) OVER (PARTITION BY product_id ORDER BY date) AS DOUBLE) AS product_lag_7_sales,
    lag(q, 1) OVER (PARTITION BY product_id ORDER BY date) AS product_lag_1_qty,
    lag(q, 7) OVER (PARTITION BY product_id ORDER BY date) AS product_lag_7_qty,
    CAST(sum(s) OVER {_pw(7)} AS DOUBLE) / count(s) OVER {_pw(7)} AS product_rolling_7_sales,
    CAST(sum(s) OVER {_pw(30)} AS DOUBLE) / count(s) OVER {_pw(30)} AS product_rolling_30_sales,
    sum(q) OVER {_pw(7)} / count(q) OVER {_pw(7)} AS product_rolling_7_qty,
    sum(q) OVER {_pw(30)} / count(q) OVER {_pw(30)} AS product_rolling_30_qty
  FROM pd)
SELECT f.*, CASE WHEN product_rolling_30_sales > 0 THEN product_rolling_7_sales / product_rolling_30_sales ELSE 1.0 END
              AS product_demand_momentum,
       wd.mean / gm.m AS global_weekday_seasonality, mo.mean / gm.m AS global_monthly_seasonality
FROM f CROSS JOIN gm LEFT JOIN wd ON isodow(f.date) - 1 = wd.k LEFT JOIN mo ON month(f.date) = mo.k""")
def product_daily_features(spark, sf_dir):
    return ts.product_daily_features(sales_ledger(spark, sf_dir))


@register("seasonal_decompose", "W21",
          "date date, sales_amount double, trend double, seasonal double, resid double", sql=f"""
WITH {DAILY_SQL_CTE},
x AS (SELECT date, CAST(sales_amount AS DOUBLE) AS v,
             CASE WHEN count(sales_amount) OVER c = 7 THEN CAST(sum(sales_amount) OVER c AS DOUBLE) / 7 END AS trend,
             (row_number() OVER (ORDER BY date) - 1) % 7 AS phase
      FROM d WINDOW c AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ph AS (SELECT phase, avg(v - trend) AS pm FROM x GROUP BY phase),
ph2 AS (SELECT phase, pm - avg(pm) OVER () AS seasonal FROM ph)
SELECT date, v AS sales_amount, trend, seasonal, v - trend - seasonal AS resid FROM x JOIN ph2 USING (phase)""")
def seasonal_decompose(spark, sf_dir):
    from pyspark.sql import functions as F
    d = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return ts.decompose_additive(d, "sales_amount", 7).withColumn(
        "sales_amount", F.col("sales_amount").cast("double"))


@register("daily_gap_audit", "W19 W20 Q7",
          "product_id string, rows bigint, first_date date, last_date date, distinct_dates bigint, "
          "irregular_steps bigint, out_of_order bigint, missing_dates bigint", sql=f"""
WITH sales AS ({SALES}),
pd AS (SELECT CAST(date AS DATE) AS date, product_id, min(CAST(ltrim(transaction_id, 'C') AS BIGINT)) AS seq FROM sales GROUP BY 1, 2),
st AS (SELECT product_id, date, date_diff('day', lag(date) OVER (PARTITION BY product_id ORDER BY date), date) AS step,
              lag(date) OVER (PARTITION BY product_id ORDER BY seq) > date AS back FROM pd)
SELECT product_id, count(*) AS rows, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS distinct_dates,
       count(*) FILTER (WHERE step <> 1) AS irregular_steps, count(*) FILTER (WHERE back) AS out_of_order,
       floor(date_diff('day', min(date), max(date)) / 1) + 1 - count(DISTINCT date) AS missing_dates
FROM st GROUP BY product_id""")
def daily_gap_audit(spark, sf_dir):
    """The order under audit is that of the ledger's order numbers."""
    from pyspark.sql import functions as F
    from tillroll.functions import calendar as cal
    from tillroll.session import partitions_for
    led = sales_ledger(spark, sf_dir)
    n = partitions_for(led)
    number = F.ltrim(F.col("transaction_id"), F.lit("C")).cast("long").alias("seq")
    days = led.select("product_id", cal.day("date").alias("date"), number).repartition(n, "product_id", "date")
    pd = days.groupBy("product_id", "date").agg(F.min("seq").alias("seq")).repartition(n, "product_id")
    return ts.gap_audit(pd, "date", 1, ["product_id"], "seq")


@register("weekly_trend", "W23 W24", "slope double, intercept double, time_corr double, n bigint", sql=f"""
WITH {WEEKLY_SQL_CTE},
t AS (SELECT weekly_sales_amount AS v, CAST(row_number() OVER (ORDER BY date) - 1 AS DOUBLE) AS t FROM wk)
SELECT regr_slope(v, t) AS slope, regr_intercept(v, t) AS intercept,
       CASE WHEN stddev_pop(v) > 0 AND stddev_pop(t) > 0 THEN corr(v, t) END AS time_corr, count(*) AS n FROM t""")
def weekly_trend(spark, sf_dir):
    from pyspark.sql import functions as F
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    wk = ts.weekly_sales(daily).withColumn("weekly_sales_amount", F.col("weekly_sales_amount").cast("double"))
    return ts.trend_slope(wk, "weekly_sales_amount")


REMEDIATED = ["rolling_7_day_sales", "rolling_30_day_sales", "rolling_90_day_sales", "sales_volatility_30_day",
              "demand_momentum"]


@register("daily_features_remediated", "P15 P16 P17 D1q",
          "date date, sales_amount double, lag_1_sales double, lag_7_sales double, "
          "weekday_seasonality_index double, rolling_7_day_sales_lag1 double, rolling_30_day_sales_lag1 double, "
          "rolling_90_day_sales_lag1 double, sales_volatility_30_day_lag1 double, demand_momentum_lag1 double, "
          "day_of_week bigint, month bigint, quarter bigint, week_of_year bigint", sql=f"""
WITH {DAILY_SQL_CTE},
f AS (
  SELECT date, CAST(sales_amount AS DOUBLE) AS sales_amount,
    CAST(lag(sales_amount, 1) OVER (ORDER BY date) AS DOUBLE) AS lag_1_sales,
    CAST(lag(sales_amount, 7) OVER (ORDER BY date) AS DOUBLE) AS lag_7_sales,
    (CAST(sum(sales_amount) OVER (PARTITION BY isodow(date)) AS DOUBLE) / count(sales_amount) OVER (PARTITION BY isodow(date)))
      / (CAST(sum(sales_amount) OVER () AS DOUBLE) / count(sales_amount) OVER () + 1e-5) AS weekday_seasonality_index,
    CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS r7,
    CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS r30,
    CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS r90,
    coalesce(stddev_samp(CAST(sales_amount AS DOUBLE)) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0.0) AS vol
  FROM d),
g AS (SELECT *, CASE WHEN r30 > 0 THEN r7 / r30 ELSE 1.0 END AS mom FROM f)
SELECT date, sales_amount, lag_1_sales, lag_7_sales, weekday_seasonality_index,
       lag(r7) OVER (ORDER BY date) AS rolling_7_day_sales_lag1, lag(r30) OVER (ORDER BY date) AS rolling_30_day_sales_lag1,
       lag(r90) OVER (ORDER BY date) AS rolling_90_day_sales_lag1, lag(vol) OVER (ORDER BY date) AS sales_volatility_30_day_lag1,
       lag(mom) OVER (ORDER BY date) AS demand_momentum_lag1,
       isodow(date) - 1 AS day_of_week, month(date) AS month, quarter(date) AS quarter, weekofyear(date) AS week_of_year
FROM g""")
def daily_features_remediated(spark, sf_dir):
    feats = ts.daily_features(sales_ledger(spark, sf_dir))
    drop = ["quantity_sold", "rolling_7_day_quantity", "rolling_30_day_quantity", "rolling_90_day_quantity",
            "lag_30_sales", "lag_1_qty", "lag_7_qty", "lag_30_qty", "monthly_seasonality_index",
            "seasonality_index", "sales_growth_rate", "quantity_momentum"]
    return ts.ensure_calendar(ts.remediate_leakage(feats, drop, REMEDIATED))


@register("feature_recompute_audit", "Q8 W4 W6", "feature string, rows bigint, mismatches bigint", sql=f"""
WITH {DAILY_SQL_CTE},
st AS (SELECT date, CAST(sales_amount AS DOUBLE) AS v,
              CAST(lag(sales_amount, 7) OVER (ORDER BY date) AS DOUBLE) AS lag_7_sales,
              CAST(sum(sales_amount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
                / count(sales_amount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7_day_sales
       FROM d),
re AS (SELECT *, lag(v, 7) OVER (ORDER BY date) AS lag7_re,
              avg(v) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS r7_re FROM st)
SELECT 'lag_7_sales' AS feature, count(*) AS rows,
       count(*) FILTER (WHERE NOT coalesce((lag_7_sales IS NULL AND lag7_re IS NULL) OR abs(lag_7_sales - lag7_re) <= 1e-6, FALSE)) AS mismatches FROM re
UNION ALL
SELECT 'rolling_7_day_sales', count(*),
       count(*) FILTER (WHERE NOT coalesce((rolling_7_day_sales IS NULL AND r7_re IS NULL) OR abs(rolling_7_day_sales - r7_re) <= 1e-6, FALSE)) FROM re""")
def feature_recompute_audit(spark, sf_dir):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tillroll.operators import quality as qu
    feats = ts.daily_features(sales_ledger(spark, sf_dir))
    w = Window.orderBy("date")
    lag7 = F.lag("sales_amount", 7).over(w)  # recomputed from the stored target column
    r7 = F.avg("sales_amount").over(w.rowsBetween(-6, 0))
    return qu.verify_feature(feats, "lag_7_sales", lag7).unionByName(
        qu.verify_feature(feats, "rolling_7_day_sales", r7, tol=1e-6))
