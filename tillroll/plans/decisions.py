"""Decision-layer plans: cross-module merges, recommendations, alerts,
KPIs, forecast evaluation (J4–J7, U1–U3, C16–C19, E1–E14, D4q–D15q, T*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.numeric import xmean_sql, xsum_sql
from tillroll.operators import customers as cu
from tillroll.operators import decisions as de
from tillroll.operators import forecasting as fc
from tillroll.operators import inventory as iv
from tillroll.operators import timeseries as ts
from tillroll.plans.catalog import register
from tillroll.plans.customers import CUTOFF, HORIZON, customer_features_sql, pred_sql
from tillroll.plans.demand import DAILY_SQL_CTE, WEEKLY_SQL_CTE
from tillroll.plans.inventory import HEALTH_EXPR, HEALTH_SQL, inventory_sql, master_sql
from tillroll.sources.ledger import ledger_sql, sales_ledger, stock_balances

SEG_RULE = ("CASE WHEN customer_loyalty_score >= 7 THEN 'Cluster 0' WHEN customer_loyalty_score >= 4 "
            "THEN 'Cluster 1' ELSE 'Cluster 2' END")

SEG_CTE = f"""{customer_features_sql()},
{pred_sql(with_sales=False)},
seg AS (SELECT *, {SEG_RULE} AS cluster FROM cf WHERE monetary > 0 AND quantity_per_order > 0)"""

MERGE_CTE = SEG_CTE + """,
merged AS (
  SELECT coalesce(s.customer_id, p.customer_id) AS customer_id, s.cluster, s.high_value_customer_flag,
         s.average_purchase_value, s.customer_tenure, p.churn_probability, p.true_churn_flag, p.risk_category,
         coalesce(s.recency, p.recency) AS recency, coalesce(s.frequency, p.frequency) AS frequency,
         coalesce(s.monetary, p.monetary) AS monetary,
         coalesce(s.customer_loyalty_score, p.customer_loyalty_score) AS customer_loyalty_score,
         CASE WHEN s.customer_id IS NOT NULL AND p.customer_id IS NOT NULL THEN 'Matched'
              WHEN s.customer_id IS NOT NULL THEN 'Segmentation only' ELSE 'Churn only' END AS match_status
  FROM seg s FULL OUTER JOIN pred p ON s.customer_id = p.customer_id)"""


def _segments(led):
    return de.segmentation_table(cu.customer_features(led))


def _scores(led):
    return cu.rule_churn_scores(cu.churn_dataset(led, CUTOFF, HORIZON))


def _views(spark, sf_dir):
    """Ledger, segmentation and churn scores, the two from one pass over the ledger; a plan
    that needs one of them builds only that one (each is materialised when built)."""
    led = sales_ledger(spark, sf_dir)
    feats, churn = cu.features_and_churn(led, CUTOFF, HORIZON)
    return led, de.segmentation_table(feats), cu.rule_churn_scores(churn)


# columns that are null on one side of the outer join are declared double
MERGED_SCHEMA = ("customer_id string, cluster string, high_value_customer_flag double, average_purchase_value double, "
                 "customer_tenure double, churn_probability double, true_churn_flag double, risk_category string, "
                 "recency bigint, frequency bigint, monetary double, customer_loyalty_score double, match_status string")


@register("customer_merge", "J4 J5 J6 F22", MERGED_SCHEMA, sql=f"WITH {MERGE_CTE} SELECT * FROM merged")
def customer_merge(spark, sf_dir):
    _, seg, pred = _views(spark, sf_dir)
    return de.merge_customer_views(seg, pred)


@register("customer_merge_validation", "J7 U2",
          "left_rows bigint, right_rows bigint, matched bigint, left_only bigint, right_only bigint",
          sql=f"""WITH {SEG_CTE}
SELECT (SELECT count(*) FROM seg) AS left_rows, (SELECT count(*) FROM pred) AS right_rows,
       (SELECT count(*) FROM (SELECT customer_id FROM seg INTERSECT SELECT customer_id FROM pred)) AS matched,
       (SELECT count(*) FROM (SELECT customer_id FROM seg EXCEPT SELECT customer_id FROM pred)) AS left_only,
       (SELECT count(*) FROM (SELECT customer_id FROM pred EXCEPT SELECT customer_id FROM seg)) AS right_only""")
def customer_merge_validation(spark, sf_dir):
    _, seg, pred = _views(spark, sf_dir)
    return de.merge_validation(seg, pred)


@register("common_customers", "U1", "customer_id string",
          sql=f"WITH {SEG_CTE} SELECT customer_id FROM seg INTERSECT SELECT customer_id FROM pred")
def common_customers(spark, sf_dir):
    _, seg, pred = _views(spark, sf_dir)
    return de.common_keys(seg, pred)


@register("unmatched_customers", "U2", "customer_id string, side string",
          sql=f"""WITH {SEG_CTE}
SELECT customer_id, 'left_only' AS side FROM (SELECT customer_id FROM seg EXCEPT SELECT customer_id FROM pred)
UNION ALL
SELECT customer_id, 'right_only' AS side FROM (SELECT customer_id FROM pred EXCEPT SELECT customer_id FROM seg)""")
def unmatched_customers(spark, sf_dir):
    _, seg, pred = _views(spark, sf_dir)
    return de.unmatched_keys(seg, pred)


def _recs_sql() -> str:
    def rec(k):
        a, p = de.CUSTOMER_ACTIONS[k]
        return f"{{'action': '{a}', 'priority': '{p}'}}"
    band = "coalesce(risk_category, 'Unknown')"
    return MERGE_CTE + f""",
r AS (SELECT customer_id, match_status, list_filter([
        CASE WHEN {band} = 'High Risk' OR (churn_probability IS NOT NULL AND churn_probability >= 0.7) THEN {rec('retention')}
             WHEN {band} = 'Medium Risk' OR (churn_probability IS NOT NULL AND churn_probability >= 0.4) THEN {rec('reengage')} END,
        CASE WHEN high_value_customer_flag = 1 OR cluster = 'Cluster 0' OR monetary > 2000 THEN {rec('vip')} END,
        CASE WHEN ({band} = 'Low Risk' OR (churn_probability IS NOT NULL AND churn_probability < 0.4))
                  AND recency IS NOT NULL AND recency <= 45 THEN {rec('cross_sell')} END,
        CASE WHEN recency IS NOT NULL AND recency > 90 THEN {rec('win_back')} END], lambda x: x IS NOT NULL) AS recs
      FROM merged),
r2 AS (SELECT customer_id, match_status, CASE WHEN len(recs) > 0 THEN recs ELSE [{rec('nurture')}] END AS recs FROM r)"""


RECS_SQL = _recs_sql()


@register("customer_recommendations", "C19 F21", "customer_id string, match_status string, rule_rank bigint, "
          "action string, priority string",
          sql=f"""WITH {RECS_SQL}
SELECT customer_id, match_status, i AS rule_rank, recs[i].action AS action, recs[i].priority AS priority
FROM r2, range(1, len(recs) + 1) t(i)""")
def customer_recommendations(spark, sf_dir):
    _, seg, pred = _views(spark, sf_dir)
    return de.recommend_customers(de.merge_customer_views(seg, pred))


@register("customer_360", "E11 J14 J4 C19",
          MERGED_SCHEMA + ", n_recommendations bigint, top_action string",
          sql=f"""WITH {RECS_SQL}
SELECT m.*, len(recs) AS n_recommendations, recs[1].action AS top_action
FROM merged m JOIN r2 ON m.customer_id = r2.customer_id""")
def customer_360(spark, sf_dir):
    _, seg, pred = _views(spark, sf_dir)
    merged = de.merge_customer_views(seg, pred)
    recs = de.recommend_customers(merged).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_recommendations"), F.min_by("action", "rule_rank").alias("top_action"))
    return merged.join(recs, "customer_id")


SEG_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in cu.SEGMENT_LABELS.items())


@register("segment_profile", "C16 E7 F17 A12",
          "cluster string, seg_order bigint, segment_name string, customers bigint, revenue double, "
          "pct_customers double, pct_revenue double, avg_recency double, avg_frequency double, "
          "avg_monetary double, avg_basket double, avg_tenure double",
          sql=f"""WITH {SEG_CTE},
o AS (SELECT * FROM (VALUES ('Cluster 0', 0), ('Cluster 1', 1), ('Cluster 2', 2)) t(cluster, seg_order)),
g AS (SELECT cluster, count(*) AS customers, {xsum_sql('monetary')} AS revenue, {xmean_sql('recency')} AS avg_recency,
             {xmean_sql('frequency')} AS avg_frequency, {xmean_sql('monetary')} AS avg_monetary,
             {xmean_sql('average_purchase_value')} AS avg_basket, {xmean_sql('customer_tenure')} AS avg_tenure
      FROM seg GROUP BY cluster)
SELECT o.cluster, seg_order, CASE o.cluster {SEG_LABELS} ELSE o.cluster END AS segment_name,
       coalesce(customers, 0) AS customers, coalesce(revenue, 0.0) AS revenue,
       coalesce(customers, 0) * 100.0::DOUBLE / sum(coalesce(customers, 0)) OVER () AS pct_customers,
       coalesce(revenue, 0.0) * 100.0::DOUBLE / sum(coalesce(revenue, 0.0)) OVER () AS pct_revenue,
       avg_recency, avg_frequency, avg_monetary, avg_basket, avg_tenure
FROM o LEFT JOIN g ON o.cluster = g.cluster""")
def segment_profile(spark, sf_dir):
    seg = _segments(sales_ledger(spark, sf_dir))
    return de.segment_profile(seg)


AUDIT_COLS = ["recency", "frequency", "monetary", "average_purchase_value", "customer_tenure"]


@register("cluster_audit", "C17 P20",
          "column string, cluster_mean double, cluster_min double, cluster_max double, n_negative bigint, "
          "n_below_one bigint, n_zero bigint, overall_mean double, cluster_median double:8",
          sql=f"""WITH {SEG_CTE},
mem AS (SELECT * FROM seg WHERE customer_id IN (SELECT customer_id FROM seg WHERE cluster = 'Cluster 1')),
""" + ",\n".join(f"""a_{c} AS (SELECT '{c}' AS "column", {xmean_sql(f'CAST({c} AS DOUBLE)')} AS cluster_mean,
    min(CAST({c} AS DOUBLE)) AS cluster_min, max(CAST({c} AS DOUBLE)) AS cluster_max,
    count(*) FILTER (WHERE {c} < 0) AS n_negative, count(*) FILTER (WHERE {c} < 1) AS n_below_one,
    count(*) FILTER (WHERE {c} = 0) AS n_zero,
    (SELECT {xmean_sql(f'CAST({c} AS DOUBLE)')} FROM seg) AS overall_mean,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) AS cluster_median FROM mem)""" for c in AUDIT_COLS) + "\n" +
          " UNION ALL ".join(f"SELECT * FROM a_{c}" for c in AUDIT_COLS))
def cluster_audit(spark, sf_dir):
    seg = _segments(sales_ledger(spark, sf_dir))
    return de.cluster_audit(seg, "Cluster 1", AUDIT_COLS)


@register("outlier_profile", "C18",
          "customers bigint, ultra_high_spenders bigint, high_frequency_buyers bigint, premium_basket_buyers bigint, "
          "low_value_lapsed bigint, ultra_spend_total double, ultra_spend_mean double, ultra_spend_max double, "
          "ultra_avg_frequency double, high_freq_spend_total double, high_freq_avg_frequency double, "
          "high_freq_max_frequency double",
          sql=f"""WITH {SEG_CTE}
SELECT count(*) AS customers, count(*) FILTER (WHERE monetary > 10000) AS ultra_high_spenders,
       count(*) FILTER (WHERE frequency > 20) AS high_frequency_buyers,
       count(*) FILTER (WHERE average_purchase_value > 1000) AS premium_basket_buyers,
       count(*) FILTER (WHERE monetary < 100 AND recency > 300) AS low_value_lapsed,
       {xsum_sql('CASE WHEN monetary > 10000 THEN monetary END')} AS ultra_spend_total,
       {xmean_sql('CASE WHEN monetary > 10000 THEN monetary END')} AS ultra_spend_mean,
       max(CASE WHEN monetary > 10000 THEN monetary END) AS ultra_spend_max,
       {xmean_sql('CASE WHEN monetary > 10000 THEN frequency END')} AS ultra_avg_frequency,
       {xsum_sql('CASE WHEN frequency > 20 THEN monetary END')} AS high_freq_spend_total,
       {xmean_sql('CASE WHEN frequency > 20 THEN frequency END')} AS high_freq_avg_frequency,
       max(CASE WHEN frequency > 20 THEN frequency END) AS high_freq_max_frequency
FROM seg""")
def outlier_profile(spark, sf_dir):
    seg = _segments(sales_ledger(spark, sf_dir))
    return de.outlier_profile(seg)


@register("top_spenders", "T5", "customer_id string, monetary double, frequency bigint, recency bigint, cluster string",
          sql=f"""WITH {SEG_CTE}
SELECT customer_id, monetary, frequency, recency, cluster FROM seg ORDER BY monetary DESC, customer_id LIMIT 20""")
def top_spenders(spark, sf_dir):
    seg = _segments(sales_ledger(spark, sf_dir))
    return de.top_k(seg, "monetary", 20, "customer_id").select("customer_id", "monetary", "frequency", "recency", "cluster")


@register("top_risk_customers", "T3 C13", "customer_id string, churn_probability double, risk_category string, monetary double",
          sql=f"""WITH {pred_sql()}
SELECT customer_id, churn_probability, risk_category, monetary FROM pred
ORDER BY churn_probability DESC, customer_id LIMIT 20""")
def top_risk_customers(spark, sf_dir):
    pred = _scores(sales_ledger(spark, sf_dir))
    return de.top_k(pred, "churn_probability", 20, "customer_id").select(
        "customer_id", "churn_probability", "risk_category", "monetary")


@register("top_products", "T1 A4", "product_id string, revenue double, quantity double",
          sql=f"""WITH sales AS ({ledger_sql()})
SELECT product_id, CAST(sum(sales_amount) AS DOUBLE) AS revenue, sum(quantity_sold) AS quantity
FROM sales GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10""")
def top_products(spark, sf_dir):
    led = sales_ledger(spark, sf_dir)
    p = led.groupBy("product_id").agg(F.sum("sales_amount").cast("double").alias("revenue"),
                                      F.sum("quantity_sold").alias("quantity"))
    return de.top_k(p, "revenue", 10, "product_id")


EXEC_SCHEMA = ("total_customers bigint, total_revenue double, num_segments bigint, high_value_customers bigint, "
               "high_risk_customers bigint, health_score double, critical_products bigint, "
               "reorder_recommendations bigint, avg_customer_value double, high_risk_pct double, "
               "health_status string, churn_status string")


@register("executive_kpis", "E1 E2 E14", EXEC_SCHEMA, sql=f"""WITH {SEG_CTE},
{inventory_sql(with_sales=False)}, {HEALTH_SQL},
m AS ({master_sql()}),
s AS (SELECT count(*) AS total_customers, {xsum_sql('monetary')} AS total_revenue, count(DISTINCT cluster) AS num_segments,
             count(*) FILTER (WHERE high_value_customer_flag = 1) AS high_value_customers FROM seg),
c AS (SELECT count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk_customers, count(*) AS scored FROM pred),
i AS (SELECT count(*) FILTER (WHERE risk_category = 'Critical') AS critical_products FROM inv),
r AS (SELECT count(*) AS reorder_recommendations FROM (SELECT 1 FROM m WHERE risk_category IN ('Critical', 'High'))),
x AS (SELECT s.*, c.high_risk_customers, {HEALTH_EXPR} AS health_score, i.critical_products, r.reorder_recommendations,
             CASE WHEN total_customers > 0 THEN total_revenue / total_customers ELSE 0.0 END AS avg_customer_value,
             CASE WHEN scored > 0 THEN high_risk_customers * 100.0::DOUBLE / scored ELSE 0.0 END AS high_risk_pct
      FROM s, c, h, i, r)
SELECT *, CASE WHEN health_score >= 80.0 THEN 'good' WHEN health_score >= 50.0 THEN 'warning' ELSE 'critical' END AS health_status,
       CASE WHEN high_risk_pct >= 20.0 THEN 'critical' WHEN high_risk_pct >= 10.0 THEN 'warning' ELSE 'good' END AS churn_status
FROM x""")
def executive_kpis(spark, sf_dir):
    led, seg, pred = _views(spark, sf_dir)
    inv = iv.inventory_table(led, stock_balances(spark, sf_dir))
    return de.executive_kpis(seg, pred, iv.health_score(inv), inv, iv.reorder_recommendations(inv, None))


# ----------------------------------------------------------- forecasting
def _weekly(spark, sf_dir):
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return ts.weekly_sales(daily).withColumn("weekly_sales_amount", F.col("weekly_sales_amount").cast("double"))


def _future(spark, sf_dir):
    return fc.seasonal_naive_future(_weekly(spark, sf_dir), 8, 364)


FUTURE_CTE = WEEKLY_SQL_CTE + """,
lst AS (SELECT arg_max(weekly_sales_amount, date) AS last_val, max(date) AS last_date FROM wk),
fut0 AS (SELECT step, last_date + CAST(7 * step AS INTEGER) AS date, last_val FROM lst, range(1, 9) t(step)),
fut AS (SELECT step, fut0.date, greatest(0.0::DOUBLE, coalesce(h.weekly_sales_amount, last_val)) AS forecast,
               last_val AS last_actual FROM fut0 LEFT JOIN wk h ON h.date = fut0.date - 364),
future AS (SELECT *, CASE WHEN last_actual <> 0 THEN (forecast - last_actual) / last_actual * 100.0::DOUBLE END
                  AS growth_from_last_historical FROM fut),
alerts AS (
  SELECT *, CASE WHEN wow_growth > 15 THEN 'surge' WHEN wow_growth < -15 THEN 'drop' END AS alert,
         CASE WHEN strftime(date, '%m-%d') IN ('12-19', '12-20', '12-21', '12-22') THEN 1 ELSE 0 END AS holiday_peak
  FROM (SELECT *, CASE WHEN lag(forecast) OVER (ORDER BY date) IS NULL THEN growth_from_last_historical
                       WHEN lag(forecast) OVER (ORDER BY date) <> 0
                       THEN (forecast - lag(forecast) OVER (ORDER BY date)) / lag(forecast) OVER (ORDER BY date) * 100.0::DOUBLE
                  END AS wow_growth FROM future))"""


@register("weekly_forecast_naive", "U3 W18 D10q (seasonal naive)",
          "step bigint, date date, forecast double, last_actual double, growth_from_last_historical double",
          sql=f"WITH {FUTURE_CTE} SELECT * FROM future")
def weekly_forecast_naive(spark, sf_dir):
    return _future(spark, sf_dir)


@register("demand_alerts", "E3 W18", "date date, forecast double, wow_growth double, alert string, holiday_peak bigint",
          sql=f"WITH {FUTURE_CTE} SELECT date, forecast, wow_growth, alert, holiday_peak FROM alerts")
def demand_alerts(spark, sf_dir):
    return fc.demand_alerts(_future(spark, sf_dir)).select("date", "forecast", "wow_growth", "alert", "holiday_peak")


@register("forecast_trend", "E4 W22 W23",
          "slope double, intercept double, trend string, pct_change_ahead double, direction string",
          sql=f"""WITH {FUTURE_CTE},
t AS (SELECT forecast, CAST(row_number() OVER (ORDER BY date) - 1 AS DOUBLE) AS t, count(*) OVER () AS n FROM future),
g AS (SELECT regr_slope(forecast, t) AS slope, regr_intercept(forecast, t) AS intercept,
             {xmean_sql('CASE WHEN t < 4 THEN forecast END')} AS f4, {xmean_sql('CASE WHEN t >= n - 4 THEN forecast END')} AS l4 FROM t)
SELECT slope, intercept,
       CASE WHEN slope > 5000 THEN 'Strong Growth' WHEN slope > 1000 THEN 'Moderate Growth'
            WHEN slope < -5000 THEN 'Strong Decline' WHEN slope < -1000 THEN 'Moderate Decline' ELSE 'Stable' END AS trend,
       CASE WHEN f4 <> 0 THEN (l4 - f4) / f4 * 100.0::DOUBLE END AS pct_change_ahead,
       CASE WHEN (CASE WHEN f4 <> 0 THEN (l4 - f4) / f4 * 100.0::DOUBLE END) > 5 THEN 'up'
            WHEN (CASE WHEN f4 <> 0 THEN (l4 - f4) / f4 * 100.0::DOUBLE END) < -5 THEN 'down' ELSE 'flat' END AS direction
FROM g""")
def forecast_trend(spark, sf_dir):
    return fc.trend_label(_future(spark, sf_dir))


@register("forecast_summary", "D15q T8",
          "total_forecast double, mean_forecast double, peak_forecast double, peak_date date",
          sql=f"""WITH {FUTURE_CTE}
SELECT {xsum_sql('forecast')} AS total_forecast, {xmean_sql('forecast')} AS mean_forecast, max(forecast) AS peak_forecast,
       arg_max(date, (forecast, date)) AS peak_date FROM future""")
def forecast_summary(spark, sf_dir):
    return fc.forecast_summary(_future(spark, sf_dir))


@register("forecast_week_labels", "E12", "date date, forecast double, days_after_christmas bigint, label string",
          sql=f"""WITH {FUTURE_CTE},
l AS (SELECT date, forecast, date_diff('day', CASE WHEN month(date) >= 7 THEN make_date(year(date), 12, 25)
                                                    ELSE make_date(year(date) - 1, 12, 25) END, date) AS off FROM future)
SELECT date, forecast, off AS days_after_christmas,
       CASE {' '.join(f"WHEN off BETWEEN {lo} AND {hi} THEN '{n}'" for lo, hi, n in fc.WEEK_LABELS)}
            ELSE '{fc.DEFAULT_WEEK_LABEL}' END AS label FROM l""")
def forecast_week_labels(spark, sf_dir):
    return fc.label_weeks(_future(spark, sf_dir)).select("date", "forecast", "days_after_christmas", "label")


@register("alert_summary", "E5 E6",
          "high_risk_customers bigint, revenue_at_risk double, critical_products bigint, immediate_reorders bigint, "
          "surges bigint, drops bigint, holiday_peaks bigint, next_surge_week date, critical_alerts bigint, "
          "warning_alerts bigint, opportunity_alerts bigint, total_alerts bigint",
          sql=f"""WITH {FUTURE_CTE}, {pred_sql(with_sales=False)}, {inventory_sql(with_sales=False)},
c AS (SELECT count(*) FILTER (WHERE churn_probability > 0.70) AS high_risk_customers,
             {xsum_sql('CASE WHEN churn_probability > 0.70 THEN monetary END')} AS revenue_at_risk FROM pred),
i AS (SELECT count(*) FILTER (WHERE risk_category = 'Critical') AS critical_products,
             count(*) FILTER (WHERE reorder_urgency >= 0.80) AS immediate_reorders FROM inv),
dal AS (SELECT count(*) FILTER (WHERE alert = 'surge') AS surges, count(*) FILTER (WHERE alert = 'drop') AS drops,
             sum(holiday_peak) AS holiday_peaks, min(CASE WHEN alert = 'surge' THEN date END) AS next_surge_week FROM alerts),
x AS (SELECT * FROM c, i, dal)
SELECT *, (CASE WHEN high_risk_customers > 100 THEN 1 ELSE 0 END) + (CASE WHEN critical_products > 50 THEN 1 ELSE 0 END) + drops AS critical_alerts,
       (CASE WHEN high_risk_customers > 0 AND high_risk_customers <= 100 THEN 1 ELSE 0 END)
       + (CASE WHEN critical_products > 0 AND critical_products <= 50 THEN 1 ELSE 0 END)
       + (CASE WHEN immediate_reorders > 0 THEN 1 ELSE 0 END) AS warning_alerts,
       surges + holiday_peaks AS opportunity_alerts,
       (CASE WHEN high_risk_customers > 100 THEN 1 ELSE 0 END) + (CASE WHEN critical_products > 50 THEN 1 ELSE 0 END) + drops
       + (CASE WHEN high_risk_customers > 0 AND high_risk_customers <= 100 THEN 1 ELSE 0 END)
       + (CASE WHEN critical_products > 0 AND critical_products <= 50 THEN 1 ELSE 0 END)
       + (CASE WHEN immediate_reorders > 0 THEN 1 ELSE 0 END) + surges + holiday_peaks AS total_alerts
FROM x""")
def alert_summary(spark, sf_dir):
    led = sales_ledger(spark, sf_dir)
    pred = _scores(led)
    return de.alert_summary(pred, iv.inventory_table(led, stock_balances(spark, sf_dir)), fc.demand_alerts(_future(spark, sf_dir)))


@register("history_tail", "T7", "date date, weekly_sales_amount double",
          sql=f"WITH {WEEKLY_SQL_CTE} SELECT date, weekly_sales_amount FROM wk ORDER BY date DESC LIMIT 16")
def history_tail(spark, sf_dir):
    return fc.tail_series(_weekly(spark, sf_dir), 16).select("date", "weekly_sales_amount")


@register("forecast_chart_rows", "U3", "date date, actual double, forecast double, kind string",
          sql=f"""WITH {FUTURE_CTE}
SELECT date, weekly_sales_amount AS actual, CAST(NULL AS DOUBLE) AS forecast, 'historical' AS kind FROM wk
UNION ALL SELECT date, CAST(NULL AS DOUBLE), forecast, 'forecast' FROM future""")
def forecast_chart_rows(spark, sf_dir):
    return fc.append_history_future(_weekly(spark, sf_dir), _future(spark, sf_dir))


NAIVE_CTE = DAILY_SQL_CTE + """,
nx AS (SELECT date, CAST(sales_amount AS DOUBLE) AS actual,
              lag(CAST(sales_amount AS DOUBLE), {season}) OVER (ORDER BY date) AS predicted FROM d),
ny AS (SELECT *, row_number() OVER (PARTITION BY predicted IS NOT NULL ORDER BY date DESC) AS rn FROM nx),
nz AS (SELECT date, actual, predicted, CASE WHEN predicted IS NULL THEN 'Dropped' WHEN rn <= 30 THEN 'Test'
                                           WHEN rn <= 60 THEN 'Validation' ELSE 'Train' END AS split FROM ny)"""


MEAN_BY_SPLIT = ("CAST(sum(CAST(actual AS DECIMAL(38,6))) OVER (PARTITION BY split) AS DOUBLE)"
                 " / count(actual) OVER (PARTITION BY split)")


def _metrics_sql(src: str) -> str:
    return f"""e AS (SELECT *, CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END AS ape,
               abs(actual - predicted) AS ae, (actual - predicted) * (actual - predicted) AS se,
               (actual - {MEAN_BY_SPLIT}) * (actual - {MEAN_BY_SPLIT}) AS dev2
        FROM {src} WHERE split <> 'Dropped')
SELECT split, count(*) AS n, coalesce({xmean_sql('ape')} * 100.0, 0.0) AS mape, {xmean_sql('ae')} AS mae,
       sqrt({xmean_sql('se')}) AS rmse, CASE WHEN {xsum_sql('dev2')} > 0 THEN 1 - {xsum_sql('se')} / {xsum_sql('dev2')} END AS r2
FROM e GROUP BY split"""


METRICS_SCHEMA = "split string, n bigint, mape double, mae double, rmse double, r2 double"


def _naive(spark, sf_dir, season=7):
    d = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return fc.naive_daily_predictions(d, season, 30, 30)


@register("forecast_metrics_naive", "D4q W25", METRICS_SCHEMA,
          sql=f"WITH {NAIVE_CTE.format(season=7)}, {_metrics_sql('nz')}")
def forecast_metrics_naive(spark, sf_dir):
    return fc.forecast_metrics(_naive(spark, sf_dir).filter(F.col("split") != "Dropped"))


@register("forecast_model_comparison", "D8q", "winner string, winner_mape double, meets_target bigint",
          sql=f"""WITH {NAIVE_CTE.format(season=7)},
a AS (SELECT 'seasonal_naive_7' AS model, * FROM nz),
b AS (SELECT 'naive_1' AS model, date, actual, lag(actual, 1) OVER (ORDER BY date) AS predicted, split FROM nz),
t AS (SELECT model, coalesce({xmean_sql('CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END')} * 100.0, 0.0) AS mape
      FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE split = 'Test' GROUP BY model)
SELECT arg_min(model, (mape, model)) AS winner, min(mape) AS winner_mape,
       CASE WHEN min(mape) <= 12.0 THEN 1 ELSE 0 END AS meets_target FROM t""")
def forecast_model_comparison(spark, sf_dir):
    from pyspark.sql import Window
    n7 = _naive(spark, sf_dir).filter(F.col("split") != "Dropped")
    n1 = _naive(spark, sf_dir).withColumn("predicted", F.lag("actual", 1).over(Window.orderBy("date")))
    n1 = n1.filter(F.col("split") != "Dropped")
    m = (fc.forecast_metrics(n7).withColumn("model", F.lit("seasonal_naive_7"))
         .unionByName(fc.forecast_metrics(n1).withColumn("model", F.lit("naive_1"))))
    return fc.compare_models(m)


@register("forecast_residuals", "D12q", "n bigint, mean_residual double, std_residual double, over_forecasts bigint, "
          "under_forecasts bigint",
          sql=f"""WITH {NAIVE_CTE.format(season=7)}
SELECT count(*) AS n, {xmean_sql('actual - predicted')} AS mean_residual, stddev_pop(actual - predicted) AS std_residual,
       count(*) FILTER (WHERE actual - predicted < 0) AS over_forecasts,
       count(*) FILTER (WHERE actual - predicted > 0) AS under_forecasts
FROM nz WHERE split = 'Test'""")
def forecast_residuals(spark, sf_dir):
    return fc.residual_report(_naive(spark, sf_dir).filter(F.col("split") == "Test"))


@register("largest_misses", "T6 D13q", "date date, actual double, predicted double, error double, pct_error double, abs_error double",
          sql=f"""WITH {NAIVE_CTE.format(season=7)}
SELECT date, actual, predicted, actual - predicted AS error,
       CASE WHEN actual <> 0 THEN (actual - predicted) / actual * 100.0::DOUBLE END AS pct_error,
       abs(actual - predicted) AS abs_error
FROM nz WHERE split = 'Test' ORDER BY abs(actual - predicted) DESC, date LIMIT 5""")
def largest_misses(spark, sf_dir):
    return fc.largest_misses(_naive(spark, sf_dir).filter(F.col("split") == "Test"), 5).select(
        "date", "actual", "predicted", "error", "pct_error", "abs_error")


@register("weekly_metrics_partial", "D5q W26 D4q",
          "variant string, n bigint, mape double",
          sql=f"""WITH {WEEKLY_SQL_CTE},
p AS (SELECT date, weekly_sales_amount AS actual, lag(weekly_sales_amount, 1) OVER (ORDER BY date) AS predicted,
             row_number() OVER (ORDER BY date DESC) AS rn FROM wk),
t AS (SELECT * FROM p WHERE rn <= 4)
SELECT 'with_last_period' AS variant, count(*) AS n,
       coalesce({xmean_sql('CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END')} * 100.0, 0.0) AS mape FROM t
UNION ALL
SELECT 'without_last_period', count(*), coalesce({xmean_sql('CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END')} * 100.0, 0.0)
FROM t WHERE rn > 1""")
def weekly_metrics_partial(spark, sf_dir):
    from pyspark.sql import Window
    w = _weekly(spark, sf_dir)
    p = w.select("date", F.col("weekly_sales_amount").alias("actual"),
                 F.lag("weekly_sales_amount", 1).over(Window.orderBy("date")).alias("predicted"),
                 F.row_number().over(Window.orderBy(F.col("date").desc())).alias("rn")).filter(F.col("rn") <= 4)
    a = fc.forecast_metrics(p, by=None).select(F.lit("with_last_period").alias("variant"), "n", "mape")
    b = fc.forecast_metrics(p.filter(F.col("rn") > 1), by=None).select(F.lit("without_last_period").alias("variant"), "n", "mape")
    return a.unionByName(b)


@register("forecast_document_roundtrip", "D14q S4 S6 D11q",
          "date date, forecast double, growth_from_last_historical double",
          sql=f"WITH {FUTURE_CTE} SELECT date, forecast, growth_from_last_historical FROM future")
def forecast_document_roundtrip(spark, sf_dir):
    """Build the nested forecast document (history with split tags + future),
    write it as JSON to the shared folder, read it back with the explicit
    document schema and flatten the future array."""
    import uuid

    from pyspark.sql import Window

    from tillroll.session import ensure_checkpoint_dir
    from tillroll.sources import sinks
    wk = _weekly(spark, sf_dir)
    hist = wk.select("date", F.col("weekly_sales_amount").alias("actual"),
                     F.lag("weekly_sales_amount", 1).over(Window.orderBy("date")).alias("predicted"))
    hist = ts.chrono_split(hist, 4, 4, required=["predicted"])
    info = {"model_name": "seasonal_naive", "granularity": "weekly", "horizon": "8 weeks", "status": "baseline"}
    doc = fc.forecast_document(hist, _future(spark, sf_dir), info)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-forecast-doc-{uuid.uuid4().hex[:12]}"
    doc.write.mode("overwrite").json(path)
    _, fut = sinks.forecast_doc_rows(sinks.read_forecast_doc(spark, path))
    return fut.select(F.to_date("date").alias("date"), "forecast", "growth_from_last_historical")


@register("weekly_forecast_history", "D11q W25", "date date, actual double, predicted double, split string",
          sql=f"""WITH {WEEKLY_SQL_CTE},
p AS (SELECT date, weekly_sales_amount AS actual, lag(weekly_sales_amount, 1) OVER (ORDER BY date) AS predicted FROM wk),
r AS (SELECT *, row_number() OVER (PARTITION BY predicted IS NOT NULL ORDER BY date DESC) AS rn FROM p)
SELECT date, actual, predicted, CASE WHEN predicted IS NULL THEN 'Dropped' WHEN rn <= 4 THEN 'Test'
                                     WHEN rn <= 8 THEN 'Validation' ELSE 'Train' END AS split FROM r""")
def weekly_forecast_history(spark, sf_dir):
    from pyspark.sql import Window
    wk = _weekly(spark, sf_dir)
    hist = wk.select("date", F.col("weekly_sales_amount").alias("actual"),
                     F.lag("weekly_sales_amount", 1).over(Window.orderBy("date")).alias("predicted"))
    return ts.chrono_split(hist, 4, 4, required=["predicted"])


@register("churn_kpis", "E14", "cohort_size bigint, high_risk_customers bigint, mean_churn_probability double, "
          "actual_churn_rate double", sql=f"""WITH {pred_sql()}
SELECT count(*) AS cohort_size, count(*) FILTER (WHERE risk_category = 'High Risk') AS high_risk_customers,
       {xmean_sql('churn_probability')} AS mean_churn_probability, {xmean_sql('true_churn_flag')} AS actual_churn_rate
FROM pred""")
def churn_kpis(spark, sf_dir):
    from tillroll.functions.numeric import exact_mean
    pred = _scores(sales_ledger(spark, sf_dir))
    return pred.agg(F.count(F.lit(1)).alias("cohort_size"),
                    F.sum(F.when(F.col("risk_category") == "High Risk", 1).otherwise(0)).alias("high_risk_customers"),
                    exact_mean("churn_probability").alias("mean_churn_probability"),
                    exact_mean("true_churn_flag").alias("actual_churn_rate"))


@register("segment_kpis", "E14 E7 A10", "customers bigint, segments bigint, high_value_share double, mean_spend double",
          sql=f"""WITH {SEG_CTE}
SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT cluster) AS segments,
       count(*) FILTER (WHERE high_value_customer_flag = 1) * 100.0::DOUBLE / count(*) AS high_value_share,
       {xmean_sql('monetary')} AS mean_spend FROM seg""")
def segment_kpis(spark, sf_dir):
    from tillroll.functions.numeric import exact_mean
    seg = _segments(sales_ledger(spark, sf_dir))
    return seg.agg(F.countDistinct("customer_id").alias("customers"), F.countDistinct("cluster").alias("segments"),
                   (F.sum(F.when(F.col("high_value_customer_flag") == 1, 1).otherwise(0)) * 100.0
                    / F.count(F.lit(1))).alias("high_value_share"),
                   exact_mean("monetary").alias("mean_spend"))


@register("executive_briefing", "E6 W22", "high_risk_customers bigint, critical_products bigint, forecast_direction string, "
          "pct_change_ahead double", sql=f"""WITH {FUTURE_CTE}, {pred_sql(with_sales=False)}, {inventory_sql(with_sales=False)},
t AS (SELECT forecast, CAST(row_number() OVER (ORDER BY date) - 1 AS DOUBLE) AS t, count(*) OVER () AS n FROM future),
g AS (SELECT {xmean_sql('CASE WHEN t < 4 THEN forecast END')} AS f4, {xmean_sql('CASE WHEN t >= n - 4 THEN forecast END')} AS l4 FROM t),
ch AS (SELECT CASE WHEN f4 <> 0 THEN (l4 - f4) / f4 * 100.0::DOUBLE END AS chg FROM g)
SELECT (SELECT count(*) FROM pred WHERE risk_category = 'High Risk') AS high_risk_customers,
       (SELECT count(*) FROM inv WHERE risk_category = 'Critical' OR stockout_probability >= 0.5 OR reorder_urgency >= 0.6) AS critical_products,
       CASE WHEN chg > 5 THEN 'up' WHEN chg < -5 THEN 'down' ELSE 'flat' END AS forecast_direction, chg AS pct_change_ahead
FROM ch""")
def executive_briefing(spark, sf_dir):
    led = sales_ledger(spark, sf_dir)
    pred = _scores(led)
    inv = iv.inventory_table(led, stock_balances(spark, sf_dir))
    hr = pred.agg(F.sum(F.when(F.col("risk_category") == "High Risk", 1).otherwise(0)).alias("high_risk_customers"))
    cp = inv.agg(F.sum(F.when((F.col("risk_category") == "Critical") | (F.col("stockout_probability") >= 0.5)
                              | (F.col("reorder_urgency") >= 0.6), 1).otherwise(0)).alias("critical_products"))
    tr = fc.trend_label(_future(spark, sf_dir)).select(F.col("direction").alias("forecast_direction"), "pct_change_ahead")
    return hr.crossJoin(cp).crossJoin(tr)
