"""Statistics / data-quality plans."""

from __future__ import annotations

import math

from tillroll.functions.numeric import xmean_sql
from tillroll.operators import customers as cu
from tillroll.operators import quality as qu
from tillroll.operators import timeseries as ts
from tillroll.plans.catalog import register
from tillroll.plans.customers import customer_features_sql, pred_sql
from tillroll.plans.demand import DAILY_SQL_CTE
from tillroll.sources.ledger import ledger_sql, sales_ledger

SALES = ledger_sql()
NUM = ["recency", "frequency", "monetary", "average_purchase_value", "quantity_per_order",
       "customer_tenure", "weekend_sales_ratio"]
SEG_SQL = ("CASE WHEN customer_loyalty_score >= 7 THEN 'Cluster 0' WHEN customer_loyalty_score >= 4 "
           "THEN 'Cluster 1' ELSE 'Cluster 2' END")


def _cf(spark, sf_dir):
    return cu.customer_features(sales_ledger(spark, sf_dir))


def _union(parts):
    return "\nUNION ALL\n".join(parts)


@register("customer_describe", "A14 Q1",
          "column string, count bigint, mean double, std double, min double, p25 double:8, p50 double:8, "
          "p75 double:8, max double",
          sql=f"WITH {customer_features_sql()}\n" + _union([
              f"SELECT '{c}' AS column, count({c}) AS count, {xmean_sql(f'CAST({c} AS DOUBLE)')} AS mean, "
              f"stddev_samp(CAST({c} AS DOUBLE)) AS std, min({c}) AS min, quantile_cont({c}, 0.25) AS p25, "
              f"quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM cf"
              for c in NUM]))
def customer_describe(spark, sf_dir):
    return qu.describe_numeric(_cf(spark, sf_dir), NUM)


CAT = ["source_system", "region", "product_id", "customer_id"]


@register("sales_categorical_profile", "A15 A10 Q1",
          "column string, count bigint, unique bigint, top string, freq bigint",
          sql=f"WITH sales AS ({ledger_sql(with_region=True)}),\n" + ",\n".join(
              f"vc_{c} AS (SELECT {c} AS value, count(*) AS cnt FROM sales WHERE {c} IS NOT NULL GROUP BY 1)"
              for c in CAT) + "\n" + _union([
              f"SELECT '{c}' AS column, sum(cnt) AS count, count(*) AS unique, arg_max(value, (cnt, value)) AS top, "
              f"max(cnt) AS freq FROM vc_{c}" for c in CAT]))
def sales_categorical_profile(spark, sf_dir):
    return qu.describe_categorical(sales_ledger(spark, sf_dir, with_region=True), CAT)


LEDGER_COLS = ["transaction_id", "source_system", "date", "customer_id", "product_id", "quantity_sold",
               "unit_price", "sales_amount", "region"]


@register("sales_null_profile", "A22 Q2",
          "column string, nulls bigint, missing_pct double",
          sql=f"WITH sales AS ({ledger_sql(with_region=True)})\n" + _union([
              f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
              f"count(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / count(*) AS missing_pct FROM sales"
              for c in LEDGER_COLS]))
def sales_null_profile(spark, sf_dir):
    return qu.null_profile(sales_ledger(spark, sf_dir, with_region=True), LEDGER_COLS)


@register("sales_duplicates", "A22", "rows bigint, distinct_rows bigint, duplicate_rows bigint",
          sql=f"""WITH sales AS ({SALES})
SELECT (SELECT count(*) FROM sales) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM sales)) AS distinct_rows,
       (SELECT count(*) FROM sales) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales)) AS duplicate_rows""")
def sales_duplicates(spark, sf_dir):
    return qu.duplicate_count(sales_ledger(spark, sf_dir))


def _corr_sql(a, b):
    if a == b:
        return f"CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) > 0 THEN 1.0 END"
    return (f"CASE WHEN stddev_pop(CAST({a} AS DOUBLE)) > 0 AND stddev_pop(CAST({b} AS DOUBLE)) > 0 "
            f"THEN corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END")


CORR_SQL = f"WITH {customer_features_sql()},\nm AS (" + _union([
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_corr_sql(a, b)} AS correlation FROM cf" for a in NUM for b in NUM]) + ")"


@register("customer_corr_matrix", "Q3", "feature_a string, feature_b string, correlation double",
          sql=CORR_SQL + " SELECT * FROM m")
def customer_corr_matrix(spark, sf_dir):
    return qu.corr_matrix(_cf(spark, sf_dir), NUM)


@register("customer_high_corr_pairs", "Q4", "feature_a string, feature_b string, correlation double, abs_correlation double",
          sql=CORR_SQL + f""",
pos AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(NUM))}) t(name, i))
SELECT feature_a, feature_b, correlation, abs(correlation) AS abs_correlation
FROM m JOIN pos pa ON m.feature_a = pa.name JOIN pos pb ON m.feature_b = pb.name
WHERE pa.i > pb.i AND abs(correlation) > 0.5""")
def customer_high_corr_pairs(spark, sf_dir):
    return qu.high_corr_pairs(qu.corr_matrix(_cf(spark, sf_dir), NUM), NUM)


VAL_COLS = NUM + ["customer_loyalty_score", "customer_risk_score", "avg_days_between_purchases"]


@register("customer_feature_validation", "Q5",
          "column string, nulls bigint, infs bigint, min double, max double, mean double",
          sql=f"WITH {customer_features_sql()}\n" + _union([
              f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS nulls, "
              f"count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS infs, min(CAST({c} AS DOUBLE)) AS min, "
              f"max(CAST({c} AS DOUBLE)) AS max, {xmean_sql(f'CAST({c} AS DOUBLE)')} AS mean FROM cf" for c in VAL_COLS]))
def customer_feature_validation(spark, sf_dir):
    return qu.validate_features(_cf(spark, sf_dir), VAL_COLS)


IQR_OUT = ("q1 double:8, q3 double:8, iqr double:8, lower double:8, upper double:8, rows bigint, outliers bigint, "
           "outlier_pct double")


def _iqr_sql(src: str, col: str) -> str:
    return f"""q AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src}),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT q1, q3, iqr, lower, upper, count(*) AS rows,
       count(*) FILTER (WHERE {col} < lower OR {col} > upper) AS outliers,
       count(*) FILTER (WHERE {col} < lower OR {col} > upper) * 100.0::DOUBLE / count(*) AS outlier_pct
FROM {src}, f GROUP BY q1, q3, iqr, lower, upper"""


@register("iqr_outliers_daily", "Q6 Q7", IQR_OUT,
          sql=f"WITH {DAILY_SQL_CTE}, dd AS (SELECT CAST(sales_amount AS DOUBLE) AS v FROM d),\n" + _iqr_sql("dd", "v"))
def iqr_outliers_daily(spark, sf_dir):
    from pyspark.sql import functions as F
    d = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return qu.iqr_outliers(d.select(F.col("sales_amount").cast("double").alias("v")), "v")


@register("iqr_outliers_panel", "Q6 Q7 (panel)", IQR_OUT,
          sql=f"""WITH sales AS ({SALES}),
pd AS (SELECT CAST(sum(sales_amount) AS DOUBLE) AS v FROM sales GROUP BY CAST(date AS DATE), product_id),
""" + _iqr_sql("pd", "v"))
def iqr_outliers_panel(spark, sf_dir):
    from pyspark.sql import functions as F
    pdy = ts.product_daily(sales_ledger(spark, sf_dir))
    return qu.iqr_outliers(pdy.select(F.col("daily_sales_amount").cast("double").alias("v")), "v")


SKEW_COLS = ["recency", "frequency", "monetary", "average_purchase_value", "customer_tenure",
             "weekend_sales_ratio", "active_months"]


def _skew_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS column, CASE WHEN avg(power({x} - mu, 2)) > 0 THEN avg(power({x} - mu, 3)) / "
            f"power(avg(power({x} - mu, 2)), 1.5) END AS skew, min({x}) AS min "
            f"FROM cf, (SELECT avg(CAST({c} AS DOUBLE)) AS mu FROM cf) m")


SKEW_SQL = f"WITH {customer_features_sql()},\nsk AS (" + _union([_skew_sql(c) for c in SKEW_COLS]) + ")"


@register("customer_skewness", "Q10", "column string, skew double, min double, transformed bigint",
          sql=SKEW_SQL + " SELECT *, CASE WHEN abs(skew) > 1.0 THEN 1 ELSE 0 END AS transformed FROM sk")
def customer_skewness(spark, sf_dir):
    return qu.skewness_report(_cf(spark, sf_dir), SKEW_COLS)


def _std_sql():
    t = []
    for c in SKEW_COLS:
        t.append(f"CASE WHEN (SELECT abs(skew) > 1.0 FROM sk WHERE \"column\" = '{c}') THEN "
                 f"ln(1 + CASE WHEN (SELECT min FROM sk WHERE \"column\" = '{c}') < 0 THEN {c} - (SELECT min FROM sk WHERE \"column\" = '{c}') ELSE {c} END) "
                 f"ELSE CAST({c} AS DOUBLE) END AS {c}")
    z = [f"CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END AS {c}"
         for c in SKEW_COLS]
    return SKEW_SQL + f", t AS (SELECT customer_id, {', '.join(t)} FROM cf)\nSELECT customer_id, {', '.join(z)} FROM t"


@register("customer_standardized", "Q10 Q11 P19",
          "customer_id string, " + ", ".join(f"{c} double" for c in SKEW_COLS), sql=_std_sql())
def customer_standardized(spark, sf_dir):
    feats = _cf(spark, sf_dir).select("customer_id", *SKEW_COLS)
    return qu.standardize(qu.deskew(feats, SKEW_COLS), SKEW_COLS)


@register("customer_robust_scaled", "Q12", "customer_id string, column string, scaled double",
          sql=f"WITH {customer_features_sql()},\nl AS (" + _union([
              f"SELECT customer_id, '{c}' AS column, CAST({c} AS DOUBLE) AS value FROM cf" for c in SKEW_COLS]) + """),
rq AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
      FROM l GROUP BY "column")
SELECT customer_id, l."column", CASE WHEN q3 - q1 <> 0 THEN (value - med) / (q3 - q1) ELSE 0.0 END AS scaled
FROM l JOIN rq ON l."column" = rq."column"
""")
def customer_robust_scaled(spark, sf_dir):
    return qu.robust_scale(_cf(spark, sf_dir), SKEW_COLS, "customer_id")


@register("sales_histogram", "A23", "bin bigint, bin_start double, bin_end double, count bigint",
          sql=f"""WITH sales AS ({SALES}),
x AS (SELECT CAST(sales_amount AS DOUBLE) AS v FROM sales),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT CASE WHEN (hi - lo) / 50 > 0 THEN least(floor((v - lo) / ((hi - lo) / 50)), 49) ELSE 0 END AS bin, lo, hi
      FROM x, mm)
SELECT CAST(bin AS BIGINT) AS bin, lo + bin * ((hi - lo) / 50) AS bin_start, lo + (bin + 1) * ((hi - lo) / 50) AS bin_end,
       count(*) AS count FROM b GROUP BY bin, lo, hi""")
def sales_histogram(spark, sf_dir):
    from pyspark.sql import functions as F
    s = sales_ledger(spark, sf_dir).select(F.col("sales_amount").cast("double").alias("v"))
    return qu.histogram(s, "v", 50)


@register("daily_sales_kde", "A24", "grid_index bigint, x double, density double",
          sql=f"""WITH {DAILY_SQL_CTE},
v AS (SELECT CAST(sales_amount AS DOUBLE) AS v FROM d),
st AS (SELECT min(v) AS lo, max(v) AS hi, count(v) AS n, stddev_samp(v) AS sd FROM v),
c AS (SELECT CASE WHEN (hi - lo) / 1024 > 0 THEN least(floor((v - lo) / ((hi - lo) / 1024)), 1023) ELSE 0 END AS fb,
             count(*) AS c FROM v, st GROUP BY 1),
g AS (SELECT unnest(range(0, 64)) AS gi)
SELECT gi AS grid_index, lo + gi * (hi - lo) / 63 AS x,
       sum(c * exp(-0.5 * power((lo + gi * (hi - lo) / 63 - (lo + (fb + 0.5) * ((hi - lo) / 1024))) / (sd * power(CAST(n AS DOUBLE), -0.2)), 2)))
         / (n * (sd * power(CAST(n AS DOUBLE), -0.2)) * {math.sqrt(2 * math.pi)!r}) AS density
FROM c, g, st GROUP BY gi, lo, hi, n, sd""")
def daily_sales_kde(spark, sf_dir):
    from pyspark.sql import functions as F
    d = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return qu.kde(d.select(F.col("sales_amount").cast("double").alias("v")), "v", 64, 1024)


@register("rfm_heatmap", "A25", "x_bin bigint, y_bin bigint, count bigint, avg_monetary double",
          sql=f"""WITH {customer_features_sql()},
mm AS (SELECT min(recency) AS xl, max(recency) AS xh, min(frequency) AS yl, max(frequency) AS yh FROM cf),
b AS (SELECT CASE WHEN (xh - xl) / 10 > 0 THEN least(floor((recency - xl) / ((xh - xl) / 10)), 9) ELSE 0 END AS x_bin,
             CASE WHEN (yh - yl) / 10 > 0 THEN least(floor((frequency - yl) / ((yh - yl) / 10)), 9) ELSE 0 END AS y_bin,
             monetary FROM cf, mm)
SELECT x_bin, y_bin, count(*) AS count, {xmean_sql('monetary')} AS avg_monetary FROM b GROUP BY 1, 2""")
def rfm_heatmap(spark, sf_dir):
    return qu.heatmap_2d(_cf(spark, sf_dir), "recency", "frequency", "monetary", 10)


SEG_PRED = pred_sql() + f""",
seg AS (SELECT pred.*, {SEG_SQL.replace('customer_loyalty_score', 'pit.customer_loyalty_score')} AS cluster
        FROM pred JOIN pit ON pred.customer_id = pit.customer_id)"""


def _seg_pred(spark, sf_dir):
    from pyspark.sql import functions as F
    ch = cu.churn_dataset(sales_ledger(spark, sf_dir), "2001-05-01", 90)
    pred = cu.rule_churn_scores(ch)
    return cu.rule_segments(ch.select("customer_id", "customer_loyalty_score")).select(
        "customer_id", "cluster").join(pred, "customer_id").withColumn("_", F.lit(1)).drop("_")


@register("segment_risk_crosstab", "A16", "cluster string, risk_category string, count bigint",
          sql=f"""WITH {SEG_PRED}
SELECT coalesce(cluster, 'All') AS cluster, coalesce(risk_category, 'All') AS risk_category, count(*) AS count
FROM seg GROUP BY CUBE (cluster, risk_category)""")
def segment_risk_crosstab(spark, sf_dir):
    return qu.crosstab(_seg_pred(spark, sf_dir), "cluster", "risk_category")


@register("segment_risk_share", "A17", "cluster string, risk_category string, count bigint, share_pct double",
          sql=f"""WITH {SEG_PRED}
SELECT cluster, risk_category, count(*) AS count,
       count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY cluster) AS share_pct
FROM seg GROUP BY cluster, risk_category""")
def segment_risk_share(spark, sf_dir):
    return qu.share_within(_seg_pred(spark, sf_dir), "cluster", "risk_category")


@register("churn_label_share", "A11", "true_churn_flag bigint, count bigint, pct double",
          sql=f"""WITH {pred_sql()}
SELECT true_churn_flag, count(*) AS count, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct
FROM pred GROUP BY true_churn_flag""")
def churn_label_share(spark, sf_dir):
    return qu.value_share(_seg_pred(spark, sf_dir), "true_churn_flag")


PROFILE_COLS = ["recency", "frequency", "monetary"]


@register("segment_group_profile", "A13 M5",
          "cluster string, column string, count bigint, min double, max double, mean double, std double, "
          "median double:8, share_pct double",
          sql=f"""WITH {customer_features_sql()},
s AS (SELECT *, {SEG_SQL} AS cluster FROM cf),
l AS ({_union([f"SELECT cluster, '{c}' AS column, CAST({c} AS DOUBLE) AS value FROM s" for c in PROFILE_COLS])}),
st AS (SELECT cluster, "column", count(*) AS count, min(value) AS min, max(value) AS max, {xmean_sql('value')} AS mean,
              stddev_samp(value) AS std, quantile_cont(value, 0.5) AS median FROM l GROUP BY 1, 2),
sz AS (SELECT cluster, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share_pct FROM s GROUP BY cluster)
SELECT st.*, sz.share_pct FROM st LEFT JOIN sz ON st.cluster = sz.cluster""")
def segment_group_profile(spark, sf_dir):
    return qu.group_profile(cu.rule_segments(_cf(spark, sf_dir)), "cluster", PROFILE_COLS)
