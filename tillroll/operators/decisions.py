"""Decision queries over the module outputs (J4–J7, U1–U5, C16–C19, E1–E14, T*).

Cross-module joins are key joins on ``customer_id`` / ``product_id``
(never positional).  KPI rows are one-row aggregates joined together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import exact_mean, exact_sum, to_number
from tillroll.functions.text import label_map
from tillroll.operators import ranking
from tillroll.operators.customers import SEGMENT_LABELS, rule_segments

OVERLAP = ["recency", "frequency", "monetary", "customer_loyalty_score"]

# Recommendation actions and priorities (reference rule texts).
CUSTOMER_ACTIONS = {
    "retention": ("Urgent Loyalty Retention Offer", "Critical"),
    "reengage": ("Proactive Re-engagement outreach", "High"),
    "vip": ("Premium VIP Loyalty Club Invitation", "High"),
    "cross_sell": ("Cross-sell Top Revenue Lines", "Standard"),
    "win_back": ("Win-back Re-activation Campaign", "High"),
    "nurture": ("Standard Nurture Stream", "Low"),
}
SEGMENT_ORDER = ["Cluster 0", "Cluster 1", "Cluster 2"]


def segmentation_table(feats: DataFrame) -> DataFrame:
    """Segmented customers: refund-dominated customers removed (P18) and a
    cluster id attached (rule stand-in for k-means labels)."""
    kept = feats.filter((F.col("monetary") > 0) & (F.col("quantity_per_order") > 0))
    return rule_segments(kept)


def merge_customer_views(seg: DataFrame, pred: DataFrame) -> DataFrame:
    """J4–J6 full outer join on customer id; overlapping columns coalesced
    left first; match status."""
    s = seg.select("customer_id", "cluster", "high_value_customer_flag", "average_purchase_value",
                   "customer_tenure", *[F.col(c).alias(f"{c}_seg") for c in OVERLAP],
                   F.lit(1).alias("_in_seg"))
    p = pred.select("customer_id", "churn_probability", "true_churn_flag", "risk_category",
                    *[F.col(c).alias(f"{c}_churn") for c in OVERLAP], F.lit(1).alias("_in_churn"))
    m = s.join(p, "customer_id", "full_outer")
    status = (F.when(F.col("_in_seg").isNotNull() & F.col("_in_churn").isNotNull(), "Matched")
               .when(F.col("_in_seg").isNotNull(), "Segmentation only").otherwise("Churn only"))
    return m.select("customer_id", "cluster", "high_value_customer_flag", "average_purchase_value",
                    "customer_tenure", "churn_probability", "true_churn_flag", "risk_category",
                    *[F.coalesce(f"{c}_seg", f"{c}_churn").alias(c) for c in OVERLAP],
                    status.alias("match_status"))


def merge_validation(a: DataFrame, b: DataFrame, key: str = "customer_id") -> DataFrame:
    """J7 row counts, distinct keys, matched and unmatched on each side."""
    ka = a.select(key).distinct().withColumn("_a", F.lit(1))
    kb = b.select(key).distinct().withColumn("_b", F.lit(1))
    j = ka.join(kb, key, "full_outer")
    counts = j.agg(F.sum(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1).otherwise(0)).alias("matched"),
                   F.sum(F.when(F.col("_b").isNull(), 1).otherwise(0)).alias("left_only"),
                   F.sum(F.when(F.col("_a").isNull(), 1).otherwise(0)).alias("right_only"))
    ra = a.agg(F.count(F.lit(1)).alias("left_rows"))
    rb = b.agg(F.count(F.lit(1)).alias("right_rows"))
    return ra.crossJoin(rb).crossJoin(counts)


def common_keys(a: DataFrame, b: DataFrame, key: str = "customer_id") -> DataFrame:
    """U1 intersection of id sets."""
    return a.select(key).intersect(b.select(key))


def unmatched_keys(a: DataFrame, b: DataFrame, key: str = "customer_id") -> DataFrame:
    """U2 symmetric difference with the side each id comes from."""
    ka, kb = a.select(key).distinct(), b.select(key).distinct()
    return (ka.join(kb, key, "left_anti").withColumn("side", F.lit("left_only"))
            .unionByName(kb.join(ka, key, "left_anti").withColumn("side", F.lit("right_only"))))


def _rec(kind: str) -> Column:
    a, p = CUSTOMER_ACTIONS[kind]
    return F.struct(F.lit(a).alias("action"), F.lit(p).alias("priority"))


def recommend_customers(merged: DataFrame) -> DataFrame:
    """C19 up to four rules plus a fallback, one row per recommendation."""
    p = to_number(F.col("churn_probability"), 0.0)
    has_p = F.col("churn_probability").isNotNull()
    band = F.coalesce(F.col("risk_category"), F.lit("Unknown"))
    rec = F.col("recency")
    rules = F.array(
        F.when((band == "High Risk") | (has_p & (p >= 0.7)), _rec("retention"))
         .when((band == "Medium Risk") | (has_p & (p >= 0.4)), _rec("reengage")),
        F.when((F.col("high_value_customer_flag") == 1) | (F.col("cluster") == "Cluster 0")
               | (F.col("monetary") > 2000), _rec("vip")),
        F.when(((band == "Low Risk") | (has_p & (p < 0.4))) & rec.isNotNull() & (rec <= 45), _rec("cross_sell")),
        F.when(rec.isNotNull() & (rec > 90), _rec("win_back")),
    )
    matched = F.filter(rules, lambda r: r.isNotNull())
    recs = F.when(F.size(matched) > 0, matched).otherwise(F.array(_rec("nurture")))
    return merged.select("customer_id", "match_status", F.posexplode(recs).alias("rule_rank", "r")).select(
        "customer_id", "match_status", (F.col("rule_rank") + 1).alias("rule_rank"), "r.action", "r.priority")


def segment_profile(seg: DataFrame) -> DataFrame:
    """C16 per segment in fixed order (absent segments kept): label, count,
    revenue, % of both, mean RFM / basket / tenure."""
    order = seg.sparkSession.createDataFrame([(c, i) for i, c in enumerate(SEGMENT_ORDER)], "cluster string, seg_order int")
    g = seg.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"), exact_sum("monetary").alias("revenue"),
        exact_mean("recency").alias("avg_recency"), exact_mean("frequency").alias("avg_frequency"),
        exact_mean("monetary").alias("avg_monetary"), exact_mean("average_purchase_value").alias("avg_basket"),
        exact_mean("customer_tenure").alias("avg_tenure"))
    x = F.broadcast(order).join(g, "cluster", "left")  # three-row order table
    w = Window.partitionBy()
    cust = F.coalesce("customers", F.lit(0))
    rev = F.coalesce("revenue", F.lit(0.0))
    return x.select("cluster", "seg_order", label_map(F.col("cluster"), SEGMENT_LABELS).alias("segment_name"),
                    cust.alias("customers"), rev.alias("revenue"),
                    (cust * 100.0 / F.sum(cust).over(w)).alias("pct_customers"),
                    (rev * 100.0 / F.sum(rev).over(w)).alias("pct_revenue"),
                    "avg_recency", "avg_frequency", "avg_monetary", "avg_basket", "avg_tenure")


def cluster_audit(seg: DataFrame, cluster: str, cols: list[str]) -> DataFrame:
    """C17 one cluster vs everyone: means, min / max / median inside the
    cluster, counts of negative, below-one and zero values."""
    ids = seg.filter(F.col("cluster") == cluster).select("customer_id")
    members = seg.join(ids, "customer_id", "left_semi")  # P20
    long_m = members.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    long_all = seg.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    overall = long_all.groupBy("column").agg(exact_mean("value").alias("overall_mean"))
    med = ranking.exact_quantiles(long_m, "value", {"cluster_median": 0.5}, ["column"])
    st = long_m.groupBy("column").agg(
        exact_mean("value").alias("cluster_mean"), F.min("value").alias("cluster_min"),
        F.max("value").alias("cluster_max"),
        F.sum(F.when(F.col("value") < 0, 1).otherwise(0)).alias("n_negative"),
        F.sum(F.when(F.col("value") < 1, 1).otherwise(0)).alias("n_below_one"),
        F.sum(F.when(F.col("value") == 0, 1).otherwise(0)).alias("n_zero"))
    return st.join(overall, "column").join(med, "column", "left")


def outlier_profile(df: DataFrame) -> DataFrame:
    """C18 sub-categories of outlying customers with counts, sums, maxima."""
    m, f, apv, r = F.col("monetary"), F.col("frequency"), F.col("average_purchase_value"), F.col("recency")
    ultra, hf = m > 10000, f > 20
    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.when(ultra, 1).otherwise(0)).alias("ultra_high_spenders"),
        F.sum(F.when(hf, 1).otherwise(0)).alias("high_frequency_buyers"),
        F.sum(F.when(apv > 1000, 1).otherwise(0)).alias("premium_basket_buyers"),
        F.sum(F.when((m < 100) & (r > 300), 1).otherwise(0)).alias("low_value_lapsed"),
        exact_sum(F.when(ultra, m)).alias("ultra_spend_total"), exact_mean(F.when(ultra, m)).alias("ultra_spend_mean"),
        F.max(F.when(ultra, m)).alias("ultra_spend_max"), exact_mean(F.when(ultra, f)).alias("ultra_avg_frequency"),
        exact_sum(F.when(hf, m)).alias("high_freq_spend_total"), exact_mean(F.when(hf, f)).alias("high_freq_avg_frequency"),
        F.max(F.when(hf, f)).alias("high_freq_max_frequency"))


def status_band(v, good: float, warn: float, higher_is_better: bool = True) -> Column:
    """E2 good / warning / critical against two cuts."""
    v = F.col(v) if isinstance(v, str) else v
    if higher_is_better:
        return F.when(v >= good, "good").when(v >= warn, "warning").otherwise("critical")
    return F.when(v >= warn, "critical").when(v >= good, "warning").otherwise("good")


def executive_kpis(seg: DataFrame, pred: DataFrame, health: DataFrame, inv: DataFrame,
                   reorder_rows: DataFrame) -> DataFrame:
    """E1 + E2 one row of headline KPIs with status bands."""
    s = seg.agg(F.count(F.lit(1)).alias("total_customers"), exact_sum("monetary").alias("total_revenue"),
                F.countDistinct("cluster").alias("num_segments"),
                F.sum(F.when(F.col("high_value_customer_flag") == 1, 1).otherwise(0)).alias("high_value_customers"))
    c = pred.agg(F.sum(F.when(F.col("risk_category") == "High Risk", 1).otherwise(0)).alias("high_risk_customers"),
                 F.count(F.lit(1)).alias("_scored"))
    i = inv.agg(F.sum(F.when(F.col("risk_category") == "Critical", 1).otherwise(0)).alias("critical_products"))
    r = reorder_rows.agg(F.count(F.lit(1)).alias("reorder_recommendations"))
    x = s.crossJoin(c).crossJoin(health.select("health_score")).crossJoin(i).crossJoin(r)
    x = x.withColumn("avg_customer_value", F.when(F.col("total_customers") > 0,
                                                   F.col("total_revenue") / F.col("total_customers")).otherwise(0.0))
    x = x.withColumn("high_risk_pct", F.when(F.col("_scored") > 0,
                                             F.col("high_risk_customers") * 100.0 / F.col("_scored")).otherwise(0.0))
    return x.drop("_scored").withColumn("health_status", status_band("health_score", 80.0, 50.0)).withColumn(
        "churn_status", status_band("high_risk_pct", 10.0, 20.0, higher_is_better=False))


def alert_summary(pred: DataFrame, inv: DataFrame, alerts: DataFrame) -> DataFrame:
    """E5 critical / warning / opportunity counts (counts taken on the full
    master table, D27)."""
    c = pred.agg(F.sum(F.when(F.col("churn_probability") > 0.70, 1).otherwise(0)).alias("high_risk_customers"),
                 exact_sum(F.when(F.col("churn_probability") > 0.70, F.col("monetary"))).alias("revenue_at_risk"))
    i = inv.agg(F.sum(F.when(F.col("risk_category") == "Critical", 1).otherwise(0)).alias("critical_products"),
                F.sum(F.when(F.col("reorder_urgency") >= 0.80, 1).otherwise(0)).alias("immediate_reorders"))
    d = alerts.agg(F.sum(F.when(F.col("alert") == "surge", 1).otherwise(0)).alias("surges"),
                   F.sum(F.when(F.col("alert") == "drop", 1).otherwise(0)).alias("drops"),
                   F.sum("holiday_peak").alias("holiday_peaks"),
                   F.min(F.when(F.col("alert") == "surge", F.col("date"))).alias("next_surge_week"))
    x = c.crossJoin(i).crossJoin(d)
    hr, cp = F.col("high_risk_customers"), F.col("critical_products")
    crit = F.when(hr > 100, 1).otherwise(0) + F.when(cp > 50, 1).otherwise(0) + F.col("drops")
    warn = (F.when((hr > 0) & (hr <= 100), 1).otherwise(0) + F.when((cp > 0) & (cp <= 50), 1).otherwise(0)
            + F.when(F.col("immediate_reorders") > 0, 1).otherwise(0))
    opp = F.col("surges") + F.col("holiday_peaks")
    return x.withColumn("critical_alerts", crit).withColumn("warning_alerts", warn).withColumn(
        "opportunity_alerts", opp).withColumn("total_alerts", crit + warn + opp)


def kpi_pivot(kpis: DataFrame, names: list[str]) -> DataFrame:
    """E13 long (metric, value) → one typed row; missing metrics → 0."""
    p = kpis.groupBy().pivot("metric", names).agg(F.first("value"))
    return p.select(*[F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(0.0)).alias(n.replace(".", "_")) for n in names])


def top_k(df: DataFrame, by: str, k: int, tiebreak: str, ascending: bool = False) -> DataFrame:
    """T1/T3/T4/T5 top-k with a unique tie-break."""
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(o, F.col(tiebreak).asc()).limit(k)
