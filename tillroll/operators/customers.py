"""Customer analytics.

The ledger is aggregated to one row per customer in a single ``groupBy``
(partial aggregation absorbs hot customers before the shuffle).  That table
is checkpointed once, because the global orderings below (loyalty
quintiles, revenue rank, 90th percentile) each read it again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import calendar as cal
from tillroll.functions.numeric import clip, exact_mean, exact_sum, round_half_up, safe_corr, safe_div
from tillroll.operators import ranking
from tillroll.session import cut_lineage

# Fixed values (reference rules): loyalty weights, churn-rule thresholds.
LOYALTY_WEIGHTS = {"recency": 0.2, "frequency": 0.3, "monetary": 0.5}
RISK_BANDS = ((0.30, "Low Risk"), (0.70, "Medium Risk"))  # else "High Risk"
WARNING_THRESHOLD = 0.7
LOST_RECENCY_DAYS = 90
HIGH_VALUE_QUANTILE = 0.9

CUSTOMER_COLUMNS = [
    "customer_id", "recency", "frequency", "monetary", "average_purchase_value",
    "quantity_per_order", "active_months", "purchase_frequency", "customer_loyalty_score",
    "customer_risk_score", "high_value_customer_flag", "customer_tenure",
    "avg_days_between_purchases", "weekend_sales_ratio", "customer_rank_by_revenue",
    "churn_warning_flag", "lost_one_time_buyer_flag",
]

CHURN_COLUMNS = [
    "customer_id", "frequency", "monetary", "recency", "average_purchase_value",
    "customer_tenure", "active_months", "purchase_frequency", "avg_days_between_purchases",
    "weekend_sales_ratio", "customer_loyalty_score", "quantity_per_order",
    "customer_rank_by_revenue", "high_value_customer_flag", "true_churn_flag",
]


def enrich_sales(sales: DataFrame) -> DataFrame:
    """C1 line enrichment: calendar parts and sales per unit."""
    return sales.select("*", *cal.date_parts("date"),
                        safe_div(F.col("sales_amount").cast("double"), "quantity_sold").alias("sales_per_unit"))


def _as_date(d) -> Column:
    return F.lit(dt.date.fromisoformat(d) if isinstance(d, str) else d)


def _by_customer(sales: DataFrame, dates: Sequence[str | None]) -> DataFrame:
    """One row per customer with, for the i-th of ``dates`` (see :func:`customer_base`), the sums ``_…i``
    over the lines up to it (``_ni`` of them, where not all lines are): they are read and sent once for all dates."""
    lines = sales.filter(F.col("customer_id").isNotNull())
    upto = [None if d is None else F.col("date") < F.date_add(_as_date(d), 1).cast("timestamp_ntz") for d in dates]
    if len(dates) == 1 and upto[0] is not None:
        lines, upto = lines.filter(upto[0]), [None]

    def own(i: int, x: Column) -> Column:
        return x if upto[i] is None else F.when(upto[i], x)

    zero, cut = F.lit(0).cast("decimal(18,4)"), [i for i, u in enumerate(upto) if u is not None]
    day, weekend = cal.day("date"), F.when(cal.is_weekend("date") == 1, F.col("sales_amount")).otherwise(zero)
    all_i = range(len(dates))
    # each transaction first: distinct transactions are then a count, without copies of the lines
    orders = lines.groupBy("customer_id", "transaction_id").agg(*[c for i in all_i for c in (
        F.max(own(i, day)).alias(f"_last{i}"), F.min(own(i, day)).alias(f"_first{i}"),
        F.sum(own(i, F.col("sales_amount"))).alias(f"_amount{i}"), F.sum(own(i, F.col("quantity_sold"))).alias(f"_qty{i}"),
        F.sum(own(i, weekend)).alias(f"_weekend{i}"))], *[F.count(own(i, F.lit(1))).alias(f"_n{i}") for i in cut])
    agg = orders.groupBy("customer_id").agg(*[c for i in all_i for c in (
        F.max(f"_last{i}").alias(f"_last{i}"), F.min(f"_first{i}").alias(f"_first{i}"),
        F.count(F.when(F.col(f"_n{i}") > 0, F.col("transaction_id")) if i in cut else "transaction_id").alias(f"_frequency{i}"),
        F.sum(f"_amount{i}").cast("double").alias(f"_monetary{i}"), F.sum(f"_qty{i}").alias(f"_qty{i}"),
        F.sum(f"_weekend{i}").cast("double").alias(f"_weekend{i}"))], *[F.sum(f"_n{i}").alias(f"_n{i}") for i in cut])
    # months are counted apart, from their own columns: sets of months in the aggregation
    # above would make it one of objects, which sorts and spills every line
    months = lines.select("customer_id", cal.month_start("date").alias("_month"), *[upto[i].alias(f"_in{i}") for i in cut])
    months = months.groupBy("customer_id", "_month").agg(*[F.max(f"_in{i}").alias(f"_in{i}") for i in cut]) if cut else months.distinct()
    months = months.groupBy("customer_id").agg(
        *[F.count(F.when(F.col(f"_in{i}"), F.col("_month")) if i in cut else "_month").alias(f"_months{i}") for i in all_i])
    last = sales.agg(F.date_add(F.max(cal.day("date")), 1).alias("_ref"))  # one-row scalar (J11)
    x = agg.join(months, "customer_id")
    x = x.crossJoin(F.broadcast(last)) if None in dates else x
    return x.select("*", *[(F.col("_ref") if d is None else F.date_add(_as_date(d), 1)).alias(f"_ref{i}") for i, d in enumerate(dates)])


def _base_of(sums: DataFrame, i: int) -> DataFrame:
    """The customers, and their columns, at the i-th date of :func:`_by_customer`."""
    c = {n: F.col(f"_{n}{i}") for n in ("last", "first", "frequency", "monetary", "qty", "weekend", "months", "ref")}
    if f"_n{i}" in sums.columns:
        sums = sums.where(F.col(f"_n{i}") > 0)
    tenure = F.datediff(c["ref"], c["first"])
    gap = F.when(c["frequency"] > 1, tenure / (c["frequency"] - 1)).otherwise(tenure.cast("double"))
    gap = F.when(gap == 0, F.lit(30.0)).otherwise(gap)
    x = sums.select(
        "customer_id",
        F.datediff(c["ref"], c["last"]).alias("recency"),
        c["frequency"].alias("frequency"), c["monetary"].alias("monetary"),
        safe_div(c["monetary"], c["frequency"]).alias("average_purchase_value"),
        safe_div(c["qty"], c["frequency"]).alias("quantity_per_order"),
        c["months"].alias("active_months"),
        safe_div(c["frequency"], c["months"]).alias("purchase_frequency"),
        tenure.alias("customer_tenure"),
        gap.alias("avg_days_between_purchases"),
        clip(F.when(c["monetary"] > 0, c["weekend"] / c["monetary"]).otherwise(F.lit(0.0)),
             0.0, 1.0).alias("weekend_sales_ratio"),
    )
    risk = F.least(F.lit(1.0), F.col("recency") / (2 * F.col("avg_days_between_purchases") + 30.0))
    return x.withColumn("customer_risk_score", risk).withColumn(
        "churn_warning_flag", F.when(F.col("customer_risk_score") > WARNING_THRESHOLD, 1).otherwise(0)
    ).withColumn(
        "lost_one_time_buyer_flag",
        F.when((F.col("frequency") == 1) & (F.col("recency") > LOST_RECENCY_DAYS), 1).otherwise(0))


def customer_base(sales: DataFrame, as_of: str | None = None) -> DataFrame:
    """A1–A3 + C2 core, one row per customer.

    ``as_of=None``: whole ledger, anchored at (last ledger day + 1).
    ``as_of=cutoff``: only days ≤ cutoff (half-open on dates, D5), anchored
    at cutoff + 1 (C10)."""
    return _base_of(_by_customer(sales, [as_of]), 0)


def loyalty_and_rank(base: DataFrame) -> DataFrame:
    """High-value flag (≥ 90th percentile), loyalty score 1–10
    from R/F/M quintiles, revenue rank (ties share the minimum).

    The three global orderings (frequency, monetary, recency — ties broken
    by customer id) come from one range-partitioned pass; the monetary
    ordering also yields the revenue rank and the 90th percentile, the
    recency ordering the quintile edges."""
    m = ranking.row_numbers_multi(base, "customer_id", {
        "f": ("frequency", True), "m": ("monetary", True), "r": ("recency", True)})
    n = F.col("n_rows")

    def quint(rn):
        return F.when(n <= 1, 1).otherwise(F.greatest(F.lit(1), F.ceil(5.0 * (F.col(rn) - 1) / (n - 1))))
    m = m.withColumn("_f", quint("rn_f")).withColumn("_m", quint("rn_m"))
    qm = ranking.quantiles_from_index(m, "monetary", {"_q90": HIGH_VALUE_QUANTILE}, "rn_m", "n_m")
    qr = ranking.quantiles_from_index(m, "recency", {"_e1": 0.2, "_e2": 0.4, "_e3": 0.6, "_e4": 0.8}, "rn_r", "n_r")
    # rank descending, ties → minimum = n − (last ascending position of the value) + 1
    m = ranking.tie_edge(m, "monetary", "rn_m", "_last_rm", first=False)
    m = m.withColumn("customer_rank_by_revenue", (F.col("n_m") - F.col("_last_rm") + 1).cast("long"))
    m = m.crossJoin(F.broadcast(qm.crossJoin(qr)))  # one-row scalars
    m = m.withColumn("high_value_customer_flag", F.when(F.col("monetary") >= F.col("_q90"), 1).otherwise(0))
    # recency quintile (qcut on values, labels 5..1; first edge ≥ value wins, D14)
    r_bin = (1 + sum(F.when(F.col("recency") > F.col(e), 1).otherwise(0) for e in ("_e1", "_e2", "_e3", "_e4")))
    r_score = 6 - r_bin
    comp = (LOYALTY_WEIGHTS["recency"] * r_score + LOYALTY_WEIGHTS["frequency"] * F.col("_f")
            + LOYALTY_WEIGHTS["monetary"] * F.col("_m"))
    m = m.withColumn("customer_loyalty_score", round_half_up(1.0 + (comp - 1.0) * (9.0 / 4.0), 2))
    return m.drop("_f", "_m", "rn_f", "rn_m", "rn_r", "n_rows", "n_f", "n_m", "n_r", "_q90", "_last_rm", "_e1", "_e2", "_e3", "_e4")


def customer_features(sales: DataFrame, as_of: str | None = None) -> DataFrame:
    """C2–C9 (C10 with ``as_of``): the 17-column customer feature table.

    A module output read by many downstream branches (segments, churn,
    scaling, audits), so it is materialised once (reliable checkpoint) rather
    than re-derived per branch."""
    base = cut_lineage(customer_base(sales, as_of))
    return cut_lineage(loyalty_and_rank(base).select(*CUSTOMER_COLUMNS))


def churn_dataset(sales: DataFrame, cutoff: str, horizon_days: int = 90) -> DataFrame:
    """C10 + C11: point-in-time features at ``cutoff`` and the label
    ``true_churn_flag`` = 1 when the customer has no order in the
    ``horizon_days`` days after the cutoff."""
    return _labelled(sales, customer_features(sales, as_of=cutoff), cutoff, horizon_days)


def features_and_churn(sales: DataFrame, cutoff: str, horizon_days: int = 90) -> tuple[DataFrame, DataFrame]:
    """:func:`customer_features` and :func:`churn_dataset` from one pass over the lines; their
    orderings do not depend on each other and are made at the same time."""
    from tillroll.operators.ml import together
    sums = cut_lineage(_by_customer(sales, [None, cutoff]))

    def ranked(i: int) -> DataFrame:
        return cut_lineage(loyalty_and_rank(_base_of(sums, i)).select(*CUSTOMER_COLUMNS))
    feats, churn = together([lambda: ranked(0), lambda: _labelled(sales, ranked(1), cutoff, horizon_days)])
    return feats, churn


def _labelled(sales: DataFrame, feats: DataFrame, cutoff: str, horizon_days: int) -> DataFrame:
    start = F.date_add(_as_date(cutoff), 1)
    stop = F.date_add(_as_date(cutoff), 1 + horizon_days)
    active = (sales.filter((F.col("date") >= start.cast("timestamp_ntz"))
                           & (F.col("date") < stop.cast("timestamp_ntz"))
                           & F.col("customer_id").isNotNull())
              .select("customer_id").distinct())
    out = feats.join(active.withColumn("_act", F.lit(1)), "customer_id", "left")
    return cut_lineage(out.withColumn("true_churn_flag", F.when(F.col("_act").isNull(), 1).otherwise(0))
                       .select(*CHURN_COLUMNS))


def leakage_audit(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """C12 Pearson r of every feature with the label (null when either side
    is constant), severity level and constant-feature flag; one row per feature."""
    aggs = []
    for c in features:
        aggs += [safe_corr(c, label).alias(f"r__{c}"), (F.min(c).eqNullSafe(F.max(c))).alias(f"d__{c}")]
    guarded = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"r__{c}").alias("correlation"),
        F.col(f"d__{c}").alias("constant")) for c in features]))
    out = guarded.select(rows.alias("r")).select("r.*")
    a = F.abs("correlation")
    return out.select(
        "feature", "correlation", a.alias("abs_correlation"),
        F.when(a > 0.95, "fail").when(a > 0.90, "high").when(a > 0.70, "medium").otherwise("ok").alias("leakage_level"),
        F.col("constant").cast("int").alias("is_constant"))


def risk_band(p) -> Column:
    """C13 <0.30 Low, <0.70 Medium, else High."""
    p = F.col(p) if isinstance(p, str) else p
    out = F.when(p < RISK_BANDS[0][0], RISK_BANDS[0][1]).when(p < RISK_BANDS[1][0], RISK_BANDS[1][1])
    return out.otherwise("High Risk")


def rule_churn_scores(churn: DataFrame) -> DataFrame:
    """Deterministic churn probability = rule risk score (C4) recomputed on
    point-in-time features; the churn-prediction table shape (8 columns)."""
    risk = F.least(F.lit(1.0), F.col("recency") / (2 * F.col("avg_days_between_purchases") + 30.0))
    return churn.select(
        "customer_id", risk.alias("churn_probability"), "true_churn_flag", "recency", "frequency",
        "monetary", "customer_loyalty_score", risk_band(risk).alias("risk_category"))


BAND_ORDER = ["Low Risk", "Medium Risk", "High Risk"]


def risk_summary(pred: DataFrame) -> DataFrame:
    """C14 per band in fixed order (absent bands kept): customers, share,
    mean probability / RFM / loyalty, actual churn rate."""
    spark = pred.sparkSession
    order = spark.createDataFrame([(b, i) for i, b in enumerate(BAND_ORDER)], "risk_category string, band_order int")
    g = pred.groupBy("risk_category").agg(
        F.count(F.lit(1)).alias("customers"),
        exact_mean("churn_probability").alias("avg_churn_probability"),
        exact_mean("recency").alias("avg_recency"), exact_mean("frequency").alias("avg_frequency"),
        exact_mean("monetary").alias("avg_monetary"), exact_mean("customer_loyalty_score").alias("avg_loyalty"),
        exact_mean("true_churn_flag").alias("actual_churn_rate"),
        exact_sum("monetary").alias("revenue_exposed"))
    # the band table has three rows
    out = F.broadcast(order).join(g, "risk_category", "left")
    tot = F.sum(F.coalesce("customers", F.lit(0))).over(Window.partitionBy())
    return out.select("risk_category", "band_order",
                      F.coalesce("customers", F.lit(0)).alias("customers"),
                      (F.coalesce("customers", F.lit(0)) * 100.0 / tot).alias("pct_customers"),
                      "avg_churn_probability", "avg_recency", "avg_frequency", "avg_monetary",
                      "avg_loyalty", "actual_churn_rate",
                      F.coalesce("revenue_exposed", F.lit(0.0)).alias("revenue_exposed"))


# Segment labels shown for cluster ids.
SEGMENT_LABELS = {"Cluster 0": "VIP Champions", "Cluster 1": "Loyal Regulars", "Cluster 2": "At-Risk Occasionals"}


def rule_segments(feats: DataFrame) -> DataFrame:
    """Deterministic segment label from the loyalty score — the stand-in for
    k-means cluster ids wherever a decision query must be checked exactly:
    ≥ 7 → Cluster 0, ≥ 4 → Cluster 1, else Cluster 2."""
    s = F.col("customer_loyalty_score")
    return feats.withColumn("cluster", F.when(s >= 7, "Cluster 0").when(s >= 4, "Cluster 1").otherwise("Cluster 2"))
