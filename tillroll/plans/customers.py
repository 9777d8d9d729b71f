"""Customer plans."""

from __future__ import annotations

from tillroll.functions.numeric import round_half_up_sql, xmean_sql, xsum_sql
from tillroll.operators import customers as cu
from tillroll.plans.catalog import register
from tillroll.sources.ledger import ledger_sql, sales_ledger

SALES = ledger_sql()
# Fixed parameters of the point-in-time churn dataset on the driver tables
# (their orders run 1995-01-01 .. 2001-08-01).
CUTOFF = "2001-05-01"
HORIZON = 90


def customer_features_sql(as_of: str | None = None, name: str = "cf", with_sales: bool = True) -> str:
    """CTE chain ending in relation ``name`` = customer feature table; the
    helper relations are prefixed with ``name`` so several chains compose."""
    p = f"{name}_"
    if as_of is None:
        lines = "SELECT * FROM sales WHERE customer_id IS NOT NULL"
        anchor = "SELECT max(CAST(date AS DATE)) + 1 AS ref FROM sales"
    else:
        lines = (f"SELECT * FROM sales WHERE customer_id IS NOT NULL "
                 f"AND date < CAST(DATE '{as_of}' + 1 AS TIMESTAMP)")
        anchor = f"SELECT DATE '{as_of}' + 1 AS ref"
    loyalty = round_half_up_sql(
        "1.0::DOUBLE + ((0.2::DOUBLE * r_score + 0.3::DOUBLE * f_score) + 0.5::DOUBLE * m_score - 1.0::DOUBLE) * 2.25::DOUBLE", 2)
    head = f"sales AS ({SALES}),\n" if with_sales else ""
    return head + f"""
{p}lines AS ({lines}),
{p}anchor AS ({anchor}),
{p}agg AS (
  SELECT customer_id, max(CAST(date AS DATE)) AS last_d, min(CAST(date AS DATE)) AS first_d,
         count(DISTINCT transaction_id) AS frequency, CAST(sum(sales_amount) AS DOUBLE) AS monetary,
         sum(quantity_sold) AS qty, count(DISTINCT date_trunc('month', date)) AS active_months,
         CAST(sum(CASE WHEN isodow(date) IN (6, 7) THEN sales_amount ELSE 0 END) AS DOUBLE) AS weekend
  FROM {p}lines GROUP BY customer_id),
{p}b0 AS (
  SELECT customer_id, date_diff('day', last_d, ref) AS recency, frequency, monetary,
         CASE WHEN frequency <> 0 THEN monetary / frequency ELSE 0.0 END AS average_purchase_value,
         CASE WHEN frequency <> 0 THEN qty / frequency ELSE 0.0 END AS quantity_per_order,
         active_months,
         CASE WHEN active_months <> 0 THEN frequency / active_months ELSE 0.0 END AS purchase_frequency,
         date_diff('day', first_d, ref) AS customer_tenure,
         CASE WHEN frequency > 1 THEN date_diff('day', first_d, ref) / (frequency - 1)
              ELSE CAST(date_diff('day', first_d, ref) AS DOUBLE) END AS gap0,
         CASE WHEN monetary > 0 THEN least(greatest(weekend / monetary, 0.0), 1.0) ELSE 0.0 END AS weekend_sales_ratio
  FROM {p}agg, {p}anchor),
{p}b1 AS (SELECT * EXCLUDE (gap0), CASE WHEN gap0 = 0 THEN 30.0::DOUBLE ELSE gap0 END AS avg_days_between_purchases FROM {p}b0),
{p}base AS (
  SELECT *, least(1.0::DOUBLE, recency / (2 * avg_days_between_purchases + 30.0::DOUBLE)) AS customer_risk_score
  FROM {p}b1),
{p}q AS (SELECT quantile_cont(monetary, 0.9) AS q90, quantile_cont(recency, 0.2) AS e1,
             quantile_cont(recency, 0.4) AS e2, quantile_cont(recency, 0.6) AS e3,
             quantile_cont(recency, 0.8) AS e4 FROM {p}base),
{p}rk AS (
  SELECT {p}base.*, {p}q.*,
         row_number() OVER (ORDER BY frequency, customer_id) AS rf,
         row_number() OVER (ORDER BY monetary, customer_id) AS rm,
         count(*) OVER () AS n,
         rank() OVER (ORDER BY monetary DESC) AS customer_rank_by_revenue
  FROM {p}base, {p}q),
{p}sc AS (
  SELECT *,
    CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ceil(5.0::DOUBLE * (rf - 1) / (n - 1))) END AS f_score,
    CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ceil(5.0::DOUBLE * (rm - 1) / (n - 1))) END AS m_score,
    6 - (1 + (recency > e1)::INT + (recency > e2)::INT + (recency > e3)::INT + (recency > e4)::INT) AS r_score
  FROM {p}rk),
{name} AS (
  SELECT customer_id, recency, frequency, monetary, average_purchase_value, quantity_per_order,
         active_months, purchase_frequency, {loyalty} AS customer_loyalty_score,
         customer_risk_score, CASE WHEN monetary >= q90 THEN 1 ELSE 0 END AS high_value_customer_flag,
         customer_tenure, avg_days_between_purchases, weekend_sales_ratio, customer_rank_by_revenue,
         CASE WHEN customer_risk_score > 0.7 THEN 1 ELSE 0 END AS churn_warning_flag,
         CASE WHEN frequency = 1 AND recency > 90 THEN 1 ELSE 0 END AS lost_one_time_buyer_flag
  FROM {p}sc)"""


def churn_sql(name: str = "churn", with_sales: bool = True) -> str:
    return customer_features_sql(CUTOFF, "pit", with_sales) + f""",
act AS (SELECT DISTINCT customer_id FROM sales WHERE customer_id IS NOT NULL
        AND date >= CAST(DATE '{CUTOFF}' + 1 AS TIMESTAMP)
        AND date < CAST(DATE '{CUTOFF}' + {1 + HORIZON} AS TIMESTAMP)),
{name} AS (
  SELECT p.customer_id, frequency, monetary, recency, average_purchase_value, customer_tenure,
         active_months, purchase_frequency, avg_days_between_purchases, weekend_sales_ratio,
         customer_loyalty_score, quantity_per_order, customer_rank_by_revenue, high_value_customer_flag,
         CASE WHEN act.customer_id IS NULL THEN 1 ELSE 0 END AS true_churn_flag
  FROM pit p LEFT JOIN act ON p.customer_id = act.customer_id)"""


def pred_sql(name: str = "pred", with_sales: bool = True) -> str:
    risk = "least(1.0::DOUBLE, recency / (2 * avg_days_between_purchases + 30.0::DOUBLE))"
    return churn_sql(with_sales=with_sales) + f""",
{name} AS (
  SELECT customer_id, {risk} AS churn_probability, true_churn_flag, recency, frequency, monetary,
         customer_loyalty_score,
         CASE WHEN {risk} < 0.30 THEN 'Low Risk' WHEN {risk} < 0.70 THEN 'Medium Risk' ELSE 'High Risk' END AS risk_category
  FROM churn)"""


CF_SCHEMA = ("customer_id string, recency bigint, frequency bigint, monetary double, "
             "average_purchase_value double, quantity_per_order double, active_months bigint, "
             "purchase_frequency double, customer_loyalty_score double, customer_risk_score double, "
             "high_value_customer_flag bigint, customer_tenure bigint, avg_days_between_purchases double, "
             "weekend_sales_ratio double, customer_rank_by_revenue bigint, churn_warning_flag bigint, "
             "lost_one_time_buyer_flag bigint")

CHURN_SCHEMA = ("customer_id string, frequency bigint, monetary double, recency bigint, "
                "average_purchase_value double, customer_tenure bigint, active_months bigint, "
                "purchase_frequency double, avg_days_between_purchases double, weekend_sales_ratio double, "
                "customer_loyalty_score double, quantity_per_order double, customer_rank_by_revenue bigint, "
                "high_value_customer_flag bigint, true_churn_flag bigint")

PRED_SCHEMA = ("customer_id string, churn_probability double, true_churn_flag bigint, recency bigint, "
               "frequency bigint, monetary double, customer_loyalty_score double, risk_category string")

CHURN_FEATURES = [c for c in cu.CHURN_COLUMNS if c not in ("customer_id", "true_churn_flag")]


@register("enriched_sales", "C1 F1 F2 F3 F4 F11",
          "transaction_id string, date date, customer_id string, product_id string, quantity_sold double, "
          "unit_price double, sales_amount double, year bigint, month bigint, quarter bigint, "
          "week_of_year bigint, day_of_week bigint, day_name string, is_weekend bigint, sales_per_unit double",
          sql=f"""
WITH sales AS ({SALES})
SELECT transaction_id, date, customer_id, product_id, quantity_sold, unit_price, sales_amount,
       year(date) AS year, month(date) AS month, quarter(date) AS quarter, weekofyear(date) AS week_of_year,
       isodow(date) - 1 AS day_of_week, dayname(date) AS day_name,
       CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN quantity_sold <> 0 THEN CAST(sales_amount AS DOUBLE) / quantity_sold ELSE 0.0 END AS sales_per_unit
FROM sales""")
def enriched_sales(spark, sf_dir):
    return cu.enrich_sales(sales_ledger(spark, sf_dir))


@register("customer_features", "A1 A2 A3 C2 C3 C4 C5 C6 C7 C8 C9 W1 W2 W3 F6", CF_SCHEMA,
          sql=f"WITH {customer_features_sql()} SELECT * FROM cf")
def customer_features(spark, sf_dir):
    return cu.customer_features(sales_ledger(spark, sf_dir))


@register("churn_dataset", "C10 C11 J8 U5", CHURN_SCHEMA, sql=f"WITH {churn_sql()} SELECT * FROM churn")
def churn_dataset(spark, sf_dir):
    return cu.churn_dataset(sales_ledger(spark, sf_dir), CUTOFF, HORIZON)


def _leak_sql() -> str:
    parts = []
    for c in CHURN_FEATURES:
        r = (f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) > 0 AND stddev_pop(CAST(true_churn_flag AS DOUBLE)) > 0 "
             f"THEN corr(CAST({c} AS DOUBLE), CAST(true_churn_flag AS DOUBLE)) END")
        parts.append(f"SELECT '{c}' AS feature, {r} AS correlation, count(DISTINCT {c}) AS n_distinct FROM churn")
    return f"""WITH {churn_sql()}, l AS ({' UNION ALL '.join(parts)})
SELECT feature, correlation, abs(correlation) AS abs_correlation,
       CASE WHEN abs(correlation) > 0.95 THEN 'fail' WHEN abs(correlation) > 0.90 THEN 'high'
            WHEN abs(correlation) > 0.70 THEN 'medium' ELSE 'ok' END AS leakage_level,
       CASE WHEN n_distinct <= 1 THEN 1 ELSE 0 END AS is_constant
FROM l"""


@register("leakage_audit", "C12 Q13", "feature string, correlation double, abs_correlation double, "
          "leakage_level string, is_constant bigint", sql=_leak_sql())
def leakage_audit(spark, sf_dir):
    ch = cu.churn_dataset(sales_ledger(spark, sf_dir), CUTOFF, HORIZON)
    return cu.leakage_audit(ch, "true_churn_flag", CHURN_FEATURES)


@register("churn_rule_scores", "C13 M14", PRED_SCHEMA, sql=f"WITH {pred_sql()} SELECT * FROM pred")
def churn_rule_scores(spark, sf_dir):
    return cu.rule_churn_scores(cu.churn_dataset(sales_ledger(spark, sf_dir), CUTOFF, HORIZON))


@register("risk_summary", "C14 C15 A11 A12",
          "risk_category string, band_order bigint, customers bigint, pct_customers double, "
          "avg_churn_probability double, avg_recency double, avg_frequency double, avg_monetary double, "
          "avg_loyalty double, actual_churn_rate double, revenue_exposed double",
          sql=f"""WITH {pred_sql()},
bands AS (SELECT * FROM (VALUES ('Low Risk', 0), ('Medium Risk', 1), ('High Risk', 2)) t(risk_category, band_order)),
g AS (SELECT risk_category, count(*) AS customers,
             {xmean_sql('churn_probability')} AS avg_churn_probability, {xmean_sql('recency')} AS avg_recency,
             {xmean_sql('frequency')} AS avg_frequency, {xmean_sql('monetary')} AS avg_monetary,
             {xmean_sql('customer_loyalty_score')} AS avg_loyalty, {xmean_sql('true_churn_flag')} AS actual_churn_rate,
             {xsum_sql('monetary')} AS revenue_exposed
      FROM pred GROUP BY risk_category)
SELECT b.risk_category, b.band_order, coalesce(customers, 0) AS customers,
       coalesce(customers, 0) * 100.0::DOUBLE / sum(coalesce(customers, 0)) OVER () AS pct_customers,
       avg_churn_probability, avg_recency, avg_frequency, avg_monetary, avg_loyalty, actual_churn_rate,
       coalesce(revenue_exposed, 0.0) AS revenue_exposed
FROM bands b LEFT JOIN g ON b.risk_category = g.risk_category""")
def risk_summary(spark, sf_dir):
    return cu.risk_summary(cu.rule_churn_scores(cu.churn_dataset(sales_ledger(spark, sf_dir), CUTOFF, HORIZON)))
