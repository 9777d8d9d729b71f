"""Product and inventory plans."""

from __future__ import annotations

from tillroll.functions.numeric import normal_sf_sql, round_half_up_sql, xmean_sql, xsum_sql
from tillroll.operators import inventory as iv
from tillroll.plans.catalog import register
from tillroll.sources.ledger import balances_sql, ledger_sql, sales_ledger, stock_balances

SALES = ledger_sql()
MIN_HOLD = repr(iv.MIN_UNIT_COST * iv.HOLDING_COST_RATE)


def inventory_sql(name: str = "inv", with_sales: bool = True) -> str:
    pol = ", ".join(f"('{c}', {sl}::DOUBLE, {z}::DOUBLE, {lt})" for c, sl, z, lt in iv.ABC_POLICY)
    z = "((simulated_current_stock - avg_daily_demand * CAST(lead_time AS DOUBLE)) / (demand_std_dev * sqrt(CAST(lead_time AS DOUBLE)) + 1e-5))"
    prob = round_half_up_sql(f"least(greatest({normal_sf_sql(z)}, 0.0::DOUBLE), 1.0::DOUBLE)", 4)
    head = f"sales AS ({SALES}),\n" if with_sales else ""
    return head + f"""
span AS (SELECT date_diff('day', min(CAST(date AS DATE)), max(CAST(date AS DATE))) + 1 AS total_days FROM sales),
dq AS (SELECT product_id, CAST(date AS DATE) AS d, sum(quantity_sold) AS q FROM sales GROUP BY 1, 2),
mom AS (SELECT product_id, sum(q * q) AS ss FROM dq GROUP BY 1),
agg AS (SELECT product_id, sum(sales_amount) AS rev_dec, sum(quantity_sold) AS total_quantity FROM sales GROUP BY 1),
st AS (
  SELECT agg.product_id, rev_dec, CAST(rev_dec AS DOUBLE) AS total_revenue, total_quantity,
         greatest(0.0::DOUBLE, total_quantity / CAST(total_days AS DOUBLE)) AS avg_daily_demand,
         sqrt(greatest(0.0::DOUBLE, (coalesce(ss, 0.0::DOUBLE) - total_quantity ** 2 / CAST(total_days AS DOUBLE))
                                    / (CAST(total_days AS DOUBLE) - 1))) AS demand_std_dev,
         greatest(0.01::DOUBLE, CAST(rev_dec AS DOUBLE) / greatest(total_quantity, 1.0::DOUBLE)) AS unit_cost,
         total_days
  FROM agg LEFT JOIN mom ON agg.product_id = mom.product_id, span),
ab AS (
  SELECT *, CAST(rev_dec AS DOUBLE) / CAST(sum(rev_dec) OVER () AS DOUBLE) AS revenue_pct,
         CAST(sum(rev_dec) OVER (ORDER BY rev_dec DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
           / CAST(sum(rev_dec) OVER () AS DOUBLE) AS cum_revenue_pct
  FROM st),
ab2 AS (SELECT *, CASE WHEN cum_revenue_pct <= 0.8 THEN 'A' WHEN cum_revenue_pct <= 0.95 THEN 'B' ELSE 'C' END AS abc_class FROM ab),
pol AS (SELECT * FROM (VALUES {pol}) t(abc_class, service_level, z_score, lead_time)),
ip AS (SELECT ab2.*, service_level, z_score, lead_time,
              z_score * demand_std_dev * sqrt(CAST(lead_time AS DOUBLE)) AS safety_stock
       FROM ab2 LEFT JOIN pol ON ab2.abc_class = pol.abc_class),
ip2 AS (SELECT *, avg_daily_demand * CAST(lead_time AS DOUBLE) + safety_stock AS reorder_point,
               greatest(0.0::DOUBLE, avg_daily_demand * 365.0::DOUBLE) AS annual_demand,
               greatest(0.2::DOUBLE * unit_cost, {MIN_HOLD}::DOUBLE) AS holding_cost_per_unit FROM ip),
ip3 AS (SELECT *, sqrt(greatest(0.0::DOUBLE, 2.0::DOUBLE * annual_demand * 50.0::DOUBLE) / holding_cost_per_unit) AS eoq FROM ip2),
balances AS ({balances_sql()}),
latest AS (SELECT product_id, arg_max(stock, as_of) AS on_hand FROM balances GROUP BY product_id),
stk AS (SELECT ip3.*, coalesce(on_hand, 0.0::DOUBLE) AS simulated_current_stock
        FROM ip3 LEFT JOIN latest ON ip3.product_id = latest.product_id),
{name} AS (
  SELECT *,
    CASE WHEN avg_daily_demand > 0 THEN simulated_current_stock / avg_daily_demand ELSE 999.0::DOUBLE END AS days_to_stockout,
    CASE WHEN simulated_current_stock < reorder_point
         THEN (reorder_point - simulated_current_stock) / (reorder_point + 1e-6) ELSE 0.0::DOUBLE END AS reorder_urgency,
    {prob} AS stockout_probability,
    CASE WHEN simulated_current_stock < safety_stock THEN 'Critical'
         WHEN simulated_current_stock < reorder_point THEN 'High'
         WHEN simulated_current_stock < 1.5::DOUBLE * reorder_point THEN 'Medium' ELSE 'Low' END AS risk_category
  FROM stk)"""


def master_sql(src: str = "inv") -> str:
    cols = []
    for c in iv.MASTER_COLUMNS:
        cols.append(f"{round_half_up_sql(c, iv.MASTER_ROUNDING[c])} AS {c}" if c in iv.MASTER_ROUNDING else c)
    return f"SELECT {', '.join(cols)} FROM {src}"


MASTER_SCHEMA = ("product_id string, abc_class string, service_level double, lead_time bigint, "
                 "total_revenue double, total_quantity double, avg_daily_demand double, annual_demand double, "
                 "demand_std_dev double, unit_cost double, z_score double, safety_stock double, "
                 "reorder_point double, eoq double, holding_cost_per_unit double, simulated_current_stock double, "
                 "days_to_stockout double, reorder_urgency double, stockout_probability double, risk_category string")


def _inv(spark, sf_dir):
    return iv.inventory_table(sales_ledger(spark, sf_dir), stock_balances(spark, sf_dir))


@register("inventory_master", "K6 K7 K8 K9 K10 K12 J10 A21 K3 F15 W11 S12", MASTER_SCHEMA,
          sql=f"WITH {inventory_sql()} {master_sql()}")
def inventory_master(spark, sf_dir):
    return iv.inventory_master(_inv(spark, sf_dir))


@register("abc_classification", "K7 W11",
          "product_id string, total_revenue double, revenue_pct double, cum_revenue_pct double, abc_class string",
          sql=f"WITH {inventory_sql()} SELECT product_id, total_revenue, revenue_pct, cum_revenue_pct, abc_class FROM inv")
def abc_classification(spark, sf_dir):
    return _inv(spark, sf_dir)


@register("reorder_top100", "K13 T2 T4",
          "product_id string, abc_class string, risk_category string, simulated_current_stock double, "
          "safety_stock double, reorder_point double, avg_daily_demand double, lead_time bigint, "
          "reorder_urgency double, days_to_stockout double, stockout_probability double, eoq double",
          sql=f"""WITH {inventory_sql()}, m AS ({master_sql()})
SELECT product_id, abc_class, risk_category, simulated_current_stock, safety_stock, reorder_point,
       avg_daily_demand, lead_time, reorder_urgency, days_to_stockout, stockout_probability, eoq
FROM m WHERE risk_category IN ('Critical', 'High')
ORDER BY abc_class ASC, reorder_urgency DESC, product_id ASC LIMIT 100""")
def reorder_top100(spark, sf_dir):
    return iv.reorder_recommendations(_inv(spark, sf_dir), 100)


@register("stockout_report", "K14 T11",
          "product_id string, abc_class string, risk_category string, simulated_current_stock double, "
          "safety_stock double, reorder_point double, avg_daily_demand double, demand_std_dev double, "
          "lead_time bigint, stockout_probability double, days_to_stockout double",
          sql=f"""WITH {inventory_sql()}, m AS ({master_sql()})
SELECT product_id, abc_class, risk_category, simulated_current_stock, safety_stock, reorder_point,
       avg_daily_demand, demand_std_dev, lead_time, stockout_probability, days_to_stockout
FROM m ORDER BY stockout_probability DESC, product_id""")
def stockout_report(spark, sf_dir):
    return iv.stockout_report(_inv(spark, sf_dir))


HEALTH_SQL = """
h AS (SELECT {a} AS pct_at_risk_a, {b} AS pct_at_risk_b, {c} AS pct_at_risk_c FROM inv)""".format(**{
    k.lower(): f"coalesce(avg(CASE WHEN abc_class = '{k}' THEN CASE WHEN risk_category IN ('Critical', 'High') "
               f"THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END) * 100.0::DOUBLE, 0.0::DOUBLE)" for k in "ABC"})
HEALTH_EXPR = round_half_up_sql(
    "least(100.0::DOUBLE, greatest(0.0::DOUBLE, 100.0::DOUBLE - (0.5::DOUBLE * pct_at_risk_a + 0.3::DOUBLE * pct_at_risk_b + 0.2::DOUBLE * pct_at_risk_c)))", 2)


@register("health_score", "K11 E2",
          "pct_at_risk_a double, pct_at_risk_b double, pct_at_risk_c double, health_score double",
          sql=f"WITH {inventory_sql()}, {HEALTH_SQL} SELECT *, {HEALTH_EXPR} AS health_score FROM h")
def health_score(spark, sf_dir):
    return iv.health_score(_inv(spark, sf_dir))


@register("abc_summary", "A18 E8",
          "abc_class string, product_count bigint, total_revenue double, total_quantity double, "
          "pct_of_catalog double, revenue_pct double, quantity_pct double",
          sql=f"""WITH {inventory_sql()},
g AS (SELECT abc_class, count(*) AS product_count, sum(rev_dec) AS rev, sum(total_quantity) AS total_quantity
      FROM inv GROUP BY abc_class)
SELECT abc_class, product_count, CAST(rev AS DOUBLE) AS total_revenue, total_quantity,
       product_count * 100.0::DOUBLE / sum(product_count) OVER () AS pct_of_catalog,
       CAST(rev AS DOUBLE) * 100.0::DOUBLE / CAST(sum(rev) OVER () AS DOUBLE) AS revenue_pct,
       CASE WHEN sum(total_quantity) OVER () <> 0 THEN total_quantity * 100.0::DOUBLE / sum(total_quantity) OVER () ELSE 0.0 END AS quantity_pct
FROM g""")
def abc_summary(spark, sf_dir):
    return iv.abc_summary(_inv(spark, sf_dir))


ROLLUP_SQL = """
roll AS (
  SELECT abc_class, {means}, count(*) AS products, {risks},
         quantile_cont(days_to_stockout, 0.5) AS median_days_to_stockout
  FROM inv GROUP BY abc_class)""".format(
    means=", ".join(f"{xmean_sql(c)} AS avg_{c}" for c in ("demand_std_dev", "safety_stock", "avg_daily_demand",
                                                            "reorder_point", "annual_demand", "unit_cost", "eoq")),
    risks=", ".join(f"sum(CASE WHEN risk_category = '{r}' THEN 1 ELSE 0 END) AS n_{r.lower()}" for r in iv.RISK_ORDER))


@register("class_rollup", "K16 A19 A13",
          "abc_class string, avg_demand_std_dev double, avg_safety_stock double, avg_avg_daily_demand double, "
          "avg_reorder_point double, avg_annual_demand double, avg_unit_cost double, avg_eoq double, "
          "products bigint, n_critical bigint, n_high bigint, n_medium bigint, n_low bigint, "
          "median_days_to_stockout double:8",
          sql=f"WITH {inventory_sql()}, {ROLLUP_SQL} SELECT * FROM roll")
def class_rollup(spark, sf_dir):
    return iv.class_rollup(_inv(spark, sf_dir))


def _kpi_sql() -> str:
    risk = ", ".join(f"sum(CASE WHEN risk_category = '{r}' THEN 1 ELSE 0 END) AS \"risk_category_counts.{r}\"" for r in iv.RISK_ORDER)
    abc = ", ".join(f"sum(CASE WHEN abc_class = '{c}' THEN 1 ELSE 0 END) AS \"abc_class_distribution.{c}.count\"" for c in "ABC")
    r2 = lambda e: round_half_up_sql(e, 2)
    one = f"""one AS (SELECT max(total_days) AS total_calendar_days, count(*) AS total_products, {risk},
        {xsum_sql('simulated_current_stock * unit_cost')} AS total_simulated_inventory_value_usd,
        {xsum_sql('greatest(0.0::DOUBLE, simulated_current_stock - reorder_point) * unit_cost')} AS excess_stock_value_usd,
        {abc} FROM inv)"""
    names = (["total_calendar_days", "total_products"] + [f"risk_category_counts.{r}" for r in iv.RISK_ORDER]
             + ["total_simulated_inventory_value_usd", "excess_stock_value_usd"]
             + [f"abc_class_distribution.{c}.count" for c in "ABC"])
    rnd = {"total_simulated_inventory_value_usd", "excess_stock_value_usd"}
    parts = [f"SELECT '{n}' AS metric, {r2(f'CAST(\"{n}\" AS DOUBLE)') if n in rnd else f'CAST(\"{n}\" AS DOUBLE)'} AS value FROM one" for n in names]
    parts += [f"SELECT '{n}' AS metric, {r2(n)} AS value FROM h" for n in ("pct_at_risk_a", "pct_at_risk_b", "pct_at_risk_c")]
    parts += [f"SELECT 'health_score' AS metric, {HEALTH_EXPR} AS value FROM h"]
    parts += [f"SELECT 'avg_days_to_stockout_class_' || lower(abc_class) AS metric, {r2('median_days_to_stockout')} AS value FROM roll",
              f"SELECT 'avg_eoq_class_' || lower(abc_class) AS metric, {r2('avg_eoq')} AS value FROM roll"]
    return f"WITH {inventory_sql()}, {HEALTH_SQL}, {ROLLUP_SQL}, {one}\n" + "\nUNION ALL\n".join(parts)


@register("inventory_kpis", "K15 E13", "metric string, value double", sql=_kpi_sql())
def inventory_kpis(spark, sf_dir):
    return iv.inventory_kpis(_inv(spark, sf_dir))


@register("inventory_checks", "K17 J12",
          "inventory_products bigint, negative_safety_stock bigint, negative_reorder_point bigint, "
          "negative_eoq bigint, null_policy_values bigint, source_products bigint, product_count_matches bigint, "
          "product_ids_match bigint",
          sql=f"""WITH {inventory_sql()},
g AS (SELECT count(*) AS inventory_products,
             sum(CASE WHEN safety_stock < 0 THEN 1 ELSE 0 END) AS negative_safety_stock,
             sum(CASE WHEN reorder_point < 0 THEN 1 ELSE 0 END) AS negative_reorder_point,
             sum(CASE WHEN eoq < 0 THEN 1 ELSE 0 END) AS negative_eoq,
             sum(CASE WHEN safety_stock IS NULL OR reorder_point IS NULL OR eoq IS NULL OR isnan(eoq) THEN 1 ELSE 0 END) AS null_policy_values
      FROM inv),
s AS (SELECT count(DISTINCT product_id) AS source_products FROM sales)
SELECT g.*, s.source_products, CASE WHEN inventory_products = source_products THEN 1 ELSE 0 END AS product_count_matches,
       CASE WHEN EXISTS (SELECT product_id FROM inv EXCEPT SELECT product_id FROM sales)
              OR EXISTS (SELECT product_id FROM sales EXCEPT SELECT product_id FROM inv) THEN 0 ELSE 1 END AS product_ids_match
FROM g, s""")
def inventory_checks(spark, sf_dir):
    led = sales_ledger(spark, sf_dir)
    return iv.inventory_checks(iv.inventory_table(led, stock_balances(spark, sf_dir)), led)


@register("product_recommendations", "K20 K19",
          "product_id string, abc_class string, risk_category string, rule_rank bigint, action string, priority string",
          sql=f"""WITH {inventory_sql()},
r AS (
  SELECT product_id, abc_class, risk_category,
    list_filter([
      CASE WHEN stockout_probability >= 0.5 OR reorder_urgency >= 0.6 OR simulated_current_stock < 0.5::DOUBLE * reorder_point
           THEN {{'action': 'REPLENISH_IMMEDIATELY', 'priority': 'Critical'}}
           WHEN simulated_current_stock < reorder_point THEN {{'action': 'REPLENISH_STANDARD', 'priority': 'High'}} END,
      CASE WHEN reorder_urgency >= 0.8 OR (days_to_stockout < 5 AND stockout_probability >= 0.8)
           THEN {{'action': 'EXPEDITE_SHIPMENT', 'priority': 'Critical'}} END,
      CASE WHEN abc_class = 'A' THEN {{'action': 'TIGHT_CONTROL_CLASS_A', 'priority': 'High'}}
           WHEN abc_class = 'C' THEN {{'action': 'REVIEW_CLASS_C_POLICY', 'priority': 'Low'}} END,
      CASE WHEN reorder_point > 0 AND simulated_current_stock > 3 * reorder_point
           THEN {{'action': 'REDUCE_OVERSTOCK', 'priority': 'Medium'}} END
    ], lambda x: x IS NOT NULL) AS recs
  FROM inv),
r2 AS (SELECT product_id, abc_class, risk_category,
              CASE WHEN len(recs) > 0 THEN recs ELSE [{{'action': 'MAINTAIN_HEALTHY_STOCK', 'priority': 'Low'}}] END AS recs
       FROM r)
SELECT product_id, abc_class, risk_category, i AS rule_rank, recs[i].action AS action, recs[i].priority AS priority
FROM r2, range(1, len(recs) + 1) t(i)""")
def product_recommendations(spark, sf_dir):
    return iv.product_recommendations(_inv(spark, sf_dir))


@register("risk_distribution", "E9 A11 K19",
          "risk_category string, products bigint, pct_products double, below_rop bigint",
          sql=f"""WITH {inventory_sql()}
SELECT risk_category, count(*) AS products, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct_products,
       sum(CASE WHEN simulated_current_stock < reorder_point THEN 1 ELSE 0 END) AS below_rop
FROM inv GROUP BY risk_category""")
def risk_distribution(spark, sf_dir):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    m = iv.risk_matrix(_inv(spark, sf_dir))
    g = m.groupBy("risk_category").agg(F.count(F.lit(1)).alias("products"), F.sum("below_rop").alias("below_rop"))
    return g.withColumn("pct_products", F.col("products") * 100.0 / F.sum("products").over(Window.partitionBy()))


PF_SCHEMA = ("product_id string, total_product_sales double, total_product_quantity double, "
             "average_product_revenue double, product_velocity double, product_total_revenue double, "
             "product_rank_by_revenue bigint, product_popularity_rank bigint, product_revenue_contribution double, "
             "weekend_sales_ratio double, slow_moving_inventory_flag bigint, daily_demand_std double, "
             "safety_stock double, reorder_point double, assumed_current_stock double, days_to_stockout double, "
             "low_stock_flag bigint, inventory_risk_score double")


@register("product_features", "A4 K1 K2 K3 K4 K5 W1 J11", PF_SCHEMA, sql=f"""
WITH sales AS ({SALES}),
span AS (SELECT date_diff('day', min(CAST(date AS DATE)), max(CAST(date AS DATE))) + 1 AS total_days,
                max(CAST(date AS DATE)) + 1 AS ref FROM sales),
grand AS (SELECT CAST(sum(sales_amount) AS DOUBLE) AS g FROM sales),
p AS (SELECT product_id, CAST(sum(sales_amount) AS DOUBLE) AS total_product_sales,
             sum(quantity_sold) AS total_product_quantity,
             CAST(sum(sales_amount) AS DOUBLE) / count(*) AS average_product_revenue,
             sum(CASE WHEN isodow(date) IN (6, 7) THEN quantity_sold ELSE 0.0 END) AS wqty,
             max(CAST(date AS DATE)) AS last_d, sum(quantity_sold * quantity_sold) AS qsq
      FROM sales GROUP BY product_id),
f AS (SELECT product_id, total_product_sales, total_product_quantity, average_product_revenue,
             total_product_quantity / CAST(total_days AS DOUBLE) AS product_velocity,
             total_product_sales AS product_total_revenue,
             total_product_sales / (g + 1e-5) AS product_revenue_contribution,
             CASE WHEN total_product_quantity > 0 THEN least(greatest(wqty / total_product_quantity, 0.0), 1.0) ELSE 0.0 END AS weekend_sales_ratio,
             date_diff('day', last_d, ref) AS since_last,
             sqrt(greatest(0.0::DOUBLE, (qsq - total_product_quantity ** 2 / CAST(total_days AS DOUBLE)) / (CAST(total_days AS DOUBLE) - 1))) AS daily_demand_std,
             rank() OVER (ORDER BY total_product_sales DESC) AS product_rank_by_revenue,
             rank() OVER (ORDER BY total_product_quantity DESC) AS product_popularity_rank
      FROM p, span, grand),
q AS (SELECT quantile_cont(product_velocity, 0.25) AS q25 FROM f),
g2 AS (SELECT f.*, q25, greatest(0.0::DOUBLE, product_velocity) AS v,
              1.96::DOUBLE * daily_demand_std * sqrt(7.0::DOUBLE) AS safety_stock FROM f, q),
g3 AS (SELECT *, v * 7.0::DOUBLE + safety_stock AS reorder_point, v * 10.0::DOUBLE AS assumed_current_stock FROM g2)
SELECT product_id, total_product_sales, total_product_quantity, average_product_revenue, product_velocity,
       product_total_revenue, product_rank_by_revenue, product_popularity_rank, product_revenue_contribution,
       weekend_sales_ratio,
       CASE WHEN product_velocity <= q25 AND since_last > 30 THEN 1 ELSE 0 END AS slow_moving_inventory_flag,
       daily_demand_std, safety_stock, reorder_point, assumed_current_stock,
       CASE WHEN v > 0 THEN assumed_current_stock / v ELSE 999.0 END AS days_to_stockout,
       CASE WHEN v > 0 AND assumed_current_stock < reorder_point THEN 1 ELSE 0 END AS low_stock_flag,
       CASE WHEN v > 0 THEN least(greatest(least(1.0::DOUBLE, reorder_point / (assumed_current_stock + 1e-5)), 0.0), 1.0) ELSE 0.0 END AS inventory_risk_score
FROM g3""")
def product_features(spark, sf_dir):
    return iv.product_features(sales_ledger(spark, sf_dir))


KPI_NAMES = ["total_products", "health_score", "risk_category_counts.Critical", "risk_category_counts.High",
             "excess_stock_value_usd", "avg_eoq_class_a"]


@register("inventory_kpi_wide", "E13", ", ".join(f"{n.replace('.', '_')} double" for n in KPI_NAMES),
          sql=_kpi_sql().replace("WITH ", "WITH kl AS (WITH ", 1) + ")\nSELECT " + ", ".join(
              f"coalesce(max(CASE WHEN metric = '{n}' THEN value END), 0.0) AS {n.replace('.', '_')}" for n in KPI_NAMES)
          + " FROM kl")
def inventory_kpi_wide(spark, sf_dir):
    from tillroll.operators import decisions as de
    return de.kpi_pivot(iv.inventory_kpis(_inv(spark, sf_dir)), KPI_NAMES)


@register("inventory_audit", "K18 K4 S12 A18", "metric string, value double")
def inventory_audit(spark, sf_dir):
    return iv.inventory_audit(sales_ledger(spark, sf_dir))


@register("inventory_with_balances", "K9 K10 K12", MASTER_SCHEMA, sql=f"""WITH {inventory_sql("inv0")},
older AS (SELECT product_id, arg_max(stock, as_of) AS s FROM balances
          WHERE as_of <= (SELECT max(as_of) - 180 FROM balances) GROUP BY product_id),
inv1 AS (SELECT inv0.* EXCLUDE (simulated_current_stock, days_to_stockout, reorder_urgency, stockout_probability, risk_category),
                coalesce(older.s, 0.0) AS simulated_current_stock
         FROM inv0 LEFT JOIN older ON inv0.product_id = older.product_id),
inv AS (
  SELECT *,
    CASE WHEN avg_daily_demand > 0 THEN simulated_current_stock / avg_daily_demand ELSE 999.0::DOUBLE END AS days_to_stockout,
    CASE WHEN simulated_current_stock < reorder_point
         THEN (reorder_point - simulated_current_stock) / (reorder_point + 1e-6) ELSE 0.0::DOUBLE END AS reorder_urgency,
    {round_half_up_sql(f"least(greatest({normal_sf_sql('((simulated_current_stock - avg_daily_demand * CAST(lead_time AS DOUBLE)) / (demand_std_dev * sqrt(CAST(lead_time AS DOUBLE)) + 1e-5))')}, 0.0::DOUBLE), 1.0::DOUBLE)", 4)} AS stockout_probability,
    CASE WHEN simulated_current_stock < safety_stock THEN 'Critical'
         WHEN simulated_current_stock < reorder_point THEN 'High'
         WHEN simulated_current_stock < 1.5::DOUBLE * reorder_point THEN 'Medium' ELSE 'Low' END AS risk_category
  FROM inv1)
{master_sql()}""")
def inventory_with_balances(spark, sf_dir):
    """K9 with the balances known half a year before the last one: the latest
    of these per product is attached, products without one get 0."""
    from pyspark.sql import functions as F
    balances = stock_balances(spark, sf_dir)
    cut = balances.agg(F.date_sub(F.max("as_of"), 180).alias("_cut"))  # one row
    known = balances.crossJoin(F.broadcast(cut)).where(F.col("as_of") <= F.col("_cut")).drop("_cut")
    return iv.inventory_master(iv.inventory_table(sales_ledger(spark, sf_dir), known))
