"""Cleaning plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import cleaning as cl
from tillroll.operators import customers as cu
from tillroll.plans.catalog import register
from tillroll.plans.customers import customer_features_sql
from tillroll.sources.ledger import ledger_sql, sales_ledger

SALES = ledger_sql()


def _report_sql(profile: str) -> str:
    if profile == "standard":
        bad, price = "product_id = 'B' AND unit_price < 0", "unit_price = 0"
    else:
        bad, price = "product_id = 'B'", "unit_price <= 0"
    steps = ", ".join(f"({i}, '{s}')" for i, s in enumerate(cl.REPORT_STEPS))
    return f"""
WITH sales AS ({SALES}),
std AS (SELECT trim(transaction_id) AS transaction_id, source_system, date,
               CASE WHEN regexp_replace(trim(customer_id), '\\.0$', '') IN ('nan', 'NaN', 'None', '') THEN NULL
                    ELSE regexp_replace(trim(customer_id), '\\.0$', '') END AS customer_id,
               trim(product_id) AS product_id, quantity_sold, unit_price, sales_amount, trim(region) AS region
        FROM sales),
d AS (SELECT DISTINCT * FROM std),
t AS (SELECT *, CASE WHEN {bad} THEN 'bad_debt_removed' WHEN {price} THEN 'zero_price_removed'
                     WHEN product_id IN ('TEST001', 'BANK CHARGES') THEN 'test_bank_charges_removed' END AS rule FROM d),
c AS (SELECT (SELECT count(*) FROM std) AS initial_rows,
             (SELECT count(*) FROM std) - count(*) AS duplicates_removed,
             count(*) FILTER (WHERE rule = 'bad_debt_removed') AS bad_debt_removed,
             count(*) FILTER (WHERE rule = 'zero_price_removed') AS zero_price_removed,
             count(*) FILTER (WHERE rule = 'test_bank_charges_removed') AS test_bank_charges_removed,
             count(*) FILTER (WHERE rule IS NULL) AS final_rows,
             count(*) FILTER (WHERE rule IS NULL AND starts_with(transaction_id, 'C')) AS returns_kept
      FROM t),
steps AS (SELECT * FROM (VALUES {steps}) s(step_order, step))
SELECT step_order, step,
       CASE step WHEN 'initial_rows' THEN initial_rows WHEN 'duplicates_removed' THEN duplicates_removed
                 WHEN 'bad_debt_removed' THEN bad_debt_removed WHEN 'zero_price_removed' THEN zero_price_removed
                 WHEN 'test_bank_charges_removed' THEN test_bank_charges_removed WHEN 'final_rows' THEN final_rows
                 ELSE returns_kept END AS rows
FROM steps, c"""


REPORT_SCHEMA = "step_order bigint, step string, rows bigint"


@register("clean_report", "P1 P2 P3 P4 P6 P7 P8 P9 P10 S1", REPORT_SCHEMA, sql=_report_sql("standard"))
def clean_report(spark, sf_dir):
    return cl.clean_sales(sales_ledger(spark, sf_dir), "standard")[1]


@register("clean_report_strict", "P6 P7 P10 (strict profile, D7)", REPORT_SCHEMA, sql=_report_sql("strict"))
def clean_report_strict(spark, sf_dir):
    return cl.clean_sales(sales_ledger(spark, sf_dir), "strict")[1]


REPAIR_INT = ["recency", "frequency", "active_months", "customer_tenure"]
REPAIR_FLOAT = ["monetary", "average_purchase_value", "quantity_per_order", "purchase_frequency"]


@register("customer_repair_report", "P13 P14 P19",
          "column string, type_before string, type_after string, nulls_before bigint, nulls_after bigint, "
          "negatives_clipped bigint, non_finite_nulled bigint",
          sql=f"""WITH {customer_features_sql()}
{' UNION ALL '.join(
    f"SELECT '{c}' AS column, '{'int' if c in ('recency', 'customer_tenure') else ('bigint' if c in REPAIR_INT else 'double')}' AS type_before, "
    f"'{'bigint' if c in REPAIR_INT else 'double'}' AS type_after, count(*) FILTER (WHERE {c} IS NULL) AS nulls_before, "
    f"count(*) FILTER (WHERE {c} IS NULL OR isinf(CAST({c} AS DOUBLE)) OR isnan(CAST({c} AS DOUBLE))) AS nulls_after, "
    f"count(*) FILTER (WHERE {c} < 0) AS negatives_clipped, "
    f"count(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE)) OR isnan(CAST({c} AS DOUBLE))) AS non_finite_nulled FROM cf"
    for c in REPAIR_INT + REPAIR_FLOAT)}""")
def customer_repair_report(spark, sf_dir):
    feats = cu.customer_features(sales_ledger(spark, sf_dir))
    fixed = cl.repair_numeric(feats, REPAIR_INT, REPAIR_FLOAT)
    return cl.column_repair_report(feats, fixed, REPAIR_INT + REPAIR_FLOAT)


@register("refund_customers", "P18",
          "customers bigint, refund_customers bigint, pct_refund double, median_monetary double:8, median_frequency double:8",
          sql=f"""WITH {customer_features_sql()},
r AS (SELECT * FROM cf WHERE monetary <= 0 OR quantity_per_order <= 0)
SELECT (SELECT count(*) FROM cf) AS customers, (SELECT count(*) FROM r) AS refund_customers,
       (SELECT count(*) FROM r) * 100.0::DOUBLE / (SELECT count(*) FROM cf) AS pct_refund,
       (SELECT quantile_cont(monetary, 0.5) FROM r) AS median_monetary,
       (SELECT quantile_cont(frequency, 0.5) FROM r) AS median_frequency""")
def refund_customers(spark, sf_dir):
    return cl.split_refund_customers(cu.customer_features(sales_ledger(spark, sf_dir)))[2]


# ----------------------------------------------------------------- sources
from tillroll.operators import inventory as _iv  # noqa: E402
from tillroll.sources import sinks as _sk  # noqa: E402
from tillroll.sources.tables import read_table as _read  # noqa: E402

HEALTH_TABLES = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey"],
                 "customer": ["c_custkey"], "part": ["p_partkey"], "events": ["event_id"]}


# the given tables are one file each
@register("table_health", "S10 A22", "table_name string, rows bigint, columns bigint, key_null_rate double, files bigint",
          sql="\nUNION ALL\n".join(
              f"SELECT '{name}' AS table_name, count(*) AS rows, (SELECT count(*) FROM (DESCRIBE {name})) AS columns, "
              f"count(*) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in keys)}) / greatest(count(*), 1) AS key_null_rate, 1 AS files FROM {name}"
              for name, keys in HEALTH_TABLES.items()))
def table_health(spark, sf_dir):
    t = {n: (_read(spark, sf_dir, n), keys) for n, keys in HEALTH_TABLES.items()}
    return _sk.table_health(spark, t).select("table_name", "rows", "columns", "key_null_rate", "files")


@register("date_coverage", "S12 F6", "first_date date, last_date date, total_days bigint, matches_expected bigint",
          sql=f"""WITH sales AS ({SALES})
SELECT min(CAST(date AS DATE)) AS first_date, max(CAST(date AS DATE)) AS last_date,
       date_diff('day', min(CAST(date AS DATE)), max(CAST(date AS DATE))) + 1 AS total_days,
       CASE WHEN date_diff('day', min(CAST(date AS DATE)), max(CAST(date AS DATE))) + 1 = 699 THEN 1 ELSE 0 END AS matches_expected
FROM sales""")
def date_coverage(spark, sf_dir):
    return _iv.date_coverage(sales_ledger(spark, sf_dir), expected_days=699)


@register("export_roundtrip", "S1 S2 S5 S6", "artefact string, rows bigint", sql=f"""
WITH sales AS ({SALES}),
d AS (SELECT CAST(date AS DATE) AS d FROM sales)
SELECT 'products.csv' AS artefact, count(DISTINCT product_id) AS rows FROM sales
UNION ALL SELECT 'products.json', count(DISTINCT product_id) FROM sales
UNION ALL SELECT 'products.parquet', count(DISTINCT product_id) FROM sales
UNION ALL SELECT 'report.json', 1
UNION ALL SELECT 'calendar_days', date_diff('day', min(d), max(d)) + 1 FROM d""")
def export_roundtrip(spark, sf_dir):
    """Write the product table in three formats plus a JSON report (S5, S6),
    re-read the CSV tolerantly (S1, S2) and count every artefact."""
    import uuid

    from pyspark.sql import functions as F

    from tillroll.session import ensure_checkpoint_dir
    from tillroll.sources.tables import read_csv_table
    led = sales_ledger(spark, sf_dir)
    prods = led.groupBy("product_id").agg(F.sum("sales_amount").cast("double").alias("revenue"),
                                         F.sum("quantity_sold").alias("quantity"))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-export-{uuid.uuid4().hex[:12]}"
    for fmt in ("csv", "json", "parquet"):
        _sk.write_table(prods, f"{base}/products.{fmt}", fmt)
    _sk.write_report(_iv.date_coverage(led), f"{base}/report.json")
    csv = read_csv_table(spark, f"{base}/products.csv", trim_headers=True, required=["product_id"],
                         drop_null_keys=["product_id"])
    parts = [
        csv.agg(F.lit("products.csv").alias("artefact"), F.count(F.lit(1)).alias("rows")),
        spark.read.json(f"{base}/products.json").agg(F.lit("products.json").alias("artefact"), F.count(F.lit(1)).alias("rows")),
        spark.read.parquet(f"{base}/products.parquet").agg(
            F.lit("products.parquet").alias("artefact"), F.count(F.lit(1)).alias("rows")),
        spark.read.text(f"{base}/report.json").agg(F.lit("report.json").alias("artefact"), F.count(F.lit(1)).alias("rows")),
        spark.read.text(f"{base}/report.json").select(
            F.lit("calendar_days").alias("artefact"),
            F.get_json_object("value", "$.total_days").cast("long").alias("rows")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("export_versions", "S7 S9", "table_name string, version bigint, rows bigint, unit_revenues bigint", sql=f"""
WITH sales AS ({SALES}),
p AS (SELECT count(DISTINCT product_id) AS n FROM sales),
d AS (SELECT date_diff('day', min(CAST(date AS DATE)), max(CAST(date AS DATE))) + 1 AS n FROM sales),
one AS (SELECT 'cleaned_sales' AS table_name, count(*) AS rows FROM sales
        UNION ALL SELECT 'enhanced_sales', count(*) FROM sales
        UNION ALL SELECT 'customer_features', count(DISTINCT customer_id) FROM sales
        UNION ALL SELECT 'product_features', n FROM p UNION ALL SELECT 'forecast_features', n FROM d)
SELECT table_name, 1 AS version, rows, 0 AS unit_revenues FROM one
UNION ALL SELECT 'product_features', 2, n, n FROM p
UNION ALL SELECT 'product_features', 3, n, 0 FROM p""")
def export_versions(spark, sf_dir):
    """The five result tables committed as one version (S9), a column back-filled in place as the
    second (S7), the first made the newest again as the third; all read back."""
    import uuid

    from pyspark.sql import functions as F

    from tillroll.operators import customers as cu
    from tillroll.operators import inventory as iv
    from tillroll.operators import timeseries as ts
    from tillroll.session import ensure_checkpoint_dir
    from tillroll.sources.versions import Versions
    led = sales_ledger(spark, sf_dir)
    store = Versions(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-store-{uuid.uuid4().hex[:12]}")
    store.commit({"cleaned_sales": led, "enhanced_sales": cu.enrich_sales(led), "customer_features": cu.customer_base(led),
                  "product_features": iv.product_features(led), "forecast_features": ts.daily_features(led)})
    store.update("product_features", lambda df: df.withColumn(
        "unit_revenue", F.col("total_product_sales") / F.greatest(F.col("total_product_quantity"), F.lit(1.0))))
    store.rollback(1)
    out = None
    for version in store.versions():
        for name in store.manifest(version)["tables"] if version == 1 else ["product_features"]:
            df = store.read(name, version)
            new = F.count("unit_revenue") if "unit_revenue" in df.columns else F.lit(0)
            row = df.agg(F.lit(name).alias("table_name"), F.lit(version).alias("version"), F.count(F.lit(1)).alias("rows"), new.alias("unit_revenues"))
            out = row if out is None else out.unionByName(row)
    return out


@register("customer_master_clean", "P5 P11 P12 J2 F16", "customer_id string, segment string, nation string", sql="""
WITH one AS (SELECT c_custkey, arg_max(c_mktsegment, c_acctbal) AS seg, arg_max(c_nationkey, c_acctbal) AS nat
             FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey)
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, upper(left(trim(seg), 1)) || lower(substr(trim(seg), 2)) AS segment, n_name AS nation
FROM one LEFT JOIN nation ON nat = n_nationkey""")
def customer_master_clean(spark, sf_dir):
    """Customer dimension: one row per id (first by account balance), market
    segment title-cased, nation from a broadcast 25-row lookup."""
    from pyspark.sql import functions as F
    cust = _read(spark, sf_dir, "customer")
    nat = F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    c = cust.select(F.col("c_custkey").cast("string").alias("customer_id"), "c_acctbal", "c_nationkey",
                    F.col("c_mktsegment").alias("segment"))
    c = cl.dedupe_by_key(cl.with_customer(c), ["customer_id"], [-F.col("c_acctbal")])
    c = cl.clean_categorical_cols(c, ["segment"])
    return c.join(nat, c.c_nationkey == nat.n_nationkey, "left").select(
        "customer_id", "segment", F.col("n_name").alias("nation"))
