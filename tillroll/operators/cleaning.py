"""Ledger cleaning.

Rule order matters for the removal report (each count is taken after the
earlier rules).  Instead of filtering step by step, every distinct row is
tagged with the first rule it matches and the tags are counted in one pass;
exact duplicates are found with a ``groupBy`` over all columns, whose
partial aggregation copes with one row repeated many times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.numeric import finite_or_null
from tillroll.functions.text import clean_categorical, normalize_id
from tillroll.operators import ranking

# Fixed values of the reference cleaning rules.
PLACEHOLDER_COLUMNS = ["store_id", "category", "discount", "payment_method"]
ADMIN_CODES = ["TEST001", "BANK CHARGES"]
BAD_DEBT_PRODUCT = "B"
RETURN_PREFIX = "C"

REPORT_STEPS = ["initial_rows", "duplicates_removed", "bad_debt_removed", "zero_price_removed",
                "test_bank_charges_removed", "final_rows", "returns_kept"]


def drop_if_present(df: DataFrame, cols: Sequence[str] = PLACEHOLDER_COLUMNS) -> DataFrame:
    """P1 (``drop`` already ignores absent names)."""
    return df.drop(*cols)


def trim_cols(df: DataFrame, cols: Sequence[str] = ("transaction_id", "product_id", "region")) -> DataFrame:
    """P2 trim the listed string columns that exist."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, F.trim(F.col(c).cast("string")))
    return df


def standardize(df: DataFrame) -> DataFrame:
    """P1 + P2 + P3: placeholders dropped, strings trimmed, customer id normalised."""
    df = trim_cols(drop_if_present(df))
    if "customer_id" in df.columns:
        df = df.withColumn("customer_id", normalize_id("customer_id"))
    return df


def rule_tag(profile: str = "standard"):
    """First matching removal rule for a row (P6–P8), null when kept."""
    pid, price = F.col("product_id"), F.col("unit_price")
    if profile == "standard":
        bad_debt, bad_price = (pid == BAD_DEBT_PRODUCT) & (price < 0), price == 0
    elif profile == "strict":
        bad_debt, bad_price = pid == BAD_DEBT_PRODUCT, price <= 0
    else:
        raise ValueError(profile)
    return (F.when(bad_debt, "bad_debt_removed").when(bad_price, "zero_price_removed")
             .when(pid.isin(*ADMIN_CODES), "test_bank_charges_removed"))


def clean_sales(df: DataFrame, profile: str = "standard") -> tuple[DataFrame, DataFrame]:
    """P10: returns (clean ledger, ordered removal report)."""
    std = standardize(df)
    distinct = std.dropDuplicates()
    tagged = distinct.withColumn("_rule", rule_tag(profile))
    clean = tagged.filter(F.col("_rule").isNull()).drop("_rule")
    return clean, removal_report(std, tagged)


def removal_report(std: DataFrame, tagged: DataFrame) -> DataFrame:
    initial = std.agg(F.count(F.lit(1)).alias("n"))
    counts = tagged.agg(
        F.count(F.lit(1)).alias("distinct_rows"),
        *[F.sum(F.when(F.col("_rule") == s, 1).otherwise(0)).alias(s) for s in REPORT_STEPS[2:5]],
        F.sum(F.when(F.col("_rule").isNull() & F.col("transaction_id").startswith(RETURN_PREFIX), 1)
              .otherwise(0)).alias("returns_kept"))
    x = initial.crossJoin(counts)
    final = F.col("distinct_rows") - sum(F.coalesce(F.col(s), F.lit(0)) for s in REPORT_STEPS[2:5])
    vals = {
        "initial_rows": F.col("n"), "duplicates_removed": F.col("n") - F.col("distinct_rows"),
        "bad_debt_removed": F.col("bad_debt_removed"), "zero_price_removed": F.col("zero_price_removed"),
        "test_bank_charges_removed": F.col("test_bank_charges_removed"), "final_rows": final,
        "returns_kept": F.col("returns_kept"),
    }
    return x.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step_order"), F.lit(s).alias("step"), F.coalesce(vals[s], F.lit(0)).cast("long").alias("rows"))
        for i, s in enumerate(REPORT_STEPS)])).alias("r")).select("r.*")


def flag_returns(df: DataFrame) -> DataFrame:
    """P9 returns are kept and flagged."""
    return df.withColumn("is_return", F.when(F.col("transaction_id").startswith(RETURN_PREFIX), 1).otherwise(0))


def with_customer(df: DataFrame) -> DataFrame:
    """P11 rows with a customer (null ids stay in sales tables only)."""
    return df.filter(F.col("customer_id").isNotNull())


def dedupe_by_key(df: DataFrame, key: Sequence[str], order_by: Sequence) -> DataFrame:
    """P5 first row per key in the ascending order of ``order_by`` (negate a
    numeric column for descending).  ``min_by`` is a partial aggregate, so a
    key repeated on a third of all rows is reduced map-side instead of
    landing in one window partition."""
    rest = [c for c in df.columns if c not in key]
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    g = df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return g.select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest])


def clean_categorical_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P12."""
    for c in cols:
        df = df.withColumn(c, clean_categorical(c))
    return df


def repair_numeric(df: DataFrame, int_cols: Sequence[str], float_cols: Sequence[str]) -> DataFrame:
    """P13 inf/NaN → null, negatives clipped to 0, integer columns cast to
    nullable bigint."""
    for c in list(int_cols) + list(float_cols):
        x = finite_or_null(F.col(c).cast("double"))
        x = F.when(x < 0, F.lit(0.0)).otherwise(x)
        df = df.withColumn(c, x.cast("long") if c in int_cols else x)
    return df


def column_repair_report(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P14 per column: type before / after, nulls before / after, negatives
    and non-finite values corrected — one aggregate per side, unpivoted."""
    tb = dict(before.dtypes)
    ta = dict(after.dtypes)
    bagg = before.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"nb_{c}") for c in cols],
                      *[F.sum(F.when(F.col(c).cast("double") < 0, 1).otherwise(0)).alias(f"neg_{c}") for c in cols],
                      *[F.sum(F.when(F.isnan(F.col(c).cast("double"))
                                     | (F.abs(F.col(c).cast("double")) == float("inf")), 1).otherwise(0)).alias(f"inf_{c}")
                        for c in cols])
    aagg = after.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"na_{c}") for c in cols])
    x = bagg.crossJoin(aagg)
    return x.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(tb[c]).alias("type_before"), F.lit(ta[c]).alias("type_after"),
        F.col(f"nb_{c}").cast("long").alias("nulls_before"), F.col(f"na_{c}").cast("long").alias("nulls_after"),
        F.col(f"neg_{c}").cast("long").alias("negatives_clipped"),
        F.col(f"inf_{c}").cast("long").alias("non_finite_nulled")) for c in cols])).alias("r")).select("r.*")


def split_refund_customers(feats: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P18 refund-dominated customers (monetary ≤ 0 or quantity per order
    ≤ 0, D26): (kept, refunds, report with count, % and medians)."""
    is_ref = (F.col("monetary") <= 0) | (F.col("quantity_per_order") <= 0)
    refunds = feats.filter(is_ref)
    kept = feats.filter(~is_ref)
    n = feats.agg(F.count(F.lit(1)).alias("customers"))
    r = refunds.agg(F.count(F.lit(1)).alias("refund_customers"))
    meds = ranking.exact_quantiles(refunds, "monetary", {"median_monetary": 0.5}, tiebreak="customer_id").crossJoin(
        ranking.exact_quantiles(refunds, "frequency", {"median_frequency": 0.5}, tiebreak="customer_id"))
    rep = n.crossJoin(r).withColumn("pct_refund", F.col("refund_customers") * 100.0 / F.col("customers"))
    rep = rep.crossJoin(meds)  # both sides are one-row aggregates
    return kept, refunds, rep


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P19 inf → null, then drop rows with a null in ``cols``."""
    for c in cols:
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            df = df.withColumn(c, finite_or_null(c))
    return df.na.drop(subset=list(cols))


def members_of(df: DataFrame, ids: DataFrame, key: str = "customer_id") -> DataFrame:
    """P20 semi-join on an id list."""
    return df.join(ids.select(key), key, "left_semi")
