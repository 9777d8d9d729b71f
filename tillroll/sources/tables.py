"""Table scans with explicit schemas.

The reference infers types at every read and re-casts by hand; here every
table has one StructType and required columns are checked up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money at line grain is an exact decimal (4 places covers price × discount).
AMOUNT = "decimal(18,4)"

# Canonical clean ledger (`sales`) and the raw ledger with placeholder columns.
SALES_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity_sold", T.DoubleType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("sales_amount", T.DecimalType(18, 4)),
    T.StructField("region", T.StringType()),
])

RAW_SALES_SCHEMA = T.StructType(SALES_SCHEMA.fields + [
    T.StructField("store_id", T.DoubleType()),
    T.StructField("category", T.DoubleType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("payment_method", T.DoubleType()),
])

STOCK_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("as_of", T.DateType()),
    T.StructField("stock", T.DoubleType()),
])

SCHEMAS = {
    "sales": SALES_SCHEMA,
    "raw_sales": RAW_SALES_SCHEMA,
    "stock": STOCK_SCHEMA,
}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; projection / filters pushed by Catalyst."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   trim_headers: bool = False, required: list[str] | None = None,
                   drop_null_keys: list[str] | None = None) -> DataFrame:
    """CSV scan with header (S1); optionally the tolerant variant (S2): blank
    lines skipped (Spark default), header names trimmed, rows with a null key
    dropped."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None and not trim_headers:
        df = reader.schema(schema).csv(path)
    else:
        df = reader.option("inferSchema", schema is None).csv(path)
        if trim_headers:
            df = df.toDF(*[c.strip() for c in df.columns])
        if schema is not None:
            present = set(df.columns)
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                             for f in schema.fields if f.name in present])
    missing = [c for c in (required or []) if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if drop_null_keys:
        df = df.na.drop(subset=drop_null_keys)
    return df


def conform(df: DataFrame, schema: T.StructType, required: list[str] | None = None) -> DataFrame:
    """Cast to the canonical schema; absent optional columns come back null."""
    present = set(df.columns)
    missing = [c for c in (required or []) if c not in present]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
