"""Sinks and table-level sources.

Writes go through the DataFrame writer (no driver-side files); reports are
one-row JSON documents built with ``to_json(struct(...))``.  Tables that are replaced
in place or belong together (S7, S9) are in :mod:`versions`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORECAST_DOC_SCHEMA = T.StructType([
    T.StructField("model_info", T.StructType([
        T.StructField(n, t) for n, t in [
            ("model_name", T.StringType()), ("granularity", T.StringType()), ("train_mape", T.DoubleType()),
            ("val_mape", T.DoubleType()), ("test_mape", T.DoubleType()), ("test_excl_mape", T.DoubleType()),
            ("mae", T.DoubleType()), ("rmse", T.DoubleType()), ("r2", T.DoubleType()), ("horizon", T.StringType()),
            ("status", T.StringType()), ("justification", T.StringType())]])),
    T.StructField("historical", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()), T.StructField("actual", T.DoubleType()),
        T.StructField("predicted", T.DoubleType()), T.StructField("split", T.StringType())]))),
    T.StructField("future", T.ArrayType(T.StructType([
        T.StructField("date", T.StringType()), T.StructField("forecast", T.DoubleType()),
        T.StructField("growth_from_last_historical", T.DoubleType())]))),
])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """S5 table sink (parquet / csv with header / json), optionally partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def report_json(df: DataFrame) -> DataFrame:
    """S6 every row as one JSON document (a one-row summary → one line)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_report(df: DataFrame, path: str) -> None:
    """S6 JSON report sink."""
    report_json(df).write.mode("overwrite").text(path)


def read_forecast_doc(spark: SparkSession, path: str) -> DataFrame:
    """S4 nested forecast document (multi-line JSON) with an explicit schema."""
    return spark.read.schema(FORECAST_DOC_SCHEMA).option("multiLine", True).json(path)


def forecast_doc_rows(doc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S4 flatten the document's two arrays into row tables."""
    hist = doc.select(F.explode("historical").alias("h")).select("h.*")
    fut = doc.select(F.explode("future").alias("f")).select("f.*")
    return hist, fut


def table_health(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """S10 per table: rows, columns, null rate of its key columns, files,
    bytes and newest file time (from the hidden ``_metadata`` column)."""
    parts = []
    for name, (df, keys) in tables.items():
        md = df.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_size").alias("_fs"),
                       F.col("_metadata.file_modification_time").alias("_fm"))
        null_any = F.lit(False)
        for k in keys:
            null_any = null_any | F.col(k).isNull()
        g = md.agg(F.count(F.lit(1)).alias("rows"),
                   (F.sum(F.when(null_any, 1).otherwise(0)) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("key_null_rate"),
                   F.countDistinct("_fp").alias("files"), F.max("_fm").alias("newest_file_time"))
        sizes = md.select("_fp", "_fs").distinct().agg(F.sum("_fs").alias("bytes"))
        parts.append(g.crossJoin(sizes).select(F.lit(name).alias("table_name"), "rows",
                                               F.lit(len(df.columns)).alias("columns"), "key_null_rate", "files",
                                               "bytes", "newest_file_time"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
