"""Tables written once in the cluster's shared folder, and small input helpers."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

_WRITTEN: list[tuple[object, str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (set by tests where unset)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.  The
    folders are removed when the driver's Python ends.
    """
    spark = df.sparkSession
    path = kept_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_path(spark: SparkSession, name: str) -> str:
    """A fresh shared folder that is removed when the driver's Python ends."""
    path = shared_path(spark, name)
    if not _WRITTEN:
        atexit.register(remove_staged)
    _WRITTEN.append((spark, path))
    return path


def remove_staged() -> None:
    """Delete what ``staged`` has written; a stopped session's folders stay."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        sc = spark.sparkContext
        if sc._jsc is None or sc._jsc.sc().isStopped():
            continue
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
