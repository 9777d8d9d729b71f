"""Connected components of a distributed edge list, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._stage import staged


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (u, v) of longs: ``root`` is the
    smallest node that it reaches.  Every step keeps the components and hangs nodes
    on smaller ones; it ends when no edge changes.  Work is joins and map-side
    combined minima, so a node with many edges is no single group."""
    pair = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = staged(edges.where("u <> v").select(pair.alias("e")).select("e.*").distinct(), "edges")
    before = None
    while True:
        told = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (told["n"], told["x"]) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = (told["n"], told["x"])
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _least(large)
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = staged(small.where("u <> v").distinct(), "edges")
