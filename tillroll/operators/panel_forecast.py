"""Recursive forecasts of every product's daily quantity (D9q, panel form).

Days without a sale count as 0, so the calendar panel is nearly all zeros and the same
inputs come again and again.  It is never built.  A sale changes its product's inputs on
six days only; between two such days they are constant.  Those stretches, summed over all
products by equal inputs and target, are the training rows, their length in days the
weight.  Their number follows the distinct patterns of sales, not products x days.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import cut_lineage

SEED = 42
FEATURES = ["lag_1", "lag_7", "mean_7", "mean_28"]
#: A product's first days, which lack lag 7, are no training rows.
YOUNG, HISTORY = 7, 28
#: Training rows of one task: few tasks make each of the booster's many small jobs short.
ROWS_A_TASK = 25_000
UNITS, MILLION = "decimal(28,6)", 1_000_000


def training_rows(sales: DataFrame, key: str = "product_id", value: str = "qty") -> DataFrame:
    """(``FEATURES``, y, weight) of every product's days from its ``YOUNG``-th day after the first
    sale to the last day of all sales; equal rows are one, with their number as weight.

    Only a product's days of sale travel, to their product; the six days that each changes are
    made, put in order and summed up in place.  Units are counted in millionths, as longs where
    all sums stay exact as doubles, and as decimals elsewhere."""
    v = F.col(value).cast(UNITS)
    sold = sales.where(v.isNotNull() & F.col("date").isNotNull()).groupBy(key, "date").agg(F.sum(v).alias("v"))
    most = sold.agg(F.max("date").alias("last"), F.max(F.abs("v")).alias("v")).first()
    last = F.lit(most["last"]).cast("date")
    whole = (most["v"] or 0) * HISTORY * MILLION < 1 << 53
    kind, scale = ("long", float(MILLION)) if whole else (UNITS, 1.0)
    sold = sold.select(key, "date", ((F.col("v") * MILLION) if whole else F.col("v")).cast(kind).alias("v"))
    zero = F.lit(0).cast(kind)

    def change(after: int | Column, **by: Column) -> Column:
        return F.struct((F.lit(after) if isinstance(after, int) else after).alias("after"),
                        *[by.get(c, zero).alias(c) for c in ("y", "l1", "l7", "s7", "s28")])

    # what a sale adds to the day's inputs, from which day after it on
    v = F.col("v")
    changes = F.array(change(0, y=v), change(1, y=-v, l1=v, s7=v, s28=v), change(2, l1=-v), change(7, l7=v),
                      change(8, l7=-v, s7=-v), change(HISTORY + 1, s28=-v))
    # the mean of 28 has fewer days in it until the 28th: each of those days is a stretch of its own
    young = F.transform(F.sequence(F.lit(YOUNG), F.lit(HISTORY)), lambda k: change(k))
    # one product's days: bounded by the calendar
    own = sold.repartition(key).withColumn("first", F.min("date").over(Window.partitionBy(key)))
    moved = own.select(key, "date", "first", F.inline(F.when(F.col("date") == F.col("first"), F.concat(changes, young)).otherwise(changes)))
    moved = moved.withColumn("date", F.date_add("date", F.col("after"))).where(F.col("date") <= last)
    w = Window.partitionBy(key).orderBy("date")  # sums take in all changes of a day; only its last row has a stretch
    at = moved.select("date", "first", *[F.sum(c).over(w).alias(c) for c in ("y", "l1", "l7", "s7", "s28")], F.lead("date").over(w).alias("next"))
    days = F.datediff(F.coalesce("next", F.date_add(last, 1)), F.col("date"))
    at = at.withColumn("days", days).where((F.col("days") > 0) & (F.col("date") >= F.date_add("first", YOUNG)))
    held = F.least(F.datediff("date", "first"), F.lit(HISTORY))
    units = {c: F.col(c).cast("double") / scale for c in ("y", "l1", "l7", "s7", "s28")}
    return at.select(
        units["l1"].alias("lag_1"), units["l7"].alias("lag_7"), (units["s7"] / 7).alias("mean_7"), (units["s28"] / held).alias("mean_28"),
        units["y"].alias("y"), "days").groupBy(*FEATURES, "y").agg(F.sum("days").cast("double").alias("weight"))


def tree_arrays(model) -> tuple[np.ndarray, ...]:
    """A boosted model as one node table: feature, threshold, left, right, value, the root and
    weight of each tree, and the greatest depth.  A leaf is its own child."""
    nodes: list[tuple[int, float, int, int, float]] = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append((0, 0.0, at, at, float(node.prediction())))
        if node.subtreeDepth() > 0:
            split = node.split()
            feature, threshold = int(split.featureIndex()), float(split.threshold())
            nodes[at] = (feature, threshold, add(node.leftChild()), add(node.rightChild()), 0.0)
        return at
    roots = [add(t._call_java("rootNode")) for t in model.trees]
    return (*(np.array(c) for c in zip(*nodes, strict=True)), np.array(roots), np.array(model.treeWeights),
            np.array(max(t.depth for t in model.trees)))


def boosted(arrays: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """What the boosted model predicts for each row of ``x``: all trees are descended at once."""
    feature, threshold, left, right, value, roots, weights, depth = arrays
    at = np.broadcast_to(roots, (len(x), len(roots)))
    rows = np.arange(len(x))[:, None]
    for _ in range(int(depth)):
        at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
    return value[at] @ weights


def fit(sales: DataFrame, key: str = "product_id", value: str = "qty", rounds: int = 100) -> GBTRegressor:
    """Boosted trees on the weighted distinct rows."""
    rows = cut_lineage(training_rows(sales, key, value))
    parts = max(1, -(-rows.count() // ROWS_A_TASK))
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "y", "weight")
    return GBTRegressor(featuresCol="features", labelCol="y", weightCol="weight", maxIter=rounds, maxDepth=4, stepSize=0.1,
                        seed=SEED).fit(table.coalesce(parts))


def forecast_recursive(sales: DataFrame, key: str = "product_id", value: str = "qty", horizon: int = 30, rounds: int = 100) -> DataFrame:
    """D9q (key, date, step, forecast) for every product that was ever sold: its last ``HISTORY`` days step
    forward, every forecast feeding the next day's inputs, floored at 0.  The trees (a few
    thousand numbers) go to the tasks; products are stepped many at a time."""
    # read by the history, the last day and the training rows
    sold = cut_lineage(sales.where(F.col(value).isNotNull() & F.col("date").isNotNull()).select(key, "date", value))
    last = sold.agg(F.max("date").alias("last"))  # one row
    back = F.datediff("last", "date")
    hist = sold.crossJoin(F.broadcast(last)).groupBy(key).agg(
        F.first("last").alias("last"), (F.max(back) + 1).alias("age"),
        F.array(*[F.coalesce(F.sum(F.when(back == k, F.col(value).cast("double"))), F.lit(0.0)) for k in range(HISTORY - 1, -1, -1)]).alias("hist"))
    if sold.limit(1).count() == 0:
        return hist.select(key, F.col("last").alias("date"), F.lit(0).alias("step"), F.lit(0.0).alias("forecast")).limit(0)
    arrays = tree_arrays(fit(sold, key, value, rounds))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 2_000):
                part = batch.slice(lo, 2_000)
                n = len(part)
                known = np.array(part.column(2).to_pylist(), float).reshape(n, HISTORY)
                age = part.column(1).to_numpy().astype(float)
                made = []
                for k in range(horizon):
                    x = np.column_stack([known[:, -1], known[:, -YOUNG], known[:, -7:].mean(1),
                                         known[:, -HISTORY:].sum(1) / np.minimum(HISTORY, age + k)])
                    made.append(np.maximum(0.0, boosted(arrays, x)))
                    known = np.column_stack([known, made[-1]])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.FixedSizeListArray.from_arrays(pa.array(np.column_stack(made).ravel()), horizon).cast(pa.list_(pa.float64()))],
                    names=[key, "made"])

    kind = sales.schema[key].dataType.simpleString()
    out = hist.select(key, "age", "hist").mapInArrow(step, f"`{key}` {kind}, made array<double>")
    out = out.crossJoin(F.broadcast(last)).select(key, "last", F.posexplode("made").alias("k", "forecast"))
    return out.select(key, F.date_add("last", F.col("k") + 1).alias("date"), (F.col("k") + 1).alias("step"), "forecast")
