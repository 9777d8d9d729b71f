"""Boosted trees of many training sets grown at the same time.

The trees are those of Spark ML's ``GBTClassifier`` (log loss, variance gain, 32 bins a feature, its
rule for the cuts): a pass over the rows tells the histograms of the open nodes of *all* models, where
Spark has a job for a level of one tree of one model.  Rows travel as blocks of bin numbers; a
task's sums follow the models, nodes and bins, not the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import cut_lineage, ensure_checkpoint_dir, partitions_for

BINS = 32
#: Rows that Spark ML takes the cuts from.
CUT_ROWS = 10_000
#: Rows that a task has at least; trees that rows catch up with at once, and after how many times their history is cut.
BLOCK, LATE, CUT = 16384, 3, 4
#: Tasks whose sums come to the driver as they are; more are summed on the way.
DIRECT = 32


@dataclass
class Tree:
    """Nodes in heap order: the children of ``i`` are 2 i + 1 and 2 i + 2; ``feature`` -1 is a leaf."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    impurity: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.cut, self.value, self.impurity = np.full(size, -1), np.zeros(size, int), np.zeros(size), np.zeros(size)

    def nodes(self, codes: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after so many levels."""
        at, rows = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
        for _ in range(levels):
            own = self.feature[at]
            at = np.where(own < 0, at, 2 * at + 1 + (codes[own, rows] > self.cut[at]))
        return at


@dataclass
class Model:
    """One fit: the rows of all folds but ``fold``; ``late`` are trees that the rows do not know yet."""

    fold: int
    rounds: int
    depth: int
    rate: float
    grown: int = 0
    level: int = 0
    tree: Tree | None = None
    late: list[Tree] = field(default_factory=list)

    def weight(self, k: int) -> float:
        return 1.0 if k == 0 else self.rate

    @property
    def open(self) -> bool:
        return self.grown < self.rounds


def cuts(values: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Spark ML's cuts of a feature: half way between values, all of them if few, else nearest to equal weights."""
    own, at = np.unique(values, return_inverse=True)
    if len(own) < 2:
        return np.empty(0)
    middle = (own[1:] + own[:-1]) / 2
    if len(middle) <= bins - 1:
        return middle
    many = np.cumsum(np.bincount(at, weights))
    stride = many[-1] / bins
    out, target = [], stride
    for k in range(1, len(own)):
        if abs(many[k - 1] - target) < abs(many[k] - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out)


def _caught_up(models: Sequence[Model], codes: np.ndarray, margins: np.ndarray) -> np.ndarray:
    margins = margins.copy()
    for i, m in enumerate(models):
        for k, tree in enumerate(m.late, m.grown - len(m.late)):
            margins[i] += m.weight(k) * tree.value[tree.nodes(codes[m.fold], m.depth)]
    return margins


def _arrays(block: tuple, folds: int, features: int, models: int) -> tuple:
    codes, y, weight, fold, margins = block
    n = len(y) // 8
    return (np.frombuffer(codes, np.uint8).reshape(folds, features, n), np.frombuffer(y), np.frombuffer(weight),
            np.frombuffer(fold, np.int64), np.frombuffer(margins).reshape(models, n))


def _sums(models: Sequence[Model], folds: int, features: int):
    """A task's sums of the weights, the residuals and their squares, by open model, node of its level, feature and bin."""
    live = [i for i, m in enumerate(models) if m.open]

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        out = [np.zeros((3, features, 2 ** models[i].level * BINS)) for i in live]
        for block in blocks:
            codes, y, weight, fold, margins = _arrays(block, folds, features, len(models))
            margins = _caught_up(models, codes, margins)
            for i, sums in zip(live, out, strict=True):
                m = models[i]
                residual = y if m.grown == 0 else 4 * y / (1 + np.exp(2 * y * margins[i]))
                node = (np.zeros(len(y), np.int64) if m.tree is None else m.tree.nodes(codes[m.fold], m.level)) - (2 ** m.level - 1)
                own = np.where((fold != m.fold) & (node >= 0), weight, 0.0)
                first, told = np.maximum(node, 0) * BINS, (own, own * residual, own * residual * residual)
                for f in range(features):
                    key = first + codes[m.fold, f]
                    for total, part in zip(sums, told, strict=True):
                        total[f] += np.bincount(key, part, sums.shape[2])
        yield np.concatenate([s.ravel() for s in out])

    return run


def _impurity(n: np.ndarray, pull: np.ndarray, square: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return (square - pull * pull / n) / n


def _grow(m: Model, sums: np.ndarray, splits: Sequence[int]) -> None:
    """Splits the nodes of the model's level at the cut of the highest gain, the first of equal ones.
    Gains are computed as Spark ML does, so that the last digits fall alike."""
    first = 2 ** m.level - 1
    sums = sums.reshape(3, len(splits), 2 ** m.level, BINS).transpose(0, 2, 1, 3)
    m.tree = m.tree or Tree(m.depth)
    upto = np.cumsum(sums, 3)
    left, right = upto[..., :-1], upto[..., -1:] - upto[..., :-1]
    after = np.cumsum(sums[0, ..., ::-1], 2)[..., ::-1][..., 1:]  # exactly 0 where no row is
    if m.level == 0:
        whole = upto[:, 0, 0, -1]
        m.tree.value[0], m.tree.impurity[0] = whole[1] / whole[0], _impurity(*(left + right)[:, 0, 0, 0])
    total = left[0] + right[0]
    of_left, of_right = _impurity(*left), _impurity(*right)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = m.tree.impurity[first:2 * first + 1, None, None] - left[0] / total * of_left - right[0] / total * of_right
    gain[(left[0] <= 0) | (after <= 0) | (np.arange(BINS - 1)[None, None, :] >= np.array(splits)[None, :, None])] = -1.0
    grew = False
    for k, at in enumerate(gain.reshape(len(gain), -1).argmax(1)):
        f, cut = divmod(int(at), BINS - 1)
        if gain[k, f, cut] > 0:
            grew, node = True, first + k
            m.tree.feature[node], m.tree.cut[node] = f, cut
            for child, side, impurity in ((2 * node + 1, left, of_left), (2 * node + 2, right, of_right)):
                m.tree.value[child] = side[1, k, f, cut] / side[0, k, f, cut]
                m.tree.impurity[child] = impurity[k, f, cut]
    m.level += 1
    if not grew or m.level == m.depth:
        m.late.append(m.tree)
        m.grown, m.level, m.tree = m.grown + 1, 0, None


def held_out_scores(data: DataFrame, label: str, folds: int, fits: Sequence[tuple[int, float, int]]) -> DataFrame:
    """(fit, fold, ``label``, p1): for each of ``fits`` (rounds, rate, depth) the probability of class 1 of
    every row of ``data`` (features, label, weight, fold) from the trees of the other folds' rows."""
    spark = data.sparkSession
    ensure_checkpoint_dir(spark)
    rows = data.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("label"), "weight",
                       F.col("fold").cast("long").alias("fold"))
    sizes = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}  # a row a fold
    least = min(sum(sizes.values()) - sizes.get(f, 0) for f in range(folds))
    if least < 1:
        raise ValueError("a fold holds all rows: nothing is left to fit on")
    some = rows if least <= CUT_ROWS else rows.sample(CUT_ROWS / least, seed=42)
    some = some.select("x", "weight", "fold").toPandas()  # about CUT_ROWS, as Spark ML's own cuts
    x, w, of = np.stack(some["x"].to_numpy()), some["weight"].to_numpy(), some["fold"].to_numpy()
    features = x.shape[1]
    edges = [[cuts(x[of != f, j], w[of != f]) for j in range(features)] for f in range(folds)]
    models = [Model(f, rounds, depth, rate) for rounds, rate, depth in fits for f in range(folds)]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            x = batch.column(0).flatten().to_numpy().reshape(n, features)
            y, weight, fold = (batch.column(i).to_numpy() for i in (1, 2, 3))
            codes = np.array([[np.searchsorted(e, x[:, j], "left") for j, e in enumerate(own)] for own in edges], np.uint8)
            told = (codes, np.where(y == 1, 1.0, -1.0), weight, fold, np.zeros((len(models), n)))
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in told], names=list("cywfm"))

    tasks = min(partitions_for(rows), -(-sum(sizes.values()) // BLOCK))
    now = cut_lineage(rows.repartition(tasks).mapInArrow(packed, "c binary, y binary, w binary, f binary, m binary")).rdd
    kept, turns = None, 0

    def refreshed(models: list[Model]):
        def run(block: tuple) -> tuple:
            codes, *_, margins = _arrays(block, folds, features, len(models))
            return (*block[:4], _caught_up(models, codes, margins).tobytes())
        return run

    def caught_up(rdd, old):
        """The rows with all late trees in their margins, kept for the next passes."""
        nonlocal turns
        new = rdd.map(refreshed([Model(m.fold, m.rounds, m.depth, m.rate, m.grown, late=list(m.late)) for m in models]))
        new.persist(StorageLevel.MEMORY_AND_DISK)
        turns += 1
        if turns % CUT == 0:
            new.checkpoint()
        new.count()
        if old is not None:
            old.unpersist()
        for m in models:
            m.late = []
        return new, new

    while any(m.open for m in models):
        if max(len(m.late) for m in models) >= LATE:
            now, kept = caught_up(now, kept)
        sums = now.mapPartitions(_sums(models, folds, features))
        told = sums.treeReduce(add) if tasks > DIRECT else np.sum(sums.collect(), 0)
        at = 0
        for m in [m for m in models if m.open]:
            size = 3 * features * 2 ** m.level * BINS
            part, at = told[at:at + size].reshape(3, -1), at + size
            _grow(m, part, [len(e) for e in edges[m.fold]])
    if any(m.late for m in models):
        now, kept = caught_up(now, kept)

    def scores(block: tuple) -> Iterator[tuple]:
        _, y, _, fold, margins = _arrays(block, folds, features, len(models))
        for i, m in enumerate(models):
            own = fold == m.fold
            yield from zip([i // folds] * int(own.sum()), fold[own].tolist(), (y[own] > 0).astype(int).tolist(),
                           (1 / (1 + np.exp(-2 * margins[i, own]))).tolist(), strict=True)

    out = cut_lineage(spark.createDataFrame(now.flatMap(scores), f"fit long, fold long, `{label}` long, p1 double"))
    if kept is not None:
        kept.unpersist()
    return out
