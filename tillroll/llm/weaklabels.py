"""Operator 6: quality classifier from weak labels.

Heuristic labellers vote on every whole document: good, bad, or nothing.  They
overlap and differ in worth.  Expectation-maximisation estimates, without any true
label, how often each votes what on good and on bad documents; it runs on the
counts of vote patterns over all documents, of which there are at most
3 ** labellers, whatever the corpus.  The posterior labels then train a linear
scorer on the hashed byte trigrams of all documents: each step of the descent is one
distributed pass over them, which returns a row of sums for each task.  Every document
gets its posterior, its score and a verdict: kept where the votes are confident of it,
else as the scorer says, with a threshold that keeps all but ``MAY_REJECT`` of the
confidently good documents (an exact quantile of all their scores).

Defined cases: a null text counts as empty; it gets votes as any short text; a null
doc_id is voted on, trained on and scored; if the votes show no two classes,
everything is kept; repeated rows give repeated results, and each counts in training;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import ranking

from ._bytes import LOWER, slices, text_buffers
from ._stage import staged, table
from .quality import COUNTS, FEATURES, measured

FEATURE_BITS = 12
#: Passes over the documents at most, and the pairs of steps that the descent remembers.
ROUNDS, PASSES, MEMORY, RIDGE = 200, 12, 10, 1e-4
#: Share of the confidently good documents that the threshold may reject.
MAY_REJECT, CONFIDENT = 0.005, 0.95

#: name: (statistic, bad bound, good bound).  A statistic at or beyond the bad bound
#: votes bad; at or beyond the good bound, on the other side, it votes good.  Signs of one
#: kind of junk have no good bound: their absence says little.
LABELLERS = {
    "symbols": ("symbol_share", 0.02, None),
    "bars": ("bar_share", 0.008, None),
    "repeats": ("repeat_share", 0.2, None),
    "copied_lines": ("dup_line_share", 0.3, None),
    "few_words": ("n_words", 10, None),
    "word_length": ("word_length", 14.0, None),
    "ended_lines": ("ended_lines", 0.15, 0.6),
    "variety": ("distinct_share", 0.2, None),
}
#: Labellers whose high values are bad.
HIGH_IS_BAD = ("symbols", "bars", "repeats", "copied_lines", "word_length")
BAD, GOOD, NONE = 0, 1, 2


def votes(counts: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Rows x labellers of BAD, GOOD or NONE."""
    out = np.full((len(counts), len(LABELLERS)), NONE, np.int64)
    for j, (labeller, (name, bad, good)) in enumerate(LABELLERS.items()):
        x = counts[:, COUNTS.index(name)] if name in COUNTS else features[:, FEATURES.index(name)]
        high = labeller in HIGH_IS_BAD
        if good is not None:
            out[x <= good if high else x >= good, j] = GOOD
        out[x >= bad if high else x <= bad, j] = BAD
    return out


def patterns(found: np.ndarray) -> np.ndarray:
    return found @ (3 ** np.arange(found.shape[1]))


def unpacked(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


class VoteModel:
    """Latent classes - good documents, and one kind of bad ones for each labeller,
    as one kind of junk says nothing about another - with their shares and, for each
    labeller, P(vote | class)."""

    def __init__(self, shares: np.ndarray, rates: np.ndarray):
        self.shares, self.rates = shares, rates  # rates: labellers x classes x votes

    def classes(self, found: np.ndarray) -> np.ndarray:
        """P(class | votes), rows x classes; class 0 is good."""
        logs = np.log(self.shares) + sum(np.log(self.rates[j])[:, found[:, j]].T for j in range(found.shape[1]))
        logs -= logs.max(1, keepdims=True)
        return np.exp(logs) / np.exp(logs).sum(1, keepdims=True)

    def posterior(self, found: np.ndarray) -> np.ndarray:
        return self.classes(found)[:, 0]

    def accuracies(self) -> dict[str, float]:
        """For each labeller, the share of its bad votes that fall on bad documents."""
        bad = self.rates[:, :, BAD] * self.shares
        return dict(zip(LABELLERS, bad[:, 1:].sum(1) / bad.sum(1), strict=True))


def expectation_maximisation(codes: np.ndarray, times: np.ndarray, rounds: int = ROUNDS) -> VoteModel | None:
    """Fit on vote patterns and their counts.  At first a document without a bad vote is
    thought good, any other of the kinds of the labellers that object.  None where
    no document, or every one, meets an objection."""
    found, weight = unpacked(codes), times.astype(float)
    against = (found == BAD).astype(float)
    some = against.any(1)
    if not weight[some].sum() or not weight[~some].sum():
        return None
    kinds = np.where(some[:, None], 0.9 * against / np.maximum(against.sum(1, keepdims=True), 1), 0.1 / len(LABELLERS))
    part = np.concatenate([np.where(some, 0.1, 0.9)[:, None], kinds], 1)
    for _ in range(rounds):
        mass = part * weight[:, None]
        rates = np.stack([[np.bincount(found[:, j], mass[:, c], 3) + 1e-2 for c in range(part.shape[1])] for j in range(len(LABELLERS))])
        rates /= rates.sum(2, keepdims=True)
        shares = mass.sum(0) + 1e-2
        model = VoteModel(shares / shares.sum(), rates)
        now = model.classes(found)
        if np.abs(now - part).max() < 1e-9:
            break
        part = now
    return model


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x 2**FEATURE_BITS: square roots of the shares of hashed byte trigrams."""
    n, size = len(offsets) - 1, 1 << FEATURE_BITS
    out = np.zeros((n, size), np.float32)
    for a, b in slices(offsets):
        part = LOWER[data[offsets[a]:offsets[b]]].astype(np.uint32)
        if len(part) < 3:
            continue
        hashed = ((part[:-2] * 0x9E3779B1 + part[1:-1] * 0x85EBCA77 + part[2:] * 0xC2B2AE3D).astype(np.uint32)
                  * np.uint32(0x27D4EB2F)) >> np.uint32(32 - FEATURE_BITS)
        local = offsets[a:b + 1] - offsets[a]
        for i in range(b - a):
            own = hashed[local[i]:max(local[i], local[i + 1] - 2)]
            if len(own):
                out[a + i] = np.bincount(own, minlength=size) / len(own)
    return np.sqrt(out)


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float, cut: float):
        self.weights, self.bias, self.cut = weights, bias, cut

    def score(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.weights + np.float32(self.bias)).astype(float)


def descend(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """Minimise a convex function by L-BFGS, with ``passes`` calls of it at most."""
    x, (value, slope), used = start, loss(start), 1
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while used < passes and np.abs(slope).max() > 1e-7:
        way, shares = -slope, []
        for s, y in reversed(steps):
            shares.append(s @ way / (s @ y))
            way = way - shares[-1] * y
        if steps:
            s, y = steps[-1]
            way = way * (s @ y / (y @ y))
        for (s, y), share in zip(steps, reversed(shares), strict=True):
            way = way + (share - y @ way / (s @ y)) * s
        length, moved = 1.0 if steps else 2.0, False
        while used < passes and not moved:
            new, used = x + length * way, used + 1
            new_value, new_slope = loss(new)
            moved = new_value <= value + 1e-4 * length * (slope @ way)
            length /= 2
        if not moved:
            break
        if (new_slope - slope) @ (new - x) > 0:
            steps = [*steps, (new - x, new_slope - slope)][-MEMORY:]
        x, value, slope = new, new_value, new_slope
    return x


def sparse(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column, and the number in each row."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view(kind), np.diff(ends) // size


def parts(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def scored(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Score of each row by ``weights`` (the last one the bias); cells, values and their number in each row."""
    cells, many = sparse(batch.column(1), np.uint16)
    cells, values = cells.astype(np.intp), sparse(batch.column(2), np.float16)[0].astype(np.float32)
    z, some = np.full(len(batch), weights[-1]), many > 0
    if some.any():
        z[some] += np.add.reduceat(values * weights.astype(np.float32)[cells], (np.cumsum(many) - many)[some])
    return z, cells, values, many


def fit_scorer(voted: DataFrame, model: VoteModel, codes: np.ndarray, times: np.ndarray) -> Scorer:
    """Logistic regression on the soft labels of all rows of ``voted`` (pattern, cells, shares),
    both classes weighing the same.  ``codes`` and ``times`` are the patterns there and their numbers."""
    good = np.zeros(3 ** len(LABELLERS))
    good[codes] = model.posterior(unpacked(codes))
    mass = max(good[codes] @ times, 1e-6), max((1 - good[codes]) @ times, 1e-6)
    size = 1 << FEATURE_BITS

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(size + 2)
            for batch in parts(batches):
                z, cells, values, many = scored(batch, weights)
                own = good[batch.column(0).to_numpy()]
                wg, wb = own / mass[0] / 2, (1 - own) / mass[1] / 2
                g = wb - (wb + wg) / (1 + np.exp(np.clip(z, -500, 500)))
                sums[:size] += np.bincount(cells, values * np.repeat(g.astype(np.float32), many), size)
                sums[size:] += g.sum(), (wb * np.logaddexp(0, z) + wg * np.logaddexp(0, -z)).sum()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([sums.tobytes()])],
                                             names=["task", "sums"])

        # one row of 32 KB from each task, added up in a fixed order
        rows = sorted(voted.select("pattern", "cells", "shares").mapInArrow(run, "task long, sums binary").collect(), key=lambda r: r["task"])
        sums = np.sum([np.frombuffer(r["sums"]) for r in rows], 0)
        inner = np.append(weights[:size], 0.0)  # the bias is not held back
        return sums[-1] + RIDGE / 2 * inner @ inner, sums[:-1] + RIDGE * inner

    weights = descend(loss, np.zeros(size + 1))
    own = Scorer(weights[:-1].astype(np.float32), float(weights[-1]), 0.0)
    sure = good >= CONFIDENT

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            z = scored(batch, weights)[0][sure[batch.column(0).to_numpy()]]
            yield pa.RecordBatch.from_arrays([pa.array(z)], names=["score"])

    if sure.any():
        known = voted.select("pattern", "cells", "shares").mapInArrow(scores, "score double")
        own.cut = min(0.0, ranking.exact_quantiles(known, "score", {"cut": MAY_REJECT}).first()["cut"])
    return own


def vote_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, cells, shares) of every document: its votes, and those features that are not 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 512):
            offsets, data = text_buffers(batch.column(0))
            codes, x = patterns(votes(*measured(data, offsets))), trigrams(data, offsets)
            rows, cells = np.nonzero(x)
            ends = np.append(0, np.cumsum(np.bincount(rows, minlength=len(x)))).astype(np.int32) * np.int32(2)  # two bytes each
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes, pa.int64()), *(pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
                                                for flat in (cells.astype(np.uint16), x[rows, cells].astype(np.float16)))],
                names=["pattern", "cells", "shares"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "pattern long, cells binary, shares binary")


def train(docs: DataFrame) -> tuple[VoteModel | None, Scorer | None]:
    voted = staged(vote_patterns(docs), "votes")
    rows = voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()  # 3 ** labellers rows at most
    codes, times = np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows])
    model = expectation_maximisation(codes, times) if rows else None
    return (None, None) if model is None else (model, fit_scorer(voted, model, codes, times))


def classify(docs: DataFrame, model: VoteModel | None, scorer: Scorer | None) -> DataFrame:
    """doc_id, n_votes, posterior, score and kept of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model, scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scorer = shared.value
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                offsets, data = text_buffers(part.column(1))
                found = votes(*measured(data, offsets))
                n = len(part)
                posterior = model.posterior(found) if model else np.ones(n)
                score = scorer.score(trigrams(data, offsets)) if scorer else np.zeros(n)
                kept = (score >= scorer.cut) | (posterior >= CONFIDENT) if scorer else np.ones(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array((found != NONE).sum(1)), pa.array(posterior), pa.array(score), pa.array(kept)],
                    names=["doc_id", "n_votes", "posterior", "score", "kept"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_votes long, posterior double, score double, kept boolean")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, *train(docs))


QUERIES = {"op6_quality_classifier": op6_quality_classifier}
ORACLES: dict[str, str] = {}
