"""Operator 5: quality rules - boosted trees over document statistics.

``statistics`` measures every whole text, from its bytes.  ``fit`` grows
gradient-boosted trees on labelled documents, by histograms of quantile bins, with
monotonic constraints: on the features named in ``FALLING`` a higher value never
raises the score.  ``flatten`` lays the trees out as numpy arrays of nodes, and
``score`` walks all rows through all trees at once.

The trees are fitted on at most ``MAX_LABELLED`` labelled documents, chosen by a
hash of their id (a documented bound); statistics and verdicts cover all documents.

Defined cases: a null text has no words, so it fails the base rule; a document with
several labels counts with the lowest; without usable labels (none, or of one
class) the base rule alone decides; a null doc_id is measured and scored but never
used for training; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import SPACE, RangeHash, distinct, sequence_hashes, slices, text_buffers, word_bounds
from ._stage import table

MAX_LABELLED = 20_000
TREES, DEPTH, RATE, BINS, MIN_ROWS, RIDGE = 80, 4, 0.15, 48, 8, 1.0
#: Share of the good held-out documents that the threshold may reject.
MAY_REJECT = 0.002
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "line_words", "upper_share",
            "digit_share", "stop_share", "bar_share", "other_share", "distinct_share", "newline_share", "ended_lines")
FALLING = ("symbol_share", "dup_line_share", "repeat_share")

_SYMBOL, _UPPER, _DIGIT, _STOP, _BAR, _OTHER = (np.zeros(256, bool) for _ in range(6))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_STOP[list(b".,;:!?")] = True
_BAR[124] = True
_OTHER[list(b"\"'()[]{}/\\=+-_@~^`")] = True
_NEWLINE = np.arange(256) == 10
_LETTER_START = (np.arange(256) & 0xC0) != 0x80


def measured(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x COUNTS as int64, rows x FEATURES as float64) of the texts."""
    counts, features = [], []
    for a, b in slices(offsets):
        part = data[offsets[a]:offsets[b]]
        local = offsets[a:b + 1] - offsets[a]
        starts, ends = word_bounds(part, local[:-1])
        words = RangeHash(part)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
        cuts = np.searchsorted(starts, local)

        def total(mask: np.ndarray, part=part, local=local) -> np.ndarray:
            sums = np.zeros(len(part) + 1, np.int64)
            np.cumsum(mask[part] if len(mask) == 256 else mask, out=sums[1:])
            return sums[local[1:]] - sums[local[:-1]]

        ink = _LETTER_START & ~SPACE
        n_words, chars, all_chars = np.diff(cuts), total(ink), total(_LETTER_START)
        symbols, lines = total(_SYMBOL), total(_NEWLINE) + 1
        windows = sequence_hashes(words, WINDOW)
        repeats, differing = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
        dup_lines, full_lines, ended = (np.zeros(b - a, np.int64) for _ in range(3))
        raw = part.tobytes()
        for i in range(b - a):
            lo, hi = int(cuts[i]), int(cuts[i + 1])
            differing[i] = len(distinct(words[lo:hi]))
            if hi - lo > WINDOW:
                own = windows[lo:hi - WINDOW + 1]
                if len(distinct(own)) < len(own):
                    _, where, times = np.unique(own, return_inverse=True, return_counts=True)
                    edge = np.zeros(hi - lo + 1, np.int64)
                    again = np.flatnonzero(times[where] > 1)
                    np.add.at(edge, again, 1)
                    np.add.at(edge, again + WINDOW, -1)
                    repeats[i] = int((np.cumsum(edge) > 0).sum())
            own_lines = [x for x in raw[local[i]:local[i + 1]].split(b"\n") if x.strip(b"\x20\t\n\r\x0b\x0c")]
            full_lines[i] = len(own_lines)
            dup_lines[i] = len(own_lines) - len(set(own_lines))
            ended[i] = sum(x.rstrip(b"\x20\t\r\x0b\x0c").endswith((b".", b"!", b"?", b":")) for x in own_lines)
        counts.append(np.stack([n_words, chars, symbols, dup_lines, repeats], 1))
        per_word, per_char = 1 / np.maximum(n_words, 1), 1 / np.maximum(all_chars, 1)
        per_line = 1 / np.maximum(full_lines, 1)
        features.append(np.stack([
            np.log1p(n_words), chars * per_word, symbols * per_char, dup_lines * per_line, repeats * per_word,
            n_words * per_line, total(_UPPER) * per_char, total(_DIGIT) * per_char, total(_STOP) * per_char,
            total(_BAR) * per_char, total(_OTHER) * per_char, differing * per_word, lines * per_char,
            ended * per_line], 1))
    if not counts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate(counts), np.concatenate(features)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the COUNTS, base_failed and ``features`` (array<double>)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            counts, features = measured(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(base_failed(counts)),
                 pa.array(list(features), pa.list_(pa.float64()))], names=[id_col, *COUNTS, "base_failed", "features"])

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, features array<double>"
    return docs.select(id_col, docs[text_col].cast("string")).mapInArrow(run, schema)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 10) | (100 * counts[:, 4] > 20 * counts[:, 0])


# ---- boosted trees


class Trees:
    """All trees as node arrays: feature (-1 at a leaf), threshold, children, value."""

    def __init__(self, feature, threshold, left, right, value, roots, start, cut):
        self.feature, self.threshold, self.left, self.right = feature, threshold, left, right
        self.value, self.roots, self.start, self.cut = value, roots, start, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row, all rows and trees a level at a time."""
        if not len(self.roots):
            return np.full(len(x), self.start)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            f = self.feature[at]
            right = x[rows, np.maximum(f, 0)] > self.threshold[at]
            at = np.where(f < 0, at, np.where(right, self.right[at], self.left[at]))
        return self.start + self.value[at].sum(1)


def flatten(trees: list[list[tuple]], start: float, cut: float) -> Trees:
    nodes, roots = [], []
    for tree in trees:
        base = len(nodes)
        roots.append(base)
        nodes += [(f, t, base + lo, base + hi, v) for f, t, lo, hi, v in tree]
    f, t, lo, hi, v = zip(*nodes, strict=True) if nodes else ((),) * 5
    return Trees(np.array(f, np.int64), np.array(t, float), np.array(lo, np.int64), np.array(hi, np.int64),
                 np.array(v, float), np.array(roots, np.int64), start, cut)


def grow(codes: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, sign: np.ndarray) -> list[tuple]:
    """One tree by Newton gain.  ``sign[f]`` is -1 where the value may only fall with
    feature f.  A split on such a feature bounds the values below it at their
    middle, so the whole tree keeps the constraint."""
    nodes: list[tuple] = []

    def add(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        me = len(nodes)
        gs, hs = g[rows].sum(), h[rows].sum()
        value = float(np.clip(-gs / (hs + RIDGE), low, high))
        nodes.append((-1, 0.0, 0, 0, RATE * value))
        if depth == DEPTH or len(rows) < 2 * MIN_ROWS:
            return me
        best, at = 1e-6, None
        for f in range(codes.shape[1]):
            own = codes[rows, f]
            n = np.bincount(own, minlength=BINS)[:-1].cumsum()
            gl = np.bincount(own, g[rows], BINS)[:-1].cumsum()
            hl = np.bincount(own, h[rows], BINS)[:-1].cumsum()
            vl = np.clip(-gl / (hl + RIDGE), low, high)
            vr = np.clip(-(gs - gl) / (hs - hl + RIDGE), low, high)
            gain = (-(gl * vl + 0.5 * (hl + RIDGE) * vl ** 2) - ((gs - gl) * vr + 0.5 * (hs - hl + RIDGE) * vr ** 2)
                    + (gs * value + 0.5 * (hs + RIDGE) * value ** 2))
            ok = (n >= MIN_ROWS) & (len(rows) - n >= MIN_ROWS)
            if sign[f]:
                ok &= sign[f] * (vr - vl) >= 0
            gain = np.where(ok, gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > best and k < len(edges[f]):
                best, at = gain[k], (f, k, float(vl[k]), float(vr[k]))
        if at is None:
            return me
        f, k, vl, vr = at
        right = codes[rows, f] > k
        middle = (vl + vr) / 2
        (l_low, l_high), (r_low, r_high) = (low, high), (low, high)
        if sign[f] < 0:
            l_low, r_high = max(low, middle), min(high, middle)
        elif sign[f] > 0:
            l_high, r_low = min(high, middle), max(low, middle)
        lo = add(rows[~right], depth + 1, l_low, l_high)
        hi = add(rows[right], depth + 1, r_low, r_high)
        nodes[me] = (f, float(edges[f][k]), lo, hi, 0.0)
        return me

    add(np.arange(len(g)), 0, -np.inf, np.inf)
    return nodes


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> tuple[list[list[tuple]], float]:
    """Logistic boosting; (trees, starting log-odds)."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    sign = np.array([-1 if f in FALLING else 0 for f in FEATURES])
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    score, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grow(codes, edges, p - y, np.maximum(p * (1 - p), 1e-6), sign)
        grown.append(tree)
        score += flatten([tree], 0.0, 0.0).raw(x)
    return grown, start


def fit(x: np.ndarray, y: np.ndarray) -> Trees | None:
    """Trees with a threshold ``cut``: the log-odds that all but ``MAY_REJECT`` of the
    good documents of a held-out quarter reach, at most 0 (even odds)."""
    if len(np.unique(y)) < 2 or len(y) < 8 * MIN_ROWS:
        return None
    held = np.arange(len(y)) % 4 == 0
    cut = 0.0
    if len(np.unique(y[~held])) == 2 and (y[held] == 1).any():
        first = flatten(*boost(x[~held], y[~held]), 0.0)
        cut = min(cut, float(np.quantile(first.raw(x[held & (y == 1)]), MAY_REJECT)))
    grown, start = boost(x, y)
    return flatten(grown, start, cut)


def train(docs: DataFrame, labels: DataFrame) -> Trees | None:
    """Fit on at most ``MAX_LABELLED`` labelled documents, in an order fixed by their ids.
    Only these are measured here, found by their ids; no text is shuffled."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("label"))
    chosen = docs.select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    label = {r["doc_id"]: float(r["label"] > 0) for r in chosen.collect()}  # MAX_LABELLED rows at most, as below
    if not label:
        return None
    ids = docs.sparkSession.createDataFrame([(x,) for x in label], "doc_id long")
    rows = statistics(docs.join(F.broadcast(ids), "doc_id", "left_semi")).select("doc_id", "features").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    return fit(np.array([r["features"] for r in rows]), np.array([label[r["doc_id"]] for r in rows]))


def judged(counts: np.ndarray, features: np.ndarray, trees: Trees | None) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds, kept) of measured texts; without a model the base rule decides."""
    kept = ~base_failed(counts)
    if trees is None:
        return np.zeros(len(counts)), kept
    parts = [trees.raw(features[k:k + 4096]) for k in range(0, len(features), 4096)]
    raw = np.concatenate(parts) if parts else np.zeros(0)
    return raw, kept & (raw >= trees.cut)


def verdicts(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, the COUNTS, base_failed, kept and score (log-odds) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            counts, features = measured(data, offsets)
            raw, kept = judged(counts, features, shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(base_failed(counts)),
                 pa.array(kept), pa.array(raw)], names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(run, schema)


def filtered(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """The documents that the rules keep, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(at))
            yield batch.filter(pa.array(judged(*measured(data, offsets), shared.value)[1]))

    return docs.mapInArrow(run, docs.schema)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return verdicts(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op5_quality_rules": op5_quality_rules}
ORACLES: dict[str, str] = {}
