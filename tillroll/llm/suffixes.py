"""Operator 9: removal of repeated byte strings, by bucket-pointer refinement.

A byte goes if some ``LENGTH``-byte string that covers it also starts anywhere else.
Sorting all suffixes of a corpus is out of reach, and not needed: every window of
``LENGTH`` bytes is represented by its anchor, the q-gram start in it with the
smallest hash.  Equal windows have their anchors at the same place, so only
suffixes at anchors (about one for 175 bytes) are put into initial buckets, by
their q-gram.

* A bucket of one anchor holds no repeated window.
* Anchors with the same whole context (all bytes of all windows that they
  represent) repeat each other entirely; only their count and first place go on.
* What is left, distinct contexts in one bucket, is refined: positions start in
  q-gram buckets, then are sorted by (own bucket, bucket ``depth`` bytes later), which
  doubles the depth; the updated pointers are used again until the depth is
  ``LENGTH``.  Windows that end in a bucket of several repeat.

A bucket of more than ``HOT`` distinct contexts is not gathered: its windows are
counted by hash, combined on the map side.

Defined cases: a null text counts as empty; matches never cross documents, but a
repeated row is a second place, whatever its doc_id; a null doc_id is an id like
any other; texts under ``LENGTH`` bytes lose nothing; an empty table gives an
empty result; other columns pass through ``remove_repeats`` unchanged, where
characters that lose only some of their bytes are dropped with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import ODD, SLICE_BYTES, RangeHash, mix, slices, text_buffers
from ._stage import free_name, partitions, staged, table, text_or_empty

LENGTH, GRAM = 400, 50  # LENGTH is GRAM times a power of two
#: Distinct contexts of a bucket that one task refines; contexts refined at once.
HOT, AT_ONCE = 32_768, 1_024
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive keys, from block-wise prefix and suffix minima."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(suffix[:n], prefix[width - 1:width - 1 + n])


def anchors_of(data: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the rows bounded by ``local``: row, gram hash, context hash, anchor, first
    and last window start that the anchor represents (positions within ``data``)."""
    n = len(data)
    none = (np.zeros(0, np.int64),) * 6
    if n < LENGTH:
        return none
    hashes = RangeHash(data)
    places = np.arange(n - GRAM + 1)
    keys = (mix(hashes(places, places + GRAM)) & ~_PLACE) | places.astype(np.uint64)
    least = sliding_minimum(keys, LENGTH - GRAM + 1)
    anchor = (least & _PLACE).astype(np.int64)
    edge = np.zeros(n + 2, np.int64)
    long_rows = np.flatnonzero(np.diff(local) >= LENGTH)
    edge[local[long_rows]] += 1
    edge[local[long_rows + 1] - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(edge)[:len(anchor)] > 0)
    if not len(starts):
        return none
    own = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    s1, s2 = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    at = own[first]
    gram = hashes(at, at + GRAM).view(np.int64)
    context = mix(hashes(s1, s2 + LENGTH) + (at - s1).astype(np.uint64) * ODD).view(np.int64)
    return np.searchsorted(local, s1, "right") - 1, gram, context, at, s1, s2


def parts(offsets: np.ndarray):
    """(first row, row bounds, start in the data) of bounded parts; a row above the
    bound comes in overlapping parts, which share no window."""
    most = min(SLICE_BYTES, int(_PLACE))
    for a, b in slices(offsets, most):
        size = int(offsets[b] - offsets[a])
        if size <= most:
            yield a, offsets[a:b + 1] - offsets[a], int(offsets[a])
        else:
            for at in range(0, size, most):
                if (end := min(at + most + LENGTH - 1, size)) - at >= LENGTH:
                    yield a, np.array([0, end - at]), int(offsets[a]) + at


ANCHOR = "gram long, context long, doc_id long, crc long, at int, s1 int, s2 int"


def anchors(docs: DataFrame) -> DataFrame:
    """One row for each anchor; places count bytes from the start of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for first, local, start in parts(offsets):
                row, gram, context, at, s1, s2 = anchors_of(data[start:start + int(local[-1])], local)
                rows = pa.array(row + first)
                move = start - offsets[row + first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(context), batch.column(0).take(rows), batch.column(2).take(rows),
                     *(pa.array((x + move).astype(np.int32)) for x in (at, s1, s2))],
                    names=[f.split()[0] for f in ANCHOR.split(", ")])

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.crc32(text).alias("crc")).mapInArrow(run, ANCHOR)


def refined(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bucket of the ``LENGTH`` bytes from each position; -1 where they leave their context."""
    n = len(data)
    ends = bounds[np.searchsorted(bounds, np.arange(n), "right")]  # of each position's context
    places = np.flatnonzero(ends - np.arange(n) >= GRAM)
    pointer = np.full(n, -1, np.int64)
    _, pointer[places] = np.unique(RangeHash(data)(places, places + GRAM), return_inverse=True)
    depth = GRAM
    while depth < LENGTH:
        places = places[ends[places] - places >= 2 * depth]
        pair = pointer[places] * (n + 1) + pointer[places + depth]
        update = np.full(n, -1, np.int64)
        _, update[places] = np.unique(pair, return_inverse=True)
        pointer, depth = update, 2 * depth
    return pointer


def runs_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending window starts as covered [start, end) runs."""
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > starts[:-1] + LENGTH
    first = np.flatnonzero(new)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1] + LENGTH


CONTEXT = "gram long, doc_id long, crc long, copies long, s1 int, n int, bytes binary"
SPAN = "doc_id long, crc long, s int, e int"


def repeated_windows(rows: list[tuple]) -> list[tuple]:
    """Spans of the contexts (doc_id, crc, copies, s1, n, bytes) whose windows repeat."""
    data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])])
    pointer = refined(data, bounds)
    windows = np.concatenate([np.arange(b, b + r[4]) for r, b in zip(rows, bounds, strict=False)])
    many = np.bincount(pointer[windows])
    out = []
    for r, b in zip(rows, bounds, strict=False):
        if r[2] == 1:  # contexts with copies are removed anyway
            again = np.flatnonzero(many[pointer[b:b + r[4]]] > 1)
            if len(again):
                out += [(r[0], r[1], int(s) + r[3], int(e) + r[3]) for s, e in zip(*runs_of(again), strict=True)]
    return out


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "crc", "s", "e"])


def refine_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by gram: whole buckets are refined together, ``AT_ONCE`` or more contexts at a time."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        for gram, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if gram != last and len(held) >= AT_ONCE:
                yield _spans(repeated_windows(held))
                held = []
            last = gram
            held.append(tuple(row))
    if held:
        yield _spans(repeated_windows(held))


def counted_windows(contexts: DataFrame) -> DataFrame:
    """Spans in buckets too large for one task: windows counted by hash."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, n in zip(batch.column("bytes").to_pylist(), batch.column("n").to_pylist(), strict=True):
                at = np.arange(n)
                out.append(RangeHash(np.frombuffer(raw, np.uint8))(at, at + LENGTH).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(5)] + [pa.array(out, pa.list_(pa.int64()))],
                                             names=["gram", "doc_id", "crc", "copies", "s1", "windows"])

    rows = contexts.mapInArrow(hashed, "gram long, doc_id long, crc long, copies long, s1 int, windows array<long>")
    each = rows.select("gram", "doc_id", "crc", "copies", "s1", F.posexplode("windows").alias("o", "window"))
    again = each.groupBy("gram", "window").agg(F.count("*").alias("times")).where("times > 1")
    return each.where("copies = 1").join(again, ["gram", "window"]).select(
        "doc_id", "crc", (F.col("s1") + F.col("o")).alias("s"), (F.col("s1") + F.col("o") + LENGTH).alias("e"))


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, crc, spans) of each document with repeated bytes; spans may overlap."""
    spark = docs.sparkSession
    found = staged(anchors(docs), "anchors")
    several = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi"))
    # a table of its own, so that the join below can split a gram that very many anchors share
    several = staged(several.where("n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("differ")), "grams")
    shared = staged(found.join(several, "gram"), "shared-anchors")
    contexts = shared.groupBy("gram", "context").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "crc", "at", "s1", "s2")).alias("first"),
        F.any_value("differ").alias("differ"))
    contexts = staged(contexts, "contexts")
    whole = shared.join(contexts.where("copies > 1").select("gram", "context"), ["gram", "context"]).select(
        "doc_id", "crc", F.col("s1").alias("s"), (F.col("s2") + LENGTH).alias("e"))

    differing = contexts.where("differ").select("gram", "copies", "first.*")
    size = differing.groupBy("gram").agg(F.count("*").alias("k"), F.min("copies").alias("least"))
    size = staged(size.where("least = 1").select("gram", "k"), "gram-sizes")  # else every context has copies
    differing = differing.join(size, "gram")
    wanted = differing.groupBy(F.col("doc_id").alias("w_id"), F.col("crc").alias("w_crc")).agg(
        F.collect_list(F.struct("gram", "copies", "at", "s1", "s2", "k")).alias("wanted"))
    text = text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long"), F.encode(text, "UTF-8").alias("raw"), F.crc32(text).alias("crc"))
    beside = texts.join(wanted.hint("shuffle_hash"), texts["doc_id"].eqNullSafe(F.col("w_id")) & (F.col("crc") == F.col("w_crc")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                raw, own = batch.column("raw")[i].as_py(), batch.column("wanted")[i].as_py()
                m = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["gram"] for w in own], pa.int64()), pa.array([batch.column("doc_id")[i].as_py()] * m, pa.int64()),
                     pa.array([batch.column("crc")[i].as_py()] * m, pa.int64()), pa.array([w["copies"] for w in own], pa.int64()),
                     pa.array([w["s1"] for w in own], pa.int32()), pa.array([w["s2"] - w["s1"] + 1 for w in own], pa.int32()),
                     pa.array([raw[w["s1"]:w["s2"] + LENGTH] for w in own], pa.binary()),
                     pa.array([w["k"] for w in own], pa.int64())],
                    names=["gram", "doc_id", "crc", "copies", "s1", "n", "bytes", "k"])

    cuts = staged(beside.select("doc_id", "crc", "raw", "wanted").mapInArrow(cut, CONTEXT + ", k long"), "cut-contexts")
    small = cuts.where(F.col("k") <= hot).drop("k").repartition(partitions(spark), "gram").sortWithinPartitions("gram")
    partial = small.mapInArrow(refine_buckets, SPAN).unionByName(counted_windows(cuts.where(F.col("k") > hot).drop("k")))
    return whole.unionByName(partial).groupBy("doc_id", "crc").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of sorted (start, end) spans."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, done = [], 0
    for s, e in spans:
        out.append(raw[done:s])
        done = e
    return b"".join(out) + raw[done:]


def with_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``docs`` and, as last column, the spans to remove; null where nothing repeats."""
    own, crc, spans = (free_name(docs, x) for x in ("_span_id", "_span_crc", "_spans"))
    found = repeated_spans(docs, hot).toDF(own, crc, spans)
    on = docs["doc_id"].cast("long").eqNullSafe(found[own]) & (F.crc32(text_or_empty()) == found[crc])
    return docs.join(found.hint("shuffle_hash"), on, "left").drop(own, crc)


def _pairs(value) -> list[tuple[int, int]]:
    return merged([(x["s"], x["e"]) for x in value]) if value else []


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The same rows and columns without the repeated bytes of their texts."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts = []
            for k in range(len(batch)):
                text, spans = batch.column(at)[k].as_py(), _pairs(batch.column(len(names))[k].as_py())
                texts.append(without(text.encode(), spans).decode("utf-8", "ignore") if spans else text)
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_spans(docs, hot).mapInArrow(run, schema)


def digests(docs: DataFrame, hot: int = HOT) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(len(batch)):
                raw, spans = (batch.column(1)[k].as_py() or "").encode(), _pairs(batch.column(2)[k].as_py())
                kept = without(raw, spans)
                rows.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(docs.select(F.col("doc_id").cast("long"), "text"), hot).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents")).withColumn("has_repeats", F.col("n_removed") > 0)


SQL = r"""
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
starts AS (SELECT doc_id, raw, unnest(range(octet_length(raw) - 399)) AS s FROM texts WHERE octet_length(raw) >= 400),
windows AS (SELECT doc_id, s, md5(raw[s + 1:s + 400]) AS w FROM starts),
again AS (SELECT doc_id, s FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
gaps AS (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400 THEN 0 ELSE 1 END AS fresh FROM again),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM gaps),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 400 AS b FROM runs GROUP BY doc_id, run),
kept AS (SELECT doc_id, run, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS a, a AS b FROM spans
    UNION ALL SELECT doc_id, max(run) + 1, max(b), 2000000000 FROM spans GROUP BY doc_id),
texts_left AS (SELECT doc_id, string_agg(substr(hex(raw), 2 * a + 1, 2 * (b - a)), '' ORDER BY run) AS left_hex
    FROM kept JOIN texts USING (doc_id) GROUP BY doc_id),
totals AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, octet_length(raw) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, coalesce(n_removed, 0) > 0 AS has_repeats,
    sha256(CASE WHEN left_hex IS NULL THEN raw ELSE unhex(left_hex) END) AS kept_sha256
FROM texts LEFT JOIN texts_left USING (doc_id) LEFT JOIN totals USING (doc_id)
"""

QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLES = {"op9_suffix_dedup": SQL}
