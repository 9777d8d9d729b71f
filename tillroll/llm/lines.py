"""Operator 1: line dedup over the whole corpus.

Lines travel as (128-bit hash, document, position), never as text.  They are
range-partitioned and sorted by all of these, so a line that a third of the corpus
holds is spread over many partitions.  Each partition is streamed: in the run of
one hash the rows of the first document stay and the others are dropped.  A
partition's first run may have begun in an earlier one; its rows are settled
afterwards from one summary row a partition.  What comes back for each document is
a compressed bitmap of the lines to keep.

Defined cases: a null or empty text is one empty line; lines whose stripped key has
under ``min_chars`` code points always stay; a null doc_id counts as larger than
all others; rows with equal doc_id are one document, so they never drop each
other's lines; an empty table gives an empty result; other columns pass through
``dedup`` unchanged.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._stage import free_name, partitions, staged, table, text_or_empty

MIN_CHARS = 10
STRIPPED = b"\x20\t\n\r\x0b\x0c"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Stripped and lower-cased (ASCII); None if too short to count."""
    key = line.strip(STRIPPED)
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return key.lower()


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, crc, pos) of each line that counts; crc tells apart rows of equal doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows, crcs, places, hashes = [], [], [], []
                for k in range(at, min(at + 256, len(batch))):
                    raw = (batch.column(1)[k].as_py() or "").encode()
                    keys = [(p, key) for p, x in enumerate(raw.split(b"\n")) if (key := line_key(x, min_chars)) is not None]
                    if keys:
                        rows += [k] * len(keys)
                        crcs += [zlib.crc32(raw)] * len(keys)
                        places += [p for p, _ in keys]
                        hashes += [digest(key) for _, key in keys]
                two = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(two[:, 0]), pa.array(two[:, 1]), batch.column(0).take(pa.array(rows, pa.int64())),
                     pa.array(crcs, pa.int64()), pa.array(places, pa.int32())], names=["h1", "h2", "doc_id", "crc", "pos"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "h1 long, h2 long, doc_id long, crc long, pos int")


SORTED = "kind int, part int, doc_id long, crc long, pos int, h1 long, h2 long, owner long"
#: Rows of ``SORTED``: a line to drop; a line of the partition's first run; the summary.
DROP, HEAD, SUMMARY = 0, 1, 2
_NULL = np.iinfo(np.int64).max  # stands for a null doc_id inside a task


def first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted partition.  ``owner``: the first document of the run, in the
    summary that of the last run, whose hash h1, h2 it gives with ``pos`` 1 if the
    partition is a single run."""
    part = TaskContext.get().partitionId()
    head: tuple[int, int] | None = None
    now: tuple[int, int] | None = None
    owner, in_head = 0, True
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        doc = batch.column(2).fill_null(_NULL).to_numpy()
        new = np.ones(n, bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = now != (int(h1[0]), int(h2[0]))
        run = np.cumsum(new)
        owners = np.concatenate([[owner], doc[new]])[run]
        if head is None:
            head = (int(h1[0]), int(h2[0]))
            in_run = run == 1
        else:
            in_run = (run == 0) if in_head else np.zeros(n, bool)
        in_head = bool(in_run[-1])
        now, owner = (int(h1[-1]), int(h2[-1])), int(owners[-1])
        take = np.flatnonzero(in_run | (doc != owners))
        m = len(take)
        kind = np.where(in_run[take], HEAD, DROP).astype(np.int32)
        rows = pa.array(take)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.full(m, part, np.int32)), *(batch.column(c).take(rows) for c in (2, 3, 4, 0, 1)),
             pa.array(owners[take])], names=[f.split()[0] for f in SORTED.split(", ")])
    if now is not None:
        first, last = head, now
        for key, who, single in ((first, None, 0), (last, owner, int(first == last))):
            yield pa.RecordBatch.from_arrays(
                [pa.array([SUMMARY], pa.int32()), pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                 pa.array([single], pa.int32()), pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                 pa.array([who], pa.int64())], names=[f.split()[0] for f in SORTED.split(", ")])


def carried_owners(summaries: list) -> dict[int, int]:
    """For each partition whose first run began earlier, the run's first document."""
    first, last = {}, {}
    for r in summaries:
        (first if r["owner"] is None else last)[r["part"]] = r
    out: dict[int, int] = {}
    before = None
    for part in sorted(last):
        if before is not None and (last[before]["h1"], last[before]["h2"]) == (first[part]["h1"], first[part]["h2"]):
            single = last[before]["pos"] == 1
            out[part] = out[before] if single and before in out else last[before]["owner"]
        before = part
    return out


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, crc, pos) of every line that an earlier document also holds."""
    spark = docs.sparkSession
    order = ["h1", "h2", F.col("doc_id").asc_nulls_last(), "crc", "pos"]
    lines = line_hashes(docs, min_chars)
    streamed = lines.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    found = staged(streamed.mapInArrow(first_occurrences, SORTED), "line-runs")
    carried = carried_owners(found.where(F.col("kind") == SUMMARY).collect())  # two rows a partition
    began = spark.createDataFrame([*carried.items()], "part int, began long")
    own = F.coalesce("doc_id", F.lit(int(_NULL)))
    held = found.where(F.col("kind") != SUMMARY).join(F.broadcast(began), "part", "left")  # a row a partition at most
    return held.where((F.col("kind") == DROP) | (own != F.coalesce("began", "owner"))).select("doc_id", "crc", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, crc, keep) of each document that loses lines: ``keep`` is the
    zlib-compressed bitmap of its lines up to the last one to drop; later ones stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for places in batch.column(2):
                at = np.asarray(places.values)
                keep = np.ones(int(at.max()) + 1, bool)
                keep[at] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes() + bytes([len(keep) % 8]), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())],
                                             names=["doc_id", "crc", "keep"])

    places = dropped_lines(docs, min_chars).groupBy("doc_id", "crc").agg(F.collect_list("pos").alias("places"))
    return places.mapInArrow(run, "doc_id long, crc long, keep binary")


def kept_lines(raw: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    """(text without the dropped lines, lines before, lines dropped)."""
    if keep is None:
        return raw, raw.count(b"\n") + 1, 0
    plain = zlib.decompress(keep)
    bits = np.unpackbits(np.frombuffer(plain[:-1], np.uint8))
    bits = bits[:len(bits) - (8 - plain[-1]) % 8]
    lines = raw.split(b"\n")
    left = [x for x, b in zip(lines, bits, strict=False) if b] + lines[len(bits):]
    return b"\n".join(left), len(lines), len(lines) - len(left)


def with_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` and, as last column, the bitmap; null where every line stays."""
    own, crc, keep = (free_name(docs, x) for x in ("_map_id", "_map_crc", "_keep"))
    maps = keep_bitmaps(docs, min_chars).toDF(own, crc, keep)
    on = docs["doc_id"].cast("long").eqNullSafe(maps[own]) & (F.crc32(text_or_empty()) == maps[crc])
    return docs.join(maps.hint("shuffle_hash"), on, "left").drop(own, crc)


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The same rows and columns, repeated lines gone; a null text stays null."""
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts = []
            for k in range(len(batch)):
                text, keep = batch.column(at)[k].as_py(), batch.column(len(names))[k].as_py()
                texts.append(text if text is None or keep is None else kept_lines(text.encode(), keep)[0].decode())
            columns = list(batch.columns[:len(names)])
            columns[at] = pa.array(texts, columns[at].type)
            if "n_chars" in names:
                old = columns[names.index("n_chars")]
                columns[names.index("n_chars")] = pa.array(
                    [o if t is None else len(t) for o, t in zip(old.to_pylist(), texts, strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return with_bitmaps(docs, min_chars).mapInArrow(run, schema)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(len(batch)):
                kept, n, lost = kept_lines((batch.column(1)[k].as_py() or "").encode(), batch.column(2)[k].as_py())
                rows.append((n, lost, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True))],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return with_bitmaps(docs).mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


SQL = r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM texts),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT k.*, owner IS NULL OR owner = doc_id AS kept FROM keyed k LEFT JOIN held USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE kept), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES = {"op1_line_dedup": SQL}
