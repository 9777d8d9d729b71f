"""Operator 7: best-fit packing by bin completion.

The documents' pieces differ, for packing, only by their length, and there are at
most ``capacity`` lengths.  So the search runs on the histogram of lengths, whose
size does not depend on the corpus; a plan says how many sequences are filled by
which pattern of lengths, and the pieces are then dealt to the plan's slots by
their rank among the pieces of their length, in parallel.

The search is bin completion: take the largest length left, enumerate the
undominated fillings of the rest of its sequence, try them by least waste, and cut
a branch whose waste so far already forces as many sequences as the incumbent.  The
first incumbent is best-fit decreasing.  A filling is applied to as many sequences
at once as its lengths allow.  The search ends when the incumbent meets the lower
bound, or after ``SEARCH_NODES`` nodes: that bounds the effort, no piece is left out.

Defined cases: a null text counts as empty and gives one piece holding the closing
id alone; repeated rows (equal doc_id or text) are packed as rows of their own;
documents with a null doc_id are packed too; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._stage import staged, table
from .bpe import byte_characters

CAPACITY, END_ID = 2048, 0
VOCABULARY = "word_bpe_49k.json"
#: Search effort, not data: nodes of the bin completion tree, fillings tried at each.
SEARCH_NODES, FILLINGS = 40_000, 6
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64

PIECE = "piece int, start long, length long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


#: Words of Latin-1 letters only: normalising them is lower-casing, and they are one
#: pre-token, so the model alone gives their ids.  The punctuation in ``TAIL`` never
#: joins such letters in one pre-token (unlike the apostrophe).
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
TAIL = b".,;:!?&%$#*|\"()[]"


class WordCoder(dict):
    """Ids of whole texts.  The tokenizer drops white space and never joins over it,
    so words encode on their own.  The coder remembers words' ids (little-endian,
    unsigned, 32 bits each) and looks up others on first sight."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.bare, self.spelling = self.tokenizer.model, byte_characters()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(TAIL)
        text = word.decode("utf-8", "replace")
        if LETTERS.fullmatch(text):
            spelt = "".join([self.spelling[b] for b in text.lower().encode()])
            ids = [t.id for t in self.bare.tokenize(spelt)]
            found = struct.pack(f"<{len(ids)}I", *ids)
        elif len(core) < len(word) and LETTERS.fullmatch(core.decode("utf-8", "replace")):
            found = self[core.lower()] + self[word[len(core):]]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) > REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8", "surrogatepass").split()))


@lru_cache(maxsize=4)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, the partition
    it was made in (``part``) and its rank there among pieces of its length (``nth``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, made = word_coder(vocabulary), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows, out = [], []
            for k in range(len(batch)):
                raw = coder.ids(batch.column(1)[k].as_py() or "") + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    cut = raw[at:at + 4 * capacity]
                    n = len(cut) // 4
                    rows.append(k)
                    out.append((piece, at // 4, n, zlib.crc32(cut), made[n], cut))
                    made[n] += 1
            columns = list(zip(*out, strict=True)) or [[]] * 6
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in columns[1:4]), pa.array([part] * len(rows), pa.int32()),
                      pa.array(columns[4], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if keep_ids:
                arrays.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in columns[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {kind}, {PIECE}, part int, nth long" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(run, schema)


# ---- the plan, on the histogram of lengths

Pattern = tuple[int, ...]
Plan = list[tuple[Pattern, int]]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing needs fewer sequences: total length, or the lengths over a half
    with what cannot go beside them, whichever is more."""
    lengths = np.arange(len(counts))
    best = -(-int((counts * lengths).sum()) // capacity)
    for k in {0, *np.flatnonzero(counts[:capacity // 2 + 1]).tolist()}:
        alone = counts[capacity - k + 1:].sum()
        half = counts[capacity // 2 + 1:capacity - k + 1]
        sizes = lengths[capacity // 2 + 1:capacity - k + 1]
        free = half.sum() * capacity - (half * sizes).sum()
        small = (counts[k:capacity // 2 + 1] * lengths[k:capacity // 2 + 1]).sum()
        best = max(best, int(alone + half.sum() + max(0, -(-int(small - free) // capacity))))
    return best


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> Plan:
    """Each piece, longest first, into the fullest sequence with room; equal
    sequences and equal lengths are handled together."""
    room: dict[int, list[list]] = {}  # free length: [pattern, how many]
    free: list[int] = []  # sorted keys of room

    def put(at: int, pattern: Pattern, n: int) -> None:
        if n:
            if at not in room:
                room[at] = []
                bisect.insort(free, at)
            room[at].append([pattern, n])

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            k = bisect.bisect_left(free, length)
            if k == len(free):
                each = capacity // length
                put(capacity - each * length, (length,) * each, left // each)
                rest = left % each
                put(capacity - rest * length, (length,) * rest, 1 if rest else 0)
                break
            at = free[k]
            pattern, n = room[at].pop()
            if not room[at]:
                del room[at]
                free.pop(k)
            each = at // length
            use = min(n, left // each)
            put(at, pattern, n - use - (use < n and left - use * each > 0))
            put(at - each * length, pattern + (length,) * each, use)
            left -= use * each
            if use < n and left:
                put(at - left * length, pattern + (length,) * left, 1)
                left = 0
    return [(pattern, n) for groups in room.values() for pattern, n in groups]


def fillings(counts: np.ndarray, rest: int, most: int = FILLINGS) -> list[Pattern]:
    """Undominated fillings of ``rest`` of up to three pieces, then greedily on, least waste first.

    One piece dominates every filling that sums to no more than it does; a pair
    dominates what can be exchanged for it piece by piece, which leaves for each
    first length only the largest second one.
    """
    there = np.flatnonzero(counts[:rest + 1])
    there = there[there > 0]
    if not len(there):
        return [()]
    single = int(there[-1])
    if single == rest:
        return [(single,)]
    below = np.zeros(rest + 1, np.int64)  # the largest length there is up to each
    below[there] = there
    below = np.maximum.accumulate(below)
    first = there[::-1]
    second = np.minimum(below[rest - first], first)
    again = (second == first) & (counts[first] < 2)
    second = np.where(again, below[np.maximum(np.minimum(first - 1, rest - first), 0)], second)
    spare = rest - first - second
    third = np.minimum(below[spare], second)
    need = 1 + (third == second) + (third == first)
    third = np.where((third > 0) & (counts[third] < need), 0, third)
    total = first + second + third
    out: dict[Pattern, int] = {}
    for i in np.argsort(-total, kind="stable")[:most]:
        pattern = [int(x) for x in (first[i], second[i], third[i]) if x]
        spare = rest - sum(pattern)
        left = {x: int(counts[x]) - pattern.count(x) for x in pattern}
        while spare > 0 and (x := int(below[spare])):
            while x and left.get(x, int(counts[x])) <= 0:
                x = int(below[x - 1])
            if not x:
                break
            each = min(spare // x, left.get(x, int(counts[x])))
            pattern += [x] * each
            left[x] = left.get(x, int(counts[x])) - each
            spare -= each * x
        out.setdefault(tuple(sorted(pattern, reverse=True)), spare)
    return sorted(out, key=lambda p: (out[p], len(p)))


def bin_completion(counts: np.ndarray, capacity: int, nodes: int = SEARCH_NODES) -> Plan:
    """A plan for all pieces: ``counts[length]`` of each length up to ``capacity``."""
    counts = np.asarray(counts, np.int64).copy()
    bound, best = lower_bound(counts, capacity), best_fit_decreasing(counts, capacity)
    used = sum(n for _, n in best)
    total = int((counts * np.arange(len(counts))).sum())
    stack: list[tuple[Pattern, int, list[Pattern], int]] = []  # applied: pattern, times; fillings left; waste before
    waste = 0
    while nodes and used > bound:
        nodes -= 1
        there = np.flatnonzero(counts)
        options: list[Pattern] = []
        if not len(there):
            used = sum(n for _, n, _, _ in stack)
            best = [(p, n) for p, n, _, _ in stack]
        elif -(-(total + waste) // capacity) < used:  # else the waste rules this branch out
            largest = int(there[-1])
            counts[largest] -= 1
            options = [tuple(sorted((largest, *f), reverse=True)) for f in fillings(counts, capacity - largest)]
            counts[largest] += 1
        while not options and stack:  # back to the last choice
            pattern, n, options, waste = stack.pop()
            for length in pattern:
                counts[length] += n
        if not options:
            break
        pattern, *others = options
        n = min(int(counts[x]) // pattern.count(x) for x in set(pattern))
        for length in pattern:
            counts[length] -= n
        stack.append((pattern, n, others, waste))
        waste += n * (capacity - sum(pattern))
    return best


def slots(plan: Plan) -> tuple[np.ndarray, ...]:
    """The plan as rows, by length and first rank: length, first rank, pieces of
    that length in one sequence, first sequence, offset there."""
    rows, first, sequence = [], {}, 0
    for pattern, n in plan:
        at = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            rows.append((length, first.get(length, 0), each, sequence, at))
            first[length] = first.get(length, 0) + each * n
            at += each * length
        sequence += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 5


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """All pieces with their sequence_id and offset (and their ids, if asked for)."""
    spark = docs.sparkSession
    made = staged(pieces(docs, vocabulary, capacity, keep_ids), "pieces")
    by_part = staged(made.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(slots(bin_completion(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = made.join(ranks, ["length", "part"]).withColumn("nth", F.col("before") + F.col("nth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, each, sequence, at = plan.value
        key = (length << 40) + first
        for batch in batches:
            own, nth = batch.column("length").to_numpy(), batch.column("nth").to_numpy()
            row = np.searchsorted(key, (own << 40) + nth, "right") - 1
            k = nth - first[row]
            arrays = [c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != "nth"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence[row] + k // each[row]), pa.array(at[row] + k % each[row] * own)],
                names=[n for n in batch.schema.names if n != "nth"] + ["sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids, "nth"]
    ready = ranked.select(*kept)
    kinds = {f.name: f.dataType.simpleString() for f in ready.schema.fields}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in kept if n != "nth") + ", sequence_id long, offset long"
    return ready.mapInArrow(run, schema)


def op7_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_vocabulary())


QUERIES = {"op7_best_fit_pack": op7_best_fit_pack}
ORACLES: dict[str, str] = {}
