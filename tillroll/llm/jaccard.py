"""Operator 8: n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles, as 64-bit hashes.  Equal
sets form one class, and only classes are joined.

*Order.*  A fixed-size sketch counts all shingles of the corpus in 2**20 slots; a
shingle's level is the logarithm of its slot's count over the mean.  All sets are
ordered by level, then hash: rare shingles first.

*Adaptive prefixes.*  If two sets are similar enough, their prefixes of
``n - ceil(t n) + l`` shingles share at least ``l``.  Each document picks the ``l`` that
costs least: prefix length, plus the candidates that its prefix's slots promise,
divided by the matches that such a prefix demands.  A pair must share as many
prefix shingles as both prefixes and sizes demand before it is verified.

*Candidates.*  Postings (shingle, class) meet by shingle.  A shingle of at most
``SMALL`` classes gives its pairs.  A more frequent one gives each class's link with its
most central one, where their prefixes share enough, and all other pairs are counted block against block inside tasks,
where only pairs that pass the demand and are not yet connected come out.

*Verification.*  Exact intersections of the full sets.  The sets of a component of
candidates meet in one task, or, if they are too many, pair by pair.  Pairs that
are already connected need no check, as it cannot change the components.

Defined cases: null, empty or wordless texts have an empty set, are linked with
nothing and are their own component; a text of fewer than five words is one
shingle, its whole sequence; repeated rows are linked copies, rows of one id with
different texts documents of their own; a null doc_id takes part, after all others
in order, and its component_id is null only if no other id is in it; an empty table gives an empty result; other columns pass
through ``one_of_each`` unchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._bytes import distinct, row_shingles, text_buffers
from ._graph import components
from ._stage import free_name, partitions, staged, table, text_or_empty

WIDTH, PERCENT = 5, 75
SLOT_BITS, SKETCH_PARTS = 20, 64
#: Classes of a shingle whose pairs are listed; above it blocks are compared.
SMALL, BLOCK = 64, 512
#: Bytes of the sets, and pairs, of a candidate component that one task verifies.
CLUSTER_BYTES, CLUSTER_PAIRS = 48 << 20, 200_000
#: Classes (24 bytes each) up to which a list of them is broadcast.
LISTED = 500_000
#: Stands for a null doc_id where ids are compared.
NO_ID = (1 << 63) - 1
U64 = np.uint64


def slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U64(64 - SLOT_BITS)).astype(np.int64)


SEEN = "kind int, doc_id long, crc long, n long, k long, part int, counts binary"


def sets_and_sketch(docs: DataFrame, width: int) -> DataFrame:
    """A row (kind 0) for each document with its set's size and hash ``k``, and for each
    task (kind 1) the slots that it has counted, in ``SKETCH_PARTS`` compressed parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            sizes, keys = [], []
            for shingles, _ in row_shingles(data, offsets, width):
                own = distinct(shingles)
                np.add.at(counts, slots(own), 1)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63) if len(own) else None)
            m = len(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(m, np.int32)), batch.column(0), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                names=[f.split()[0] for f in SEEN.split(", ")])
        packed = [zlib.compress(x.astype(np.int64).tobytes(), 1) for x in np.split(counts, SKETCH_PARTS)]
        m = SKETCH_PARTS
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int32)), *(pa.nulls(m, pa.int64()) for _ in range(4)),
             pa.array(np.arange(m, dtype=np.int32)), pa.array(packed, pa.binary())], names=[f.split()[0] for f in SEEN.split(", ")])

    return docs.mapInArrow(run, SEEN)


def summed_sketch(seen: DataFrame) -> np.ndarray:
    """The corpus counts, in 2**SLOT_BITS numbers whatever its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(raw), np.int64)
                sums[part] = sums[part] + own if part in sums else own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(
            [zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())], names=["part", "counts"])

    rows = seen.where("kind = 1").select("part", "counts").repartition(SKETCH_PARTS, "part")
    total = np.zeros((SKETCH_PARTS, (1 << SLOT_BITS) // SKETCH_PARTS), np.int64)
    for row in rows.mapInArrow(run, "part int, counts binary").collect():  # SKETCH_PARTS rows
        total[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return total.reshape(-1)


class Order:
    """The common order of shingles and the choice of prefixes."""

    def __init__(self, counts: np.ndarray, percent: int):
        mean = max(1.0, counts.sum() / len(counts))
        self.level = np.clip(np.floor(np.log2(np.maximum(counts, 1) / (2 * mean))), 0, 15).astype(np.uint8)  # ordered numbers stay positive as longs
        self.excess = np.maximum(counts - 2 * mean, 0).astype(np.float32)
        self.percent = percent

    def prefix(self, own: np.ndarray) -> tuple[np.ndarray, int]:
        """(the chosen prefix of a set as ordered numbers, share of common shingles in thousandths)."""
        n, at = len(own), slots(own)
        key = (self.level[at].astype(U64) << U64(59)) | (own >> U64(5))
        order = np.argsort(key)
        least = -(-self.percent * n // 100)
        base = n - least
        both = -(-2 * self.percent * n // (100 + self.percent))  # the overlap that an equal size demands
        ladder = sorted({1, 1 + n // 32, 1 + n // 16, 1 + n // 8})
        ladder = [x for x in ladder if base + x <= n]
        cost = np.cumsum(self.excess[at][order])
        if cost[-1] == 0:
            length = base + 1
        else:
            length = min((base + x + cost[base + x - 1] / max(1, both - (n - base - x)), base + x) for x in ladder)[1]
        return key[order[:length]], int(1000 * (self.level[at] > 0).sum() // n)


def postings(docs: DataFrame, order: Order, width: int) -> DataFrame:
    """(token, k, size, last, common): the prefix of each set, once for each task that meets
    it; ``size`` packs the set's size (upper half) and the prefix's, ``last`` is its last token."""
    shared = docs.sparkSession.sparkContext.broadcast(order)  # 2**SLOT_BITS slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        met: set[int] = set()
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            tokens, rows = [], []

            def flush(tokens=tokens, rows=rows):
                size = np.array([len(t) for t in tokens])
                k, n, common = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                last = np.array([t[-1] for t in tokens], U64).view(np.int64)
                out = pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)),
                     *(pa.array(np.repeat(c, size)) for c in (k, n << 32 | size, last, common))],
                    names=["token", "k", "size", "last", "common"])
                tokens.clear()
                rows.clear()
                return out

            held = 0
            for shingles, _ in row_shingles(data, offsets, width):
                if not len(shingles):
                    continue
                own = distinct(shingles)
                k = xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
                if k in met:
                    continue
                met.add(k)
                prefix, common = shared.value.prefix(own)
                tokens.append(prefix)
                rows.append((k, len(own), common))
                held += len(prefix)
                if held > 200_000:
                    yield flush()
                    held = 0
            if tokens:
                yield flush()

    return docs.mapInArrow(run, "token long, k long, size long, last long, common long")


#: ``kind`` 0: a pair with ``c`` common tokens; 1: a token (in ``b``) of a small bucket
#: with its class; 2: a token of a large bucket with its class.
MET = "kind int, a long, b long, c long, sa long, sb long, la long, lb long, common long"


def _met(kind: int, a, b, c, sa, sb, la, lb, common) -> pa.RecordBatch:
    m = len(a)
    fill = lambda x: np.zeros(m, np.int64) if x is None else np.asarray(x, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(m, kind, np.int32)), *(pa.array(fill(x)) for x in (a, b, c, sa, sb, la, lb, common))],
        names=[f.split()[0] for f in MET.split(", ")])


def meet(percent: int, small: int):
    """Streams postings sorted by (token, k)."""

    def listed(t: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of complete buckets of up to ``small`` classes; t: tokens, rows: k, size, last, common."""
        if not len(t):
            return
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        size = np.diff(np.append(first, len(t)))
        ones, twos = [], []
        for s in np.unique(size[size > 1]):
            at = first[size == s][:, None] + np.arange(s)
            i, j = np.triu_indices(int(s), 1)
            ones.append(at[:, i].reshape(-1))
            twos.append(at[:, j].reshape(-1))
        if not ones:
            return
        many = np.repeat(size > 1, size)
        yield _met(1, rows[many, 0], t[many], None, None, None, None, None, None)
        one, two = np.concatenate(ones), np.concatenate(twos)
        na, nb = rows[one, 1] >> 32, rows[two, 1] >> 32
        fits = np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent
        one, two = one[fits], two[fits]
        if not len(one):
            return
        a, b = rows[one, 0], rows[two, 0]
        order = np.lexsort((b, a))
        one, two, a, b = one[order], two[order], a[order], b[order]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        c = np.diff(np.append(new, len(a)))
        one, two = one[new], two[new]
        yield _met(0, a[new], b[new], c, rows[one, 1], rows[two, 1], rows[one, 2], rows[two, 2], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t0, r0 = np.zeros(0, np.int64), np.zeros((0, 4), np.int64)  # the last bucket so far, while it is small
        sent = None  # the last (token, k) that went out as part of a large bucket
        for batch in batches:
            t = np.concatenate([t0, batch.column(0).to_numpy()])
            rows = np.concatenate([r0, np.stack([batch.column(i).to_numpy() for i in (1, 2, 3, 4)], 1)])
            new = np.ones(len(t), bool)  # not a copy of a class that several tasks met
            new[1:] = (t[1:] != t[:-1]) | (rows[1:, 0] != rows[:-1, 0])
            if sent is not None:
                new &= (t != sent[0]) | (rows[:, 0] != sent[1])
            t, rows = t[new], rows[new]
            if not len(t):
                continue
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            size = np.diff(np.append(first, len(t)))
            large = np.repeat((size > small) | (t[first] == sent[0] if sent is not None else False), size)
            tail = (t == t[-1]) & ~large
            if large.any():
                yield _met(2, rows[large, 0], t[large], None, rows[large, 1], None, rows[large, 2], None, rows[large, 3])
            sent = (int(t[-1]), int(rows[-1, 0])) if large[-1] else None
            yield from listed(t[~large & ~tail], rows[~large & ~tail])
            t0, r0 = t[tail], rows[tail]
        yield from listed(t0, r0)

    return run


def demanded(xp, sa, sb, la, lb, percent: int):
    """Prefix shingles that a similar pair must share, for arrays (``xp`` is numpy).  Of
    the prefix that ends first, every shared shingle lies in both prefixes; only the
    rest of its set can add to the overlap."""
    na, nb, pa_, pb = sa >> 32, sb >> 32, sa & 0xFFFFFFFF, sb & 0xFFFFFFFF
    need = -(-percent * (na + nb) // (100 + percent))
    return xp.maximum(1, xp.where(la <= lb, need - (na - pa_), need - (nb - pb)))


def demanded_column(percent: int) -> Column:
    """The same for the columns sa, sb, la, lb."""
    na, nb = F.shiftright("sa", 32), F.shiftright("sb", 32)
    pa_, pb = (F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in ("sa", "sb"))
    need = F.ceil((na + nb) * percent / F.lit(100 + percent))
    return F.greatest(F.lit(1), F.when(F.col("la") <= F.col("lb"), need - (na - pa_)).otherwise(need - (nb - pb)))


def compare_blocks(percent: int):
    """Counts common tokens of all pairs of two blocks of one large bucket; rows are
    sorted by token and block pair.  A pair is told in its first common bucket only."""

    def told(rows: list[dict], one: int, two: int) -> list[tuple]:
        rows = sorted(rows, key=lambda r: r["side"])
        token = rows[0]["token"]
        k, s, last, label, side = (np.array([r[x] for r in rows], np.int64) for x in ("k", "s", "last", "label", "side"))
        size = np.array([len(r["hot"]) + len(r["rare"]) for r in rows])
        names, column, times = np.unique(np.concatenate([np.asarray([*r["hot"], *r["rare"]], np.int64) for r in rows]),
                                         return_inverse=True, return_counts=True)
        frequent = np.isin(names, np.unique(np.concatenate([np.asarray(r["hot"], np.int64) for r in rows])))
        earlier = frequent & (names < token)
        row = np.repeat(np.arange(len(rows)), size)
        a = np.arange(len(rows)) if one == two else np.flatnonzero(side == 0)
        b = a if one == two else np.flatnonzero(side == 1)
        if not len(a) or not len(b):
            return []
        common = np.zeros((len(a), len(b)), np.float32)
        before = np.zeros((len(a), len(b)), np.float32)
        for some in np.array_split(np.flatnonzero(times > 1), 1 + len(names) // 4096):  # columns at once
            at = np.full(len(names), -1)
            at[some] = np.arange(len(some))
            part = at[column] >= 0
            x = np.zeros((len(rows), len(some)), np.float32)
            x[row[part], at[column[part]]] = 1
            common += x[a] @ x[b].T
            x = x[:, earlier[some]]
            before += x[a] @ x[b].T
        na, nb = s[a][:, None] >> 32, s[b][None, :] >> 32
        demand = demanded(np, s[a][:, None], s[b][None, :], last[a][:, None], last[b][None, :], percent)
        good = ((before == 0) & (common >= demand) & (label[a][:, None] != label[b][None, :])
                & (np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent))
        if one == two:
            good &= k[a][:, None] < k[b][None, :]
        i, j = np.nonzero(good)
        return list(zip(np.minimum(k[a[i]], k[b[j]]).tolist(), np.maximum(k[a[i]], k[b[j]]).tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        now = None

        def out():
            pairs = told(held, now[1], now[2])
            x, y = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["token"], r["one"], r["two"])
                if key != now and held:
                    yield out()
                    held = []
                now = key
                held.append(r)
        if held:
            yield out()

    return run


def narrowed(pairs: DataFrame, sets: DataFrame, percent: int, part: int) -> DataFrame:
    """The pairs (a, b, got) that may still be similar once the even (part 0) or the odd
    (part 1) shingles are compared too, by 32 bits of each: with ``got`` matches before,
    at most all shingles not yet seen can match.  Truncation only adds matches, so no
    similar pair goes; a quarter of the bytes of the sets travels beside each pair."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(1):
                own = np.frombuffer(raw.as_buffer(), U64)
                odd = (own & U64(1)).astype(bool)
                rows.append(((own[odd == bool(part)] >> U64(32)).astype(np.uint32).tobytes(), len(own), 0 if part else int(odd.sum())))
            own, n, rest = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary()), pa.array(n, pa.int64()),
                                              pa.array(rest, pa.int64())], names=["k", "own", "n", "rest"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                if len(x) > len(y):
                    x, y = y, x
                got.append(int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0)
            got = np.array(got, np.int64) + batch.column("got").to_numpy()
            na, nb, ra, rb = (batch.column(c).to_numpy() for c in ("na", "nb", "ra", "rb"))
            most = got + np.minimum(ra, rb)
            keep = most * (100 + percent) >= percent * (na + nb)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got)], names=["a", "b", "got"]).filter(
                pa.array(keep))

    some = sets.select("k", "own").mapInArrow(cut, "k long, own binary, n long, rest long")
    one, two = some.toDF("a", "x", "na", "ra"), some.toDF("b", "y", "nb", "rb")
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "got", "x", "y", "na", "nb", "ra", "rb")
    return rows.mapInArrow(judge, "a long, b long, got long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets are similar enough; most others fall on the way there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.select("a", "b", F.lit(0).cast("long").alias("got"))
    for part in (0, 1):
        near = narrowed(near, sets, percent, part)
    one = sets.select(F.col("k").alias("a"), F.col("own").alias("x"))
    two = sets.select(F.col("k").alias("b"), F.col("own").alias("y"))
    rows = staged(near.select("a", "b"), "near-pairs").join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a long, b long")


def check_clusters(percent: int):
    """Streams clusters, each with its sets and then its pairs, most promising first: a
    pair that earlier links already connect needs no check."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets, root = None, {}, {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            one, two = [], []
            for i, (cluster, kind, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("root", "kind", "a", "b")), strict=True)):
                if cluster != now:
                    now, sets, root = cluster, {}, {}
                if kind == 0:
                    sets[a] = np.frombuffer(batch.column("own")[i].as_py(), U64)
                    continue
                p, q = find(a), find(b)
                if p == q:
                    continue
                x, y = sorted((sets[a], sets[b]), key=len)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    root[p] = q
                    one.append(a)
                    two.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])

    return run


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(k, root, own): the sets of the wanted classes (k, root, rep, rep_crc), read from the
    text of their first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(2))
            own = [distinct(s).tobytes() for s, _ in row_shingles(data, offsets, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary())], names=["k", "root", "own"])

    on = docs["doc_id"].eqNullSafe(F.col("rep")) & (docs["crc"] == F.col("rep_crc"))
    wanted = staged(wanted.select("k", "root", "rep", "rep_crc"), "wanted")
    few = wanted.count() <= LISTED  # then the list goes to the texts, else the texts to the list
    rows = docs.join(F.broadcast(wanted) if few else wanted.hint("shuffle_hash"), on)
    return rows.select("k", "root", "text").mapInArrow(run, "k long, root long, own binary")


def grouped(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(k, root, small): the components of candidate pairs, and whether one task verifies one."""
    found = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    clusters = staged(found.select(F.col("node").alias("k"), "root"), "clusters")
    heavy = clusters.join(classes.select("k", "n"), "k").groupBy("root").agg(F.sum("n").alias("n"))
    many = pairs.select(F.col("a").alias("k")).join(clusters, "k").groupBy("root").agg(F.count("*").alias("pairs"))
    size = heavy.join(many, "root").select("root", ((8 * F.col("n") <= CLUSTER_BYTES) & (F.col("pairs") <= CLUSTER_PAIRS)).alias("small"))
    return staged(clusters.join(staged(size, "cluster-sizes"), "root").select("k", "root", "small"), "clusters")


def linked(pairs: DataFrame, clusters: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) that connect what the candidate pairs (a, b, c) connect.  ``clusters``
    (k, root, small) holds the candidate components; in the small ones every set travels once,
    from its text to its cluster's task, the pairs of others are verified one by one."""
    spark = pairs.sparkSession
    dealt = staged(pairs.join(clusters.withColumnRenamed("k", "a"), "a"), "dealt-pairs")
    told = dealt.agg(F.count_if("small").alias("inside"), F.count_if(~F.col("small")).alias("outside")).first()
    out = spark.createDataFrame([], "a long, b long")
    if told["inside"]:
        inside = dealt.where("small").select("root", F.lit(1).alias("kind"), (-F.col("c")).alias("rank"), "a", "b",
                                             F.lit(None).cast("binary").alias("own"))
        asked = clusters.where("small").join(dealt.select("root").distinct(), "root", "left_semi").select("k", "root")
        members = full_sets(docs, classes.join(asked, "k"), width).select(
            "root", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("rank"), F.col("k").alias("a"), F.lit(None).cast("long").alias("b"), "own")
        rows = members.unionByName(inside).repartition(partitions(spark), "root").sortWithinPartitions("root", "kind", "rank", "a", "b")
        out = out.unionByName(rows.mapInArrow(check_clusters(percent), "a long, b long"))
    if told["outside"]:
        outside = dealt.where("not small")
        ends = outside.select(F.col("a").alias("k")).union(outside.select("b")).distinct()
        asked = classes.join(ends, "k", "left_semi").withColumn("root", F.lit(0).cast("long"))
        out = out.unionByName(verified(outside, staged(full_sets(docs, asked, width).select("k", "own"), "sets"), percent))
    return out


def enough_in_common(pairs: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of ``hot`` classes those whose sizes fit and whose prefixes share as many
    shingles, ``c``, as a similar pair must: the frequent and the rare ones that each class shares with any."""
    own = hot.select("k", "s", "last", F.concat("hot", "rare").alias("tokens"))
    met = pairs.join(own.toDF("a", "sa", "la", "ta"), "a").join(own.toDF("b", "sb", "lb", "tb"), "b")
    na, nb = F.shiftright("sa", 32), F.shiftright("sb", 32)
    met = met.where(F.least(na, nb) * 100 >= F.greatest(na, nb) * percent).withColumn("c", F.size(F.array_intersect("ta", "tb")).cast("long"))
    return met.where(F.col("c") >= demanded_column(percent)).select("a", "b", "c")


def linked_classes(docs: DataFrame, seen: DataFrame, classes: DataFrame, width: int, percent: int, small: int, block: int) -> DataFrame:
    """(node, root) of the classes that are linked with another one."""
    spark = docs.sparkSession
    order = Order(summed_sketch(seen), percent)
    met = staged(postings(docs, order, width).repartition(partitions(spark), "token").sortWithinPartitions("token", "k")
                 .mapInArrow(meet(percent, small), MET), "met")

    # classes that meet in rare shingles, and in frequent ones
    pairs = met.where("kind = 0").groupBy("a", "b").agg(
        F.sum("c").alias("c"), *(F.max(x).alias(x) for x in ("sa", "sb", "la", "lb")))
    some = met.where("kind = 2").select(F.col("a").alias("k"), F.col("b").alias("token"), F.col("sa").alias("s"),
                                        F.col("la").alias("last"), "common")
    # what each class of a frequent shingle shares with any other: at most its own prefix
    token = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("b")))
    hot = met.where("kind > 0").groupBy(F.col("a").alias("k")).agg(
        F.max("sa").alias("s"), F.max(F.when(F.col("kind") == 2, F.col("la"))).alias("last"), F.array_sort(token(2)).alias("hot"), token(1).alias("rare"))
    hot = staged(hot.where(F.size("hot") > 0), "hot-classes")
    # a pair that also meets in a frequent shingle is judged there, with all its matches
    close = staged(pairs.where(F.col("c") >= demanded_column(percent)).select("a", "b", "c"), "close-pairs")

    # the most central class of each frequent shingle
    centre = staged(some.groupBy("token").agg(F.max(F.struct("common", "k")).alias("x")).select(
        "token", F.col("x.k").alias("c")), "centres")
    star = some.join(centre, "token").where("k <> c").select(F.least("k", "c").alias("a"), F.greatest("k", "c").alias("b")).distinct()
    star = enough_in_common(star, hot, percent)
    first = staged(close.unionByName(star).groupBy("a", "b").agg(F.max("c").alias("c")), "first-pairs")
    links = staged(linked(first, grouped(first, classes), classes, docs, width, percent), "links")
    roots = staged(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")

    # pairs of classes in frequent shingles that are still in different components
    def labelled(rows: DataFrame, by: str, name: str) -> DataFrame:
        own = roots.select(F.col("node").alias(by), F.col("root").alias(name))
        return rows.join(own, by, "left").withColumn(name, F.coalesce(name, by))

    each = labelled(hot, "k", "label").select("k", "s", "last", "rare", "label", "hot", F.explode("hot").alias("token"))
    buckets = each.groupBy("token").agg(F.count("*").alias("many"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    buckets = staged(buckets.where("lo <> hi").select("token", F.ceil(F.col("many") / block).cast("int").alias("blocks")), "buckets")
    each = each.join(buckets, "token").withColumn("own", F.pmod(F.xxhash64("k"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    each = each.select("token", "k", "s", "last", "rare", "label", "hot", "own", other)
    one, two = F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")
    dealt = each.select("token", one, two, (F.col("own") > F.col("other")).cast("int").alias("side"), "k", "s", "last", "rare", "label", "hot")
    keys = ["token", "one", "two"]
    found = dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(
        compare_blocks(percent), "a long, b long")
    found = found.distinct().join(first, ["a", "b"], "left_anti").withColumn("c", F.lit(0).cast("long"))
    found = staged(found, "block-pairs")
    more_links = staged(linked(found, grouped(found, classes), classes, docs, width, percent), "links")
    every = links.union(more_links)
    return components(every.select(F.col("a").alias("u"), F.col("b").alias("v")))


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """doc_id, crc (of the text), n_shingles, component_id and root (the component's own
    number, null for an empty set)."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.crc32(text).alias("crc"))
    seen = staged(sets_and_sketch(rows, width), "sets-seen")
    own = seen.where("kind = 0").select("doc_id", "crc", "n", "k")
    sort_id = F.coalesce("doc_id", F.lit(NO_ID))
    classes = staged(own.where("k is not null").groupBy("k").agg(
        F.min(F.struct(sort_id.alias("i"), "doc_id", "crc")).alias("x"), F.max("n").alias("n")).select(
        "k", "n", F.col("x.i").alias("least"), F.col("x.doc_id").alias("rep"), F.col("x.crc").alias("rep_crc")), "classes")
    roots = linked_classes(rows, seen, classes, width, percent, small, block)
    roots = staged(roots, "final-roots")
    named = classes.join(roots, classes["k"] == roots["node"], "left").select("k", F.coalesce("root", "k").alias("root"), "least")
    lowest = named.groupBy("root").agg(F.min("least").alias("component"))
    by_class = named.join(lowest, "root").select("k", "component", "root")
    out = own.join(by_class, "k", "left")
    component = F.when(F.col("component") == NO_ID, F.lit(None)).otherwise(F.col("component"))
    return out.select("doc_id", "crc", F.col("n").alias("n_shingles"),
                      F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(component).alias("component_id"), "root")


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, whole rows;
    documents with an empty set all stay."""
    own, crc, empty = (free_name(docs, x) for x in ("_id", "_crc", "_empty"))
    marks = staged(jaccard_components(docs, width, percent), "marks")
    lowest = marks.where("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("i"), "doc_id", "crc")).alias("x"))
    keep = lowest.select("x.doc_id", "x.crc", F.lit(False)).union(
        marks.where("n_shingles = 0").select("doc_id", "crc", F.lit(True)).distinct()).toDF(own, crc, empty)
    on = docs["doc_id"].cast("long").eqNullSafe(keep[own]) & (F.crc32(text_or_empty()) == keep[crc])
    kept = docs.join(keep.hint("shuffle_hash"), on)
    again = kept.where(F.col(empty)).drop(own, crc, empty)
    return kept.where(~F.col(empty)).dropDuplicates([own, crc]).drop(own, crc, empty).unionByName(again)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM texts),
sets AS (SELECT min(doc_id) AS k, g, len(g) AS n FROM (SELECT doc_id, list_sort(g) AS g FROM grams) WHERE len(g) > 0 GROUP BY g),
members AS (SELECT doc_id, k FROM (SELECT doc_id, list_sort(g) AS g FROM grams) JOIN sets USING (g)),
each AS (SELECT k, n, unnest(g) AS s FROM sets),
common AS (SELECT a.k AS a, b.k AS b, a.n AS na, b.n AS nb, count(*) AS i
    FROM each a JOIN each b ON a.s = b.s AND a.k < b.k GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * i >= 75 * (na + nb - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT k AS a, k AS b FROM sets UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
roots AS (SELECT a AS k, min(b) AS component_id FROM reach GROUP BY a)
SELECT g.doc_id, len(g.g) AS n_shingles, coalesce(component_id, g.doc_id) AS component_id
FROM grams g LEFT JOIN members USING (doc_id) LEFT JOIN roots USING (k)
"""

QUERIES = {"op8_ngram_jaccard": op8_ngram_jaccard}
ORACLES = {"op8_ngram_jaccard": SQL}
