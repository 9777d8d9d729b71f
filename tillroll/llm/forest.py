"""Operator 3: approximate nearest neighbours by a hash-prefix forest.

Every vector has one long hash string for each of ``TREES`` trees.  A symbol of a
string is the signed axis that is nearest to the vector after a random rotation.
A tree is the sorted array of its strings; here it is cut by the first symbol into
buckets, and large buckets into blocks, so that each is sorted and searched in one
task.  A query descends in every tree to the longest prefixes that match; all trees
ascend together, one symbol at a time, until the prefixes of that length hold
``want`` vectors in all.  Those are scored exactly; a query that has to ascend to
the empty prefix meets every vector once, through the buckets of one tree.

``want`` is fitted: the least of a fixed ladder with which a bounded sample of
queries (``SAMPLE``, by hash of their id) finds ``TARGET`` of its true neighbours, which
one scan over all vectors gives.  Structured vectors need few candidates; on
structureless ones a fixed recall costs a share of all vectors.

Largest inner products are searched: vectors are scaled by the largest norm and
get one more component that makes their norms equal.

Equal vectors are indexed once, with their ``k`` + 1 smallest ids: no other member
can be among anyone's ``k`` nearest.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id or vectors whose length is not
the table's most frequent one (of equally frequent ones, the greatest); repeated
rows count once; a query without other vectors has no rows; ties go to the smaller
id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._stage import partitions, staged, table

K, EVERY = 20, 20
TREES, SAMPLE, TARGET, SEED = 64, 64, 0.95, 20_240_601
#: Vectors of a bucket that one task sorts; larger buckets are cut into blocks.
BLOCK = 65_536


class Hasher:
    """The strings of vectors: ``depth`` symbols for each tree, packed in a long."""

    def __init__(self, dim: int, depth: int, trees: int = TREES):
        self.dim, self.depth, self.trees = dim, depth, trees
        self.bits = max(1, int(2 * (dim + 1) - 1).bit_length())

    def codes(self, x: np.ndarray) -> np.ndarray:
        """x: rows of unit vectors with dim + 1 components; rows x trees."""
        out = np.zeros((len(x), self.trees), np.int64)
        x32 = x.astype(np.float32)
        for tree in range(self.trees):
            rng = np.random.default_rng([SEED, tree])
            for _ in range(self.depth):
                turn = np.linalg.qr(rng.standard_normal((self.dim + 1, self.dim + 1)))[0].astype(np.float32)
                y = x32 @ turn
                axis = np.abs(y).argmax(1)
                out[:, tree] = (out[:, tree] << self.bits) | (2 * axis + (y[np.arange(len(y)), axis] > 0))
        return out

    def prefix(self, codes, length: int):
        return codes >> (self.bits * (self.depth - length))


def raised(x: np.ndarray, largest: float) -> np.ndarray:
    """Vectors over the largest norm, with the component that makes them unit vectors."""
    scaled = x / largest
    return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled ** 2).sum(1)))[:, None]])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column of float64 vectors."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.float64).reshape(len(column), dim)


def clean_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, key, vec binary, norm) of the rows that take part."""
    v = F.col("v")
    good = F.size(v) > 0
    ok = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    ok = ok.where(F.col("vec_id").isNotNull() & good & F.forall(
        v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))) & F.exists(v, lambda c: c != 0))
    lengths = ok.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(len(batch), -1) + 0.0  # no negative zeros
            raw = [row.tobytes() for row in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), pa.array(raw, pa.binary()),
                 pa.array(np.sqrt((x ** 2).sum(1)) if len(x) else np.zeros(0))], names=["vec_id", "key", "vec", "norm"])

    one = ok.join(F.broadcast(lengths), F.size("v") == F.col("d")).select("vec_id", "v")  # a single row
    return one.mapInArrow(run, "vec_id long, key binary, vec binary, norm double")


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """(key, vec, norm, ids): equal vectors with their ``k`` + 1 smallest ids.  Each
    batch is reduced first, so a group has at most that many ids for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[bytes, set] = {}
            at: dict[bytes, int] = {}
            for i, (vec_id, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own.setdefault(key, set()).add(vec_id)
                at.setdefault(key, i)
            rows = pa.array(list(at.values()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(rows), batch.column(2).take(rows), batch.column(3).take(rows),
                 pa.array([sorted(x)[:k + 1] for x in own.values()], pa.list_(pa.int64()))], names=["key", "vec", "norm", "ids"])

    part = vectors.mapInArrow(run, "key binary, vec binary, norm double, ids array<long>")
    return part.groupBy("key").agg(
        F.any_value("vec").alias("vec"), F.any_value("norm").alias("norm"),
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))


def hashed(classes: DataFrame, hasher: Hasher, largest: float) -> DataFrame:
    """``classes`` with ``codes`` (as an indexed vector) and, for queries, ``asked``."""
    dim = hasher.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"), dim)
            norm = batch.column("norm").to_numpy()[:, None]
            flags = batch.column("is_query").to_pylist()
            codes = hasher.codes(raised(x, largest)) if len(x) else np.zeros((0, hasher.trees), np.int64)
            asked: list = [None] * len(x)
            if any(flags):
                which = np.flatnonzero(flags)
                found = hasher.codes(np.hstack([x[which] / norm[which], np.zeros((len(which), 1))]))
                for i, c in zip(which, found, strict=True):
                    asked[i] = c
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(codes), pa.list_(pa.int64())), pa.array(asked, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "codes", "asked"])

    return classes.mapInArrow(run, "key binary, vec binary, norm double, ids array<long>, is_query boolean, "
                                   "codes array<long>, asked array<long>")


def entries(index: DataFrame, hasher: Hasher, blocks: DataFrame, with_vectors: bool) -> DataFrame:
    """Indexed vectors by bucket and block: tree, first, block, code, depth -1 (no query)."""
    each = index.select("key", *["vec"] * with_vectors, F.element_at("ids", 1).alias("low"),
                        F.posexplode("codes").alias("tree", "code"))
    each = each.withColumn("first", F.shiftright("code", hasher.bits * (hasher.depth - 1)))
    each = each.join(F.broadcast(blocks), ["tree", "first"])  # trees x symbols rows at most
    return each.select("tree", "first", F.pmod(F.xxhash64("key"), "n_blocks").alias("block"), "code",
                       F.lit(-1).alias("depth"), "key", "low", *["vec"] * with_vectors)


def asked_entries(queries: DataFrame, hasher: Hasher, blocks: DataFrame, with_vectors: bool) -> DataFrame:
    """Queries sent to the blocks of their bucket in each tree, or, at depth 0, to
    every bucket of tree 0.  ``queries`` has key, vec, asked and depth."""
    each = queries.where("depth > 0").select("key", *["vec"] * with_vectors, "depth", F.posexplode("asked").alias("tree", "code"))
    each = each.withColumn("first", F.shiftright("code", hasher.bits * (hasher.depth - 1))).join(
        F.broadcast(blocks), ["tree", "first"])
    whole = queries.where("depth = 0").select("key", *["vec"] * with_vectors, "depth", F.lit(0).cast("long").alias("code"))
    whole = whole.crossJoin(F.broadcast(blocks.where("tree = 0")))  # one row for each symbol at most
    both = each.unionByName(whole)
    return both.select("tree", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"), "code",
                       "depth", "key", F.lit(0).cast("long").alias("low"), *["vec"] * with_vectors)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by tree, first and block, joined to one for each of these."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(keys[a])
            if key != now and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def arranged(rows: DataFrame) -> DataFrame:
    order = ["tree", "first", "block"]
    return rows.repartition(partitions(rows.sparkSession), *order).sortWithinPartitions(*order, "code")


def prefix_counts(both: DataFrame, hasher: Hasher) -> DataFrame:
    """(key, counts): how many indexed vectors share 1, 2, ... symbols with a query, in all trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in by_bucket(batches):
            depth, code = bucket.column("depth").to_numpy(), bucket.column("code").to_numpy()
            index, asked = code[depth < 0], np.flatnonzero(depth >= 0)
            counts = []
            for length in range(1, hasher.depth + 1):
                have, want = hasher.prefix(index, length), hasher.prefix(code[asked], length)
                counts.append(np.searchsorted(have, want, "right") - np.searchsorted(have, want, "left"))
            yield pa.RecordBatch.from_arrays(
                [bucket.column("key").take(pa.array(asked)), *(pa.array(c) for c in counts)],
                names=["key", *(f"c{n}" for n in range(1, hasher.depth + 1))])

    names = [f"c{n}" for n in range(1, hasher.depth + 1)]
    rows = arranged(both).mapInArrow(run, "key binary, " + ", ".join(f"{n} long" for n in names))
    return rows.groupBy("key").agg(F.array(*(F.sum(n) for n in names)).alias("counts"))


RESULT = "key binary, found array<struct<s:double,low:bigint,key:binary>>"


def search(both: DataFrame, hasher: Hasher, k: int) -> DataFrame:
    """(key, found): for each query and bucket the ``k`` + 1 best vectors that share its prefix."""
    kind = pa.list_(pa.struct([("s", pa.float64()), ("low", pa.int64()), ("key", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in by_bucket(batches):
            depth, code = bucket.column("depth").to_numpy(), bucket.column("code").to_numpy()
            where, asked = np.flatnonzero(depth < 0), np.flatnonzero(depth >= 0)
            if not len(asked) or not len(where):
                continue
            index, x = code[where], matrix(bucket.column("vec").take(pa.array(where)), hasher.dim)
            q = matrix(bucket.column("vec").take(pa.array(asked)), hasher.dim)
            low, keys = bucket.column("low").to_numpy()[where], bucket.column("key").take(pa.array(where)).to_pylist()
            out = []
            for i, a in enumerate(asked):
                shift = hasher.bits * (hasher.depth - int(depth[a]))
                lo, hi = (0, len(index)) if depth[a] == 0 else (
                    np.searchsorted(index >> shift, code[a] >> shift, "left"), np.searchsorted(index >> shift, code[a] >> shift, "right"))
                s = x[lo:hi] @ q[i]
                take = np.arange(len(s))
                if len(s) > k + 1:  # with all that rounding may part from the last place
                    last = np.partition(s, len(s) - k - 1)[len(s) - k - 1]
                    take = np.flatnonzero(s >= last - 1e-9 * (1 + abs(last)))
                exact = np.cumsum(x[lo + take] * q[i], 1)[:, -1]  # the same bits in every bucket, unlike the product above
                order = np.lexsort((low[lo + take], -exact))[:k + 1]
                out.append([{"s": float(exact[t]), "low": int(low[lo + take[t]]), "key": keys[lo + take[t]]} for t in order])
            yield pa.RecordBatch.from_arrays([bucket.column("key").take(pa.array(asked)), pa.array(out, kind)], names=["key", "found"])

    return arranged(both).mapInArrow(run, RESULT)


def best(found: DataFrame, k: int) -> DataFrame:
    """One list for each query: distinct vectors, best first, ties to the smaller id."""
    ordered = F.array_sort(
        F.array_distinct(F.flatten(F.collect_list("found"))),
        lambda a, b: F.when(a["s"] > b["s"], -1).when(a["s"] < b["s"], 1).when(a["low"] < b["low"], -1)
        .when(a["low"] > b["low"], 1).otherwise(0))
    return found.groupBy("key").agg(F.slice(ordered, 1, k + 1).alias("found"))


def true_neighbours(index: DataFrame, sample: list, hasher: Hasher, k: int) -> dict[bytes, list]:
    """For each sampled query the codes of its ``k`` nearest other vectors, by one scan."""
    spark = index.sparkSession
    dim = hasher.dim
    asked = spark.sparkContext.broadcast(  # SAMPLE vectors at most
        ([r["key"] for r in sample], np.stack([np.frombuffer(r["vec"], np.float64) for r in sample])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, q = asked.value
        for batch in batches:
            if not len(batch):
                continue
            scores = q @ matrix(batch.column("vec"), dim).T
            own = batch.column("key").to_pylist()
            who, s, at = [], [], []
            for i, key in enumerate(keys):
                order = np.argsort(-scores[i], kind="stable")[:k + 1]
                order = [j for j in order if own[j] != key][:k]
                who += [key] * len(order)
                s += scores[i][order].tolist()
                at += [int(j) for j in order]
            yield pa.RecordBatch.from_arrays(
                [pa.array(who, pa.binary()), pa.array(s, pa.float64()), batch.column("codes").take(pa.array(at, pa.int64()))],
                names=["key", "s", "codes"])

    rows = index.mapInArrow(run, "key binary, s double, codes array<long>")
    top = rows.groupBy("key").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "codes")), asc=False), 1, k).alias("top"))
    return {bytes(r["key"]): [x["codes"] for x in r["top"]] for r in top.collect()}  # SAMPLE x k rows at most


def fitted_want(sample: list, truth: dict, hasher: Hasher, n: int, target: float, k: int) -> int:
    """The least candidate number of the ladder that reaches the target on the sample.
    The ladder starts where ``k`` + 1 different vectors are sure, met once in each tree."""
    shared, totals = [], []
    for r in sample:
        own, near = np.array(r["asked"]), np.array(truth.get(bytes(r["key"]), []), np.int64).reshape(-1, hasher.trees)
        length = np.zeros(len(near), int)
        for d in range(1, hasher.depth + 1):
            length[(hasher.prefix(near, d) == hasher.prefix(own, d)).any(1)] = d
        shared.append(length)
        totals.append(np.array(r["counts"]))
    want, most = hasher.trees * (k + 1), hasher.trees * n
    while want < most:
        got = [length >= max((d for d in range(1, hasher.depth + 1) if c[d - 1] >= want), default=0)
               for length, c in zip(shared, totals, strict=True)]
        if np.concatenate(got).mean() >= target:
            return want
        want = int(want * 1.25) + 1
    return most + 1  # the empty prefix: every vector


def nearest(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY,
            trees: int = TREES, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = rows.sparkSession
    vectors = staged(clean_vectors(rows, id_col, vec_col), "vectors")
    asking = vectors.where(F.col("vec_id") % every == 0).select("vec_id", "key").distinct()
    flags = asking.select("key", F.lit(True).alias("is_query")).distinct()
    classes = staged(vector_classes(vectors, k).join(flags, "key", "left").withColumn(
        "is_query", F.coalesce("is_query", F.lit(False))), "vector-classes")
    told = classes.agg(F.count("*").alias("n"), F.max("norm").alias("m"), F.max(F.length("vec")).alias("b")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not told["n"]:
        return empty
    dim = told["b"] // 8
    hasher = Hasher(dim, 1, trees)
    while hasher.depth * hasher.bits < 60 - hasher.bits and (1 << (hasher.bits * (hasher.depth - 1))) < told["n"]:
        hasher = Hasher(dim, hasher.depth + 1, trees)
    index = staged(hashed(classes, hasher, told["m"]), "forest")
    first = F.shiftright("code", hasher.bits * (hasher.depth - 1)).alias("first")
    blocks = index.select(F.posexplode("codes").alias("tree", "code")).groupBy("tree", first).agg(F.count("*").alias("n"))
    blocks = staged(blocks.select("tree", "first", F.ceil(F.col("n") / BLOCK).cast("long").alias("n_blocks")), "forest-blocks")
    queries = index.where("is_query")
    counted = entries(index, hasher, blocks, False).unionByName(
        asked_entries(queries.withColumn("depth", F.lit(1)), hasher, blocks, False))
    queries = staged(queries.join(prefix_counts(counted, hasher), "key", "left").withColumn(
        "counts", F.coalesce("counts", F.array_repeat(F.lit(0).cast("long"), hasher.depth))), "forest-queries")
    sample = queries.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("key", "vec", "asked", "counts").collect()
    if not sample:
        return empty
    want = fitted_want(sample, true_neighbours(index, sample, hasher, k), hasher, told["n"], target, k)
    depth = F.coalesce(F.array_max(F.transform("counts", lambda c, i: F.when(c >= want, (i + 1).cast("int")))), F.lit(0))
    ready = queries.withColumn("depth", depth)
    found = search(entries(index, hasher, blocks, True).unionByName(asked_entries(ready, hasher, blocks, True)), hasher, k)
    own = queries.select("key", F.array(F.struct(
        (F.col("norm") * F.col("norm")).alias("s"), F.element_at("ids", 1).alias("low"), F.col("key").alias("key"))).alias("found"))
    # an own vector that was not met has its exact score from the scan of buckets or from its norm
    met = best(found, k + 1).select("key", "found")
    both = queries.select("key").join(met, "key", "left").join(own.withColumnRenamed("found", "self"), "key")
    has = F.exists(F.coalesce("found", F.array().cast(found.schema["found"].dataType)), lambda x: x["key"] == F.col("key"))
    both = both.select("key", F.when(F.col("found").isNull(), F.col("self")).when(has, F.col("found")).otherwise(
        F.concat("found", "self")).alias("found"))
    ranked = both.select(F.col("key").alias("q_key"), F.inline("found")).join(
        classes.select("key", "ids"), "key").select("q_key", "s", F.explode("ids").alias("vec_id"))
    lists = ranked.groupBy("q_key").agg(F.slice(F.array_sort(
        F.collect_list(F.struct((-F.col("s")).alias("minus"), "vec_id"))), 1, k + 1).alias("near"))
    each = asking.join(lists, asking["key"] == lists["q_key"]).select(F.col("vec_id").alias("query_id"), "near")
    left = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(left).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def op3_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op3_hash_forest": op3_hash_forest}
ORACLES: dict[str, str] = {}
