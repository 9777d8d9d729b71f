"""Operator 11: Merkle dataset manifest with pointer-jumping proofs (native).

Every row is a leaf: the hash of its fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and the value.  The leaves of a source, by document id, form a
tree in which every three consecutive nodes become their hash; the trees' roots, by
source, form the top tree in the same way.

* ``numbered`` gives each leaf its place: leaves are range-partitioned by (source,
  document, digest), so that a hot source spreads over tasks, and the counts of each
  (partition, source) become offsets.
* ``folded`` builds ``SPAN`` levels in one shuffle: a block is one node of the level
  reached and all that lies below it, 3 ** SPAN nodes at most, whatever the source.
* ``proofs`` jumps pointers.  A node knows an ancestor and the segment of siblings
  on the way to it.  A self-join of a node's ancestor with its own row doubles the
  distance and concatenates the segments, until every leaf reaches the root.  An
  ancestor at distance d has at most 3 ** d nodes below it, so no key is hot while
  many rows are joined; once the ancestors are few (counted, at most
  ``BROADCAST_BYTES``), they are broadcast and the long segments stay where they are.

Defined cases: any field may be null; rows with a null source form a source of their
own, before all others; a null document id sorts first; repeated rows are leaves of
their own, next to each other; a lone leaf is its source's root; an empty table gives
an empty result; very long texts are hashed whole; other columns are ignored, also
those named like the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators.ranking import row_number_global

from ._stage import partitions, staged, table

ARITY = 3
#: Levels that one shuffle builds.
SPAN = 6
#: More levels than any count of rows in 64 bits can have.
MOST_LEVELS = 40
#: Ancestors' rows are broadcast up to this size, joined by a shuffle beyond it.
BROADCAST_BYTES = 8 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = ("tree", "level", "pos")
UP = tuple(f"up_{c}" for c in NODE)


def h(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' concatenated UTF-8 bytes."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaves(docs: DataFrame, forged_text: Column | None = None, where: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and, where ``where`` holds, ``forged``: the leaf of the row
    with ``forged_text`` instead of its text."""
    rest = [framed(F.col(c)) for c in FIELDS[:-1]]
    forged = F.lit(None).cast("string")
    if forged_text is not None:
        forged = F.when(where, h(*rest, framed(forged_text)))
    return docs.select("doc_id", "source", h(*rest, framed(F.col("text"))).alias("leaf"), forged.alias("forged"))


def depth(n: Column) -> Column:
    """Levels above ``n`` nodes until one remains."""
    return sum(((n > ARITY ** k).cast("int") for k in range(1, MOST_LEVELS - 1)), (n > 1).cast("int"))


def numbered(rows: DataFrame) -> DataFrame:
    """Leaves with ``tree`` (1 for the first source), ``n`` (leaves in it), ``d`` (its
    levels above them), ``pos`` (from 0) and the row's ``doc``."""
    spark = rows.sparkSession
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    order = ["part", F.col("doc_id").asc_nulls_first(), "leaf"]
    hashed = staged(rows.withColumn("part", key), "merkle-hashes")  # sampled and dealt out from here: texts are read once
    placed = staged(
        hashed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
        .withColumn("pid", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id() - F.shiftleft(F.col("pid").cast("long"), 33)), "merkle-leaves")
    counts = placed.groupBy("pid", "part").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    own = Window.partitionBy("part")
    before = F.coalesce(F.sum("c").over(own.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = row_number_global(placed.select("part").distinct(), ["part"], out="tree")
    offsets = counts.select("pid", "part", (before - F.col("first")).alias("shift"), F.sum("c").over(own).alias("n"))
    return placed.join(offsets.join(ranks, "part"), ["pid", "part"]).withColumn("d", depth(F.col("n"))).select(
        "tree", "n", "d", (F.col("at") + F.col("shift")).alias("pos"), F.col("leaf").alias("digest"),
        F.struct("doc_id", "leaf", "forged", "d").alias("doc"))


def runs(digests: Column) -> Column:
    """The parents of a level's digests, in order."""
    last = F.ceil(F.size(digests) / ARITY).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: h(F.array_join(F.slice(digests, i * ARITY + 1, ARITY), "")))


def folded(nodes: DataFrame, deepest: int) -> tuple[DataFrame, DataFrame]:
    """(links, roots) of the trees over ``nodes`` (tree, d, pos, digest, doc): a link is a node
    (``NODE``), its parent (``UP``) and its siblings as one step; a root is (tree, digest, doc)."""
    none = F.lit(None).cast(nodes.schema["doc"].dataType).alias("doc")
    roots = nodes.where("d = 0").select("tree", "digest", "doc")
    links = None
    for base in range(0, max(1, deepest), SPAN):
        block = F.floor(F.col("pos") / F.lit(ARITY ** SPAN)).cast("long")
        levels = F.aggregate(F.sequence(F.lit(1), F.col("height")), F.array(F.col("members.digest")),
                             lambda made, _: F.concat(made, F.array(runs(F.element_at(made, -1)))))
        built = staged(
            nodes.where(F.col("d") > base).groupBy("tree", block.alias("block"))
            .agg(F.first("d").alias("d"), F.sort_array(F.collect_list(F.struct("pos", "digest", "doc"))).alias("members"))
            .withColumn("height", F.least(F.lit(SPAN), F.col("d") - base)).withColumn("levels", levels), "merkle-blocks")
        each = built.select("tree", "d", "block", "members", F.posexplode(F.slice("levels", 1, F.col("height"))).alias("j", "all"))
        each = each.select("*", F.posexplode("all").alias("i", "digest"))
        first = F.col("i") - F.col("i") % ARITY
        side = lambda start, count: F.unhex(F.array_join(F.slice("all", start, count), ""))
        step = F.struct(side(first + 1, F.col("i") % ARITY).alias("left"),
                        side(F.col("i") + 2, ARITY - 1 - F.col("i") % ARITY).alias("right"))
        width = F.element_at(F.array(*[F.lit(ARITY ** (SPAN - j)) for j in range(SPAN)]), F.col("j") + 1)
        pos, level = F.col("block") * width + F.col("i"), F.col("j") + base
        at_top = (F.col("tree") > 0) & (level + 1 == F.col("d"))
        own = each.select(
            "tree", level.alias("level"), pos.alias("pos"),
            F.when(at_top, 0).otherwise(F.col("tree")).alias("up_tree"), F.when(at_top, 0).otherwise(level + 1).alias("up_level"),
            F.when(at_top, F.col("tree") - 1).otherwise(F.floor(pos / F.lit(ARITY)).cast("long")).alias("up_pos"),
            F.array(step).alias("steps"), F.when(level == 0, F.get("members", F.col("i"))["doc"]).alias("doc"))
        links = own if links is None else links.unionByName(own)
        last = F.get(F.element_at("levels", -1), F.lit(0)).alias("digest")
        roots = roots.unionByName(built.where(F.col("d") <= base + SPAN).select("tree", last, none))
        nodes = built.where(F.col("d") > base + SPAN).select("tree", "d", F.col("block").alias("pos"), last, none)
    return links, roots


def jumped(left: DataFrame, right: DataFrame, few: bool) -> DataFrame:
    """``left`` with ancestors twice as far: those of its ancestors, segments concatenated."""
    far = right.select(*[F.col(c).alias(f"up_{c}") for c in NODE], *[F.col(c).alias(f"far_{c}") for c in UP],
                       F.col("steps").alias("more"))
    met = left.join(F.broadcast(far) if few else far, list(UP), "left")
    found = F.col("more").isNotNull()
    return met.select(*[c for c in left.columns if c not in (*UP, "steps")],
                      *[F.when(found, F.col(f"far_{c}")).otherwise(F.col(c)).alias(c) for c in UP],
                      F.when(found, F.concat("steps", "more")).otherwise(F.col("steps")).alias("steps"))


def proofs(links: DataFrame, rows_at: list[int], most: int) -> DataFrame:
    """Every leaf's ``doc`` and ``steps`` to the root.  ``rows_at`` bounds the links at each level,
    ``most`` is the longest way.  In the round of ``k`` a row spans k levels, and only levels
    divisible by k can be asked for (in the top tree, which ways enter anywhere, all)."""
    own = links.where("doc IS NOT NULL")
    inner = links.where("level > 0 OR tree = 0").drop("doc")
    k = 1
    while k < most:
        few = sum(rows_at[k::k]) * (120 + k * 130) <= BROADCAST_BYTES
        own = jumped(own, inner, few)
        if 2 * k < most:
            aligned = inner.where((F.col("level") % (2 * k) == 0) | (F.col("tree") == 0))
            inner = staged(jumped(aligned, inner, few), "merkle-jumps")
        k *= 2
    return own.select("doc", "steps")


def manifest(rows: DataFrame) -> DataFrame:
    """Of ``leaves``: doc_id, leaf, forged, d (levels up to the subroot), root, and ``steps``: the
    siblings left and right of the way (binary digests), from the leaf's level to the root's."""
    nodes = staged(numbered(rows), "merkle-nodes")
    at = [F.sum(F.when(F.col("d") > k, F.ceil(F.col("n") / F.lit(float(ARITY ** k))))).alias(f"l{k}") for k in range(MOST_LEVELS)]
    told = nodes.where("pos = 0").agg(F.count("*").alias("trees"), F.coalesce(F.max("d"), F.lit(0)).alias("deepest"), *at).first()
    trees, top = told["trees"], 0
    while ARITY ** top < trees:
        top += 1
    links, roots = folded(nodes, told["deepest"])
    top_links, root = folded(roots.select(F.lit(0).cast("long").alias("tree"), F.lit(top).alias("d"),
                                          (F.col("tree") - 1).alias("pos"), "digest", "doc"), top)
    last = root.first()
    all_links = staged(links.unionByName(top_links), "merkle-links")
    rows_at = [int(told[f"l{k}"] or 0) + 2 * trees + top for k in range(MOST_LEVELS)]
    found = proofs(all_links, rows_at, told["deepest"] + top)
    alone = nodes.where((F.col("n") == 1) & F.lit(trees == 1)).select(
        "doc", F.array().cast(all_links.schema["steps"].dataType).alias("steps"))
    return found.unionByName(alone).select("doc.*", "steps", F.lit(last["digest"] if last else None).cast("string").alias("root"))


def climbed(digest: Column, steps: Column) -> Column:
    """The digest that a leaf and the siblings on its way give."""
    text = lambda side: F.lower(F.hex(side))
    return F.aggregate(steps, digest, lambda up, s: h(text(s["left"]), up, text(s["right"])))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    made = manifest(leaves(docs, F.replace(F.col("text"), F.lit("\n"), F.lit("")), even))
    siblings = F.array_join(F.transform("steps", lambda s: F.lower(F.concat(F.hex(s["left"]), F.hex(s["right"])))), "")
    out = made.select("doc_id", "leaf", climbed(F.col("leaf"), F.slice("steps", 1, F.col("d"))).alias("subroot"), "root",
                      h(siblings).alias("proof_sha256"), climbed(F.coalesce("forged", "leaf"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: All trees level by level; CRC-32 by its definition, bit by bit, for the decimal ids.
SQL = r"""
WITH RECURSIVE framed AS (
    SELECT doc_id, source, text, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
        || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM documents),
hashed AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS forged,
        4294967295 - list_reduce(flatten(list_transform(range(1, CAST(length(CAST(doc_id AS VARCHAR)) + 1 AS BIGINT)),
            lambda k: list_transform(range(0, 8), lambda b: (ascii(substr(CAST(doc_id AS VARCHAR), CAST(k AS INT), 1)) >> CAST(b AS INT)) & 1))),
            lambda c, bit: xor(c >> 1, 3988292384 * xor(c & 1, bit)), 4294967295) AS crc FROM framed),
leafed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree FROM hashed),
low AS (
    SELECT tree, 0 AS lv, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM leafed
    UNION ALL
    SELECT tree, lv + 1, up, digest, count(*) OVER (PARTITION BY tree) FROM (
        SELECT tree, lv, pos // 3 AS up, sha256(string_agg(digest, '' ORDER BY pos)) AS digest FROM low WHERE n > 1 GROUP BY tree, lv, pos // 3)),
sub AS (SELECT tree, digest, lv FROM low WHERE n = 1),
high AS (
    SELECT 0 AS lv, tree - 1 AS pos, digest, count(*) OVER () AS n FROM sub
    UNION ALL
    SELECT lv + 1, up, digest, count(*) OVER () FROM (
        SELECT lv, pos // 3 AS up, sha256(string_agg(digest, '' ORDER BY pos)) AS digest FROM high WHERE n > 1 GROUP BY lv, pos // 3)),
nodes AS (SELECT tree, lv, pos, digest FROM low WHERE n > 1 UNION ALL SELECT 0, lv, pos, digest FROM high WHERE n > 1),
sides AS (
    SELECT tree, lv, pos,
        coalesce(string_agg(digest, '') OVER (PARTITION BY tree, lv, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER (PARTITION BY tree, lv, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM nodes),
ways AS (
    SELECT a.tree, a.pos, list({'l': l, 'r': r} ORDER BY s.lv) AS way FROM leafed a
    JOIN sides s ON s.tree = a.tree AND s.pos = a.pos // CAST(power(3, s.lv) AS BIGINT) GROUP BY a.tree, a.pos),
tops AS (
    SELECT b.tree, list({'l': l, 'r': r} ORDER BY s.lv) AS way FROM sub b
    JOIN sides s ON s.tree = 0 AND s.pos = (b.tree - 1) // CAST(power(3, s.lv) AS BIGINT) GROUP BY b.tree),
proof AS (
    SELECT a.doc_id, a.leaf, sub.digest AS subroot, high.digest AS root,
        list_concat(coalesce(w.way, []), coalesce(t.way, [])) AS way,
        CASE WHEN crc % 2 = 0 THEN forged ELSE leaf END AS start
    FROM leafed a JOIN sub USING (tree) JOIN high ON high.n = 1
    LEFT JOIN ways w ON w.tree = a.tree AND w.pos = a.pos LEFT JOIN tops t ON t.tree = a.tree),
done AS (
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(way, lambda s: s.l || s.r), 'string_agg', ''), '')) AS proof_sha256,
        list_reduce(list_prepend({'l': '', 'r': start}, way), lambda u, s: {'l': '', 'r': sha256(s.l || u.r || s.r)}).r AS folded_root FROM proof)
SELECT *, folded_root = root AS verified FROM done
"""

QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}
ORACLES = {"op11_merkle_manifest": SQL}
