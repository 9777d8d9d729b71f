"""Global order statistics without a single-task window (W1, W2, W3, W11,
exact quantiles for C6, K2, Q6, A13, A19).

A window with no ``partitionBy`` moves every row into one task.  Here the
rows are range-partitioned on the full (unique) sort key instead, so each
task holds ~1/N of the data even when one value or one group holds a third
of all rows.  Per-partition counts (or sums) — one row per partition, a
size bounded by the partition count, not by the data — are prefix-summed
and joined back as offsets.

Spark samples range bounds with a seed tied to the RDD id, so two reads of
"the same" range exchange can disagree.  The partition id and in-partition
position are therefore stamped once and the stamped rows are cut from their
lineage with a reliable ``checkpoint()`` into the cluster's shared
checkpoint folder; counts and rows are both read from that copy, which also
survives executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import cut_lineage


def _n_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _ranged(df: DataFrame, keys: list[Column], num_partitions: int | None) -> DataFrame:
    """Range-partition + sort on ``keys``; stamp ``_pid`` and ``_pos``
    (0-based position inside the partition) and checkpoint the result."""
    n = _n_parts(df, num_partitions)
    stamped = (df.repartitionByRange(n, *keys)
                 .sortWithinPartitions(*keys)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_pos", F.monotonically_increasing_id()
                             - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    return cut_lineage(stamped)


def row_number_global(df: DataFrame, order: Sequence, partition_by: Sequence[str] = (),
                      out: str = "rn", size_out: str | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """1-based row number in ``order`` (optionally within ``partition_by``
    groups); ``order`` must end in a unique tie-break for determinism.
    ``size_out`` also attaches the group size."""
    pb = list(partition_by)
    keys = _cols(pb) + _cols(order)
    ranged = _ranged(df, keys, num_partitions)
    counts = ranged.groupBy("_pid", *pb).agg(F.count(F.lit(1)).alias("_cnt"))
    w_grp = Window.partitionBy(*pb).orderBy("_pid") if pb else Window.orderBy("_pid")
    w_pid = Window.partitionBy("_pid").orderBy(*pb) if pb else Window.partitionBy("_pid").orderBy("_pid")
    prev = Window.unboundedPreceding
    offsets = counts.select(
        "_pid", *pb,
        F.coalesce(F.sum("_cnt").over(w_grp.rowsBetween(prev, -1)), F.lit(0)).alias("_before_grp"),
        F.coalesce(F.sum("_cnt").over(w_pid.rowsBetween(prev, -1)), F.lit(0)).alias("_before_pid"),
        F.sum("_cnt").over(Window.partitionBy(*pb) if pb else Window.partitionBy()).alias("_gsize"),
    )
    if not pb:
        # one row per range partition: bounded by the partition count
        offsets = F.broadcast(offsets)
    res = ranged.join(offsets, ["_pid", *pb]).withColumn(
        out, (F.col("_pos") + 1 - F.col("_before_pid") + F.col("_before_grp")).cast("long"))
    if size_out:
        res = res.withColumn(size_out, F.col("_gsize").cast("long"))
    return res.drop("_pid", "_pos", "_before_grp", "_before_pid", "_gsize")


def rank_min(df: DataFrame, value: str, tiebreak: str, out: str, ascending: bool = False,
             partition_by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """W1 ``rank(method='min')``: tied values share the smallest rank, i.e.
    1 + the number of rows with a strictly better value.  Computed over the
    distinct values (partial aggregation collapses hot values) with a
    range-partitioned running count, then joined back on the value.  Rows
    with a null ``value`` get a null rank.  ``tiebreak`` is not needed for
    ranks with ties and is kept for API symmetry."""
    pb = list(partition_by)
    base = df.filter(F.col(value).isNotNull())
    vc = base.groupBy(*pb, value).agg(F.count(F.lit(1)).alias("_c"))
    order = F.col(value).asc() if ascending else F.col(value).desc()
    cum = running_sum(vc, "_c", [order], "_cum", pb, num_partitions)
    ranks = cum.select(*pb, value, (F.col("_cum") - F.col("_c") + 1).cast("long").alias(out))
    ranked = base.join(ranks, [*pb, value], "inner")
    nulls = df.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast("long"))
    return ranked.unionByName(nulls)


def qcut_first(df: DataFrame, value: str, tiebreak: str, out: str, q: int = 5,
               labels: Sequence | None = None, num_partitions: int | None = None) -> DataFrame:
    """W2+W3: quantile bucket of ``rank(method='first')`` — equal-count bins
    with interpolated, right-closed edges (not ``ntile``).  With unique
    ranks r = 1..n the bucket is ``max(1, ceil(q·(r−1)/(n−1)))``."""
    rn = row_number_global(df, [F.col(value).asc(), F.col(tiebreak).asc()], (), out="_r",
                           size_out="_n", num_partitions=num_partitions)
    b = F.when(F.col("_n") <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * (F.col("_r") - 1) / (F.col("_n") - 1)))).cast("int")
    if labels is not None:
        b = F.element_at(F.array(*[F.lit(x) for x in labels]), b)
    return rn.withColumn(out, b).drop("_r", "_n")


def quantiles_from_index(df: DataFrame, col: str, probs: dict[str, float], rn: str = "rn",
                         size: str = "n", partition_by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles from an existing row numbering
    (``rn`` 1-based in ascending ``col`` order, ``size`` rows per group):
    one conditional aggregate pass, one output row per group."""
    pb = list(partition_by)
    aggs = []
    for k, p in probs.items():
        h = (F.col(size) - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h) + 1, F.ceil(h) + 1
        aggs += [F.max(F.when(F.col(rn) == lo, F.col(col))).alias(f"_lo_{k}"),
                 F.max(F.when(F.col(rn) == hi, F.col(col))).alias(f"_hi_{k}"),
                 F.max(h - F.floor(h)).alias(f"_fr_{k}")]
    g = df.groupBy(*pb).agg(*aggs)
    return g.select(*pb, *[
        (F.col(f"_lo_{k}") + F.col(f"_fr_{k}") * (F.col(f"_hi_{k}") - F.col(f"_lo_{k}"))).alias(k)
        for k in probs])


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float],
                    partition_by: Sequence[str] = (), tiebreak: str | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (pandas ``quantile``, Spark
    ``percentile``, DuckDB ``quantile_cont``) as one row per group with one
    column per entry of ``probs``.

    Rows are first counted per distinct value (partial aggregation: a value
    held by a third of all rows becomes one row), then a range-partitioned
    running count over the distinct values locates the two values around
    every target position — no group is gathered into one buffer (as
    ``percentile`` would) and no row-level sort is needed.  ``tiebreak`` is
    accepted for API symmetry; values need no tie-break here."""
    pb = list(partition_by)
    vc = df.filter(F.col(col).isNotNull()).groupBy(*pb, col).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sum(vc, "_c", [F.col(col).asc()], "_cum", pb, num_partitions)
    sizes = vc.groupBy(*pb).agg(F.sum("_c").alias("_n"))
    x = cum.join(F.broadcast(sizes) if not pb else sizes, pb) if pb else cum.crossJoin(F.broadcast(sizes))
    start = F.col("_cum") - F.col("_c")  # rows before this value
    aggs = []
    for k, p in probs.items():
        h = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h) + 1, F.ceil(h) + 1
        aggs += [F.max(F.when((start < lo) & (lo <= F.col("_cum")), F.col(col))).alias(f"_lo_{k}"),
                 F.max(F.when((start < hi) & (hi <= F.col("_cum")), F.col(col))).alias(f"_hi_{k}"),
                 F.max(h - F.floor(h)).alias(f"_fr_{k}")]
    g = x.groupBy(*pb).agg(*aggs)
    return g.select(*pb, *[
        (F.col(f"_lo_{k}") + F.col(f"_fr_{k}") * (F.col(f"_hi_{k}") - F.col(f"_lo_{k}"))).alias(k)
        for k in probs])


def running_sum(df: DataFrame, value: str, order: Sequence, out: str,
                partition_by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """W11 running total in a global order (rows up to and including the
    current one); ``order`` must be unique."""
    pb = list(partition_by)
    keys = _cols(pb) + _cols(order)
    ranged = _ranged(df, keys, num_partitions)
    sums = ranged.groupBy("_pid", *pb).agg(F.sum(value).alias("_s"))
    w_grp = Window.partitionBy(*pb).orderBy("_pid") if pb else Window.orderBy("_pid")
    offsets = sums.select("_pid", *pb, F.coalesce(
        F.sum("_s").over(w_grp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    if not pb:
        offsets = F.broadcast(offsets)
    w_local = Window.partitionBy("_pid", *pb).orderBy(*_cols(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_loc", F.sum(value).over(w_local))
    return local.join(offsets, ["_pid", *pb]).withColumn(
        out, F.col("_off") + F.col("_loc")).drop("_pid", "_pos", "_off", "_loc")


def row_numbers_multi(df: DataFrame, id_col: str, orderings: dict[str, tuple[str, bool]],
                      num_partitions: int | None = None) -> DataFrame:
    """Several global orderings of one table in a single range-partitioned
    pass: rows are unpivoted to (ordering, value, id), numbered within each
    ordering, and pivoted back.  Adds ``rn_<name>`` (ties broken by
    ``id_col``, nulls last), ``n_rows`` and ``n_<name>``, the number of
    non-null values.  Values must be numeric (descending orders negate the
    value)."""
    parts = [df.select(F.col(id_col), F.lit(name).alias("_o"),
                       (F.col(col).cast("double") if asc else -F.col(col).cast("double")).alias("_v"))
             for name, (col, asc) in orderings.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    rn = row_number_global(long, [F.col("_v").asc_nulls_last(), F.col(id_col).asc()], ["_o"], out="_rn",
                           size_out="_n", num_partitions=num_partitions)
    wide = rn.groupBy(id_col).agg(*[F.max(F.when(F.col("_o") == name, F.col("_rn"))).alias(f"rn_{name}")
                                    for name in orderings], F.max("_n").alias("n_rows"))
    known = df.agg(*[F.count(col).alias(f"n_{name}") for name, (col, _) in orderings.items()])  # one row
    return df.join(wide, id_col).crossJoin(F.broadcast(known))


def tie_edge(df: DataFrame, value: str, rn: str, out: str, first: bool = True) -> DataFrame:
    """Adds ``out``: the first (or last) position ``rn`` among the rows with an equal
    ``value``; null where the value is null.  One row per distinct value is joined
    back null-safely, so no row is lost and AQE can split a hot value."""
    edge = (F.min if first else F.max)(rn)
    ties = df.groupBy(F.col(value).alias("_tie")).agg(edge.alias("_edge"))
    x = df.join(ties, df[value].eqNullSafe(ties["_tie"]), "left")
    return x.withColumn(out, F.when(F.col(value).isNotNull(), F.col("_edge")).cast("long")).drop("_tie", "_edge")
