"""Data-quality and statistics operators.

Multi-column statistics unpivot first (``stack``) and then aggregate by
column name, so one shuffle serves every column; exact quartiles come from
the range-partitioned helpers, never from a whole column in one buffer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import exact_mean, safe_corr
from tillroll.operators import ranking


def unpivot(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (), name: str = "column",
            value: str = "value") -> DataFrame:
    """Wide → long (``DataFrame.unpivot``) with every value cast to double."""
    x = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return x.unpivot(list(ids), list(cols), name, value)


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A14 count, mean, std (sample), min, 25/50/75 %, max per column (exact)."""
    long = unpivot(df, cols).filter(F.col("value").isNotNull())
    stats = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), exact_mean("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = ranking.exact_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["column"])
    return stats.join(qs, "column", "left")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A15 count, unique, top (most frequent; ties → greatest value), freq."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    vc = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return vc.groupBy("column").agg(
        F.sum("cnt").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.max(F.struct("cnt", "value")).alias("_top")).select(
        "column", "count", "unique", F.col("_top.value").alias("top"), F.col("_top.cnt").alias("freq"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A22/Q2 null count and percentage per column (one aggregate, unpivoted)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in cols])
    long = agg.unpivot(["_n"], cols, "column", "nulls")
    return long.select("column", F.col("nulls").cast("long").alias("nulls"),
                       (F.col("nulls") * 100.0 / F.col("_n")).alias("missing_pct"))


def missing_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q2 non-zero missing percentages, descending."""
    return null_profile(df, cols).filter(F.col("nulls") > 0).orderBy(F.col("missing_pct").desc(), "column")


def duplicate_count(df: DataFrame) -> DataFrame:
    """A22 duplicate rows = rows − distinct rows."""
    return df.agg(F.count(F.lit(1)).alias("rows")).crossJoin(
        df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows"))).withColumn(
        "duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q3 Pearson r for every ordered pair (long form), null for constant
    columns (Spark's ``corr`` raises on zero variance under ANSI)."""
    aggs = [F.stddev_pop(F.col(c).cast("double")).alias(f"s__{c}") for c in cols]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs += [safe_corr(a, b).alias(f"r__{a}__{b}") for a, b in pairs]
    one = df.agg(*aggs)
    rows = []
    for a in cols:
        for b in cols:
            if a == b:
                r = F.when(F.col(f"s__{a}") > 0, F.lit(1.0))
            else:
                k = f"r__{a}__{b}" if (a, b) in pairs else f"r__{b}__{a}"
                r = F.when((F.col(f"s__{a}") > 0) & (F.col(f"s__{b}") > 0), F.col(k))
            rows.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), r.alias("correlation")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def high_corr_pairs(matrix: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Q4 lower-triangle pairs with |r| > threshold."""
    pos = {c: i for i, c in enumerate(cols)}
    idx = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    return matrix.filter((idx[F.col("feature_a")] > idx[F.col("feature_b")])
                         & (F.abs("correlation") > threshold)).withColumn("abs_correlation", F.abs("correlation"))


def validate_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5 nulls, infinities, min, max, mean per feature."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    inf = F.abs("value") == float("inf")
    fin = F.when(~inf & ~F.isnan("value"), F.col("value"))
    return long.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNull() | F.isnan("value"), 1).otherwise(0)).alias("nulls"),
        F.sum(F.when(inf, 1).otherwise(0)).alias("infs"),
        F.min(fin).alias("min"), F.max(fin).alias("max"), exact_mean(fin).alias("mean"))


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, group: Sequence[str] = ()) -> DataFrame:
    """Q6 Tukey fences Q1 − k·IQR, Q3 + k·IQR; outlier count and %."""
    q = ranking.exact_quantiles(df, col, {"q1": 0.25, "q3": 0.75}, group)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "lower", F.col("q1") - k * F.col("iqr")).withColumn("upper", F.col("q3") + k * F.col("iqr"))
    x = df.join(F.broadcast(q) if not group else q, list(group)) if group else df.crossJoin(F.broadcast(q))
    out = (F.col(col) < F.col("lower")) | (F.col(col) > F.col("upper"))
    g = x.groupBy(*group, "q1", "q3", "iqr", "lower", "upper").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.when(out, 1).otherwise(0)).alias("outliers"))
    return g.withColumn("outlier_pct", F.col("outliers") * 100.0 / F.col("rows"))


def skewness_report(df: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Q10 population skewness per column and whether a log1p transform
    (after shifting by the minimum when negative) applies."""
    long = unpivot(df, cols).filter(F.col("value").isNotNull())
    g = long.groupBy("column").agg(F.skewness("value").alias("skew"), F.min("value").alias("min"))
    return g.withColumn("transformed", F.when(F.abs("skew") > threshold, 1).otherwise(0))


def deskew(df: DataFrame, cols: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Q10 apply the transform chosen by :func:`skewness_report`."""
    rep = skewness_report(df, cols, threshold)
    one = rep.groupBy().pivot("column", list(cols)).agg(F.first(F.struct("transformed", "min")))
    x = df.crossJoin(F.broadcast(one.select(*[F.col(f"`{c}`").alias(f"_t_{c}") for c in cols])))
    for c in cols:
        t = F.col(f"_t_{c}")
        shifted = F.when(t.getField("min") < 0, F.col(c) - t.getField("min")).otherwise(F.col(c))
        x = x.withColumn(c, F.when(t.getField("transformed") == 1, F.log1p(shifted)).otherwise(F.col(c).cast("double")))
    return x.drop(*[f"_t_{c}" for c in cols])


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q11 (x − mean) / population std (0 when the std is 0)."""
    st = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in cols],
                *[F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}") for c in cols])
    x = df.crossJoin(F.broadcast(st))
    for c in cols:
        x = x.withColumn(c, F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).otherwise(0.0))
    return x.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def robust_scale(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Q12 (x − median) / IQR (0 when IQR is 0), exact quartiles."""
    long = unpivot(df, cols, [id_col])
    q = ranking.exact_quantiles(long, "value", {"q1": 0.25, "med": 0.5, "q3": 0.75}, ["column"])
    x = long.join(F.broadcast(q), "column")  # one row per column
    iqr = F.col("q3") - F.col("q1")
    return x.select(id_col, "column", F.when(iqr != 0, (F.col("value") - F.col("med")) / iqr).otherwise(0.0).alias("scaled"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """A23 equal-width bins over [min, max] (last bin closed)."""
    mm = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = df.select(col).filter(F.col(col).isNotNull()).crossJoin(F.broadcast(mm))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col(col) - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0)
    g = x.groupBy(b.cast("long").alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return g.select("bin", (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"), "count")


def kde(df: DataFrame, col: str, grid: int = 64, fine_bins: int = 1024) -> DataFrame:
    """A24 Gaussian density behind the histogram at ``grid`` points, Scott's
    bandwidth (σ·n^(−1/5)).  Binned: rows are first counted into
    ``fine_bins`` equal-width bins (one aggregation, skew-proof), then each
    grid point sums over bin centres — work independent of the row count."""
    st = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"), F.count(col).alias("_n"),
                F.stddev_samp(col).alias("_sd"))
    x = df.select(col).filter(F.col(col).isNotNull()).crossJoin(F.broadcast(st))
    fw = (F.col("_hi") - F.col("_lo")) / fine_bins
    fb = F.when(fw > 0, F.least(F.floor((F.col(col) - F.col("_lo")) / fw), F.lit(fine_bins - 1))).otherwise(0)
    counts = x.groupBy(fb.cast("long").alias("fb")).agg(F.count(F.lit(1)).alias("c"))
    pts = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("gi"))
    cells = counts.crossJoin(F.broadcast(pts))  # ≤ fine_bins × grid rows
    h = F.col("_sd") * F.pow(F.col("_n").cast("double"), -0.2)
    gx = F.col("_lo") + F.col("gi") * (F.col("_hi") - F.col("_lo")) / (grid - 1)
    cx = F.col("_lo") + (F.col("fb") + 0.5) * fw
    z = (gx - cx) / h
    g = cells.groupBy("gi", gx.alias("x"), "_n", "_sd").agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("_s"))
    bw = F.col("_sd") * F.pow(F.col("_n").cast("double"), -0.2)
    return g.select(F.col("gi").alias("grid_index"), "x",
                    (F.col("_s") / (F.col("_n") * bw * math.sqrt(2 * math.pi))).alias("density"))


def heatmap_2d(df: DataFrame, x: str, y: str, z: str, bins: int = 10) -> DataFrame:
    """A25 mean of ``z`` over equal-width (x, y) bins."""
    mm = df.agg(F.min(x).alias("_xl"), F.max(x).alias("_xh"), F.min(y).alias("_yl"), F.max(y).alias("_yh"))
    d = df.crossJoin(F.broadcast(mm))

    def bucket(c, lo, hi):
        w = (F.col(hi) - F.col(lo)) / bins
        return F.when(w > 0, F.least(F.floor((F.col(c) - F.col(lo)) / w), F.lit(bins - 1))).otherwise(0).cast("long")
    return d.groupBy(bucket(x, "_xl", "_xh").alias("x_bin"), bucket(y, "_yl", "_yh").alias("y_bin")).agg(
        F.count(F.lit(1)).alias("count"), exact_mean(z).alias(f"avg_{z}"))


def crosstab(df: DataFrame, a: str, b: str, total_label: str = "All") -> DataFrame:
    """A16 contingency counts with margins: ``cube`` gives all four grouping sets."""
    g = df.cube(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b)).agg(
        F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_gid"))
    return g.select(F.when(F.col("_gid").bitwiseAND(2) > 0, F.lit(total_label)).otherwise(F.col(a)).alias(a),
                    F.when(F.col("_gid").bitwiseAND(1) > 0, F.lit(total_label)).otherwise(F.col(b)).alias(b),
                    "count")


def share_within(df: DataFrame, group: str, cat: str) -> DataFrame:
    """A17 count of ``cat`` inside each ``group`` and its share of the group."""
    g = df.groupBy(group, cat).agg(F.count(F.lit(1)).alias("count"))
    return g.withColumn("share_pct", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy(group)))


def value_share(df: DataFrame, col: str) -> DataFrame:
    """A11 value counts and % of total."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    tot = df.agg(F.count(F.lit(1)).alias("_tot"))  # one-row total: no single-task window over values
    return g.crossJoin(F.broadcast(tot)).select(col, "count", (F.col("count") * 100.0 / F.col("_tot")).alias("pct"))


def group_profile(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """A13 per group and column: count, share, min, max, mean, median, std."""
    long = unpivot(df, cols, [key]).filter(F.col("value").isNotNull())
    st = long.groupBy(key, "column").agg(
        F.count(F.lit(1)).alias("count"), F.min("value").alias("min"), F.max("value").alias("max"),
        exact_mean("value").alias("mean"), F.stddev_samp("value").alias("std"))
    med = ranking.exact_quantiles(long, "value", {"median": 0.5}, [key, "column"])
    tot = df.agg(F.count(F.lit(1)).alias("_tot"))
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_g")).crossJoin(F.broadcast(tot))
    sizes = sizes.withColumn("share_pct", F.col("_g") * 100.0 / F.col("_tot")).drop("_tot")
    return st.join(med, [key, "column"], "left").join(sizes.drop("_g"), key, "left")


def feature_target_corr(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Q13 guarded Pearson r of each feature with a target."""
    m = corr_matrix(df, list(cols) + [target])
    return m.filter((F.col("feature_b") == target) & (F.col("feature_a") != target)).select(
        F.col("feature_a").alias("feature"), "correlation")



def verify_feature(df: DataFrame, stored: str, recomputed: Column, tol: float = 1e-6) -> DataFrame:
    """Q8 stored feature vs its recomputation: rows, mismatches (null-safe,
    within ``tol``), first mismatching row."""
    same = (F.col(stored).isNull() & recomputed.isNull()) | (F.abs(F.col(stored) - recomputed) <= tol)
    x = df.withColumn("_ok", F.coalesce(same, F.lit(False)))
    return x.agg(F.lit(stored).alias("feature"), F.count(F.lit(1)).alias("rows"),
                 F.sum(F.when(~F.col("_ok"), 1).otherwise(0)).alias("mismatches"))
