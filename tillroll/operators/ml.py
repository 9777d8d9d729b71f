"""Model-based operators on Spark ML.

Fits are distributed Spark ML estimators; the driver only loops over a
handful of seeds / models / parameter settings, never over data.  Python
runs on executors in one place, parallel across series: ``mapInArrow`` over
the products' series for the unit-root test (Q9).  Forecasting models are in
:mod:`model_forecasts` (the totals) and :mod:`panel_forecast` (products).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tillroll.functions.numeric import exact_mean, safe_corr
from tillroll.operators import ranking
from tillroll.operators.boosted_folds import held_out_scores
from tillroll.session import cut_lineage, partitions_for

SEED = 42
KMEANS_ITERATIONS = 300
#: Independent fits that run at once.
FITS = 6
#: Points that a task of joint k-means steps has at least, and distances that one of its steps holds.
BLOCK, PAIRS = 16384, 200_000


def together(jobs: Sequence[Callable]) -> list:
    """Results of ``jobs``, ``FITS`` of them at a time: fits on the same data that do not depend on
    each other are many short Spark jobs, whose waits then overlap."""
    with ThreadPoolExecutor(FITS) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(job)) for job in jobs]]


# ------------------------------------------------------------- clustering
def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def kmeans_segments(df: DataFrame, cols: Sequence[str], k: int = 3, restarts: int = 10,
                    id_col: str = "customer_id") -> tuple[DataFrame, float]:
    """M1 k-means (k-means|| init) over ``restarts`` seeds, keeping the
    lowest within-cluster sum of squares; labels ``Cluster n``."""
    data = cut_lineage(assemble(df, cols))
    fits = together([partial(KMeans(k=k, seed=SEED + s, maxIter=KMEANS_ITERATIONS, featuresCol="features", predictionCol="_c").fit, data)
                     for s in range(restarts)])
    best = min(fits, key=lambda m: m.summary.trainingCost)
    best_cost = best.summary.trainingCost
    out = best.transform(data).withColumn("cluster", F.concat(F.lit("Cluster "), F.col("_c").cast("string")))
    return out.drop("features", "_c"), float(best_cost)


def silhouette_sq(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """M3 mean silhouette with squared Euclidean distance in closed form
    (linear cost, no point pairs): per cluster n, Σy and Σ‖y‖² are enough
    for the mean distance of a point to every cluster.  The k cluster sums
    travel as one broadcast array row, so every point stays one row (equal
    points count each).  Singletons score 0."""
    sq = sum(F.col(c) * F.col(c) for c in cols)
    stats = df.groupBy(F.col(cluster).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(sq).alias("yy"), F.array(*[F.sum(c) for c in cols]).alias("s"))
    sums = stats.agg(F.collect_list(F.struct("k", "n", "yy", "s")).alias("_sums"))  # k entries
    pts = df.select(F.col(cluster).alias("_own"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"),
                    sq.alias("_xx")).crossJoin(F.broadcast(sums))

    def total(g):
        dot = F.aggregate(F.zip_with(F.col("_x"), g["s"], lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
        return g["n"] * F.col("_xx") - 2 * dot + g["yy"]

    mine = F.get(F.filter("_sums", lambda g: g["k"].eqNullSafe(F.col("_own"))), F.lit(0))
    a = F.when(mine["n"] > 1, total(mine) / (mine["n"] - 1))
    b = F.array_min(F.transform(F.filter("_sums", lambda g: ~g["k"].eqNullSafe(F.col("_own"))), lambda g: total(g) / g["n"]))
    per = pts.select(a.alias("a"), b.alias("b"))
    s = F.when(F.col("a").isNull() | F.col("b").isNull() | (F.greatest("a", "b") == 0), 0.0).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.agg(F.avg(s).alias("silhouette"), F.count(F.lit(1)).alias("points"))


def davies_bouldin(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """M4 mean over clusters of max_j (S_i + S_j) / d(c_i, c_j); S = mean
    Euclidean distance of members to their centroid."""
    cent = df.groupBy(cluster).agg(*[exact_mean(c).alias(f"c_{i}") for i, c in enumerate(cols)])
    x = df.join(F.broadcast(cent), cluster)  # k centroids
    dist = F.sqrt(sum((F.col(c) - F.col(f"c_{i}")) ** 2 for i, c in enumerate(cols)))
    scat = x.groupBy(cluster).agg(exact_mean(dist).alias("_s"))
    cs = cent.join(scat, cluster)
    a = cs.select(*[F.col(c).alias(f"a_{c}") for c in cs.columns])
    b = cs.select(*[F.col(c).alias(f"b_{c}") for c in cs.columns])
    pairs = a.join(b, F.col(f"a_{cluster}") != F.col(f"b_{cluster}"))  # k × (k − 1) centroid pairs
    dij = F.sqrt(sum((F.col(f"a_c_{i}") - F.col(f"b_c_{i}")) ** 2 for i in range(len(cols))))
    r = pairs.groupBy(f"a_{cluster}").agg(F.max((F.col("a__s") + F.col("b__s")) / dij).alias("_r"))
    return r.agg(exact_mean("_r").alias("davies_bouldin"), F.count(F.lit(1)).alias("clusters"))


def _assigned(centres: Sequence[np.ndarray]) -> Callable:
    """One pair of arrays for a task's blocks of points: for every centre of every start the number of the points
    nearest to it and their sums, and after them the squared distances of each start's points."""
    stacked = np.vstack(centres)
    square = (stacked ** 2).sum(1)[:, None]
    sizes = [len(c) for c in centres]
    first = np.cumsum([0, *sizes[:-1]])
    dim, step = stacked.shape[1], max(1, PAIRS // len(stacked))

    def run(blocks: Iterator) -> Iterator[tuple[bytes, bytes]]:
        sums, costs = np.zeros((len(stacked), dim + 1)), np.zeros(len(centres))
        for (block,) in blocks:
            points = np.frombuffer(block).reshape(-1, dim)
            for at in range(0, len(points), step):
                x = points[at:at + step]
                away = -2 * stacked @ x.T + square  # less the point's own square
                least = np.minimum.reduceat(away, first, axis=0)
                nearest = away == np.repeat(least, sizes, axis=0)
                if nearest.sum() > least.size:  # of equally near centres the first
                    for a, k in zip(first, sizes, strict=True):
                        nearest[a:a + k] &= nearest[a:a + k].cumsum(0) == 1
                costs += least.sum(1) + (x ** 2).sum()
                sums += nearest.astype(float) @ np.column_stack([np.ones(len(x)), x])
        yield sums.tobytes(), costs.tobytes()

    return run


def lloyd(df: DataFrame, cols: Sequence[str], starts: Sequence[np.ndarray], iterations: int = KMEANS_ITERATIONS,
          tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """(centres, cost) of each of ``starts`` when none of its centres moves by more than ``tol``; the
    cost is that of the last assignment, as Spark's k-means has it.

    One pass over the points moves all starts that still move, so there are as many jobs as the
    slowest has iterations.  A task tells one row of sums, whose size follows the starts."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], names=["x"])

    points = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    tasks = min(partitions_for(df), -(-df.count() // BLOCK) or 1)
    blocks = cut_lineage(points.repartition(tasks).mapInArrow(packed, "x binary")).rdd
    centres, costs, moving = [np.array(c, float) for c in starts], [0.0] * len(starts), list(range(len(starts)))
    for _ in range(iterations):
        if not moving:
            break
        told = blocks.mapPartitions(_assigned([centres[i] for i in moving])).collect()  # a pair a task
        sums, cost = (np.sum([np.frombuffer(t) for t in column], 0) for column in zip(*told, strict=True))
        sums, at, still = sums.reshape(-1, len(cols) + 1), 0, []
        for i, c in zip(moving, cost, strict=True):
            own, old = sums[at:at + len(centres[i])], centres[i]
            at += len(old)
            met = own[:, 0] > 0  # a centre without points stays
            centres[i] = np.where(met[:, None], own[:, 1:] / np.maximum(own[:, :1], 1.0), old)
            costs[i] = float(c)
            if (((centres[i] - old) ** 2).sum(1) > tol * tol).any():
                still.append(i)
        moving = still
    return list(zip(centres, costs, strict=True))


def nearest_centre(cols: Sequence[str], centres: np.ndarray) -> Column:
    """The number of the first nearest of a few centres."""
    away = F.array(*[sum((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, centre, strict=True)) for centre in centres])
    return (F.array_position(away, F.array_min(away)) - 1).cast("int")


def kmeans_sweep(df: DataFrame, feature_sets: dict[str, Sequence[str]], ks: Sequence[int] = range(2, 9),
                 restarts: int = 10) -> DataFrame:
    """M2/T10 per feature set and k, best of ``restarts`` starts: WCSS, silhouette
    (squared Euclidean), Davies–Bouldin, and whether k has the set's best silhouette.

    Spark's k-means|| finds the centres of every start; all of them then move together (:func:`lloyd`)."""
    spark = df.sparkSession
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="_c", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    starts = [(k, s) for k in ks for s in range(restarts)]

    def swept(name: str, cols: Sequence[str]) -> list[tuple]:
        data = cut_lineage(assemble(df, cols))

        def begun(k: int, s: int) -> list:
            return KMeans(k=k, seed=SEED + s, maxIter=0, featuresCol="features", predictionCol="_c").fit(data).clusterCenters()

        fits = dict(zip(starts, lloyd(data, cols, together([partial(begun, *start) for start in starts])), strict=True))

        def judged(k: int) -> tuple:
            centres, cost = min((fits[k, s] for s in range(restarts)), key=lambda fit: fit[1])
            pred = cut_lineage(data.withColumn("_c", nearest_centre(cols, centres)))
            db = davies_bouldin(pred, cols, "_c").first()["davies_bouldin"]
            return name, int(k), cost, float(ev.evaluate(pred)), float(db)

        own = together([partial(judged, k) for k in ks])
        best = max(own, key=lambda r: (r[3], -r[1]))[1]
        return [(*r, int(r[1] == best)) for r in own]

    rows = sum(together([partial(swept, name, cols) for name, cols in feature_sets.items()]), [])
    return spark.createDataFrame(rows, "feature_set string, k long, wcss double, silhouette double, davies_bouldin double, "
                                       "is_best long")


# ------------------------------------------------------------------ churn
def stratified_split(df: DataFrame, label: str, test_frac: float = 0.2, id_col: str = "customer_id",
                     seed: int = SEED) -> DataFrame:
    """M9 exact stratified split: within each label, rows in hash order; the
    first ``test_frac`` of each label go to test (range-partitioned numbering)."""
    h = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    rn = ranking.row_number_global(h, [F.col("_h"), F.col(id_col)], [label], out="_r", size_out="_n")
    return rn.withColumn("is_test", F.when(F.col("_r") <= F.round(F.col("_n") * test_frac), 1).otherwise(0)).drop(
        "_h", "_r", "_n")


def fold_column(df: DataFrame, label: str, folds: int = 5, id_col: str = "customer_id",
                seed: int = SEED) -> DataFrame:
    """M10 stratified fold id = row number in hash order within label mod k."""
    h = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed + 1)))
    rn = ranking.row_number_global(h, [F.col("_h"), F.col(id_col)], [label], out="_r")
    return rn.withColumn("fold", (F.col("_r") % folds).cast("int")).drop("_h", "_r")


def class_weights(df: DataFrame, label: str, mode: str = "balanced") -> DataFrame:
    """M11 ``balanced``: n / (2·n_class); ``ratio``: positives weighted neg/pos."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = df.agg(F.count(F.lit(1)).alias("_n"), F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("_neg"),
                 F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"))
    x = df.join(F.broadcast(c), label).crossJoin(F.broadcast(tot))
    if mode == "balanced":
        w = F.col("_n") / (2.0 * F.col("_nc"))
    else:
        w = F.when(F.col(label) == 1, F.col("_neg") / F.col("_pos")).otherwise(1.0)
    return x.withColumn("weight", w.cast("double")).drop("_nc", "_n", "_neg", "_pos")


def binary_metrics(df: DataFrame, label: str = "label", prob: str = "probability", threshold: float = 0.5,
                   id_col: str = "customer_id") -> DataFrame:
    """M13 accuracy, precision, recall, F1, specificity, confusion counts and
    ROC AUC exactly by the rank-sum formula with average ranks for ties
    (ranks from a range-partitioned global ordering)."""
    y, p = F.col(label), F.col(prob)
    pred = F.when(p >= threshold, 1).otherwise(0)
    cm = df.agg(F.sum(F.when((pred == 1) & (y == 1), 1).otherwise(0)).alias("tp"),
                F.sum(F.when((pred == 1) & (y == 0), 1).otherwise(0)).alias("fp"),
                F.sum(F.when((pred == 0) & (y == 0), 1).otherwise(0)).alias("tn"),
                F.sum(F.when((pred == 0) & (y == 1), 1).otherwise(0)).alias("fn"))
    # average rank of a score = rows with a lower score + (ties + 1) / 2, from
    # per-distinct-score counts and a range-partitioned running count
    vc = df.groupBy(prob).agg(F.count(F.lit(1)).alias("_c"), F.sum(F.when(y == 1, 1).otherwise(0)).alias("_npos"))
    cum = ranking.running_sum(vc, "_c", [p.asc()], "_cum")
    avg_rank = (F.col("_cum") - F.col("_c")) + (F.col("_c") + 1) / 2.0
    auc = cum.agg(F.sum(F.col("_npos") * avg_rank).alias("_rs"), F.sum("_npos").alias("_np"),
                  (F.sum("_c") - F.sum("_npos")).alias("_nn"))
    x = cm.crossJoin(auc)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return x.select(
        ((tp + tn) / (tp + tn + fp + fn)).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
        F.when(tn + fp > 0, tn / (tn + fp)).otherwise(0.0).alias("specificity"),
        F.when((F.col("_np") > 0) & (F.col("_nn") > 0),
               (F.col("_rs") - F.col("_np") * (F.col("_np") + 1) / 2.0) / (F.col("_np") * F.col("_nn"))).alias("roc_auc"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), tn.cast("long").alias("tn"), fn.cast("long").alias("fn"))


CHURN_MODELS = {
    "logistic_regression": lambda: LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                                                      maxIter=1000),
    "random_forest": lambda: RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                                    numTrees=100, seed=SEED),
    "boosted_trees_a": lambda: GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                             maxIter=50, maxDepth=5, seed=SEED),
    "boosted_trees_b": lambda: GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                             maxIter=100, maxDepth=3, stepSize=0.05, seed=SEED),
}


def train_churn(df: DataFrame, features: Sequence[str], label: str = "true_churn_flag",
                models: Sequence[str] = tuple(CHURN_MODELS)) -> tuple[DataFrame, dict]:
    """M9 + M11 + M12 + M13: stratified split, class weights, four
    classifiers, held-out metrics per model.  Returns (metrics, fitted)."""
    base = class_weights(stratified_split(df, label), label, "balanced").withColumn("label", F.col(label).cast("double"))
    data = cut_lineage(assemble(base, features))
    train, test = data.filter(F.col("is_test") == 0), data.filter(F.col("is_test") == 1)

    def measured(name: str) -> tuple:
        m = CHURN_MODELS[name]().fit(train)
        scored = m.transform(test).withColumn("p1", vector_to_array("probability")[1])
        return m, binary_metrics(scored, label, "p1").withColumn("model", F.lit(name))

    both = together([partial(measured, name) for name in models])  # the models do not depend on each other
    return reduce(DataFrame.unionByName, [met for _, met in both]), {name: m for name, (m, _) in zip(models, both, strict=True)}


def cross_validate(df: DataFrame, features: Sequence[str], label: str = "true_churn_flag", folds: int = 5,
                   models: Sequence[str] = tuple(CHURN_MODELS)) -> DataFrame:
    """M10 stratified cross-validation: every model is fitted on the other folds and
    scored on its own; one row per model and fold with the held-out metrics."""
    base = class_weights(fold_column(df, label, folds), label, "balanced").withColumn("label", F.col(label).cast("double"))
    data = cut_lineage(assemble(base, features))

    kinds = {name: CHURN_MODELS[name]() for name in models}
    boosted = [name for name, m in kinds.items() if isinstance(m, GBTClassifier)]

    def measured(scored: DataFrame, fold: int, name: str) -> DataFrame:
        return binary_metrics(scored, label, "p1").select(
            F.lit(name).alias("model"), F.lit(fold).cast("long").alias("fold"), "accuracy", "precision", "recall", "f1", "roc_auc")

    def scores(fold: int, name: str) -> list[DataFrame]:
        train, test = data.filter(F.col("fold") != fold), data.filter(F.col("fold") == fold)
        scored = kinds[name].fit(train).transform(test).withColumn("p1", vector_to_array("probability")[1])
        return [measured(cut_lineage(scored.select(label, "p1")), fold, name)]  # scored once for all of its metrics

    def joint() -> list[DataFrame]:
        """The boosted models of all folds, grown together."""
        told = held_out_scores(data, label, folds, [(m.getMaxIter(), m.getStepSize(), m.getMaxDepth()) for m in map(kinds.get, boosted)])
        return together([partial(measured, told.where((F.col("fit") == i) & (F.col("fold") == fold)), fold, name)
                         for i, name in enumerate(boosted) for fold in range(folds)])

    jobs = [joint] if boosted else []
    jobs += [partial(scores, fold, name) for fold in range(folds) for name in models if name not in boosted]
    return reduce(DataFrame.unionByName, sum(together(jobs), []))


def champion(metrics: DataFrame) -> DataFrame:
    """T9 best model by (ROC AUC, recall)."""
    return metrics.agg(F.max_by("model", F.struct("roc_auc", "recall", "model")).alias("champion"))


def score_customers(model, df: DataFrame, features: Sequence[str], id_col: str = "customer_id") -> DataFrame:
    """M14 probability per customer and C13 band."""
    from tillroll.operators.customers import risk_band
    s = model.transform(assemble(df, features)).withColumn("churn_probability", vector_to_array("probability")[1])
    return s.select(id_col, "churn_probability", risk_band("churn_probability").alias("risk_category"),
                    *[c for c in df.columns if c != id_col])


def churn_drivers(model, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """M15 importance (trees) or |coefficient| (linear) with the direction
    from the sign of the feature–label correlation."""
    spark = df.sparkSession
    if hasattr(model, "featureImportances"):
        imp = model.featureImportances.toArray().tolist()
    else:
        imp = [abs(c) for c in model.coefficients.toArray().tolist()]
    t = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    corr = df.agg(*[safe_corr(f, label).alias(f) for f in features])
    corr_long = corr.unpivot([], list(features), "feature", "correlation")
    return t.join(corr_long, "feature").withColumn(
        "direction", F.when(F.col("correlation") > 0, "raises churn").when(F.col("correlation") < 0, "lowers churn")
        .otherwise("neutral")).withColumn("rank", F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature")))


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str,
                           id_col: str = "customer_id") -> DataFrame:
    """M16 AUC drop when one feature's values are permuted across rows.

    Rows are numbered once in a hash order (range-partitioned); feature k
    takes its values from the row ``shift_k`` places further along that
    cycle — a derangement of the column — via one equi-join per feature."""
    spark = df.sparkSession
    base = df.withColumn("label", F.col(label).cast("double"))

    def auc_of(frame):
        s = model.transform(assemble(frame, features)).withColumn("p1", vector_to_array("probability")[1])
        return binary_metrics(s, "label", "p1", id_col=id_col).first()["roc_auc"]
    ref = auc_of(base)
    idx = ranking.row_number_global(base.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(SEED))),
                                    [F.col("_h"), F.col(id_col)], out="_ra", size_out="_n").drop("_h")
    rows = []
    for k, f in enumerate(features):
        shift = 1 + 7919 * (k + 1)
        donor = idx.select(((F.col("_ra") - 1 + F.lit(shift)) % F.col("_n") + 1).alias("_ra"), F.col(f).alias("_v"))
        perm = idx.drop(f).join(donor, "_ra").withColumnRenamed("_v", f).drop("_ra", "_n")
        rows.append((f, float(ref - auc_of(perm))))
    return spark.createDataFrame(rows, "feature string, auc_drop double")


# ------------------------------------------------------------- unit roots
# Fixed values, regression with a constant: MacKinnon (2010) large-sample critical values, and the
# response surface of MacKinnon (1994) for p-values: polynomials in the statistic whose normal
# probability is p, below and above the switch-over; 0 and 1 beyond the range.
ADF_CRITICAL = {"1%": -3.43035, "5%": -2.86154, "10%": -2.56677}
ADF_SMALL_P, ADF_LARGE_P = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
ADF_SWITCH, ADF_LOWEST, ADF_HIGHEST = -1.61, -18.83, 2.74


def adf_p_value(stat: float) -> float:
    """p-value of an ADF statistic (constant, no trend)."""
    if stat > ADF_HIGHEST:
        return 1.0
    if stat < ADF_LOWEST:
        return 0.0
    terms = ADF_SMALL_P if stat <= ADF_SWITCH else ADF_LARGE_P
    return NormalDist().cdf(sum(c * stat ** k for k, c in enumerate(terms)))


def adf_statistic(y: np.ndarray) -> tuple[float, int] | None:
    """(statistic, lag order by AIC over one sample), None where the series decides nothing: too
    short, constant, lags that depend on each other, or a fit without residuals.

    The regressions of all lag orders are nested: one orthogonal decomposition of the longest
    has the squared residuals of each.  Where its columns come near dependence, every order
    is fitted by itself."""
    n = len(y)
    dy = np.diff(y)
    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    if most < 0 or not np.isfinite(y).all():
        return None
    floor = 1e-14 * max(float(np.mean(dy ** 2)), 1e-300)

    def design(p: int, first: int) -> np.ndarray:
        x = np.empty((n - 1 - first, p + 2))
        x[:, 0], x[:, 1] = 1.0, y[first:-1]
        for j in range(1, p + 1):
            x[:, j + 1] = dy[first - j:n - 1 - j]
        return x

    def fitted(p: int, first: int):
        """(coefficients, design, mean squared residual) of the regression with p lags, None if its columns depend."""
        target, x = dy[first:], design(p, first)
        scale = np.sqrt((x ** 2).sum(0))
        if (scale == 0).any():
            return None
        beta, _, rank, _ = np.linalg.lstsq(x / scale, target, rcond=1e-10)
        if rank < x.shape[1] or len(target) <= x.shape[1]:
            return None
        resid = target - x / scale @ beta
        return beta / scale, x, float(resid @ resid) / len(target)

    def nested() -> list[float] | None:
        """Mean squared residuals of 0 to ``most`` lags, None if the columns come near dependence."""
        target, x = dy[most:], design(most, most)
        scale = np.sqrt((x ** 2).sum(0))
        if (scale == 0).any() or len(target) <= x.shape[1]:
            return None
        q, r = np.linalg.qr(x / scale)
        if np.abs(np.diag(r)).min() < 1e-3:
            return None
        part = q.T @ target
        rest = target - q @ part
        return ((float(rest @ rest) + np.concatenate([np.cumsum(part[:1:-1] ** 2)[::-1], [0.0]])) / len(target)).tolist()

    best, told = None, nested()
    for p in range(most + 1):
        if told is None:
            got = fitted(p, most)
            if got is None:
                continue
            mean_sq = got[2]
        else:
            mean_sq = told[p]
        if mean_sq <= floor:
            return None
        aic = (n - 1 - most) * np.log(mean_sq) + 2 * (p + 2)
        if best is None or aic < best[0]:
            best = (aic, p)
    got = None if best is None else fitted(best[1], best[1])
    if got is None or got[2] <= floor:
        return None
    beta, x, mean_sq = got
    s2 = mean_sq * len(x) / (len(x) - x.shape[1])
    r = np.linalg.qr(x, mode="r")
    width = np.linalg.solve(r.T, np.eye(x.shape[1])[1])  # the second row of R^-1, transposed
    return float(beta[1] / np.sqrt(s2 * (width @ width))), best[1]


def adf_by_series(series: DataFrame, key: str, value: str, min_obs: int = 20, step_days: int | None = None) -> DataFrame:
    """Q9 augmented Dickey-Fuller test per series (constant, lag order by AIC up to
    12 (n/100)^1/4): statistic, p-value, verdict at p < 0.05, and the 1/5/10 % critical values.
    A series that decides nothing has null in all of them; null values are left out.

    With ``step_days`` a series has one value for so many days (one row at most for each), and
    the steps between its first and last that have none count as 0.  A series travels as one
    row of its own values; absent steps are filled in where it is tested."""
    at = F.unix_micros(F.col("date").cast("timestamp")) if step_days is None else F.datediff("date", F.lit("1970-01-01").cast("date"))
    at = F.coalesce(at.cast("long"), F.lit(np.iinfo(np.int64).max))  # rows without a date come last
    told = series.select(F.col(key), at.alias("at"), F.col(value).cast("double").alias("v"))
    if step_days is None:
        told = told.withColumn("v", F.nanvl("v", F.lit(None)))
    item = F.when(F.col("v").isNotNull(), F.struct("at", "v"))
    rows = told.groupBy(key).agg(F.collect_list(item).alias("items")).select(
        key, F.col("items.at").alias("at"), F.col("items.v").alias("v"))
    own = rows.schema[key]
    fields = pa.schema([("nobs", pa.int64()), ("adf_stat", pa.float64()), ("used_lag", pa.int64()), ("p_value", pa.float64()),
                        ("stationary", pa.int64())])

    def ordered(at: np.ndarray, v: np.ndarray) -> np.ndarray:
        order = np.argsort(at, kind="stable")
        at, v = at[order], v[order]
        if step_days is None or not len(at):
            return v
        y = np.zeros((at[-1] - at[0]) // step_days + 1)
        y[(at - at[0]) // step_days] = v
        return y[~np.isnan(y)]

    def adf(y: np.ndarray) -> tuple:
        still = len(y) < min_obs or np.abs(y - y[0]).max() <= 1e-8 + 1e-5 * abs(y[0])
        got = None if still else adf_statistic(y)
        stat, lag = got or (None, None)
        p = None if got is None else adf_p_value(stat)
        return len(y), stat, lag, p, None if p is None else int(p < 0.05)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            at, v = (batch.column(i).values.to_numpy(zero_copy_only=False) for i in (1, 2))
            with np.errstate(invalid="ignore"):
                out = [adf(ordered(at[a:b], v[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)] if out else [
                pa.array([], f.type) for f in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[own.name, *fields.names])

    kind = own.dataType.simpleString()
    out = rows.mapInArrow(run, f"`{key}` {kind}, nobs long, adf_stat double, used_lag long, p_value double, stationary long")
    return out.select("*", *[F.lit(v).alias(f"crit_{k[:-1]}pct") for k, v in ADF_CRITICAL.items()])
