"""Starts of k-means that move together are those that Spark moves one by one."""

import numpy as np
from pyspark.ml.clustering import KMeans

from tillroll.operators import ml


def jobs(spark):
    """The number of the next Spark job."""
    spark.sparkContext.setJobGroup("count", "count")
    spark.range(1).collect()
    n = max(spark.sparkContext.statusTracker().getJobIdsForGroup("count"))
    spark.sparkContext.setJobGroup("other", "other")
    return n


def cloud(spark, n=600):
    x = np.random.default_rng(3).normal(size=(n, 3)) + np.repeat([[0], [2], [4]], n // 3, 0)
    return x, spark.createDataFrame([(str(i), *map(float, v)) for i, v in enumerate(x)], "customer_id string, a double, b double, c double")


def test_starts_that_move_together_end_as_in_sparks_kmeans(spark, monkeypatch):
    monkeypatch.setattr(ml, "BLOCK", 100)
    _, df = cloud(spark)
    data = ml.cut_lineage(ml.assemble(df, ["a", "b", "c"]))
    of = lambda k, seed, most: KMeans(k=k, seed=seed, maxIter=most, featuresCol="features", predictionCol="_c").fit(data)
    starts = [(k, seed) for k in (2, 5, 7) for seed in (1, 2)]
    begun = [of(*start, 0).clusterCenters() for start in starts]
    first = jobs(spark)
    got = ml.lloyd(data, ["a", "b", "c"], begun)
    used, want = jobs(spark) - first, [of(*start, 300) for start in starts]
    for (centres, cost), model in zip(got, want, strict=True):
        assert np.allclose(centres, model.clusterCenters(), atol=1e-9) and abs(cost - model.summary.trainingCost) < 1e-6
    assert used <= max(m.summary.numIter for m in want) + 8  # a job for a step of all starts


def test_equal_points_go_to_the_first_of_equal_centres(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 5 + [(5.0, 1.0)] * 3, "a double, b double")
    (centres, cost), = ml.lloyd(df, ["a", "b"], [np.array([[0.0, 1.0], [2.0, 1.0], [6.0, 1.0]])])
    assert centres.tolist() == [[1.0, 1.0], [2.0, 1.0], [5.0, 1.0]] and abs(cost) < 1e-9


def test_sweep_tells_the_best_start_of_every_k(spark):
    x, df = cloud(spark)
    got = ml.kmeans_sweep(df, {"all": ["a", "b", "c"], "two": ["a", "b"]}, (2, 3), 3).collect()
    assert [(r.feature_set, r.k) for r in got] == [("all", 2), ("all", 3), ("two", 2), ("two", 3)]
    _, least = ml.kmeans_segments(df, ["a", "b", "c"], 3, 3)
    assert abs(got[1].wcss - least) < 1e-6 and sum(r.is_best for r in got) == 2 and got[0].wcss > got[1].wcss
