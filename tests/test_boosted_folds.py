"""Boosted trees of all folds grown together are those that Spark ML grows one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillroll.operators import boosted_folds, ml


def customers(spark, n=600):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, 4))
    x[:, 2] = rng.integers(0, 5, n)
    x[:, 3] = np.where(rng.random(n) < 0.5, 0, x[:, 3])
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) > 0.5
    return spark.createDataFrame([(f"c{i}", *map(float, v), int(t), float(1 + i % 3), i % 3) for i, (v, t) in enumerate(zip(x, y, strict=True))],
                                 "customer_id string, a double, b double, c double, d double, true_churn_flag long, weight double, fold int")


def gbt(rounds, rate, depth):
    return GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=42)


def next_job(spark):
    spark.sparkContext.setJobGroup("count", "count")
    spark.range(1).collect()
    n = max(spark.sparkContext.statusTracker().getJobIdsForGroup("count"))
    spark.sparkContext.setJobGroup("other", "other")
    return n


@pytest.mark.parametrize("small", [False, True])
def test_trees_of_all_folds_are_those_of_sparks_booster(spark, monkeypatch, small):
    if small:  # many tasks, sums made on the way, rows refreshed and their history cut often
        for name, value in (("BLOCK", 100), ("LATE", 1), ("CUT", 2), ("DIRECT", 2)):
            monkeypatch.setattr(boosted_folds, name, value)
    data = ml.cut_lineage(ml.assemble(customers(spark), list("abcd")).withColumn("label", F.col("true_churn_flag").cast("double")))
    fits, first = [(6, 0.1, 4), (8, 0.05, 2)], next_job(spark)
    told = boosted_folds.held_out_scores(data, "label", 3, fits)
    used = next_job(spark) - first
    got = told.toPandas()
    assert small or used <= 6 * 4 + 16  # a job for a level of all trees, not for one of each
    off = []
    for i, fit in enumerate(fits):
        for fold in range(3):
            scored = gbt(*fit).fit(data.where(F.col("fold") != fold)).transform(data.where(F.col("fold") == fold))
            want = np.sort(scored.select(vector_to_array("probability")[1].alias("p")).toPandas()["p"])
            own = np.sort(got[(got.fit == i) & (got.fold == fold)]["p1"])
            off.append(np.abs(own - want))
    # cuts of equal gain are told apart by the last digits, which follow the order of sums
    assert (np.concatenate(off) > 1e-9).mean() < 0.03 and np.concatenate(off).max() < 0.1


def test_cross_validation_of_boosted_and_other_models(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    kinds = {"linear": lambda: LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=20),
             "boosted": lambda: gbt(4, 0.1, 2), "other": lambda: gbt(3, 0.2, 3)}
    monkeypatch.setattr(ml, "CHURN_MODELS", kinds)
    df = customers(spark).drop("weight", "fold")
    got = {(r.model, r.fold): r for r in ml.cross_validate(df, list("abcd"), folds=3, models=tuple(kinds)).collect()}
    assert set(got) == {(m, f) for m in kinds for f in range(3)}
    base = ml.class_weights(ml.fold_column(df, "true_churn_flag", 3), "true_churn_flag").withColumn("label", F.col("true_churn_flag").cast("double"))
    data = ml.cut_lineage(ml.assemble(base, list("abcd")))
    for (name, fold), r in got.items():
        scored = kinds[name]().fit(data.where(F.col("fold") != fold)).transform(data.where(F.col("fold") == fold))
        want = ml.binary_metrics(scored.withColumn("p1", vector_to_array("probability")[1]), "true_churn_flag", "p1").first()
        for c in ("accuracy", "precision", "recall", "f1", "roc_auc"):
            assert abs(r[c] - want[c]) < (1e-9 if name == "linear" else 0.02), (name, fold, c)


def test_cuts_of_few_and_many_values():
    assert boosted_folds.cuts(np.array([3.0, 1.0, 1.0]), np.ones(3)).tolist() == [2.0]
    assert len(boosted_folds.cuts(np.ones(5), np.ones(5))) == 0
    many = boosted_folds.cuts(np.arange(320.0), np.ones(320))
    assert len(many) <= 31 and np.allclose(np.diff(many), 10)


def test_a_fold_of_all_rows_is_refused(spark):
    data = ml.assemble(customers(spark, 9).withColumn("fold", F.lit(0)), list("abcd"))
    with pytest.raises(ValueError, match="nothing is left"):
        boosted_folds.held_out_scores(data, "true_churn_flag", 3, [(2, 0.1, 2)])
