"""Model plans (M1–M16, D6q–D9q, Q9, E10).

Forecasting models are in :mod:`tillroll.plans.model_forecasts`.

Plans whose numbers depend on a learner's internals (k-means seeds, tree
ensembles, boosted regressors) have no SQL oracle and are checked on rows
only; the deterministic evaluation pieces (silhouette in closed form,
Davies–Bouldin, exact rank-sum AUC, the model registry over deterministic
models) do have one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.numeric import xmean_sql
from tillroll.operators import customers as cu
from tillroll.operators import density, ranking
from tillroll.operators import ml
from tillroll.operators import quality as qu
from tillroll.operators import timeseries as ts
from tillroll.functions import calendar as cal
from tillroll.plans.catalog import register
from tillroll.plans.customers import CUTOFF, HORIZON, pred_sql
from tillroll.plans.decisions import NAIVE_CTE
from tillroll.plans.inventory import HEALTH_EXPR, HEALTH_SQL, inventory_sql
from tillroll.plans.quality import SKEW_COLS, _std_sql
from tillroll.session import cut_lineage
from tillroll.sources.ledger import sales_ledger, stock_balances

CHURN_FEATURES = [c for c in cu.CHURN_COLUMNS if c not in ("customer_id", "true_churn_flag")]
SEG_RULE = ("CASE WHEN customer_loyalty_score >= 7 THEN 'Cluster 0' WHEN customer_loyalty_score >= 4 "
            "THEN 'Cluster 1' ELSE 'Cluster 2' END")


def _scaled(spark, sf_dir):
    feats = cu.customer_features(sales_ledger(spark, sf_dir))
    z = qu.standardize(qu.deskew(feats.select("customer_id", "customer_loyalty_score", *SKEW_COLS), SKEW_COLS),
                       SKEW_COLS)
    return cut_lineage(z)  # the clustering matrix is read by every model / metric branch


@register("kmeans_segments", "M1 M5 F20", "customer_id string, cluster string")
def kmeans_segments(spark, sf_dir):
    seg, _ = ml.kmeans_segments(_scaled(spark, sf_dir), SKEW_COLS, k=3, restarts=10)
    return seg.select("customer_id", "cluster")


@register("kmeans_sweep", "M2 M3 M4 T10", "feature_set string, k bigint, wcss double, silhouette double, "
          "davies_bouldin double, is_best bigint")
def kmeans_sweep(spark, sf_dir):
    sets = {"with_active_months": SKEW_COLS, "without_active_months": [c for c in SKEW_COLS if c != "active_months"]}
    return ml.kmeans_sweep(_scaled(spark, sf_dir), sets, range(2, 9))


def _scaled_seg_sql() -> str:
    # standardised features plus the rule cluster of every customer
    base = _std_sql()
    head, select = base.rsplit("\nSELECT customer_id, ", 1)
    return head + f""",
z AS (SELECT customer_id, {select}),
zs AS (SELECT z.*, {SEG_RULE.replace('customer_loyalty_score', 'cf.customer_loyalty_score')} AS cluster
       FROM z JOIN cf ON z.customer_id = cf.customer_id)"""


def _rule_scaled(spark, sf_dir):
    return cu.rule_segments(_scaled(spark, sf_dir))


SQ = " + ".join(f"{c} * {c}" for c in SKEW_COLS)


def _density_points(spark, sf_dir):
    return density.numbered(_scaled(spark, sf_dir), SKEW_COLS, "customer_id")


def _density_sql() -> str:
    dist = "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SKEW_COLS) + ")"
    return f"""RECURSIVE {_scaled_seg_sql().strip().removeprefix('WITH')},
pts AS (SELECT *, row_number() OVER (ORDER BY customer_id) AS nid FROM z),
dist AS (SELECT a.nid AS a, b.nid AS b, {dist} AS d FROM pts a, pts b)"""


@register("density_clusters", "J13 M7", "customer_id string, cluster bigint", sql=f"""WITH {_density_sql()},
near AS (SELECT a, b FROM dist WHERE d <= 0.8),
core AS (SELECT a AS nid FROM near GROUP BY a HAVING count(*) >= 7),
links AS (SELECT a, b FROM near WHERE a <> b AND a IN (SELECT nid FROM core) AND b IN (SELECT nid FROM core)),
lab(n, l) USING KEY (n) AS (
  SELECT nid, nid FROM core
  UNION SELECT e.b, min(lab.l) FROM lab JOIN links e ON lab.n = e.a JOIN recurring.lab cur ON cur.n = e.b
        WHERE lab.l < cur.l GROUP BY e.b),
border AS (SELECT a AS n, min(b) AS c FROM near WHERE a NOT IN (SELECT nid FROM core) AND b IN (SELECT nid FROM core) GROUP BY a),
member AS (SELECT n, l FROM lab UNION ALL SELECT border.n, lab.l FROM border JOIN lab ON border.c = lab.n),
name AS (SELECT l, row_number() OVER (ORDER BY l) - 1 AS cluster FROM (SELECT DISTINCT l FROM member))
SELECT customer_id, coalesce(cluster, -1) AS cluster FROM pts LEFT JOIN member ON nid = n LEFT JOIN name USING (l)""")
def density_clusters(spark, sf_dir):
    pts = _density_points(spark, sf_dir)
    return density.density_labels(pts, [(0.8, 7)]).join(pts.select("nid", "customer_id"), "nid").select("customer_id", "cluster")


@register("density_grid", "M8 T10", "eps double, min_samples bigint, n_clusters bigint, n_noise bigint, noise_pct double, "
          "silhouette double, is_best bigint")
def density_grid(spark, sf_dir):
    return density.density_grid(_density_points(spark, sf_dir))


K_PERCENTILES = (50, 75, 80, 85, 90, 92, 95, 97, 99)


@register("k_distance_profile", "J13 M6", "percentile bigint, distance double", sql=f"""WITH {_density_sql()},
ranked AS (SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d) AS r FROM dist),
kth AS (SELECT d FROM ranked WHERE r = 10)
""" + "\nUNION ALL\n".join(f"SELECT {p} AS percentile, quantile_cont(d, {p / 100}) AS distance FROM kth" for p in K_PERCENTILES))
def k_distance_profile(spark, sf_dir):
    kth = density.kth_distances(_density_points(spark, sf_dir), 10)
    q = ranking.exact_quantiles(kth, "distance", {f"p{p}": p / 100 for p in K_PERCENTILES})
    rows = F.array(*[F.struct(F.lit(p).cast("long").alias("percentile"), F.col(f"p{p}").alias("distance")) for p in K_PERCENTILES])
    return q.select(F.inline(rows))


@register("silhouette_rule_clusters", "M3", "silhouette double, points bigint", sql=_scaled_seg_sql() + f""",
st AS (SELECT cluster AS k, count(*) AS n, sum({SQ}) AS yy, {', '.join(f'sum({c}) AS s_{c}' for c in SKEW_COLS)}
       FROM zs GROUP BY cluster),
pk AS (SELECT customer_id, cluster, k, n, ({SQ}) AS xx, yy, ({' + '.join(f'{c} * s_{c}' for c in SKEW_COLS)}) AS dot FROM zs, st),
d AS (SELECT customer_id, cluster,
             max(CASE WHEN cluster = k AND n > 1 THEN (n * xx - 2 * dot + yy) / (n - 1) END) AS a,
             min(CASE WHEN cluster <> k THEN (n * xx - 2 * dot + yy) / n END) AS b,
             max(CASE WHEN cluster = k THEN n END) AS own_n
      FROM pk GROUP BY customer_id, cluster),
s AS (SELECT CASE WHEN own_n <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM d)
SELECT {xmean_sql('s')} AS silhouette, count(*) AS points FROM s""")
def silhouette_rule_clusters(spark, sf_dir):
    return ml.silhouette_sq(_rule_scaled(spark, sf_dir), SKEW_COLS, "cluster")


@register("davies_bouldin_rule_clusters", "M4", "davies_bouldin double, clusters bigint", sql=_scaled_seg_sql() + f""",
cent AS (SELECT cluster, {', '.join(f'{xmean_sql(c)} AS c_{c}' for c in SKEW_COLS)} FROM zs GROUP BY cluster),
sc AS (SELECT zs.cluster, {xmean_sql('sqrt(' + ' + '.join(f'power({c} - c_{c}, 2)' for c in SKEW_COLS) + ')')} AS s
       FROM zs JOIN cent ON zs.cluster = cent.cluster GROUP BY zs.cluster),
cs AS (SELECT cent.*, s FROM cent JOIN sc ON cent.cluster = sc.cluster),
r AS (SELECT a.cluster, max((a.s + b.s) / sqrt({' + '.join(f'power(a.c_{c} - b.c_{c}, 2)' for c in SKEW_COLS)})) AS r
      FROM cs a JOIN cs b ON a.cluster <> b.cluster GROUP BY a.cluster)
SELECT {xmean_sql('r')} AS davies_bouldin, count(*) AS clusters FROM r""")
def davies_bouldin_rule_clusters(spark, sf_dir):
    return ml.davies_bouldin(_rule_scaled(spark, sf_dir), SKEW_COLS, "cluster")


METRIC_COLS = ("accuracy double, precision double, recall double, f1 double, specificity double, roc_auc double, "
               "tp bigint, fp bigint, tn bigint, fn bigint")


def _auc_cte(src: str, label: str, prob: str, name: str = "auc_row") -> str:
    return f"""
cm AS (SELECT count(*) FILTER (WHERE {prob} >= 0.5 AND {label} = 1) AS tp, count(*) FILTER (WHERE {prob} >= 0.5 AND {label} = 0) AS fp,
              count(*) FILTER (WHERE {prob} < 0.5 AND {label} = 0) AS tn, count(*) FILTER (WHERE {prob} < 0.5 AND {label} = 1) AS fn
       FROM {src}),
rk AS (SELECT {label} AS y, (2 * rank() OVER (ORDER BY {prob}) + count(*) OVER (PARTITION BY {prob}) - 1) / 2.0 AS r FROM {src}),
au AS (SELECT sum(CASE WHEN y = 1 THEN r END) AS rs, count(*) FILTER (WHERE y = 1) AS np, count(*) FILTER (WHERE y = 0) AS nn FROM rk),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM cm),
{name} AS (SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
       CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS specificity,
       CASE WHEN np > 0 AND nn > 0 THEN (rs - np * (np + 1) / 2.0) / (np * nn) END AS roc_auc, tp, fp, tn, fn
FROM pr, au)"""


def _auc_sql(src: str, label: str, prob: str) -> str:
    return _auc_cte(src, label, prob) + "\nSELECT * FROM auc_row"


@register("auc_rule_score", "M13", METRIC_COLS, sql=f"WITH {pred_sql()}, {_auc_sql('pred', 'true_churn_flag', 'churn_probability')}")
def auc_rule_score(spark, sf_dir):
    pred = cu.rule_churn_scores(cu.churn_dataset(sales_ledger(spark, sf_dir), CUTOFF, HORIZON))
    return ml.binary_metrics(pred, "true_churn_flag", "churn_probability")


def _churn(spark, sf_dir):
    return cu.churn_dataset(sales_ledger(spark, sf_dir), CUTOFF, HORIZON)


@register("churn_model_metrics", "M9 M11 M12 M13 T9", "model string, " + METRIC_COLS)
def churn_model_metrics(spark, sf_dir):
    metrics, _ = ml.train_churn(_churn(spark, sf_dir), CHURN_FEATURES)
    return metrics


# which customers a fold holds follows a hash, how many of each label does not
@register("churn_cv_folds", "M10", "fold bigint, customers bigint, churn_rate double", sql=f"""WITH {pred_sql()},
n AS (SELECT true_churn_flag, count(*) AS n FROM pred GROUP BY 1),
r AS (SELECT true_churn_flag, unnest(range(1, n + 1)) % 5 AS fold FROM n)
SELECT fold, count(*) AS customers, avg(true_churn_flag) AS churn_rate FROM r GROUP BY fold""")
def churn_cv_folds(spark, sf_dir):
    f = ml.fold_column(_churn(spark, sf_dir), "true_churn_flag", 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("customers"), F.avg("true_churn_flag").alias("churn_rate"))


@register("churn_cv_metrics", "M10 M12 M13", "model string, folds bigint, accuracy double, precision double, recall double, "
          "f1 double, roc_auc double, roc_auc_std double")
def churn_cv_metrics(spark, sf_dir):
    """Means over the folds, and the spread of the AUC."""
    per = ml.cross_validate(_churn(spark, sf_dir), CHURN_FEATURES)
    return per.groupBy("model").agg(F.count(F.lit(1)).alias("folds"), *[
        F.avg(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")],
        F.stddev_pop("roc_auc").alias("roc_auc_std"))


@register("churn_scores", "M14 T9 C13", "customer_id string, churn_probability double, risk_category string, model string")
def churn_scores(spark, sf_dir):
    ch = _churn(spark, sf_dir)
    metrics, fitted = ml.train_churn(ch, CHURN_FEATURES)
    best = ml.champion(metrics).first()["champion"]
    return ml.score_customers(fitted[best], ch, CHURN_FEATURES).select(
        "customer_id", "churn_probability", "risk_category", F.lit(best).alias("model"))


@register("churn_drivers", "M15 Q13", "feature string, importance double, correlation double, direction string, rank bigint")
def churn_drivers(spark, sf_dir):
    ch = _churn(spark, sf_dir)
    _, fitted = ml.train_churn(ch, CHURN_FEATURES, models=("random_forest",))
    return ml.churn_drivers(fitted["random_forest"], ch, CHURN_FEATURES, "true_churn_flag")


@register("churn_permutation_importance", "M16", "feature string, auc_drop double")
def churn_permutation_importance(spark, sf_dir):
    ch = _churn(spark, sf_dir)
    _, fitted = ml.train_churn(ch, CHURN_FEATURES, models=("logistic_regression",))
    return ml.permutation_importance(fitted["logistic_regression"], ch, CHURN_FEATURES, "true_churn_flag")


@register("adf_products", "Q9", "product_id string, nobs bigint, adf_stat double, used_lag bigint, p_value double, stationary bigint, "
          "crit_1pct double, crit_5pct double, crit_10pct double")
def adf_products(spark, sf_dir):
    led = sales_ledger(spark, sf_dir)
    wk = led.groupBy("product_id", cal.week_ending_sunday("date").alias("date")).agg(F.sum("quantity_sold").alias("qty"))
    # weeks without sales between a product's first and last are 0, as all are of lines without a product
    qty = F.when(F.col("product_id").isNull(), 0.0).otherwise(F.coalesce("qty", F.lit(0.0)))
    weeks = wk.where(F.col("date").isNotNull()).withColumn("qty", qty)
    return ml.adf_by_series(weeks, "product_id", "qty", min_obs=20, step_days=7)


@register("model_registry", "E10", "module string, metric string, value double, status string",
          sql=f"""WITH {pred_sql()}, {_auc_cte('pred', 'true_churn_flag', 'churn_probability')},
{NAIVE_CTE.format(season=7).replace('sales AS (', 'sales_unused AS (', 1)},
fm AS (SELECT coalesce({xmean_sql('CASE WHEN actual <> 0 THEN abs((actual - predicted) / actual) END')} * 100.0, 0.0) AS mape
       FROM nz WHERE split = 'Test'),
{inventory_sql(with_sales=False)}, {HEALTH_SQL}
SELECT 'churn' AS module, 'roc_auc' AS metric, roc_auc AS value,
       CASE WHEN roc_auc >= 0.7 THEN 'Production' ELSE 'Review' END AS status FROM auc_row
UNION ALL SELECT 'demand_forecasting', 'test_mape', mape, CASE WHEN mape <= 12.0 THEN 'Production' ELSE 'Review' END FROM fm
UNION ALL SELECT 'inventory', 'health_score', {HEALTH_EXPR}, CASE WHEN {HEALTH_EXPR} >= 50.0 THEN 'Production' ELSE 'Review' END FROM h""")
def model_registry(spark, sf_dir):
    from tillroll.operators import forecasting as fc
    from tillroll.operators import inventory as iv
    led = sales_ledger(spark, sf_dir)
    pred = cu.rule_churn_scores(cu.churn_dataset(led, CUTOFF, HORIZON))
    auc = ml.binary_metrics(pred, "true_churn_flag", "churn_probability").select(
        F.lit("churn").alias("module"), F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    d = ts.densify_daily(ts.daily_sales(led), ["sales_amount", "quantity_sold"])
    fm = fc.forecast_metrics(fc.naive_daily_predictions(d).filter(F.col("split") == "Test")).select(
        F.lit("demand_forecasting").alias("module"), F.lit("test_mape").alias("metric"), F.col("mape").alias("value"))
    hs = iv.health_score(iv.inventory_table(led, stock_balances(spark, sf_dir))).select(
        F.lit("inventory").alias("module"), F.lit("health_score").alias("metric"), F.col("health_score").alias("value"))
    rows = auc.unionByName(fm).unionByName(hs)
    ok = (F.when(F.col("metric") == "roc_auc", F.col("value") >= 0.7)
           .when(F.col("metric") == "test_mape", F.col("value") <= 12.0).otherwise(F.col("value") >= 50.0))
    return rows.withColumn("status", F.when(ok, "Production").otherwise("Review"))
