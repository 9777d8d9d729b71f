"""Plans on fitted forecasting models (D6q–D11q, and what is served from them: D14q, D15q,
E3–E6, E10, W18, W22, W23).

The learners have no SQL form: tests hold the booster, the search, the recursion and the
panel's training rows against plain versions.  The naive forecasts keep their own plans.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import customers as cu
from tillroll.operators import decisions as de
from tillroll.operators import forecasting as fc
from tillroll.operators import inventory as iv
from tillroll.operators import ml
from tillroll.operators import model_forecasts as mf
from tillroll.operators import panel_forecast as pf
from tillroll.operators import timeseries as ts
from tillroll.plans.catalog import register
from tillroll.plans.customers import CUTOFF, HORIZON
from tillroll.session import cut_lineage
from tillroll.sources.ledger import sales_ledger, stock_balances

METRICS = "n bigint, mape double, mae double, rmse double, r2 double"
FUTURE = "step bigint, date date, forecast double, last_actual double, growth_from_last_historical double"


def _weekly_table(spark, sf_dir):
    daily = ts.densify_daily(ts.daily_sales(sales_ledger(spark, sf_dir)), ["sales_amount", "quantity_sold"])
    return cut_lineage(mf.weekly_table(daily))


def _daily_table(spark, sf_dir):
    return cut_lineage(mf.daily_table(ts.daily_features(sales_ledger(spark, sf_dir))))


def _served(spark, sf_dir):
    return cut_lineage(mf.weekly_forecast(_weekly_table(spark, sf_dir), mf.served_job(spark)))


@register("forecast_search", "D7q", "trial bigint, rounds bigint, step_size double:8, max_depth bigint, min_child_weight double, "
          "row_share double, feature_share double, reg_alpha double:12, reg_lambda double:12, val_mape double, is_best bigint")
def forecast_search(spark, sf_dir):
    return mf.search(spark, _weekly_table(spark, sf_dir), mf.search_settings(100))


@register("forecast_search_metrics", "D7q D4q D5q", f"split string, {METRICS}")
def forecast_search_metrics(spark, sf_dir):
    """The best of the hundred trials, fitted again and measured on every split."""
    table = _weekly_table(spark, sf_dir)
    best = cut_lineage(mf.search(spark, table, mf.search_settings(100))).where("is_best = 1")
    return mf.split_metrics(table, best.select(mf.SETTING_NAMES))


@register("weekly_model_metrics", "D4q D5q W26", f"split string, {METRICS}")
def weekly_model_metrics(spark, sf_dir):
    return mf.split_metrics(_weekly_table(spark, sf_dir), mf.served_job(spark))


@register("weekly_model_history", "D11q W25", "date date, actual double, predicted double, split string")
def weekly_model_history(spark, sf_dir):
    return mf.weekly_history(_weekly_table(spark, sf_dir), mf.served_job(spark))


@register("weekly_model_forecast", "D10q", FUTURE)
def weekly_model_forecast(spark, sf_dir):
    return _served(spark, sf_dir)


@register("weekly_model_summary", "D15q T8 W22 W23 E4", "total_forecast double, mean_forecast double, peak_forecast double, "
          "peak_date date, slope double, trend string, pct_change_ahead double, direction string")
def weekly_model_summary(spark, sf_dir):
    future = _served(spark, sf_dir)
    return fc.forecast_summary(future).crossJoin(fc.trend_label(future))  # one row each


@register("weekly_model_alerts", "E3 W18 E12", "date date, forecast double, wow_growth double, alert string, holiday_peak bigint, label string")
def weekly_model_alerts(spark, sf_dir):
    return fc.label_weeks(fc.demand_alerts(_served(spark, sf_dir)))


@register("model_alert_summary", "E5 E6",
          "high_risk_customers bigint, revenue_at_risk double, critical_products bigint, immediate_reorders bigint, "
          "surges bigint, drops bigint, holiday_peaks bigint, next_surge_week date, critical_alerts bigint, "
          "warning_alerts bigint, opportunity_alerts bigint, total_alerts bigint")
def model_alert_summary(spark, sf_dir):
    """The alert roll-up on the fitted champion's churn scores and the fitted weekly forecast."""
    led = sales_ledger(spark, sf_dir)
    return de.alert_summary(_fitted_scores(led)[0], iv.inventory_table(led, stock_balances(spark, sf_dir)),
                            fc.demand_alerts(_served(spark, sf_dir)))


@register("weekly_model_document", "D14q D11q S4", "kind string, date date, actual double, predicted double, forecast double, split string, "
          "test_mape double")
def weekly_model_document(spark, sf_dir):
    """The nested forecast document of the served model, unpacked again."""
    table = _weekly_table(spark, sf_dir)
    job = mf.served_job(spark)
    test = mf.split_metrics(table, job).where("split = 'Test'").first()
    doc = fc.forecast_document(mf.weekly_history(table, job), mf.weekly_forecast(table, job),
                               {"granularity": "Weekly", "horizon": "8 Weeks", "test_mape": test["mape"] if test else None})
    past = doc.select(F.col("model_info.test_mape").cast("double").alias("test_mape"), F.inline("historical")).withColumns(
        {"kind": F.lit("historical"), "forecast": F.lit(None).cast("double")})
    ahead = doc.select(F.col("model_info.test_mape").cast("double").alias("test_mape"), F.inline("future")).withColumns(
        {"kind": F.lit("future"), "actual": F.lit(None).cast("double"), "predicted": F.lit(None).cast("double"), "split": F.lit(None).cast("string")})
    return past.unionByName(ahead.drop("growth_from_last_historical")).withColumn("date", F.to_date("date"))


@register("forecast_gbt_metrics", "D6q D4q P17", f"model string, target string, split string, rounds bigint, {METRICS}")
def forecast_gbt_metrics(spark, sf_dir):
    return mf.daily_metrics(spark, _daily_table(spark, sf_dir))


@register("forecast_gbt_comparison", "D8q", "winner string, winner_mape double, meets_target bigint")
def forecast_gbt_comparison(spark, sf_dir):
    return mf.series_metric_winner(mf.daily_metrics(spark, _daily_table(spark, sf_dir)))


@register("forecast_daily_recursive", "D9q", "model string, test_mape double, step bigint, date date, sales_forecast double, "
          "quantity_forecast double")
def forecast_daily_recursive(spark, sf_dir):
    return mf.daily_forecast(spark, _daily_table(spark, sf_dir))


@register("forecast_recursive_products", "D9q", "product_id string, date date, step bigint, forecast double")
def forecast_recursive_products(spark, sf_dir):
    pdy = ts.product_daily(sales_ledger(spark, sf_dir)).select("product_id", "date", F.col("daily_quantity_sold").alias("qty"))
    return pf.forecast_recursive(pdy, "product_id", "qty", horizon=30)


def _fitted_scores(led):
    """Every customer's churn probability by the fitted champion; its metrics (one row)."""
    from tillroll.plans.models import CHURN_FEATURES
    ch = cu.churn_dataset(led, CUTOFF, HORIZON)
    metrics, fitted = ml.train_churn(ch, CHURN_FEATURES)
    metrics = cut_lineage(metrics)
    best = ml.champion(metrics).first()["champion"]
    return cut_lineage(ml.score_customers(fitted[best], ch, CHURN_FEATURES)), metrics.where(F.col("model") == best)


@register("model_registry_fitted", "E10", "module string, model string, metric string, value double, status string")
def model_registry_fitted(spark, sf_dir):
    """The registry of the fitted models: churn champion, weekly and daily forecasts."""
    _, best = _fitted_scores(sales_ledger(spark, sf_dir))
    weekly = mf.split_metrics(_weekly_table(spark, sf_dir), mf.served_job(spark)).where("split = 'Test'")
    daily = mf.series_metric_winner(mf.daily_metrics(spark, _daily_table(spark, sf_dir)))
    rows = best.select(F.lit("churn").alias("module"), "model", F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    rows = rows.unionByName(weekly.select(F.lit("weekly_forecast").alias("module"), F.lit("served").alias("model"),
                                          F.lit("test_mape").alias("metric"), F.col("mape").alias("value")))
    rows = rows.unionByName(daily.select(F.lit("daily_forecast").alias("module"), F.col("winner").alias("model"),
                                         F.lit("test_mape").alias("metric"), F.col("winner_mape").alias("value")))
    ok = F.when(F.col("metric") == "roc_auc", F.col("value") >= 0.7).otherwise(F.col("value") <= fc.MAPE_TARGET)
    return rows.withColumn("status", F.when(ok, "Production").otherwise("Review"))
