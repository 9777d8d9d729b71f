"""Physical-plan guards from tools/plan_audit.py."""

import os
import sys

import pytest

import __spark_entry__ as e

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_audit import audit  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,budget", [("davies_bouldin_rule_clusters", 20), ("customer_360", 20),
                                         ("silhouette_rule_clusters", 10), ("executive_kpis", 20)])
def test_composite_plans_stay_within_shuffle_budget(spark, name, budget):
    assert audit(e.queries()[name](spark, SF))["shuffles"] <= budget


def test_point_in_time_scan_pushes_date_filters(spark):
    df = e.queries()["churn_dataset"](spark, SF)
    # the plan root is a checkpoint; inspect the label branch that scans the ledger
    from tillroll.operators import customers as cu
    from tillroll.sources.ledger import sales_ledger
    led = sales_ledger(spark, SF)
    plan = cu.customer_base(led, "2001-05-01")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(date" in plan and df.count() > 0


def test_entity_plans_use_no_python(spark):
    for name in ("customer_features", "inventory_master", "daily_features", "product_features"):
        assert audit(e.queries()[name](spark, SF))["python"] == 0
