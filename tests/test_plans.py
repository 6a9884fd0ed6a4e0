"""Physical plans: what must and must not appear in them."""

from __future__ import annotations

import pytest

from tallyward.operators import analyst, checks, dashboard, features
from tallyward.plans import queries as Q
from tallyward.sources.contracts import CONTRACTS

# One query for each shape of plan.
SHAPES = """
    a03_source_access b01_dedupe_inpatient c10_layer_metrics c21_inpatient_quarantine
    c23_unified_valid d01_claims_with_beneficiary d08_part_features d12_analytics
    d13_counts_by_segment e01_claim_checks e04_metric_union e05_prediction_quarantine
    e07_latest_rows e09_label_distribution f02_split f02_split_exact f05_class_weights
    f09_class_balance f17_prompts g05_concentrated_scored i02_aggregate_consistency
    i03_metric_drift i04_investigation_context i05_risk_by_quality
""".split()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


PYTHON = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
ALL_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")
# Their broadcast side has at most two labels times a fixed number of rows.
BOUNDED = {"f02_split_exact", "f09_class_balance"}


@pytest.mark.parametrize("name", SHAPES)
def test_plan_holds_at_scale(spark, sf_dir, no_broadcast, name):
    """No Python, no all-pairs join, and no broadcast but those of proven size."""
    plan = plan_of(Q.QUERIES[name](spark, sf_dir))
    assert [w for w in PYTHON + ALL_PAIRS if w in plan] == []
    assert ("BroadcastHashJoin" in plan) == (name in BOUNDED)


@pytest.fixture
def stored_features(spark, sf_dir, tmp_path):
    path = str(tmp_path / "features")
    Q.gold(spark, sf_dir, Q.PART).write.parquet(path)
    return spark.read.parquet(path)


def test_checks_scan_twice_and_move_only_the_key(stored_features):
    plan = plan_of(checks.run_checks(stored_features, checks.FEATURE_CHECKS))
    assert plan.count("FileScan") == 2
    assert plan.count("ReadSchema: struct<Provider:string>") == 1
    assert plan.count("hashpartitioning") == 1


def test_gold_validation_scans_twice(stored_features):
    assert plan_of(checks.validate_features(stored_features)).count("FileScan") == 2


def test_filters_reach_the_scan(stored_features):
    plan = plan_of(analyst.concentrated_features(stored_features))
    assert "GreaterThanOrEqual(total_claims,10)" in plan
    assert "TakeOrderedAndProject" in plan
    assert "avg_deductible_amount" not in plan


def test_label_pattern_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "history")
    spark.createDataFrame([], CONTRACTS["quality.data_quality_metrics"]).write.parquet(path)
    history = spark.read.parquet(path)
    assert "StringStartsWith(metric_name,null)" in plan_of(
        dashboard.null_percentages(history)
    )
    assert "WindowGroupLimit" in plan_of(dashboard.latest_rows(history))


def test_gold_sums_per_visit_before_the_join(spark, sf_dir, no_broadcast):
    """Claims meet the beneficiaries only after they are summed per provider and beneficiary."""
    claims = features.claim_indicators(Q.claims(spark, sf_dir))
    plan = plan_of(features.provider_totals(claims, Q.valid(Q.BENE, spark, sf_dir)))
    join = plan.index("SortMergeJoin [BeneID")
    assert "HashAggregate(keys=[Provider" in plan[:join]
    assert "HashAggregate(keys=[Provider" in plan[join:]
    assert "Expand" not in plan
