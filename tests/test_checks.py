from __future__ import annotations

import pytest

from tallyward.operators import checks, silver
from tallyward.plans import queries as Q
from tallyward.sources.contracts import contract

SUITE = checks.CheckSuite("t", "k", required=("k", "v"), non_negative=("v",), ratios=("r",))


def values(metrics):
    return {r["metric_name"]: r["metric_value"] for r in metrics.collect()}


def test_run_checks_by_hand(spark):
    rows = [
        ("a", 1, 0.5),
        ("a", -1, 1.5),
        ("b", None, -0.1),
        (None, 3, None),
        (None, 4, 1.0),
        ("c", 0, float("nan")),
    ]
    found = values(checks.run_checks(spark.createDataFrame(rows, "k string, v int, r double"), SUITE))
    assert found == pytest.approx(
        {
            "total_records": 6.0,
            "duplicate_primary_key_count": 2.0,  # "a", and null once
            "missing_primary_key_count": 2.0,
            "null_count_k": 2.0,
            "null_percent_k": 100 / 3,
            "null_count_v": 1.0,
            "null_percent_v": 100 / 6,
            "negative_value_count_v": 1.0,
            "invalid_ratio_count_r": 3.0,  # NaN is above every number
        }
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, v int, r double")
    found = checks.run_checks(empty, SUITE)
    assert set(values(found).values()) == {0.0} and found.count() == 9
    assert found.drop("metric_timestamp").dtypes == [
        ("table_name", "string"),
        ("metric_name", "string"),
        ("metric_value", "double"),
    ]
    features = spark.createDataFrame([], contract("gold.provider_fraud_features"))
    assert set(values(checks.validate_features(features)).values()) == {0.0}
    assert checks.label_distribution(features).count() == 0


def test_metrics_have_the_history_contract(spark, sf_dir):
    wanted = contract("quality.data_quality_metrics").simpleString()
    assert Q.layer_metrics(spark, sf_dir).schema.simpleString() == wanted
    gold = Q.gold(spark, sf_dir)
    for made in (
        checks.run_checks(gold, checks.FEATURE_CHECKS),
        checks.validate_features(gold),
        checks.label_distribution(gold),
    ):
        assert made.schema.simpleString() == wanted


def test_layer_metrics_add_up(spark, sf_dir):
    for entity in silver.ENTITIES:
        found = values(checks.layer_metrics(entity, Q.flagged(entity, spark, sf_dir)))
        assert found["total_records"] == Q.raw(entity, spark, sf_dir).count()
        parts = ("valid_records", "quarantine_records", entity.duplicates_metric)
        assert sum(found[p] for p in parts) == found["total_records"]


def test_label_metrics_sum_to_the_providers(spark, sf_dir):
    gold = Q.gold(spark, sf_dir)
    assert sum(values(checks.label_distribution(gold)).values()) == gold.count()


def test_an_unfilled_label_has_no_metric_name(spark):
    df = spark.createDataFrame([(None,), (1,)], "fraud_label int")
    names = {r["metric_name"] for r in checks.label_distribution(df).collect()}
    assert names == {None, "fraud_label_1"}


def predictions(spark, rows):
    names = contract("gold.provider_fraud_predictions").fieldNames()
    keys = (
        "Provider", "fraud_probability", "total_claims", "avg_reimbursement_amount",
        "claims_per_beneficiary",
    )
    data = [tuple(dict(zip(keys, r)).get(c) for c in names) for r in rows]
    return spark.createDataFrame(data, contract("gold.provider_fraud_predictions"))


def test_prediction_quarantine(spark):
    rows = [
        ("ok", 0.0, 1, 1.0, 1.0),
        ("one", 1.0, 0, 0.0, None),
        ("low", -0.1, 1, 1.0, 1.0),
        ("high", 1.1, 1, 1.0, 1.0),
        ("nan", float("nan"), 1, 1.0, 1.0),
        ("none", None, 1, 1.0, 1.0),
        (None, 0.5, 1, 1.0, 1.0),
        ("all", None, -1, -1.0, -1.0),
    ]
    found = checks.quarantine_predictions(predictions(spark, rows))
    assert {r["Provider"]: r["dq_reason"] for r in found.collect()} == {
        "low": "Invalid Fraud Probability",
        "high": "Invalid Fraud Probability",
        "nan": "Invalid Fraud Probability",
        "none": "Missing Fraud Probability",
        None: "Missing Provider",
        "all": "Missing Fraud Probability, Negative Total Claims, Negative Avg Reimbursement, "
        "Negative Claims Per Beneficiary",
    }
    wanted = contract("quality.quarantine_provider_fraud_predictions")
    assert found.columns == wanted.fieldNames()
