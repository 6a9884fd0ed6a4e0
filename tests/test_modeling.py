from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators import modeling as M
from tallyward.operators import scoring
from tallyward.sources.contracts import CONTRACTS, contract

SMALL = M.ForestSpec("small", trees=10, depth=4)


def scored(spark, rows):
    """(label, predicted, probability)"""
    schema = "fraud_label int, predicted_fraud_label int, fraud_probability double"
    return spark.createDataFrame(rows, schema)


def rank_sum_auc(rows):
    pos = [p for y, _, p in rows if y == 1]
    neg = [p for y, _, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_auc_special_cases(spark):
    assert M.roc_auc(scored(spark, [(1, 1, 0.5), (0, 0, 0.5)] * 5)) == pytest.approx(0.5)
    assert M.roc_auc(scored(spark, [(1, 1, 0.9), (0, 0, 0.1)] * 5)) == pytest.approx(1.0)
    assert M.roc_auc(scored(spark, [(1, 1, 0.1), (0, 0, 0.9)] * 5)) == pytest.approx(0.0)


def test_auc_equals_the_rank_sum(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), 0, round(rng.random(), 1)) for _ in range(300)]
    assert M.roc_auc(scored(spark, rows)) == pytest.approx(rank_sum_auc(rows))


def test_classification_metrics_by_hand(spark):
    rows = [(1, 1, 0.9)] * 3 + [(0, 1, 0.6)] + [(1, 0, 0.4)] * 2 + [(0, 0, 0.1)] * 4
    found = M.classification_metrics(scored(spark, rows)).first().asDict()
    assert found == pytest.approx(
        {"accuracy": 0.7, "precision": 0.75, "recall": 0.6, "f1_score": 2 / 3}
    )


def test_classification_metrics_without_positives(spark):
    found = M.classification_metrics(scored(spark, [(0, 0, 0.1)])).first().asDict()
    assert found == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}
    empty = M.classification_metrics(scored(spark, [])).first().asDict()
    assert set(empty.values()) == {0.0}


def features(spark, n=600, seed=1):
    """Providers whose label follows the high-reimbursement ratio, with some noise."""
    rng = random.Random(seed)
    names = contract("gold.provider_fraud_features").fieldNames()
    rows = []
    for i in range(n):
        ratio = rng.random()
        row = {
            "Provider": f"P{i}",
            "total_claims": rng.randint(1, 50),
            "high_reimbursement_claim_ratio": ratio,
            "avg_reimbursement_amount": None if i % 40 == 0 else rng.random() * 100,
            "fraud_label": int(ratio + rng.gauss(0, 0.08) > 0.7),
        }
        rows.append(tuple(row.get(c) for c in names))
    return spark.createDataFrame(rows, CONTRACTS["gold.provider_fraud_features"])


def test_model_frame_has_no_nulls(spark):
    frame = M.model_frame(features(spark))
    assert frame.columns == ["Provider", *M.FEATURES, "fraud_label"]
    assert frame.na.drop().count() == frame.count() == 600


def splits(split):
    return {r["Provider"]: r["split"] for r in split.collect()}


@pytest.mark.parametrize("exact", [False, True])
def test_split_is_repeatable_and_complete(spark, exact):
    frame = M.model_frame(features(spark))
    one = splits(M.split_rows(frame, exact=exact))
    two = splits(M.split_rows(frame.repartition(5), exact=exact))
    assert one == two and len(one) == 600
    assert splits(M.split_rows(frame, seed=7, exact=exact)) != one


@pytest.mark.parametrize("share", [0.2, 0.333, 0.9])
def test_exact_split_meets_each_quota(spark, share):
    frame = M.model_frame(features(spark, 500))
    sizes = {r[0]: r[1] for r in frame.groupBy("fraud_label").count().collect()}
    split = M.split_rows(frame, share=share, exact=True)
    test = split.filter("split = 'test'").groupBy("fraud_label").count().collect()
    assert {r[0]: r[1] for r in test} == {
        label: int(n * share + 0.5) for label, n in sizes.items()
    }
    assert split.count() == 500


def test_exact_split_when_cells_hold_many_rows(spark, monkeypatch):
    """With few cells the quota cuts through a cell; the smallest draws of it are test."""
    monkeypatch.setattr(M, "SPLIT_CELLS", 3)
    frame = M.model_frame(features(spark, 400))
    sizes = {r[0]: r[1] for r in frame.groupBy("fraud_label").count().collect()}
    split = M.split_rows(frame, exact=True)
    test = split.filter("split = 'test'").groupBy("fraud_label").count().collect()
    assert {r[0]: r[1] for r in test} == {k: int(n * 0.2 + 0.5) for k, n in sizes.items()}


def test_share_of_the_plain_split(spark):
    frame = spark.range(20000).select(
        F.concat(F.lit("P"), "id").alias("Provider"), (F.col("id") % 10 == 0).cast("int").alias("fraud_label")
    )
    balance = M.class_balance(M.split_rows(frame, exact=False)).collect()
    counts = {(r["split"], r["fraud_label"]): r["count"] for r in balance}
    for label, size in ((0, 18000), (1, 2000)):
        assert counts["test", label] / size == pytest.approx(0.2, abs=0.03)
    shares = {(r["split"], r["fraud_label"]): r["proportion"] for r in balance}
    assert shares["train", 0] + shares["train", 1] == pytest.approx(1.0)


def test_missing_label_on_a_side_is_an_error(spark):
    frame = spark.createDataFrame([("P1", 0), ("P2", 0)], "Provider string, fraud_label int")
    with pytest.raises(ValueError, match="too few providers"):
        M.require_both_labels(M.split_rows(frame))


@pytest.mark.parametrize("labels", [range(8), [0, 1, None]])
def test_labels_outside_the_domain_are_an_error(spark, labels):
    frame = spark.createDataFrame(
        [(f"P{i}", x) for i in range(30) for x in labels], "Provider string, fraud_label int"
    )
    with pytest.raises(ValueError, match="labels must be 0 or 1"):
        M.require_labels(frame)
    M.require_labels(frame.filter("fraud_label IN (0, 1)"))
    for exact in (False, True):  # no row is lost on the way
        split = M.split_rows(frame, exact=exact)
        assert split.count() == frame.count()
        unused = split.filter("split = 'unused'")
        assert unused.count() == frame.filter("fraud_label IS NULL OR fraud_label > 1").count()
    assert M.weigh(frame).count() == frame.count()


def test_the_model_does_not_depend_on_the_layout(spark):
    rows = M.model_frame(features(spark, 200))
    found = []
    for partitions in (1, 4, 7):
        model = M.fit_forest(rows.repartition(partitions), SMALL)
        scores = M.predict(model, rows).select("Provider", "fraud_probability").collect()
        found.append({r[0]: r[1] for r in scores})
    assert found[0] == found[1] == found[2]


def test_planning_a_fit_runs_no_job(spark):
    frame = M.split_rows(M.model_frame(features(spark, 50)))
    spark.sparkContext.setJobGroup("plan-only", "")
    try:
        M.training_rows(frame, SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_balanced_weights(spark):
    frame = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "fraud_label int")
    found = {r[0]: r[1] for r in M.class_weights(frame).collect()}
    assert found == pytest.approx({0: 8 / 12, 1: 8 / 4})
    total = M.weigh(frame).groupBy("fraud_label").agg(F.sum("class_weight")).collect()
    assert [r[1] for r in total] == pytest.approx([4.0, 4.0])


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    split = M.split_rows(M.model_frame(features(spark)), exact=True)
    return M.train_candidate(split, SMALL, str(tmp_path_factory.mktemp("models")))


def test_forest_separates(run):
    assert run.metrics["roc_auc"] > 0.9
    assert set(run.metrics) == {"accuracy", "precision", "recall", "f1_score", "roc_auc"}


def test_importance_names_the_feature_that_matters(spark, run):
    ranked = M.feature_importance(spark, run.model).orderBy(F.desc("importance_score")).collect()
    assert len(ranked) == 18 and ranked[0]["feature_name"] == "high_reimbursement_claim_ratio"
    assert sum(r["importance_score"] for r in ranked) == pytest.approx(1.0)


def test_scoring_a_stored_model(spark, run):
    from pyspark.ml import PipelineModel

    table = features(spark, 200, seed=9).withColumn(
        "fraud_label", F.when(F.col("total_claims") > 5, F.col("fraud_label"))
    )
    out = scoring.score_providers(PipelineModel.load(run.path), table)
    wanted = contract("gold.provider_fraud_predictions")
    assert out.schema.simpleString() == wanted.simpleString()
    rows = out.collect()
    assert len(rows) == 200
    for r in rows:
        assert 0 <= r["fraud_probability"] <= 1
        assert r["predicted_fraud_label"] == int(r["fraud_probability"] > 0.5)
        band = "High Risk" if r["fraud_probability"] >= 0.8 else (
            "Medium Risk" if r["fraud_probability"] >= 0.5 else "Low Risk"
        )
        assert r["fraud_risk_category"] == band
    missing = {r["Provider"] for r in table.filter("fraud_label IS NULL").collect()}
    assert {r["Provider"] for r in rows if r["fraud_label"] is None} == missing


def runs_table(spark, rows):
    """(run_id, roc_auc, day)"""
    names = contract("models.model_runs").fieldNames()
    data = [
        tuple(
            dict(run_id=i, roc_auc=a, created_at=dt.datetime(2024, 1, d)).get(c) for c in names
        )
        for i, a, d in rows
    ]
    return spark.createDataFrame(data, CONTRACTS["models.model_runs"])


def test_best_run(spark):
    def best(rows):
        return M.best_run(runs_table(spark, rows)).first()["run_id"]

    assert best([("a", 0.8, 1), ("b", 0.9, 1)]) == "b"
    assert best([("a", 0.9, 2), ("b", 0.9, 1)]) == "a"
    assert best([("b", 0.9, 1), ("a", 0.9, 1)]) == "a"
    assert best([("a", float("nan"), 2), ("b", 0.4, 1), ("c", None, 3)]) == "b"


def test_champion_is_the_newest_version(spark):
    best = runs_table(spark, [("a", 0.8, 1)])
    one = M.registry_entry(best, "m", 1, "first", {"project": "x"})
    two = M.registry_entry(best, "m", 2, "second", {"project": "x"})
    other = M.registry_entry(best, "other", 9, "third", {"project": "x"})
    row = M.champion(one.unionByName(two).unionByName(other), "m").first()
    assert (row["version"], row["description"]) == (2, "second")
    assert row["tags"] == {"project": "x", "metric_roc_auc": "0.8"}
    assert one.schema.simpleString() == contract("models.model_registry").simpleString()


def test_run_log(spark, run):
    log = M.run_log(spark, [run])
    assert log.schema.simpleString() == contract("models.model_runs").simpleString()
    row = log.first()
    assert (row["n_estimators"], row["max_depth"], row["class_weight"]) == (10, 4, "balanced")
    assert row["training_partitions"] == SMALL.partitions


def test_prompt(spark):
    rows = [("P1", 0.85, 12, 100.5, 1.5, "High Risk"), ("P2", 0.1, 3, None, 1.0, "Low Risk")]
    df = spark.createDataFrame(
        rows,
        "Provider string, fraud_probability double, total_claims bigint, "
        "avg_reimbursement_amount double, claims_per_beneficiary double, fraud_risk_category string",
    )
    one, two = (r["fraud_analysis_prompt"] for r in scoring.add_prompts(df).collect())
    assert one == (
        "Analyze this healthcare provider.\n\nProvider: P1\nFraud Probability: 0.85\n"
        "Total Claims: 12\nAverage Reimbursement: 100.5\nClaims Per Beneficiary: 1.5\n"
        "Risk Category: High Risk\n\nExplain why this provider may be suspicious."
    )
    assert two is None
    fixed = [r["fraud_analysis_prompt"] for r in scoring.add_prompts(df, decimals=2).collect()]
    assert "Reimbursement: 100.50\n" in fixed[0] and fixed[1] is None
