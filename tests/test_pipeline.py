"""The whole batch, once by path and once in the session catalog."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyward.operators import analyst, dashboard, silver
from tallyward.operators import modeling as M
from tallyward.plans import pipeline as P
from tallyward.plans import queries as Q
from tallyward.sources import derived
from tallyward.sources.contracts import contract
from tallyward.sources.store import TableStore

SPECS = (M.ForestSpec("one", trees=5, depth=3), M.ForestSpec("two", trees=8, depth=4))


@pytest.fixture(scope="module", params=["path", "catalog"])
def batch(request, spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp(request.param)
    store = TableStore(spark, str(folder / "tables") if request.param == "path" else None)
    store.create_layers()
    for name, df in derived.bronze_tables(spark, sf_dir, derived.PART_GRAIN).items():
        store.overwrite(df, name)
    batch = P.Batch(store, Q.as_of(), Q.run_ts())
    batch.run(str(folder / "models"), SPECS)
    yield batch
    if store.root is None:
        for layer in ("bronze", "silver", "gold", "monitoring", "quality", "models"):
            spark.sql(f"DROP DATABASE {layer} CASCADE")


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    one, two = (sorted(map(repr, Q.stable(d.select(columns)).collect())) for d in (left, right))
    assert one == two


@pytest.mark.parametrize("entity", silver.ENTITIES, ids=lambda e: e.name)
def test_stored_rows_equal_the_lazy_ones(spark, sf_dir, batch, entity):
    same(batch.valid(entity), Q.valid(entity, spark, sf_dir, derived.PART_GRAIN))
    same(batch.quarantined(entity), Q.quarantined(entity, spark, sf_dir, derived.PART_GRAIN))


def test_features_equal_the_lazy_ones(spark, sf_dir, batch):
    same(batch.store.read(P.FEATURES), Q.gold(spark, sf_dir, derived.PART_GRAIN))


def test_layer_metrics_equal_the_lazy_ones(spark, sf_dir, batch):
    logged = batch.store.read(P.HISTORY).filter(
        F.col("table_name").isin(*[e.name for e in silver.ENTITIES], "unified_claims")
    )
    assert logged.count() == 19
    metrics = {(r[0], r[1]): r[2] for r in logged.collect()}
    assert metrics["provider_labels", "total_records"] == 200
    assert metrics["unified_claims", "valid_records"] == batch.unified().count()


def test_every_table_keeps_its_contract(batch):
    for name in (
        P.FEATURES,
        "gold.provider_fraud_analytics",
        P.PREDICTIONS,
        "gold.provider_fraud_ai_input",
        "gold.model_feature_importance",
        P.HISTORY,
        "quality.quarantine_provider_fraud_predictions",
        "quality.dq_dashboard_summary",
        P.RUNS,
        P.REGISTRY,
    ):
        found, wanted = batch.store.read(name).schema, contract(name)
        assert found.simpleString() == wanted.simpleString(), name


def test_the_champion_has_the_best_auc(batch):
    runs = {r["run_id"]: r["roc_auc"] for r in batch.store.read(P.RUNS).collect()}
    row = M.champion(batch.store.read(P.REGISTRY), P.MODEL_NAME).first()
    assert runs[row["run_id"]] == max(runs.values()) and row["version"] == 1
    assert float(row["tags"]["metric_roc_auc"]) == runs[row["run_id"]]


def test_training_again_adds_a_version(batch, tmp_path):
    batch.train(str(tmp_path), SPECS[:1])
    assert M.champion(batch.store.read(P.REGISTRY), P.MODEL_NAME).first()["version"] == 2
    assert batch.store.read(P.RUNS).count() == 3


def test_every_provider_is_scored_and_prompted(batch):
    providers = batch.store.read(P.FEATURES).count()
    predictions = batch.store.read(P.PREDICTIONS)
    assert predictions.count() == providers
    assert predictions.filter("fraud_probability BETWEEN 0 AND 1").count() == providers
    prompts = batch.store.read("gold.provider_fraud_ai_input")
    assert prompts.filter("fraud_analysis_prompt LIKE 'Analyze%'").count() == providers


def test_reports_run_on_the_stored_tables(batch):
    read = batch.store.read
    predictions, history = read(P.PREDICTIONS), read(P.HISTORY)
    assert analyst.top_providers(predictions).count() == 25
    assert analyst.concentrated_providers(read(P.FEATURES), predictions).count() == 50
    assert analyst.top_prompts(read("gold.provider_fraud_ai_input")).count() == 20
    assert analyst.importance_ranking(read("gold.model_feature_importance")).count() == 18
    counted = analyst.actual_and_predicted(predictions).agg(F.sum("provider_count")).first()[0]
    assert counted == predictions.count()
    shown = dashboard.quality_summary(read("quality.dq_dashboard_summary"))
    assert shown.count() == history.select("table_name", "metric_name").distinct().count()
    assert dashboard.quarantine_metrics(history).count() == 5
    assert dashboard.null_percentages(history).count() == 15
    assert dashboard.label_metrics(history).count() == 2


def test_views_show_the_split(spark, batch):
    read = batch.store.read
    for entity in silver.ENTITIES:
        same(read(entity.silver), batch.valid(entity))
        same(read(entity.quarantine), batch.quarantined(entity))
    same(read("silver.unified_claims"), batch.unified().drop("quarantine_reason"))
    assert read("monitoring.quarantine_unified_claims").count() == 0


def test_published_rows_are_read_from_their_folder_only(batch):
    plan = batch.store.read("silver.inpatient_claims").select("ClaimID")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dq_is_valid" in text


def test_the_dashboard_with_ties(batch):
    same(batch.store.read("quality.dq_dashboard_summary_with_ties"), dashboard.latest_rows(batch.store.read(P.HISTORY)))


def test_training_reads_the_stored_split(batch):
    split = batch.store.read(P.SPLIT)
    shares = {(r[0], r[1]): r[2] for r in split.groupBy("split", M.LABEL).count().collect()}
    for label in M.CLASSES:
        n = shares["train", label] + shares["test", label]
        assert shares["test", label] == int(n * M.TEST_SHARE + 0.5)
    plan = M.training_rows(split.filter("split = 'train'"), SPECS[0])._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Relation [") <= 2  # rows and class weights
    scores = batch.store.read("models.test_scores_one")
    assert scores.count() == split.filter("split = 'test'").count()


def test_valid_rows_are_read_from_their_folder_only(batch):
    df = batch.valid(silver.INPATIENT_CLAIMS).select("ClaimID")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dq_is_valid" in plan


def test_a_named_run_can_be_run_again(spark, sf_dir, tmp_path):
    """Run twice, the second time after a run that was lost on its way: equal tables."""
    store = TableStore(spark, str(tmp_path / "tables"))
    for name, df in derived.bronze_tables(spark, sf_dir, derived.PART_GRAIN).items():
        store.overwrite(df, name)
    batch = P.Batch(store, Q.as_of(), Q.run_ts(), "2024-01-01")
    batch.run(str(tmp_path / "models"), SPECS[:1])
    names = [P.HISTORY, P.RUNS, P.REGISTRY, P.FEATURES, P.PREDICTIONS, "silver.unified_claims"]

    def shown(name):
        return sorted(map(str, Q.stable(store.read(name)).collect()))

    before = {name: shown(name) for name in names}
    batch.build_silver()  # lost after this
    batch.run(str(tmp_path / "models"), SPECS[:1])
    for name in names:
        assert shown(name) == before[name], name
