"""The whole batch: raw tables to silver, gold, models, predictions and quality tables.

Each stage writes its result and the next one reads it back, so a lost executor costs the tasks of
one stage, and valid rows, quarantined rows and metrics always describe the same data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame

from tallyward.operators import checks, dashboard, features, modeling, scoring, silver
from tallyward.sources.contracts import conform, contract
from tallyward.sources.store import TableStore

HISTORY = "quality.data_quality_metrics"
FEATURES = "gold.provider_fraud_features"
PREDICTIONS = "gold.provider_fraud_predictions"
RUNS, REGISTRY = "models.model_runs", "models.model_registry"
SPLIT = "models.training_split"
MODEL_NAME = "provider_risk_model"
STAGED = "_staged"


@dataclass(frozen=True)
class Batch:
    """Where to read and write, the clock of the run, and its name.

    A run that is named can be run again after a failure: what it had appended stays once. That needs
    a store in folders, where every write is whole or not there.
    """

    store: TableStore
    as_of: Column | None = None
    run_ts: Column | None = None
    run_id: str | None = None

    def batch(self, step: str) -> str | None:
        """The name under which a step of this run appends."""
        return f"{self.run_id}/{step}" if self.run_id else None

    # silver ------------------------------------------------------------------

    def build_entity(self, entity: silver.Entity) -> None:
        """Stage the flagged rows once, split by folder, and log the metrics."""
        staged = entity.staged(self.store.read(entity.raw), self.as_of, self.run_ts)
        name = entity.silver + STAGED
        stored = self.store.overwrite(staged, name, ["dq_is_valid"])
        columns = [c for c in stored.columns if c != silver.COPIES]
        kept = [c for c in columns if c != "quarantine_reason"]
        self.store.publish_view(entity.silver, name, "dq_is_valid = 1", kept)
        self.store.publish_view(entity.quarantine, name, "dq_is_valid = 0", columns)
        self.log(checks.layer_metrics(entity, stored, self.run_ts), entity.name)

    def valid(self, entity: silver.Entity) -> DataFrame:
        """Valid rows of a staged entity: reads the valid folder only."""
        staged = self.store.read(entity.silver + STAGED)
        return entity.valid(staged).drop("quarantine_reason")

    def quarantined(self, entity: silver.Entity) -> DataFrame:
        staged = self.store.read(entity.silver + STAGED)
        return staged.filter("dq_is_valid = 0").drop(silver.COPIES)

    def build_unified(self) -> None:
        unified = silver.unify_claims(
            self.valid(silver.INPATIENT_CLAIMS), self.valid(silver.OUTPATIENT_CLAIMS)
        )
        staged = silver.flag_unified(unified).withColumn(
            "quarantine_reason", silver.flagged_reasons(silver.UNIFIED_RULES)
        )
        name = "silver.unified_claims" + STAGED
        valid = silver.UNIFIED_VALID
        stored = self.store.overwrite(staged, name, [valid])
        kept = [c for c in stored.columns if c != "quarantine_reason"]
        self.store.publish_view("silver.unified_claims", name, f"{valid} = 1", kept)
        self.store.publish_view(
            "monitoring.quarantine_unified_claims", name, f"{valid} = 0", stored.columns
        )
        self.log(checks.unified_metrics(stored, self.run_ts), "unified_claims")

    def unified(self) -> DataFrame:
        return silver.valid_unified(self.store.read("silver.unified_claims" + STAGED))

    def build_silver(self) -> None:
        for entity in silver.ENTITIES:
            self.build_entity(entity)
        self.build_unified()

    # gold --------------------------------------------------------------------

    def build_gold(self) -> None:
        table = features.provider_features(
            self.unified(),
            self.valid(silver.BENEFICIARY),
            self.valid(silver.PROVIDER_LABELS),
            self.run_ts,
        )
        stored = self.store.overwrite(table, FEATURES)
        self.store.overwrite(
            features.provider_analytics(stored), "gold.provider_fraud_analytics"
        )

    # models ------------------------------------------------------------------

    def train(self, model_root: str, specs=modeling.CANDIDATES, exact: bool = True) -> None:
        """Fit all candidates, log them, promote the best and publish its importances.

        The split is stored once and read by every fit; so are the scored test rows of each run.
        """
        spark = self.store.spark
        frame = modeling.model_frame(self.store.read(FEATURES))
        modeling.require_labels(frame)
        split = self.store.overwrite(modeling.split_rows(frame, exact=exact), SPLIT)
        modeling.require_both_labels(split)
        runs = [
            modeling.train_candidate(
                split,
                spec,
                model_root,
                lambda scores, spec=spec: self.store.overwrite(
                    scores, f"models.test_scores_{spec.run_name}"
                ),
            )
            for spec in specs
        ]
        log = self.store.append(
            modeling.run_log(spark, runs, self.run_ts), RUNS, contract(RUNS), self.batch("runs")
        )
        best = modeling.best_run(log)
        entry = modeling.registry_entry(
            best,
            MODEL_NAME,
            self.next_version(),
            f"Random forest on the provider features of {FEATURES}.",
            {"project": "provider_risk", "source_table": FEATURES},
            self.run_ts,
        )
        self.store.append(entry, REGISTRY, contract(REGISTRY), self.batch("champion"))
        self.store.overwrite(
            modeling.feature_importance(spark, self.champion_model()),
            "gold.model_feature_importance",
        )

    def next_version(self) -> int:
        if not self.store.exists(REGISTRY):
            return 1
        newest = modeling.champion(self.store.read(REGISTRY), MODEL_NAME).first()
        return newest["version"] + 1 if newest else 1

    def champion_model(self) -> PipelineModel:
        row = modeling.champion(self.store.read(REGISTRY), MODEL_NAME).first()
        return PipelineModel.load(row["path"])

    # scoring -----------------------------------------------------------------

    def score(self) -> None:
        table = conform(self.store.read(FEATURES), contract(FEATURES))
        scored = scoring.score_providers(self.champion_model(), table, self.run_ts)
        stored = self.store.overwrite(scored, PREDICTIONS)
        self.store.overwrite_checked(
            scoring.add_prompts(stored),
            "gold.provider_fraud_ai_input",
            contract("gold.provider_fraud_ai_input"),
        )

    # quality -----------------------------------------------------------------

    def log(self, metrics: DataFrame, step: str) -> None:
        self.store.append(metrics, HISTORY, contract(HISTORY), self.batch(step))

    def check_quality(self) -> None:
        """Check features and predictions, quarantine predictions, refresh the dashboard."""
        table, predictions = self.store.read(FEATURES), self.store.read(PREDICTIONS)
        found = [
            checks.run_checks(table, checks.FEATURE_CHECKS, self.run_ts),
            checks.run_checks(predictions, checks.PREDICTION_CHECKS, self.run_ts),
            checks.validate_features(table, self.run_ts),
            checks.label_distribution(table, self.run_ts),
        ]
        self.log(reduce(DataFrame.unionByName, found), "checks")
        quarantine = "quality.quarantine_provider_fraud_predictions"
        self.store.overwrite_checked(
            checks.quarantine_predictions(predictions, self.run_ts),
            quarantine,
            contract(quarantine),
        )
        summary, history = "quality.dq_dashboard_summary", self.store.read(HISTORY)
        self.store.overwrite_checked(
            dashboard.latest_values(history), summary, contract(summary)
        )
        self.store.overwrite_checked(
            dashboard.latest_rows(history), summary + "_with_ties", contract(summary)
        )

    def run(self, model_root: str, specs=modeling.CANDIDATES, exact: bool = True) -> None:
        """Features, then models, then scores, then quality: each needs the one before."""
        self.store.create_layers()
        self.build_silver()
        self.build_gold()
        self.train(model_root, specs, exact)
        self.score()
        self.check_quality()
