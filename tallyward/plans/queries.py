"""The registry of checkable queries over the order tables: name -> (spark, folder) -> DataFrame.

Every query reads whole tables. Outputs are made comparable across engines: dates and times as
text, fractional numbers rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import rules as R
from tallyward.functions import scalars as S
from tallyward.operators import (
    analyst,
    checks,
    dashboard,
    features,
    investigation,
    modeling,
    scoring,
    silver,
)
from tallyward.operators.dedupe import dedupe
from tallyward.sources import derived
from tallyward.sources.contracts import contract
from tallyward.sources.store import (
    TableStore,
    preview,
    shared_folder,
    source_access,
    source_counts,
)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed clock of the checked runs.
AS_OF, RUN_TS = "2009-12-01", "2024-01-01 00:00:00"
# Added before rounding to 4 places: moves exact halves, which engines round differently, off the
# edge. Far below the kept precision and far above floating-point noise.
NUDGE = 1.2345e-7

SUPPLIER, PART = derived.SUPPLIER_GRAIN, derived.PART_GRAIN


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def stable(df: DataFrame) -> DataFrame:
    """Dates and times as text, doubles rounded, other columns as they are."""

    def shown(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "double":
            return F.round(c + NUDGE, 4).alias(name)
        if kind == "date":
            return c.cast("string").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)
        return c

    return df.select([shown(name, kind) for name, kind in df.dtypes])


# Shared parts -----------------------------------------------------------------


def raw(entity: silver.Entity, spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    return derived.bronze_table(spark, sf_dir, entity.raw, grain)


def clean(entity, spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    return entity.clean(raw(entity, spark, sf_dir, grain), as_of(), run_ts())


def flagged(entity, spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    return entity.flagged(raw(entity, spark, sf_dir, grain), as_of(), run_ts())


def valid(entity, spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    return entity.valid(flagged(entity, spark, sf_dir, grain))


def quarantined(entity, spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    return entity.quarantined(flagged(entity, spark, sf_dir, grain))


def unified(spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    """Valid claims of both kinds, flagged again as one table."""
    return silver.flag_unified(
        silver.unify_claims(
            valid(silver.INPATIENT_CLAIMS, spark, sf_dir, grain),
            valid(silver.OUTPATIENT_CLAIMS, spark, sf_dir, grain),
        )
    )


def unified_unsplit(spark, sf_dir) -> DataFrame:
    """Clean claims of both kinds, invalid ones included, so that the unified rules can fire."""
    return silver.flag_unified(
        silver.unify_claims(
            clean(silver.INPATIENT_CLAIMS, spark, sf_dir),
            clean(silver.OUTPATIENT_CLAIMS, spark, sf_dir),
        )
    )


def claims(spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    return silver.valid_unified(unified(spark, sf_dir, grain))


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write a table that is about to be scanned more than once, and read it back."""
    spark = df.sparkSession
    return TableStore(spark, shared_folder(spark), codec=codec).overwrite(df, "scratch.table")


def stored_claims(spark, sf_dir, grain=SUPPLIER) -> DataFrame:
    """The unified claims as the batch has them: written once, then scanned by each branch."""
    return stored(claims(spark, sf_dir, grain))


def gold_of(table: DataFrame, spark, sf_dir, grain=SUPPLIER, **options) -> DataFrame:
    return features.provider_features(
        table,
        valid(silver.BENEFICIARY, spark, sf_dir),
        valid(silver.PROVIDER_LABELS, spark, sf_dir, grain),
        run_ts(),
        **options,
    )


def gold(spark, sf_dir, grain=SUPPLIER, **options) -> DataFrame:
    return gold_of(stored_claims(spark, sf_dir, grain), spark, sf_dir, grain, **options)


def stored_gold(spark, sf_dir, grain=PART, **options) -> DataFrame:
    return stored(gold(spark, sf_dir, grain, **options))


def totals(spark, sf_dir) -> DataFrame:
    return features.provider_totals(
        features.claim_indicators(stored_claims(spark, sf_dir)),
        valid(silver.BENEFICIARY, spark, sf_dir),
    )


def formula_scores(table: DataFrame, score: Column) -> DataFrame:
    """Predictions from a formula instead of a model, so that both engines agree on them."""
    return scoring.prediction_columns(
        table.withColumn("fraud_probability", score).withColumn(
            "predicted_fraud_label", S.flag(F.col("fraud_probability") >= 0.5)
        ),
        run_ts(),
    )


def predictions_of(table: DataFrame) -> DataFrame:
    score = F.least(
        F.lit(1.0),
        0.7 * F.col("high_reimbursement_claim_ratio") + 0.3 * F.col("inpatient_claim_ratio"),
    )
    return formula_scores(table, score)


def predictions(spark, sf_dir) -> DataFrame:
    return predictions_of(gold(spark, sf_dir, PART))


def faulty_predictions_of(table: DataFrame) -> DataFrame:
    """Predictions of which some are out of range, missing or negative."""
    score = F.when(
        F.col("unique_beneficiaries") % 7 != 0,
        2 * F.col("high_reimbursement_claim_ratio") - 0.5 * F.col("inpatient_claim_ratio"),
    )
    amount = F.col("avg_reimbursement_amount")
    negated = F.when(F.col("inpatient_claims") == 5, -amount).otherwise(amount)
    return formula_scores(table.withColumn("avg_reimbursement_amount", negated), score)


def faulty_predictions(spark, sf_dir) -> DataFrame:
    return faulty_predictions_of(gold(spark, sf_dir, PART))


def quarantine(spark, sf_dir) -> DataFrame:
    return checks.quarantine_predictions(faulty_predictions(spark, sf_dir), run_ts())


def prompts(spark, sf_dir) -> DataFrame:
    return scoring.add_prompts(stable(predictions(spark, sf_dir)))


def layer_metrics(spark, sf_dir) -> DataFrame:
    """Each entity's flagged rows are stored once, for its own metrics and for the union."""
    kept = {e.name: stored(flagged(e, spark, sf_dir)) for e in silver.ENTITIES}
    found = [checks.layer_metrics(e, kept[e.name], run_ts()) for e in silver.ENTITIES]
    claims_of = [e.valid(kept[e.name]) for e in (silver.INPATIENT_CLAIMS, silver.OUTPATIENT_CLAIMS)]
    unified_rows = silver.flag_unified(silver.unify_claims(*claims_of))
    found.append(checks.unified_metrics(unified_rows, run_ts()))
    return reduce(DataFrame.unionByName, found)


def yearly_metrics(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """Metrics of past runs: counts of flagged claims of both kinds per year of the claim."""

    def of(entity: silver.Entity, rows: DataFrame) -> DataFrame:
        year = F.date_trunc("year", F.col("ClaimStartDt")).cast("timestamp")
        counts = (
            rows.groupBy(year.alias("metric_timestamp"))
            .agg(
                F.count("*").cast("double").alias("total_records"),
                F.sum("dq_is_valid").cast("double").alias("valid_records"),
                F.sum(1 - F.col("dq_is_valid")).cast("double").alias("quarantine_records"),
            )
        )
        names = ["total_records", "valid_records", "quarantine_records"]
        return counts.unpivot(["metric_timestamp"], names, "metric_name", "metric_value").select(
            F.lit(entity.name).alias("table_name"),
            "metric_name",
            "metric_value",
            "metric_timestamp",
        )

    return of(silver.INPATIENT_CLAIMS, inpatient).unionByName(
        of(silver.OUTPATIENT_CLAIMS, outpatient)
    )


def yearly_history(spark, sf_dir) -> DataFrame:
    return yearly_metrics(
        flagged(silver.INPATIENT_CLAIMS, spark, sf_dir),
        flagged(silver.OUTPATIENT_CLAIMS, spark, sf_dir),
    )


def history(spark, sf_dir) -> DataFrame:
    """Past runs, the checks of this run, and a label distribution that was appended twice.

    Flagged claims are stored once, for the counts per year and for the features.
    """
    kinds = (silver.INPATIENT_CLAIMS, silver.OUTPATIENT_CLAIMS)
    kept = [stored(flagged(e, spark, sf_dir), "zstd") for e in kinds]
    rows = silver.unify_claims(*[e.valid(k) for e, k in zip(kinds, kept)])
    table = stored(
        gold_of(silver.valid_unified(silver.flag_unified(rows)), spark, sf_dir)
    )
    labels = checks.label_distribution(table, run_ts())
    parts = [
        yearly_metrics(*kept),
        checks.run_checks(table, checks.FEATURE_CHECKS, run_ts()),
        labels,
        labels,
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Fitted:
    """What training left in its store: features, split, scored test rows, runs and registry."""

    store: TableStore
    split: DataFrame
    scores: list[DataFrame]
    runs: list[modeling.Run]


MODEL_NAME = "provider_risk_model"
RUNS, REGISTRY = "models.model_runs", "models.model_registry"

# A model is fitted once per session, folder and candidates; several queries look at it.
_fitted: dict[tuple, Fitted] = {}


def fitted(spark, sf_dir) -> Fitted:
    """Both candidates fitted on the claims from which the label can be learned."""
    key = (spark.sparkContext.applicationId, sf_dir, modeling.CANDIDATES)
    if key not in _fitted:
        store = TableStore(spark, shared_folder(spark))
        table = store.overwrite(
            gold(spark, sf_dir, derived.LEARNABLE_GRAIN), "gold.provider_fraud_features"
        )
        frame = modeling.model_frame(table)
        modeling.require_labels(frame)
        split = store.overwrite(modeling.split_rows(frame), "models.training_split")
        modeling.require_both_labels(split)
        scores, runs = [], []
        for spec in modeling.CANDIDATES:

            def keep(found: DataFrame, name: str = f"models.scores_{spec.run_name}") -> DataFrame:
                scores.append(store.overwrite(found, name))
                return scores[-1]

            runs.append(modeling.train_candidate(split, spec, f"{store.root}/models", keep))
        log = store.append(modeling.run_log(spark, runs, run_ts()), RUNS, contract(RUNS))
        entry = registry_entry(modeling.best_run(log), 1)
        store.append(entry, REGISTRY, contract(REGISTRY))
        _fitted[key] = Fitted(store, split, scores, runs)
    return _fitted[key]


def registry_entry(best: DataFrame, version: int) -> DataFrame:
    return modeling.registry_entry(
        best,
        MODEL_NAME,
        version,
        "Random forest on the provider features.",
        {"project": "provider_risk", "source_table": "gold.provider_fraud_features"},
        run_ts(),
    )


def champion_model(spark, sf_dir) -> PipelineModel:
    """The champion, by the path in the registry."""
    row = modeling.champion(fitted(spark, sf_dir).store.read(REGISTRY), MODEL_NAME).first()
    return PipelineModel.load(row["path"])


# Features made of the amounts, which carry the label in the learnable claims.
CARRIERS = (
    "avg_reimbursement_amount",
    "total_reimbursement_amount",
    "max_reimbursement_amount",
    "high_reimbursement_claims",
    "high_reimbursement_claim_ratio",
)


def supplier_runs(spark, sf_dir) -> DataFrame:
    """A table of runs made from the suppliers: undefined scores, ties, several times."""
    suppliers = derived.table(spark, sf_dir, "supplier").selectExpr(
        "concat('run-', s_suppkey) AS run_id",
        "concat('nation-', s_nationkey) AS run_name",
        f"'{modeling.MODEL_TYPE}' AS model_type",
        "CAST(100 AS INT) AS n_estimators",
        "CAST(8 AS INT) AS max_depth",
        "'balanced' AS class_weight",
        "CAST(32 AS INT) AS training_partitions",
        *[f"CAST(0 AS DOUBLE) AS {m}" for m in ("accuracy", "precision", "recall", "f1_score")],
        "CASE WHEN s_suppkey % 10 = 0 THEN CAST('NaN' AS DOUBLE) WHEN s_suppkey % 7 > 0 "
        "THEN floor(abs(s_acctbal) / 1000) / 10 END AS roc_auc",
        "concat('models/', s_suppkey) AS path",
        f"timestamp'{RUN_TS}' + make_dt_interval(s_nationkey) AS created_at",
    )
    return suppliers


# Queries ----------------------------------------------------------------------

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under ``name``; its output is made comparable."""

    def add(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: stable(build(spark, sf_dir))
        return build

    return add


BENE, INP, OUTP, LABELS = silver.ENTITIES


@query("a01_scan")
def a01(spark, sf_dir):
    return raw(INP, spark, sf_dir)


@query("a03_source_access")
def a03(spark, sf_dir):
    return source_access(spark, derived.bronze_tables(spark, sf_dir))


@query("a04_source_row_counts")
def a04(spark, sf_dir):
    return source_counts(derived.bronze_tables(spark, sf_dir))


@query("a05_preview")
def a05(spark, sf_dir):
    return preview(raw(BENE, spark, sf_dir), 20, ["BeneID"])


@query("a07_overwrite")
def a07(spark, sf_dir):
    store = TableStore(spark, shared_folder(spark))
    store.overwrite(raw(BENE, spark, sf_dir), "silver.beneficiary")
    return store.overwrite(
        valid(BENE, spark, sf_dir).drop(silver.STAMP), "silver.beneficiary"
    )


@query("a08_overwrite_checked")
def a08(spark, sf_dir):
    store = TableStore(spark, shared_folder(spark))
    table = silver.common_claim_columns(claims(spark, sf_dir))
    return store.overwrite_checked(
        table, "silver.unified_claims", contract("silver.unified_claims")
    )


@query("a09_append")
def a09(spark, sf_dir):
    store = TableStore(spark, shared_folder(spark))
    name = "quality.data_quality_metrics"
    for entity in silver.ENTITIES:
        metrics = checks.layer_metrics(entity, flagged(entity, spark, sf_dir), run_ts())
        store.append(metrics, name, contract(name))
    return store.read(name)


@query("a10_declared_table")
def a10(spark, sf_dir):
    store, name = TableStore(spark, shared_folder(spark)), "gold.provider_fraud_features"
    return store.append(gold(spark, sf_dir), name, contract(name))


@query("b01_dedupe_beneficiary")
def b01_beneficiary(spark, sf_dir):
    return dedupe(raw(BENE, spark, sf_dir), "BeneID")


@query("b01_dedupe_inpatient")
def b01_inpatient(spark, sf_dir):
    return dedupe(raw(INP, spark, sf_dir), "ClaimID", silver.COPIES)


@query("b01_dedupe_outpatient")
def b01_outpatient(spark, sf_dir):
    return dedupe(raw(OUTP, spark, sf_dir), "ClaimID", silver.COPIES)


def _columns(df: DataFrame, key: str, **derived_columns: Column) -> DataFrame:
    return df.select(key, *[c.alias(name) for name, c in derived_columns.items()])


@query("b02_parse_date")
def b02(spark, sf_dir):
    dates = ["ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt"]
    return _columns(
        raw(INP, spark, sf_dir), "ClaimID", **{d: S.parse_date(F.col(d)) for d in dates}
    )


@query("b03_parse_optional_date")
def b03(spark, sf_dir):
    return _columns(raw(BENE, spark, sf_dir), "BeneID", DOD=S.parse_optional_date(F.col("DOD")))


@query("b04_numeric_cast")
def b04(spark, sf_dir):
    amount = S.to_number(F.col("InscClaimAmtReimbursed").cast("string"))
    return _columns(raw(OUTP, spark, sf_dir), "ClaimID", InscClaimAmtReimbursed=amount)


@query("b05_tolerant_cast")
def b05(spark, sf_dir):
    amount = S.to_number(F.col("DeductibleAmtPaid"))
    return _columns(raw(INP, spark, sf_dir), "ClaimID", DeductibleAmtPaid=amount)


@query("b06_age")
def b06(spark, sf_dir):
    return clean(BENE, spark, sf_dir).select("BeneID", "DOB", "age")


@query("b07_deceased")
def b07(spark, sf_dir):
    return clean(BENE, spark, sf_dir).select("BeneID", "DOD", "is_deceased")


@query("b08_gender")
def b08(spark, sf_dir):
    return clean(BENE, spark, sf_dir).select("BeneID", "Gender", "gender_desc")


@query("b09_race")
def b09(spark, sf_dir):
    return clean(BENE, spark, sf_dir).select("BeneID", "race_desc")


@query("b10_claim_duration")
def b10(spark, sf_dir):
    return clean(OUTP, spark, sf_dir).select("ClaimID", "claim_duration_days")


@query("b11_hospital_stay")
def b11(spark, sf_dir):
    return clean(INP, spark, sf_dir).select("ClaimID", "hospital_stay_days")


@query("b12_processing_timestamp")
def b12(spark, sf_dir):
    return clean(LABELS, spark, sf_dir).select("Provider", silver.STAMP)


@query("b13_label_decode")
def b13(spark, sf_dir):
    return clean(LABELS, spark, sf_dir).select("Provider", "PotentialFraud", "fraud_label")


@query("b14_claim_type")
def b14(spark, sf_dir):
    return silver.tag_claim_type(clean(INP, spark, sf_dir), silver.INPATIENT).select(
        "ClaimID", "claim_type"
    )


@query("b15_align_outpatient")
def b15(spark, sf_dir):
    return silver.align_outpatient(clean(OUTP, spark, sf_dir)).select(
        "ClaimID", "AdmissionDt", "DischargeDt", "hospital_stay_days"
    )


@query("b16_common_columns")
def b16(spark, sf_dir):
    return silver.common_claim_columns(
        silver.tag_claim_type(valid(INP, spark, sf_dir), silver.INPATIENT)
    )


@query("b17_union")
def b17(spark, sf_dir):
    return silver.unify_claims(valid(INP, spark, sf_dir), valid(OUTP, spark, sf_dir))


@query("c01_missing")
def c01(spark, sf_dir):
    return flagged(INP, spark, sf_dir).select(
        "ClaimID", "dq_missing_claim_id", "dq_missing_provider", "dq_missing_bene_id"
    )


@query("c02_out_of_range")
def c02(spark, sf_dir):
    return flagged(BENE, spark, sf_dir).select("BeneID", "dq_invalid_dob", "dq_invalid_age")


@query("c03_date_order")
def c03(spark, sf_dir):
    return flagged(INP, spark, sf_dir).select(
        "ClaimID", "dq_invalid_claim_dates", "dq_invalid_admission_dates"
    )


@query("c04_negative")
def c04(spark, sf_dir):
    return flagged(OUTP, spark, sf_dir).select(
        "ClaimID", "dq_negative_reimbursement", "dq_negative_deductible"
    )


@query("c05_not_in_set")
def c05(spark, sf_dir):
    genders = R.not_in("gender_desc", ["Male", "Female"])
    known = R.Rule("dq_unknown_gender", "Unknown Gender", genders)
    return R.flag_rows(clean(BENE, spark, sf_dir), [known]).select("BeneID", "dq_unknown_gender")


@query("c06_not_positive")
def c06(spark, sf_dir):
    return unified_unsplit(spark, sf_dir).select(
        "ClaimID", "claim_type", "dq_invalid_claim_type", "dq_invalid_claim_duration"
    )


@query("c07_validity")
def c07(spark, sf_dir):
    return flagged(OUTP, spark, sf_dir).select("ClaimID", "dq_is_valid")


@query("c08_valid_split")
def c08(spark, sf_dir):
    return R.valid_rows(flagged(LABELS, spark, sf_dir)).drop(silver.COPIES, silver.STAMP)


@query("c09_quarantine_split")
def c09(spark, sf_dir):
    return R.quarantined_rows(flagged(BENE, spark, sf_dir), silver.BENEFICIARY_RULES).select(
        "BeneID", "quarantine_reason"
    )


@query("c10_layer_metrics")
def c10(spark, sf_dir):
    return layer_metrics(spark, sf_dir)


@query("c11_single_pass_metrics")
def c11(spark, sf_dir):
    return checks.layer_metrics(LABELS, flagged(LABELS, spark, sf_dir), run_ts())


@query("c20_beneficiary_valid")
def c20_valid(spark, sf_dir):
    return valid(BENE, spark, sf_dir)


@query("c20_beneficiary_quarantine")
def c20_quarantine(spark, sf_dir):
    return quarantined(BENE, spark, sf_dir)


@query("c21_inpatient_valid")
def c21_valid(spark, sf_dir):
    return valid(INP, spark, sf_dir)


@query("c21_inpatient_quarantine")
def c21_quarantine(spark, sf_dir):
    return quarantined(INP, spark, sf_dir)


@query("c22_outpatient_valid")
def c22_valid(spark, sf_dir):
    return valid(OUTP, spark, sf_dir)


@query("c22_outpatient_quarantine")
def c22_quarantine(spark, sf_dir):
    return quarantined(OUTP, spark, sf_dir)


@query("c23_unified_valid")
def c23_valid(spark, sf_dir):
    return claims(spark, sf_dir)


@query("c23_unified_quarantine")
def c23_quarantine(spark, sf_dir):
    return silver.quarantined_unified(unified_unsplit(spark, sf_dir))


@query("c24_labels_valid")
def c24_valid(spark, sf_dir):
    return valid(LABELS, spark, sf_dir)


@query("c24_labels_quarantine")
def c24_quarantine(spark, sf_dir):
    return quarantined(LABELS, spark, sf_dir)


@query("d01_claims_with_beneficiary")
def d01(spark, sf_dir):
    people = valid(BENE, spark, sf_dir).select("BeneID", "age", "gender_desc")
    return features.join_beneficiaries(
        claims(spark, sf_dir).select("ClaimID", "claim_type", "BeneID"), people
    )


@query("d02_claim_type_indicators")
def d02(spark, sf_dir):
    return features.claim_indicators(claims(spark, sf_dir)).select(
        "ClaimID", "claim_type", "is_inpatient_claim", "is_outpatient_claim"
    )


@query("d03_high_reimbursement")
def d03(spark, sf_dir):
    return features.claim_indicators(claims(spark, sf_dir)).select(
        "ClaimID", "claim_type", "is_high_reimbursement_claim"
    )


@query("d04_chronic_condition")
def d04(spark, sf_dir):
    return features.chronic_flags(valid(BENE, spark, sf_dir))


@query("d05_provider_totals")
def d05(spark, sf_dir):
    return totals(spark, sf_dir)


@query("d06_ratios")
def d06(spark, sf_dir):
    return features.add_ratios(totals(spark, sf_dir)).select(
        "Provider", *features.RATIOS, "claims_per_beneficiary"
    )


@query("d07_labelled")
def d07(spark, sf_dir):
    return features.attach_labels(
        totals(spark, sf_dir), valid(LABELS, spark, sf_dir)
    ).select("Provider", "total_claims", "fraud_label")


@query("d08_filled_features")
def d08(spark, sf_dir):
    return gold(spark, sf_dir)


@query("d08_unfilled_label")
def d08_unfilled(spark, sf_dir):
    return gold(spark, sf_dir, fill_label=False).select("Provider", "fraud_label")


@query("d08_part_features")
def d08_part(spark, sf_dir):
    return gold(spark, sf_dir, PART)


@query("d09_fill_numbers")
def d09(spark, sf_dir):
    return features.fill_numbers(
        features.attach_labels(totals(spark, sf_dir), valid(LABELS, spark, sf_dir))
    ).select("Provider", "avg_hospital_stay_days", "fraud_label")


@query("d10_fraud_status")
def d10(spark, sf_dir):
    return gold(spark, sf_dir, fill_label=False).select(
        "Provider", S.label_status(F.col("fraud_label")).alias("fraud_status")
    )


@query("d11_risk_segment")
def d11(spark, sf_dir):
    return gold(spark, sf_dir, PART).select(
        "Provider", S.risk_segment(F.col("high_reimbursement_claim_ratio")).alias("risk_segment")
    )


@query("d12_analytics")
def d12(spark, sf_dir):
    return features.provider_analytics(gold(spark, sf_dir))


@query("d13_counts_by_label")
def d13_label(spark, sf_dir):
    return features.group_counts(gold(spark, sf_dir), "fraud_label")


@query("d13_counts_by_segment")
def d13_segment(spark, sf_dir):
    table = features.provider_analytics(gold(spark, sf_dir, PART))
    return features.group_counts(table, "fraud_status", "risk_segment")


@query("d13_counts_by_risk")
def d13_risk(spark, sf_dir):
    return features.group_counts(predictions(spark, sf_dir), "fraud_risk_category")


CLAIM_SUITE = checks.CheckSuite(
    "unified_claims",
    "ClaimID",
    required=("BeneID", "AdmissionDt", "DeductibleAmtPaid"),
    non_negative=("InscClaimAmtReimbursed", "claim_duration_days"),
    ratios=("hospital_stay_days",),
)


@query("e01_claim_checks")
def e01(spark, sf_dir):
    return checks.run_checks(stored(unified_unsplit(spark, sf_dir)), CLAIM_SUITE, run_ts())


@query("e02_feature_checks")
def e02(spark, sf_dir):
    return checks.run_checks(stored_gold(spark, sf_dir), checks.FEATURE_CHECKS, run_ts())


@query("e03_prediction_checks")
def e03(spark, sf_dir):
    scores = stored(faulty_predictions(spark, sf_dir))
    return checks.run_checks(scores, checks.PREDICTION_CHECKS, run_ts())


@query("e04_metric_union")
def e04(spark, sf_dir):
    table = stored_gold(spark, sf_dir)
    scores = faulty_predictions_of(table)
    return checks.run_checks(table, checks.FEATURE_CHECKS, run_ts()).unionByName(
        checks.run_checks(scores, checks.PREDICTION_CHECKS, run_ts())
    )


@query("e05_prediction_quarantine")
def e05(spark, sf_dir):
    return quarantine(spark, sf_dir)


@query("e06_latest_values")
def e06(spark, sf_dir):
    return dashboard.latest_values(history(spark, sf_dir))


@query("e07_latest_rows")
def e07(spark, sf_dir):
    return dashboard.latest_rows(history(spark, sf_dir))


@query("e08_gold_validation")
def e08(spark, sf_dir):
    return checks.validate_features(stored_gold(spark, sf_dir, fill_label=False), run_ts())


@query("e09_label_distribution")
def e09(spark, sf_dir):
    return checks.label_distribution(gold(spark, sf_dir), run_ts())


@query("e10_quality_summary")
def e10(spark, sf_dir):
    return dashboard.quality_summary(dashboard.latest_rows(history(spark, sf_dir)))


@query("e11_quarantine_metrics")
def e11(spark, sf_dir):
    return dashboard.quarantine_metrics(history(spark, sf_dir))


@query("e12_null_percentages")
def e12(spark, sf_dir):
    return dashboard.null_percentages(history(spark, sf_dir))


@query("e13_label_metrics")
def e13(spark, sf_dir):
    return dashboard.label_metrics(history(spark, sf_dir))


@query("f01_model_frame")
def f01(spark, sf_dir):
    return modeling.model_frame(gold(spark, sf_dir, PART))


@query("f02_split")
def f02(spark, sf_dir):
    frame = modeling.model_frame(gold(spark, sf_dir, PART))
    split = modeling.split_rows(frame, exact=False)
    return split.select("Provider", modeling.LABEL, "split")


@query("f02_split_exact")
def f02_exact(spark, sf_dir):
    frame = modeling.model_frame(stored_gold(spark, sf_dir))
    return modeling.split_rows(frame).select("Provider", modeling.LABEL, "split")


def decided(scored: DataFrame) -> DataFrame:
    """Scores of a model, which no other engine can repeat, as what must hold of them.

    ``score_decides``: the label is the likelier one. ``band_agrees``, where there is a band: it is
    that of the probability.
    """
    p = F.col("fraud_probability")
    label = F.when(p > 0.5, 1).otherwise(0)
    columns = {"score_decides": p.between(0, 1) & (label == F.col("predicted_fraud_label"))}
    if "fraud_risk_category" in scored.columns:
        band = F.when(p >= 0.8, "High Risk").when(p >= 0.5, "Medium Risk").otherwise("Low Risk")
        columns["band_agrees"] = band == F.col("fraud_risk_category")
    return scored.withColumns(columns).drop("fraud_probability", "fraud_risk_category")


@query("f03_forest_a")
def f03(spark, sf_dir):
    return decided(fitted(spark, sf_dir).scores[0])


@query("f04_forest_b")
def f04(spark, sf_dir):
    return decided(fitted(spark, sf_dir).scores[1])


@query("f05_class_weights")
def f05(spark, sf_dir):
    return modeling.class_weights(modeling.model_frame(gold(spark, sf_dir, PART)))


@query("f06_predictions")
def f06(spark, sf_dir):
    known = fitted(spark, sf_dir)
    return decided(
        modeling.predict(known.runs[0].model, known.split).select(
            "Provider", "split", "predicted_fraud_label", "fraud_probability"
        )
    )


@query("f07_classification_metrics")
def f07(spark, sf_dir):
    return modeling.classification_metrics(predictions(spark, sf_dir))


@query("f08_roc_auc")
def f08(spark, sf_dir):
    area = modeling.roc_auc(predictions_of(stored_gold(spark, sf_dir)))
    return spark.createDataFrame([(area,)], "roc_auc double")


@query("f09_class_balance")
def f09(spark, sf_dir):
    frame = modeling.model_frame(stored_gold(spark, sf_dir))
    return modeling.class_balance(modeling.split_rows(frame))


@query("f10_feature_importance")
def f10(spark, sf_dir):
    """Every input with what must hold: a share between 0 and 1, one in all."""
    scores = modeling.feature_importance(spark, champion_model(spark, sf_dir))
    total = scores.agg(F.sum("importance_score")).first()[0]
    return scores.select(
        "feature_name",
        F.col("importance_score").between(0, 1).alias("is_share"),
        F.lit(round(total, 6)).alias("total"),
    )


@query("f11_run_log")
def f11(spark, sf_dir):
    return fitted(spark, sf_dir).store.read(RUNS).select(
        "run_name",
        "model_type",
        "n_estimators",
        "max_depth",
        "class_weight",
        "training_partitions",
        (F.col("roc_auc") > 0.9).alias("separates"),
        "created_at",
    )


@query("f12_best_run")
def f12(spark, sf_dir):
    return modeling.best_run(supplier_runs(spark, sf_dir))


@query("f13_champion")
def f13(spark, sf_dir):
    runs = supplier_runs(spark, sf_dir)
    first = modeling.best_run(runs.filter("run_name = 'nation-1'"))
    registry = registry_entry(first, 1).unionByName(registry_entry(modeling.best_run(runs), 2))
    return modeling.champion(registry, MODEL_NAME).withColumn("tags", F.to_json("tags"))


@query("f14_batch_scoring")
def f14(spark, sf_dir):
    table = fitted(spark, sf_dir).store.read("gold.provider_fraud_features")
    scored = scoring.score_providers(champion_model(spark, sf_dir), table, run_ts())
    return decided(scored)


@query("f15_risk_band")
def f15(spark, sf_dir):
    return faulty_predictions(spark, sf_dir).select(
        "Provider", "fraud_probability", "fraud_risk_category"
    )


@query("f16_prediction_columns")
def f16(spark, sf_dir):
    return predictions(spark, sf_dir)


@query("f17_prompts")
def f17(spark, sf_dir):
    return prompts(spark, sf_dir).select("Provider", "fraud_analysis_prompt")


@query("g01_top_providers")
def g01(spark, sf_dir):
    return analyst.top_providers(predictions(spark, sf_dir))


@query("g02_high_risk")
def g02(spark, sf_dir):
    return analyst.high_risk_providers(predictions(spark, sf_dir))


@query("g03_risk_distribution")
def g03(spark, sf_dir):
    return analyst.risk_distribution(predictions(spark, sf_dir))


@query("g04_actual_and_predicted")
def g04(spark, sf_dir):
    return analyst.actual_and_predicted(predictions(spark, sf_dir))


@query("g05_concentrated")
def g05(spark, sf_dir):
    return analyst.concentrated_features(gold(spark, sf_dir))


@query("g05_concentrated_scored")
def g05_scored(spark, sf_dir):
    table = stored_gold(spark, sf_dir)
    return analyst.concentrated_providers(table, predictions_of(table))


@query("g06_feature_importance")
def g06(spark, sf_dir):
    """Every rank: the score is no larger than the one above, and a carrier is on top."""
    scores = modeling.feature_importance(spark, champion_model(spark, sf_dir))
    ranked = analyst.importance_ranking(scores).collect()  # one row per feature of the model
    rows = [
        (rank, below["importance_score"] <= above["importance_score"], rank > 1 or below["feature_name"] in CARRIERS)
        for rank, (above, below) in enumerate(zip([ranked[0], *ranked], ranked), 1)
    ]
    return spark.createDataFrame(rows, "rank int, no_larger boolean, carrier_on_top boolean")


@query("g07_top_prompts")
def g07(spark, sf_dir):
    return analyst.top_prompts(prompts(spark, sf_dir))


@query("g08_quality_summary")
def g08(spark, sf_dir):
    return dashboard.quality_summary(dashboard.latest_values(history(spark, sf_dir)))


@query("g09_quarantined_predictions")
def g09(spark, sf_dir):
    return analyst.newest_quarantined(quarantine(spark, sf_dir))


@query("g10_suspicious_providers")
def g10(spark, sf_dir):
    return analyst.suspicious_providers(predictions(spark, sf_dir))


@query("i02_aggregate_consistency")
def i02(spark, sf_dir):
    """A stored table that has gone stale against claims aggregated again."""
    table = stored_claims(spark, sf_dir, PART)
    stale = stored(gold_of(table, spark, sf_dir, PART)).withColumn(
        "total_claims", F.col("total_claims") + S.flag(F.col("inpatient_claims") == 4)
    ).filter(F.col("outpatient_claims") != 3)
    return investigation.aggregate_consistency(stale, gold_of(table, spark, sf_dir, PART))


@query("i03_metric_drift")
def i03(spark, sf_dir):
    return dashboard.metric_drift(yearly_history(spark, sf_dir))


@query("i04_investigation_context")
def i04(spark, sf_dir):
    table = stored_gold(spark, sf_dir)
    scores = faulty_predictions_of(table)
    return investigation.investigation_context(
        table, scores, checks.quarantine_predictions(scores, run_ts())
    )


@query("i05_risk_by_quality")
def i05(spark, sf_dir):
    return investigation.risk_by_quality(
        faulty_predictions(spark, sf_dir), R.reasons(checks.PREDICTION_RULES)
    )
