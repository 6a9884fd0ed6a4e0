"""Column contracts of the raw, gold and quality tables, and checks against them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Column names, order and types that other tools rely on.
CONDITION_COLUMNS = (
    "ChronicCond_Alzheimer",
    "ChronicCond_Heartfailure",
    "ChronicCond_KidneyDisease",
    "ChronicCond_Cancer",
    "ChronicCond_ObstrPulmonary",
    "ChronicCond_Depression",
    "ChronicCond_Diabetes",
    "ChronicCond_IschemicHeart",
    "ChronicCond_Osteoporasis",
    "ChronicCond_rheumatoidarthritis",
    "ChronicCond_stroke",
)

BENEFICIARY_COLUMNS = "BeneID string, DOB string, DOD string, Gender int, Race int, " + ", ".join(
    f"{c} int" for c in CONDITION_COLUMNS
)

INPATIENT_COLUMNS = """
    ClaimID string, BeneID string, Provider string,
    ClaimStartDt string, ClaimEndDt string, AdmissionDt string, DischargeDt string,
    InscClaimAmtReimbursed double, DeductibleAmtPaid string
"""

OUTPATIENT_COLUMNS = """
    ClaimID string, BeneID string, Provider string,
    ClaimStartDt string, ClaimEndDt string,
    InscClaimAmtReimbursed double, DeductibleAmtPaid string
"""

LABEL_COLUMNS = "Provider string, PotentialFraud string"

UNIFIED_COLUMNS = """
    ClaimID string, BeneID string, Provider string,
    ClaimStartDt date, ClaimEndDt date, AdmissionDt date, DischargeDt date,
    InscClaimAmtReimbursed double, DeductibleAmtPaid double,
    claim_duration_days int, hospital_stay_days int, claim_type string
"""

FEATURE_COLUMNS = """
    Provider string,
    total_claims bigint, unique_beneficiaries bigint,
    inpatient_claims bigint, outpatient_claims bigint,
    avg_reimbursement_amount double, total_reimbursement_amount double,
    max_reimbursement_amount double,
    avg_deductible_amount double, total_deductible_amount double,
    avg_claim_duration_days double, avg_hospital_stay_days double,
    high_reimbursement_claims bigint, chronic_condition_claims bigint,
    inpatient_claim_ratio double, outpatient_claim_ratio double,
    high_reimbursement_claim_ratio double, chronic_condition_claim_ratio double,
    claims_per_beneficiary double,
    fraud_label int, gold_processed_timestamp timestamp
"""

ANALYTICS_COLUMNS = """
    Provider string, fraud_status string, risk_segment string,
    total_claims bigint, unique_beneficiaries bigint, claims_per_beneficiary double,
    inpatient_claims bigint, outpatient_claims bigint,
    inpatient_claim_ratio double, outpatient_claim_ratio double,
    avg_reimbursement_amount double, total_reimbursement_amount double,
    max_reimbursement_amount double,
    avg_deductible_amount double, total_deductible_amount double,
    avg_claim_duration_days double, avg_hospital_stay_days double,
    high_reimbursement_claims bigint, high_reimbursement_claim_ratio double,
    chronic_condition_claims bigint, chronic_condition_claim_ratio double,
    gold_processed_timestamp timestamp
"""

PREDICTION_COLUMNS = """
    Provider string, fraud_label int, predicted_fraud_label int,
    fraud_probability double, fraud_risk_category string,
    total_claims bigint, unique_beneficiaries bigint, claims_per_beneficiary double,
    avg_reimbursement_amount double, total_reimbursement_amount double,
    inpatient_claim_ratio double, outpatient_claim_ratio double,
    high_reimbursement_claim_ratio double, chronic_condition_claim_ratio double,
    avg_claim_duration_days double, avg_hospital_stay_days double,
    prediction_timestamp timestamp
"""

CONTRACTS = {
    "bronze.beneficiarydata": BENEFICIARY_COLUMNS,
    "bronze.inpatientdata": INPATIENT_COLUMNS,
    "bronze.outpatientdata": OUTPATIENT_COLUMNS,
    "bronze.provider": LABEL_COLUMNS,
    "silver.unified_claims": UNIFIED_COLUMNS,
    "gold.provider_fraud_features": FEATURE_COLUMNS,
    "gold.provider_fraud_analytics": ANALYTICS_COLUMNS,
    "gold.provider_fraud_predictions": PREDICTION_COLUMNS,
    "gold.provider_fraud_ai_input": PREDICTION_COLUMNS + ", fraud_analysis_prompt string",
    "gold.model_feature_importance": "feature_name string, importance_score double",
    "quality.data_quality_metrics": (
        "table_name string, metric_name string, metric_value double, metric_timestamp timestamp"
    ),
    "quality.quarantine_provider_fraud_predictions": (
        PREDICTION_COLUMNS + ", dq_reason string, quarantine_timestamp timestamp"
    ),
    "quality.dq_dashboard_summary": (
        "table_name string, metric_name string, "
        "latest_metric_value double, latest_metric_timestamp timestamp"
    ),
    # Kept by this library in place of an experiment tracker.
    "models.model_runs": (
        "run_id string, run_name string, model_type string, n_estimators int, max_depth int, "
        "class_weight string, training_partitions int, "
        "accuracy double, precision double, recall double, f1_score double, "
        "roc_auc double, path string, created_at timestamp"
    ),
    "models.model_registry": (
        "model string, version int, alias string, run_id string, path string, "
        "description string, tags map<string,string>, created_at timestamp"
    ),
}

# The eight tables that are declared up front.
DECLARED_TABLES = tuple(n for n in CONTRACTS if n.split(".")[0] in ("gold", "quality"))


class ContractError(ValueError):
    """A frame does not have the columns its table promises."""


def contract(name: str) -> T.StructType:
    """The schema promised for table ``name``."""
    return T.StructType.fromDDL(CONTRACTS[name])


def column_names(name: str) -> list[str]:
    """The columns of table ``name`` in order; needs no session."""
    # A comma within <> belongs to a type.
    return [column.split()[0] for column in re.split(r",(?![^<]*>)", CONTRACTS[name])]


def describe_schema(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, nullable boolean"
    )


def _differences(actual: T.StructType, expected: T.StructType) -> list[tuple]:
    found = {f.name: f.dataType.simpleString() for f in actual.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = []
    for name, kind in wanted.items():
        have = found.get(name)
        status = "missing" if have is None else "ok" if have == kind else "type differs"
        rows.append((name, kind, have, status))
    rows += [(name, None, kind, "unexpected") for name, kind in found.items() if name not in wanted]
    return rows


def contract_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Compare the columns of ``df`` with ``expected``: column, expected, actual, status."""
    return df.sparkSession.createDataFrame(
        _differences(df.schema, expected),
        "column_name string, expected string, actual string, status string",
    )


def conform(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` with its columns in contract order; ContractError if any is off."""
    wrong = [r for r in _differences(df.schema, expected) if r[3] != "ok"]
    if wrong:
        raise ContractError("; ".join(f"{n}: expected {e}, found {a}" for n, e, a, _ in wrong))
    return df.select(expected.fieldNames())


def declare_tables(spark: SparkSession, fmt: str = "parquet", names=DECLARED_TABLES) -> None:
    """Create the declared tables, empty, in the session catalog where absent."""
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({CONTRACTS[name]}) USING {fmt}")
