"""Table quality: metrics in one pass, in the long form (table, metric, value, time)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.rules import Rule, missing, negative, outside, reasons
from tallyward.operators.features import RATIOS
from tallyward.operators.silver import COPIES, UNIFIED_VALID, Entity, now_or

METRIC_KEYS = ["table_name", "metric_name"]


def long_metrics(wide: DataFrame, table_name: str, run_ts: Column | None = None) -> DataFrame:
    """Turn a one-row frame into one row per column; the column names are the metric names."""
    numbers = wide.select([F.col(f"`{c}`").cast("double").alias(c) for c in wide.columns])
    long = numbers.unpivot([], [f"`{c}`" for c in wide.columns], "metric_name", "metric_value")
    return long.select(
        F.lit(table_name).alias("table_name"),
        "metric_name",
        "metric_value",
        now_or(run_ts).alias("metric_timestamp"),
    )


def _sum_or_zero(name: str) -> Column:
    return F.coalesce(F.sum(F.col(f"`{name}`")), F.lit(0))


def layer_metrics(entity: Entity, flagged: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Raw, valid, quarantined and removed rows of one entity.

    The flagged rows carry the number of raw rows behind them, so the raw table is not read again.
    """
    wide = flagged.agg(
        _sum_or_zero(COPIES).alias("total_records"),
        F.count_if(F.col("dq_is_valid") == 1).alias("valid_records"),
        F.count_if(F.col("dq_is_valid") == 0).alias("quarantine_records"),
        (_sum_or_zero(COPIES) - F.count("*")).alias(entity.duplicates_metric),
    )
    return long_metrics(wide, entity.name, run_ts)


def unified_metrics(flagged: DataFrame, run_ts: Column | None = None) -> DataFrame:
    wide = flagged.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col(UNIFIED_VALID) == 1).alias("valid_records"),
        F.count_if(F.col(UNIFIED_VALID) == 0).alias("quarantine_records"),
    )
    return long_metrics(wide, "unified_claims", run_ts)


@dataclass(frozen=True)
class CheckSuite:
    """What to check of one table."""

    table_name: str
    primary_key: str
    required: Sequence[str] = ()
    non_negative: Sequence[str] = ()
    ratios: Sequence[str] = ()


# The columns checked, in order.
FEATURE_CHECKS = CheckSuite(
    table_name="provider_fraud_features",
    primary_key="Provider",
    required=(
        "Provider",
        "total_claims",
        "unique_beneficiaries",
        "avg_reimbursement_amount",
        "total_reimbursement_amount",
        "claims_per_beneficiary",
        "fraud_label",
    ),
    non_negative=(
        "total_claims",
        "unique_beneficiaries",
        "inpatient_claims",
        "outpatient_claims",
        "avg_reimbursement_amount",
        "total_reimbursement_amount",
        "max_reimbursement_amount",
        "avg_deductible_amount",
        "total_deductible_amount",
        "avg_claim_duration_days",
        "claims_per_beneficiary",
    ),
    ratios=tuple(RATIOS),
)
PREDICTION_CHECKS = CheckSuite(
    table_name="provider_fraud_predictions",
    primary_key="Provider",
    required=(
        "Provider",
        "fraud_label",
        "predicted_fraud_label",
        "fraud_probability",
        "fraud_risk_category",
        "total_claims",
        "avg_reimbursement_amount",
        "claims_per_beneficiary",
    ),
    non_negative=(
        "fraud_probability",
        "total_claims",
        "unique_beneficiaries",
        "claims_per_beneficiary",
        "avg_reimbursement_amount",
        "total_reimbursement_amount",
    ),
    ratios=("fraud_probability",),
)


def _duplicate_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number of keys with more than one row; a repeated null key is one key."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).agg(
        F.count_if(F.col("rows") > 1).alias(name)
    )


def run_checks(df: DataFrame, suite: CheckSuite, run_ts: Column | None = None) -> DataFrame:
    """All checks of the suite from two scans.

    Every count of rows comes from one aggregate that shuffles one row per task. Only the search
    for repeated keys moves data, and only the key column, counted within each task first.
    """
    key, total = suite.primary_key, F.count("*")
    metrics = [
        total.alias("total_records"),
        F.count_if(F.col(key).isNull()).alias("missing_primary_key_count"),
    ]
    for c in suite.required:
        count = F.count_if(F.col(c).isNull())
        share = F.coalesce(F.try_divide(count, total) * 100, F.lit(0.0))
        metrics += [count.alias(f"null_count_{c}"), share.alias(f"null_percent_{c}")]
    for c in suite.non_negative:
        metrics.append(F.count_if(F.col(c) < 0).alias(f"negative_value_count_{c}"))
    for c in suite.ratios:
        metrics.append(F.count_if(outside(c, 0, 1)()).alias(f"invalid_ratio_count_{c}"))
    duplicates = _duplicate_keys(df, key, "duplicate_primary_key_count")
    return long_metrics(df.agg(*metrics), suite.table_name, run_ts).unionByName(
        long_metrics(duplicates, suite.table_name, run_ts)
    )


GOLD_TABLE = "gold_provider_features"


def validate_features(features: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The six gold checks. A row with several ratios off counts once."""
    off = reduce(Column.__or__, [outside(c, 0, 1)() for c in RATIOS])
    wide = features.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("Provider").isNull()).alias("missing_provider"),
        F.count_if(F.col("fraud_label").isNull()).alias("missing_fraud_label"),
        F.count_if(F.col("total_claims") < 0).alias("negative_total_claims"),
        F.count_if(off).alias("invalid_ratio_values"),
    )
    duplicates = _duplicate_keys(features, "Provider", "duplicate_provider")
    return long_metrics(wide, GOLD_TABLE, run_ts).unionByName(
        long_metrics(duplicates, GOLD_TABLE, run_ts)
    )


def label_distribution(features: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """One metric ``fraud_label_<value>`` per label."""
    return (
        features.groupBy("fraud_label")
        .count()
        .select(
            F.lit(GOLD_TABLE).alias("table_name"),
            F.concat(F.lit("fraud_label_"), F.col("fraud_label").cast("string")).alias(
                "metric_name"
            ),
            F.col("count").cast("double").alias("metric_value"),
            now_or(run_ts).alias("metric_timestamp"),
        )
    )


# Reason texts and their order.
PREDICTION_RULES = (
    Rule("dq_provider", "Missing Provider", missing("Provider")),
    Rule("dq_probability", "Missing Fraud Probability", missing("fraud_probability")),
    Rule("dq_probability_range", "Invalid Fraud Probability", outside("fraud_probability", 0, 1)),
    Rule("dq_claims", "Negative Total Claims", negative("total_claims")),
    Rule("dq_reimbursement", "Negative Avg Reimbursement", negative("avg_reimbursement_amount")),
    Rule(
        "dq_claims_per_beneficiary",
        "Negative Claims Per Beneficiary",
        negative("claims_per_beneficiary"),
    ),
)


def quarantine_predictions(predictions: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Predictions that break a rule, with the reasons."""
    return (
        predictions.withColumn("dq_reason", reasons(PREDICTION_RULES))
        .filter(F.col("dq_reason") != "")
        .withColumn("quarantine_timestamp", now_or(run_ts))
    )
