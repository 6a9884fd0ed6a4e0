"""Analyst reports over features, predictions, prompts and quality tables.

Every ordering ends in the provider, so that equal scores come in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.scalars import HIGH_RISK


def _by_probability(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy(F.col("fraud_probability").desc(), "Provider")


def top_providers(predictions: DataFrame, rows: int = 25) -> DataFrame:
    return _by_probability(predictions).limit(rows).select(
        "Provider",
        "fraud_probability",
        "fraud_risk_category",
        "total_claims",
        "unique_beneficiaries",
        "claims_per_beneficiary",
        "avg_reimbursement_amount",
        "total_reimbursement_amount",
        "high_reimbursement_claim_ratio",
        "chronic_condition_claim_ratio",
    )


def suspicious_providers(predictions: DataFrame, rows: int = 20) -> DataFrame:
    return _by_probability(predictions).limit(rows).select(
        "Provider",
        "fraud_probability",
        "fraud_risk_category",
        "total_claims",
        "avg_reimbursement_amount",
        "high_reimbursement_claim_ratio",
        "claims_per_beneficiary",
    )


def high_risk_providers(predictions: DataFrame) -> DataFrame:
    return _by_probability(predictions.filter(F.col("fraud_risk_category") == HIGH_RISK))


def risk_distribution(predictions: DataFrame) -> DataFrame:
    return (
        predictions.groupBy("fraud_risk_category")
        .agg(
            F.count("*").alias("provider_count"),
            F.avg("fraud_probability").alias("avg_fraud_probability"),
            F.avg("total_claims").alias("avg_total_claims"),
            F.avg("avg_reimbursement_amount").alias("avg_reimbursement_amount"),
        )
        .orderBy(F.col("avg_fraud_probability").desc())
    )


def actual_and_predicted(predictions: DataFrame) -> DataFrame:
    keys = ["fraud_label", "predicted_fraud_label"]
    return predictions.groupBy(*keys).agg(F.count("*").alias("provider_count")).orderBy(*keys)


def _concentrated(providers: DataFrame, min_claims: int, rows: int) -> DataFrame:
    return (
        providers.filter(F.col("total_claims") >= min_claims)
        .orderBy(
            F.col("high_reimbursement_claim_ratio").desc(),
            F.col("avg_reimbursement_amount").desc(),
            "Provider",
        )
        .limit(rows)
    )


CONCENTRATION_COLUMNS = [
    "total_claims",
    "high_reimbursement_claim_ratio",
    "avg_reimbursement_amount",
    "max_reimbursement_amount",
    "claims_per_beneficiary",
]


def concentrated_features(features: DataFrame, min_claims: int = 10, rows: int = 50) -> DataFrame:
    """Providers with the largest share of high-reimbursement claims."""
    return _concentrated(features, min_claims, rows).select("Provider", *CONCENTRATION_COLUMNS)


def concentrated_providers(
    features: DataFrame, predictions: DataFrame, min_claims: int = 10, rows: int = 50
) -> DataFrame:
    """As ``concentrated_features``, with each provider's score.

    The top rows are picked before the join, so only they meet the predictions.
    """
    top = concentrated_features(features, min_claims, rows)
    scores = predictions.select("Provider", "fraud_probability", "fraud_risk_category")
    return _concentrated(top.join(scores, "Provider", "left"), min_claims, rows).select(
        "Provider", "fraud_probability", "fraud_risk_category", *CONCENTRATION_COLUMNS
    )


def importance_ranking(importance: DataFrame) -> DataFrame:
    return importance.select("feature_name", "importance_score").orderBy(
        F.col("importance_score").desc(), "feature_name"
    )


def top_prompts(prompts: DataFrame, rows: int = 20) -> DataFrame:
    return _by_probability(prompts).limit(rows).select(
        "Provider", "fraud_probability", "fraud_risk_category", "fraud_analysis_prompt"
    )


def newest_quarantined(quarantined: DataFrame) -> DataFrame:
    return quarantined.orderBy(F.col("quarantine_timestamp").desc(), "Provider")
