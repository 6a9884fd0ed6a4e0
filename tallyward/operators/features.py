"""Provider features: claims joined with beneficiaries and labels, one row per provider."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import scalars as S
from tallyward.operators.silver import INPATIENT, OUTPATIENT, now_or
from tallyward.sources.contracts import CONDITION_COLUMNS, column_names

STAMP = "gold_processed_timestamp"

# Numerators of the ratios over total_claims.
RATIOS = {
    "inpatient_claim_ratio": "inpatient_claims",
    "outpatient_claim_ratio": "outpatient_claims",
    "high_reimbursement_claim_ratio": "high_reimbursement_claims",
    "chronic_condition_claim_ratio": "chronic_condition_claims",
}

# Averages, each kept as a sum and a count of known values until the last step.
AVERAGES = {
    "avg_reimbursement_amount": "InscClaimAmtReimbursed",
    "avg_deductible_amount": "DeductibleAmtPaid",
    "avg_claim_duration_days": "claim_duration_days",
    "avg_hospital_stay_days": "hospital_stay_days",
}


def chronic_flags(beneficiaries: DataFrame) -> DataFrame:
    """(BeneID, has_chronic_condition): all the join needs of the beneficiary table."""
    return beneficiaries.select(
        "BeneID", S.any_equals_one(CONDITION_COLUMNS).alias("has_chronic_condition")
    )


def join_beneficiaries(claims: DataFrame, beneficiaries: DataFrame) -> DataFrame:
    """Claims with their beneficiary's columns; claims without a beneficiary stay."""
    return claims.join(beneficiaries, "BeneID", "left")


def claim_indicators(
    claims: DataFrame, high_amount: float = S.HIGH_REIMBURSEMENT
) -> DataFrame:
    """Per-claim 0/1 columns: kind of claim and high reimbursement."""
    return claims.withColumns(
        {
            "is_inpatient_claim": S.flag(F.col("claim_type") == INPATIENT),
            "is_outpatient_claim": S.flag(F.col("claim_type") == OUTPATIENT),
            "is_high_reimbursement_claim": S.is_high_reimbursement(
                F.col("InscClaimAmtReimbursed"), high_amount
            ),
        }
    )


def patient_visits(claims: DataFrame) -> DataFrame:
    """Number of claims per provider and beneficiary."""
    return claims.groupBy("Provider", "BeneID").agg(F.count("*").alias("claim_rows"))


def provider_totals(
    claims: DataFrame, beneficiaries: DataFrame, approx: bool = False
) -> DataFrame:
    """The 13 measures per provider, from claims with indicators.

    Three parts meet in one aggregation, which combines within each task before its shuffle: the
    claims with their amounts, which are shuffled here alone; the visits; and the claim ids. Claims
    are counted per provider and beneficiary before the join. That step counts beneficiaries exactly
    and leaves the join far fewer and narrower rows; a heavy beneficiary has at most one row per
    provider, a heavy provider is spread over its beneficiaries. Claim ids are made distinct on the
    two columns they need, or estimated with ``approx``.
    """
    visits = (
        patient_visits(claims)
        .join(chronic_flags(beneficiaries), "BeneID", "left")
        .select(
            "Provider",
            "BeneID",
            (F.col("claim_rows") * F.coalesce("has_chronic_condition", F.lit(0))).alias(
                "chronic_condition_claims"
            ),
        )
    )
    measured = claims.select(
        "Provider",
        F.col("is_inpatient_claim").alias("inpatient_claims"),
        F.col("is_outpatient_claim").alias("outpatient_claims"),
        F.col("is_high_reimbursement_claim").alias("high_reimbursement_claims"),
        *AVERAGES.values(),
    )
    ids = claims.select("Provider", "ClaimID")
    if approx:
        counted = ids.groupBy("Provider").agg(F.approx_count_distinct("ClaimID").alias("claims"))
    else:
        known = S.flag(F.col("ClaimID").isNotNull())
        counted = ids.distinct().select("Provider", known.alias("claims"))

    def total(column: str) -> Column:
        return F.sum(column).alias(column)

    parts = [measured, visits, counted]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    sums = union.groupBy("Provider").agg(
        F.sum("claims").cast("bigint").alias("total_claims"),
        F.count("BeneID").alias("unique_beneficiaries"),
        total("inpatient_claims"),
        total("outpatient_claims"),
        total("high_reimbursement_claims"),
        total("chronic_condition_claims"),
        F.max("InscClaimAmtReimbursed").alias("max_reimbursement_amount"),
        *[
            agg(c).alias(f"{kind}_{c}")
            for c in AVERAGES.values()
            for kind, agg in (("sum", F.sum), ("known", F.count))
        ],
    )
    return sums.select(
        "Provider",
        "total_claims",
        "unique_beneficiaries",
        "inpatient_claims",
        "outpatient_claims",
        *[
            F.try_divide(F.col(f"sum_{c}"), F.col(f"known_{c}")).alias(name)
            for name, c in AVERAGES.items()
        ],
        F.col("sum_InscClaimAmtReimbursed").alias("total_reimbursement_amount"),
        "max_reimbursement_amount",
        F.col("sum_DeductibleAmtPaid").alias("total_deductible_amount"),
        "high_reimbursement_claims",
        "chronic_condition_claims",
    )


def add_ratios(totals: DataFrame) -> DataFrame:
    """Shares of total_claims, and claims per beneficiary; null where the divisor is 0."""
    ratios = {
        name: F.try_divide(F.col(part), F.col("total_claims")) for name, part in RATIOS.items()
    }
    ratios["claims_per_beneficiary"] = F.try_divide(
        F.col("total_claims"), F.col("unique_beneficiaries")
    )
    return totals.withColumns(ratios)


def attach_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels.select("Provider", "fraud_label"), "Provider", "left")


def fill_features(features: DataFrame, fill_label: bool = True) -> DataFrame:
    """0 for providers without hospital stays and, unless told otherwise, without a label."""
    label = {"fraud_label": 0} if fill_label else {}
    return features.fillna({"avg_hospital_stay_days": 0} | label)


def provider_features(
    claims: DataFrame,
    beneficiaries: DataFrame,
    labels: DataFrame,
    run_ts: Column | None = None,
    high_amount: float = S.HIGH_REIMBURSEMENT,
    fill_label: bool = True,
    approx: bool = False,
) -> DataFrame:
    """The gold feature table. ``beneficiaries`` and ``labels`` have unique keys."""
    totals = provider_totals(claim_indicators(claims, high_amount), beneficiaries, approx)
    labelled = attach_labels(add_ratios(totals), labels).withColumn(STAMP, now_or(run_ts))
    return fill_features(labelled, fill_label).select(
        column_names("gold.provider_fraud_features")
    )


def provider_analytics(
    features: DataFrame, high: float = S.SEGMENT_HIGH, medium: float = S.SEGMENT_MEDIUM
) -> DataFrame:
    """The analyst table: label as text and a risk segment by high-reimbursement ratio."""
    return features.withColumns(
        {
            "fraud_status": S.label_status(F.col("fraud_label")),
            "risk_segment": S.risk_segment(F.col("high_reimbursement_claim_ratio"), high, medium),
        }
    ).select(column_names("gold.provider_fraud_analytics"))


def fill_numbers(df: DataFrame) -> DataFrame:
    """0 for nulls in every numeric column; other columns stay."""
    return df.fillna(0)


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()
