"""Cross-checks between gold tables, and the context of an investigation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.sources.contracts import column_names

# What the aggregation of claims gives: the feature table's columns before the ratios, less the key.
_columns = column_names("gold.provider_fraud_features")
MEASURES = tuple(_columns[1 : _columns.index("inpatient_claim_ratio")])


def _differs(name: str, tolerance: float) -> Column:
    """Relative difference above the tolerance; null equals null only."""
    a, b = F.col(f"stored.{name}"), F.col(f"fresh.{name}")
    apart = F.abs(a - b) > F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return F.coalesce(apart, ~a.eqNullSafe(b))


def aggregate_consistency(
    stored: DataFrame,
    recomputed: DataFrame,
    measures: Sequence[str] = MEASURES,
    tolerance: float = 1e-9,
) -> DataFrame:
    """Per measure, how many providers differ between the stored and the recomputed table.

    A provider missing on one side differs in every measure that is known on the other.
    """
    columns = ["Provider", *measures]
    both = stored.select(columns).alias("stored").join(
        recomputed.select(columns).alias("fresh"),
        F.col("stored.Provider").eqNullSafe(F.col("fresh.Provider")),
        "full",
    )
    counts = both.agg(*[F.count_if(_differs(m, tolerance)).alias(m) for m in measures])
    return counts.unpivot([], list(measures), "measure", "differing_providers")


def investigation_context(
    features: DataFrame, predictions: DataFrame, quarantined: DataFrame
) -> DataFrame:
    """One row per scored provider: its score, all its features, and why it was quarantined."""
    shown = predictions.drop("prediction_timestamp")
    extra = [
        c
        for c in column_names("gold.provider_fraud_features")
        if c not in shown.columns and not c.endswith("_timestamp")
    ]
    flagged = quarantined.filter(F.col("Provider").isNotNull()).select("Provider", "dq_reason")
    return shown.join(features.select("Provider", *extra), "Provider", "left").join(
        flagged, "Provider", "left"
    )


def risk_by_quality(predictions: DataFrame, reasons: Column) -> DataFrame:
    """Providers and mean score per risk band and quality finding.

    The reasons are computed on the predictions themselves, which spares a join.
    """
    return (
        predictions.withColumn("quality_finding", reasons)
        .groupBy("fraud_risk_category", "quality_finding")
        .agg(
            F.count("*").alias("provider_count"),
            F.avg("fraud_probability").alias("avg_fraud_probability"),
        )
    )
