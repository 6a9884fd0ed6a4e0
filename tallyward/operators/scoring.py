"""Batch scoring, risk bands and the text prompt per provider."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import scalars as S
from tallyward.operators.modeling import FEATURES, predict
from tallyward.operators.silver import now_or
from tallyward.sources.contracts import column_names


def prediction_columns(scored: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Band the probability and keep the 17 columns of the prediction table."""
    return scored.withColumns(
        {
            "fraud_risk_category": S.risk_band(F.col("fraud_probability")),
            "prediction_timestamp": now_or(run_ts),
        }
    ).select(column_names("gold.provider_fraud_predictions"))


def score_providers(
    model: PipelineModel, features: DataFrame, run_ts: Column | None = None
) -> DataFrame:
    """Score every provider where its row lies. The label travels along untouched."""
    ready = features.select("Provider", "fraud_label", *FEATURES).fillna(0, list(FEATURES))
    return prediction_columns(predict(model, ready), run_ts)


# The prompt, as (text before the value, column), and its closing words.
PROMPT_PARTS = (
    ("Analyze this healthcare provider.\n\nProvider: ", "Provider"),
    ("\nFraud Probability: ", "fraud_probability"),
    ("\nTotal Claims: ", "total_claims"),
    ("\nAverage Reimbursement: ", "avg_reimbursement_amount"),
    ("\nClaims Per Beneficiary: ", "claims_per_beneficiary"),
    ("\nRisk Category: ", "fraud_risk_category"),
)
PROMPT_END = "\n\nExplain why this provider may be suspicious."


def add_prompts(predictions: DataFrame, decimals: int | None = None) -> DataFrame:
    """Add ``fraud_analysis_prompt``; null if any value in it is null.

    ``decimals`` fixes the digits of fractional numbers; without it Spark's own text is used.
    """
    kinds = dict(predictions.dtypes)

    def as_text(name: str) -> Column:
        if decimals is not None and kinds[name] == "double":
            value = F.col(name)
            return F.when(value.isNotNull(), F.format_string(f"%.{decimals}f", value))
        return F.col(name).cast("string")

    pieces = [p for text, name in PROMPT_PARTS for p in (F.lit(text), as_text(name))]
    return predictions.withColumn("fraud_analysis_prompt", F.concat(*pieces, F.lit(PROMPT_END)))
