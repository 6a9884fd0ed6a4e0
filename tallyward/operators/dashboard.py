"""Latest values, listings and change over time of the metrics history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.checks import METRIC_KEYS


def latest_values(history: DataFrame) -> DataFrame:
    """One row per metric: the latest time and a value of that time.

    Of several values at the latest time the largest is taken, so the result is repeatable.
    """
    latest = F.max(F.struct("metric_timestamp", "metric_value")).alias("latest")
    return history.groupBy(*METRIC_KEYS).agg(latest).select(
        *METRIC_KEYS,
        F.col("latest.metric_timestamp").alias("latest_metric_timestamp"),
        F.col("latest.metric_value").alias("latest_metric_value"),
    )


def latest_rows(history: DataFrame) -> DataFrame:
    """All rows at the latest time of their metric, ties included.

    Ranking with a limit of 1 lets Spark drop older rows of each task before the shuffle.
    """
    newest_first = Window.partitionBy(*METRIC_KEYS).orderBy(F.col("metric_timestamp").desc())
    return (
        history.filter(F.col("table_name").isNotNull() & F.col("metric_name").isNotNull())
        .withColumn("age_rank", F.rank().over(newest_first))
        .filter((F.col("age_rank") == 1) & F.col("metric_timestamp").isNotNull())
        .select(
            *METRIC_KEYS,
            F.col("metric_value").alias("latest_metric_value"),
            F.col("metric_timestamp").alias("latest_metric_timestamp"),
        )
    )


def quality_summary(summary: DataFrame) -> DataFrame:
    return summary.select(*METRIC_KEYS, "latest_metric_value", "latest_metric_timestamp").orderBy(
        *METRIC_KEYS
    )


def quarantine_metrics(history: DataFrame) -> DataFrame:
    return history.filter(F.col("metric_name").like("%quarantine%")).orderBy(
        F.col("metric_timestamp").desc(), *METRIC_KEYS
    )


def null_percentages(history: DataFrame) -> DataFrame:
    """Null shares, largest first. The prefix before the wildcard ``_`` can go to the scan."""
    name = F.col("metric_name")
    return (
        history.filter(name.startswith("null") & name.like("null_percent%"))
        .select(*METRIC_KEYS, "metric_value")
        .orderBy(F.col("metric_value").desc(), *METRIC_KEYS)
    )


def label_metrics(history: DataFrame) -> DataFrame:
    """Label counts. In the pattern ``_`` stands for any one character."""
    name = F.col("metric_name")
    return history.filter(name.startswith("fraud") & name.like("fraud_label_%")).select(
        "metric_name", "metric_value"
    )


def metric_drift(history: DataFrame, slice_unit: str = "day") -> DataFrame:
    """Each value with the one before it in its metric, the change and the relative change.

    Values are ordered by time within slices of ``slice_unit``; the first of a slice looks at the
    last of the slice before. So one long-running metric is never sorted as a whole: the window
    across slices sees one row per slice. Values at the same time are ordered by size.
    """
    sliced = history.withColumn("slice", F.date_trunc(slice_unit, "metric_timestamp"))
    keys = [*METRIC_KEYS, "slice"]
    closing = sliced.groupBy(*keys).agg(
        F.max(F.struct("metric_timestamp", "metric_value")).alias("closing")
    )
    across = Window.partitionBy(*METRIC_KEYS).orderBy("slice")
    opening = closing.select(
        *[F.col(k).alias(f"of_{k}") for k in keys],
        F.lag("closing.metric_value").over(across).alias("opening_value"),
    )
    inside = Window.partitionBy(*keys).orderBy("metric_timestamp", "metric_value")
    ranked = sliced.withColumns(
        {"place": F.row_number().over(inside), "before": F.lag("metric_value").over(inside)}
    )
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
    previous = F.when(F.col("place") == 1, F.col("opening_value")).otherwise(F.col("before"))
    change = F.col("metric_value") - F.col("previous_value")
    return (
        ranked.join(opening, same, "left")
        .withColumn("previous_value", previous)
        .select(
            *METRIC_KEYS,
            "metric_timestamp",
            "metric_value",
            "previous_value",
            change.alias("change"),
            F.try_divide(change, F.col("previous_value")).alias("relative_change"),
        )
    )
