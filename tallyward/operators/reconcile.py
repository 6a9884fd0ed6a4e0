"""Rows without a partner, and differences of tables as multisets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_partner(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """The rows whose key some parent has; null keys have none."""
    return rows.join(_keys(parents, parent_key), F.col(key) == F.col("_key"), "left_semi")


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """The rows whose key no parent has, without those of a null key; `without_key` has them."""
    found = rows.filter(F.col(key).isNotNull())
    return found.join(_keys(parents, parent_key), F.col(key) == F.col("_key"), "left_anti")


def without_key(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col(key).isNull())


def _keys(parents: DataFrame, key: str) -> DataFrame:
    """The parents' keys, once each, so that a key of very many parents is one row."""
    return parents.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()


def orphan_counts(
    name: str, rows: DataFrame, key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """(kind, n_rows, n_keys) for orphans and rows without a key; zeros where there are none.

    Rows are counted by key before they meet the parents, so a hot key is one row in the join.
    """
    counts = rows.groupBy(F.col(key).alias("_row_key")).agg(F.count("*").alias("n"))
    lone = orphans(counts, "_row_key", parents, parent_key)

    def shown(kind: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count("_row_key").alias("n_keys"),
        ).select(F.lit(f"{name}: {kind}").alias("kind"), "n_rows", "n_keys")

    missing = counts.filter("_row_key IS NULL")
    return shown("no partner", lone).unionByName(shown("no key", missing))


def differences(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, n_left, n_right) of the rows that are not in both tables equally often.

    Nulls are equal to each other, and so are NaNs. One aggregate over both tables: a row that occurs
    very often costs one row per task.
    """
    both = (
        left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(*columns)
        .agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    )
    return both.filter("n_left <> n_right")


def except_all(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``left``, each as often as it is there more than in ``right``."""
    more = differences(left, right, columns).filter("n_left > n_right")
    times = F.explode(F.sequence(F.lit(1), (F.col("n_left") - F.col("n_right")).cast("int")))
    return more.select(*columns, times.alias("_nth")).drop("_nth")


def overlap_summary(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n_left, n_right, n_common, n_left_only, n_right_only), counted with multiplicity; one row."""
    counted = (
        left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(*columns)
        .agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    )
    zero = F.lit(0).cast("bigint")
    common = F.least("l", "r")
    measures = {
        "n_left": F.col("l"),
        "n_right": F.col("r"),
        "n_common": common,
        "n_left_only": F.col("l") - common,
        "n_right_only": F.col("r") - common,
    }
    return counted.agg(*[F.coalesce(F.sum(m), zero).alias(n) for n, m in measures.items()])
