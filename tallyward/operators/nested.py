"""Lists of reasons, and tags kept as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.rules import Rule

CORRUPT = "_corrupt"


def reason_list(rules: Sequence[Rule]) -> Column:
    """Reasons of the failed rules, from their flag columns, as a list in rule order.

    Taken from the flags and not from the joined text, so a reason may hold the separator.
    """
    each = [F.when(F.col(r.flag_column) == 1, F.lit(r.reason)) for r in rules]
    return F.array_compact(F.array(*each))


def reason_counts(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(reason, n_rows): how many rows fail each rule; rules that nothing fails are not listed."""
    each = flagged.select(F.explode(reason_list(rules)).alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n_rows"))


def reason_pairs(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(reason, other, n_rows): how many rows fail two rules together, the earlier rule first.

    A row gives as many pairs as it fails, which the number of rules bounds.
    """
    listed = flagged.select(reason_list(rules).alias("r"))
    pairs = F.expr(
        "flatten(transform(r, (x, i) -> transform(slice(r, i + 2, size(r)), "
        "y -> struct(x AS reason, y AS other))))"
    )
    return (
        listed.select(F.explode(pairs).alias("pair"))
        .groupBy("pair.reason", "pair.other")
        .agg(F.count("*").alias("n_rows"))
    )


def tags_as_json(tags: str) -> Column:
    """A map as JSON text with its keys in order, so equal maps have equal texts."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(tags)))
    return F.to_json(ordered)


def parsed(rows: DataFrame, text: str, schema: str) -> DataFrame:
    """``rows`` with the fields of their JSON text as columns, and ``_corrupt``.

    A text that is no JSON object of the schema has null fields and stands in ``_corrupt`` whole; a
    null text has nulls everywhere. Fields that are absent are null.
    """
    found = F.from_json(text, f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return rows.withColumn("_parsed", found).select(*rows.columns, "_parsed.*")
