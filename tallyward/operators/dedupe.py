"""One row per business key."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe(
    df: DataFrame,
    key: str,
    copies: str | None = None,
    parsers: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Keep, for each key, the row that sorts first by all other columns (nulls first).

    The null key counts as one key. The smallest row is an aggregate, so each task sends at most
    one row per key through the shuffle: a key that holds a third of the table costs no more than
    any other. The choice depends on values only, so a recomputed task keeps the same row.

    ``copies`` names a column for the number of rows the key had. ``parsers`` turn columns of the
    kept row into other values; as a part of the aggregate they run once per row, where a filter
    above a projection would run them again for each of its conditions.
    """
    parsers = parsers or {}
    others = [c for c in df.columns if c != key]
    kept = F.min(F.struct(*others))
    values = [parsers.get(c, lambda value: value)(kept[c]).alias(c) for c in others]
    counted = [F.count("*").alias(copies)] if copies else []
    grouped = df.groupBy(key).agg(*values, *counted)
    return grouped.select(*df.columns, *([copies] if copies else []))
