"""Joins and sums along time: the value known at a time, overlapping stays, rolling sums.

Time is cut into slices, so one busy key is many partitions of a window and not one sort. Rows are
joined by plain shuffles, which adaptive execution splits where a key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def day_number(date: Column) -> Column:
    return F.unix_date(date.cast("date"))


def _slice(time: Column, days: int) -> Column:
    return F.floor(day_number(time) / days)


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    values: Sequence[str],
    slice_days: int = 90,
) -> DataFrame:
    """All rows of ``left`` with the ``values`` of the last row of ``right`` not after ``left_time``.

    Rows of one key and time in ``right`` are one: the one whose values sort last. A null value is a
    value and does not fall back to an earlier row. Rows of ``left`` without a key or time, and those
    before the first row of their key, get nulls; rows of ``right`` without a key or time are passed
    over. Both times are dates or both are timestamps.

    Only distinct pairs of key and time are put in order, so rows that repeat them cost nothing here.
    Each slice starts from the last value of the slices before it, which come from ``right`` alone:
    the many times of ``left`` are sorted in their window and in no other place.
    """
    known = (
        right.filter(F.col(by).isNotNull() & F.col(right_time).isNotNull())
        .groupBy(F.col(by).alias("_by"), F.col(right_time).alias("_at"))
        .agg(F.max(F.struct(*[F.col(v) for v in values])).alias("_value"))
    )
    asked = (
        left.filter(F.col(by).isNotNull() & F.col(left_time).isNotNull())
        .select(F.col(by).alias("_by"), F.col(left_time).alias("_at"))
        .distinct()
    )
    empty = F.lit(None).cast(known.schema["_value"].dataType)
    points = (
        known.withColumn("_asks", F.lit(False))
        .unionByName(asked.withColumn("_value", empty).withColumn("_asks", F.lit(True)))
        .withColumn("_slice", _slice(F.col("_at"), slice_days))
    )
    # one row per key and slice that asks: what the slices before leave it with
    asking = asked.select("_by", _slice(F.col("_at"), slice_days).alias("_slice")).distinct()
    last_known = F.max(F.struct("_at", "_value")).alias("_end")
    ends = known.groupBy("_by", _slice(F.col("_at"), slice_days).alias("_slice")).agg(last_known)
    before = W.partitionBy("_by").orderBy("_slice").rangeBetween(W.unboundedPreceding, -1)
    carried = (
        ends.withColumn("_asks", F.lit(False))
        .unionByName(asking.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
        .withColumn("_carried", F.last("_end", ignorenulls=True).over(before)["_value"])
        .filter("_asks")
        .select("_by", "_slice", "_carried")
    )
    # values come before questions of the same time
    upto = W.partitionBy("_by", "_slice").orderBy("_at", "_asks")
    found = F.last(F.when(~F.col("_asks"), F.struct("_value")), ignorenulls=True).over(upto)
    answers = (
        points.select("*", found.alias("_found"))
        .filter("_asks")
        .join(carried, ["_by", "_slice"], "left")
        .select(
            F.col("_by"),
            F.col("_at"),
            F.coalesce(F.col("_found._value"), F.col("_carried")).alias("_value"),
        )
    )
    return left.join(
        answers, (left[by] == answers["_by"]) & (left[left_time] == answers["_at"]), "left"
    ).select(*[left[c] for c in left.columns], *[F.col(f"_value.{v}").alias(v) for v in values])


def overlapping(
    stays: DataFrame, by: str, key: str, start: str, end: str, keep: Sequence[str] = (), days: int = 16
) -> DataFrame:
    """Pairs of stays of one ``by`` that share a day: (by, a, b, days), with ``keep`` of either.

    ``a`` has the smaller key. Bounds are dates and belong to the stay. A stay without a key, bound or
    ``by``, or that ends before it starts, overlaps with nothing. Rows of equal keys are no pair.

    Each stay is put into the bins of ``days`` days that it touches, and a pair is taken in the bin
    where the later of the two starts and in no other. A key with very many stays is many bins, and
    a bin with very many is split by the join.
    """
    first, last = day_number(F.col(start)), day_number(F.col(end))
    binned = (
        stays.filter(F.col(by).isNotNull() & F.col(key).isNotNull() & (first <= last))
        .select(F.col(by).alias("_by"), F.col(key).alias("_key"), first.alias("_first"),
                last.alias("_last"), *keep)
        .withColumn(
            "_bin",
            F.explode(F.sequence(F.floor(F.col("_first") / days), F.floor(F.col("_last") / days))),
        )
    )
    a, b = binned.alias("a"), binned.alias("b")
    later = F.greatest("a._first", "b._first")
    earlier = F.least("a._last", "b._last")
    return a.join(
        b,
        (F.col("a._by") == F.col("b._by"))
        & (F.col("a._bin") == F.col("b._bin"))
        & (F.col("a._key") < F.col("b._key"))
        & (later <= earlier)
        & (F.floor(later / days) == F.col("a._bin")),
    ).select(
        F.col("a._by").alias(by),
        F.col("a._key").alias("a"),
        F.col("b._key").alias("b"),
        (earlier - later + 1).alias("days"),
        *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in keep for side in "ab"],
    )


def rolling(
    rows: DataFrame,
    by: str,
    date: str,
    days: int,
    measures: Mapping[str, Column],
    slice_days: int = 360,
) -> DataFrame:
    """Sums over the last ``days`` days up to each date that a key has rows on: (by, date, measures).

    ``measures`` are numbers of single rows; a null counts as nothing, and a sum of nulls alone is
    null. Rows without a date are passed over; null is a key.

    Rows are summed by key and date first, so a date with very many rows is one. Slices are summed
    apart: the dates within ``days`` of a slice's end are shown to the next slice as well.
    """
    daily = (
        rows.filter(F.col(date).isNotNull())
        .select(F.col(by).alias("_by"), F.col(date).cast("date").alias("_date"),
                *[c.alias(n) for n, c in measures.items()])
        .groupBy("_by", "_date")
        .agg(*[F.sum(n).alias(n) for n in measures])
        .withColumn("_day", day_number(F.col("_date")))
    )
    own = F.floor(F.col("_day") / slice_days)
    last_seen = F.floor((F.col("_day") + days - 1) / slice_days)
    shown = daily.withColumn("_own", own).withColumn("_slice", F.explode(F.sequence(own, last_seen)))
    upto = W.partitionBy("_by", "_slice").orderBy("_day").rangeBetween(1 - days, 0)
    return (
        shown.select("*", *[F.sum(n).over(upto).alias(f"_{n}") for n in measures])
        .filter("_slice = _own")
        .select(
            F.col("_by").alias(by),
            F.col("_date").alias(date),
            *[F.col(f"_{n}").alias(n) for n in measures],
        )
    )


def with_rolling(
    rows: DataFrame, by: str, date: str, days: int, measures: Mapping[str, Column]
) -> DataFrame:
    """Every row with the rolling sums of its key and date; nulls where it has no date."""
    sums = rolling(rows, by, date, days, measures).withColumnsRenamed({by: "_by", date: "_date"})
    same = rows[by].eqNullSafe(sums["_by"]) & (rows[date] == sums["_date"])
    return rows.join(sums, same, "left").select(*[rows[c] for c in rows.columns], *measures)
