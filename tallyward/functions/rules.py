"""Row rules: declared once, compiled to flag columns, a validity column and reason text.

Each kind of rule states what a null does. ``missing`` and ``disordered`` fail on null; the
others pass it, because a comparison with null is not true.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.scalars import flag

REASON_SEPARATOR = ", "


@dataclass(frozen=True)
class Rule:
    """``fails`` builds the condition late, since columns need a running session."""

    flag_column: str
    reason: str
    fails: Callable[[], Column]

    def as_flag(self) -> Column:
        return flag(self.fails()).alias(self.flag_column)


def missing(name: str) -> Callable[[], Column]:
    """Fails on null."""
    return lambda: F.col(name).isNull()


def outside(name: str, low: float, high: float) -> Callable[[], Column]:
    """Fails below ``low`` or above ``high``; null passes, NaN fails as the largest number."""
    return lambda: (F.col(name) < low) | (F.col(name) > high)


def disordered(start: str, end: str) -> Callable[[], Column]:
    """Fails if either is null or the end lies before the start."""
    return lambda: F.col(start).isNull() | F.col(end).isNull() | (F.col(end) < F.col(start))


def negative(name: str) -> Callable[[], Column]:
    """Fails below zero; null passes."""
    return lambda: F.col(name) < 0


def not_positive(name: str) -> Callable[[], Column]:
    """Fails at zero and below; null passes."""
    return lambda: F.col(name) <= 0


def not_in(name: str, values: Sequence) -> Callable[[], Column]:
    """Fails on any other value; null passes."""
    return lambda: ~F.col(name).isin(*values)


def reasons(rules: Sequence[Rule]) -> Column:
    """Reasons of the failed rules in rule order; empty text if none failed."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(r.fails(), F.lit(r.reason)) for r in rules])


def all_pass(rules: Sequence[Rule]) -> Column:
    """1 if no rule fails."""
    return flag(reduce(Column.__and__, [F.col(r.flag_column) == 0 for r in rules]))


def flag_rows(df: DataFrame, rules: Sequence[Rule], valid: str = "dq_is_valid") -> DataFrame:
    """Add one 0/1 column per rule, and the validity column."""
    return df.select("*", *[r.as_flag() for r in rules]).withColumn(valid, all_pass(rules))


def valid_rows(flagged: DataFrame, valid: str = "dq_is_valid") -> DataFrame:
    return flagged.filter(F.col(valid) == 1)


def flagged_reasons(rules: Sequence[Rule]) -> Column:
    """As ``reasons``, from flag columns already computed."""
    return F.concat_ws(
        REASON_SEPARATOR, *[F.when(F.col(r.flag_column) == 1, F.lit(r.reason)) for r in rules]
    )


def quarantined_rows(
    flagged: DataFrame, rules: Sequence[Rule], valid: str = "dq_is_valid"
) -> DataFrame:
    """The invalid rows with the reasons they failed."""
    return flagged.filter(F.col(valid) == 0).withColumn("quarantine_reason", flagged_reasons(rules))
