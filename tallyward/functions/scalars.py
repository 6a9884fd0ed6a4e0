"""Derived columns. All are built-in expressions, so they stay inside generated code.

Text that does not parse becomes null, never an error; the row rules then decide what happens.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MISSING_TEXT = "NA"
DAYS_PER_YEAR = 365.25
HIGH_REIMBURSEMENT = 5000.0
SEGMENT_HIGH, SEGMENT_MEDIUM = 0.30, 0.10
BAND_HIGH, BAND_MEDIUM = 0.80, 0.50
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "High Risk", "Medium Risk", "Low Risk"


def parse_date(text: Column) -> Column:
    """The date written as yyyy-MM-dd; null for any other text.

    The plain cast is several times faster than a pattern, and takes more spellings; comparing the
    date's own text with the input leaves only the full form.
    """
    day = text.try_cast("date")
    return F.when(day.cast("string") == text, day)


def parse_optional_date(text: Column) -> Column:
    """As ``parse_date``; the text NA stands for no date."""
    return parse_date(F.nullif(text, F.lit(MISSING_TEXT)))


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def age_in_years(birth: Column, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, birth) / F.lit(DAYS_PER_YEAR))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def is_deceased(death: Column) -> Column:
    return flag(death.isNotNull())


def gender_text(code: Column) -> Column:
    return F.when(code == 1, "Male").when(code == 2, "Female").otherwise("Unknown")


def as_text(code: Column) -> Column:
    return code.cast("string")


def inclusive_days(start: Column, end: Column) -> Column:
    """Days from start to end, counting both."""
    return F.datediff(end, start) + 1


def label_code(answer: Column) -> Column:
    return F.when(answer == "Yes", 1).when(answer == "No", 0)


def any_equals_one(columns: Iterable[str]) -> Column:
    """1 if any of the columns is 1; nulls count as not one."""
    return flag(reduce(Column.__or__, [F.col(c) == 1 for c in columns]))


def is_high_reimbursement(amount: Column, threshold: float = HIGH_REIMBURSEMENT) -> Column:
    return flag(amount >= threshold)


def label_status(label: Column) -> Column:
    return F.when(label == 1, "Fraud").when(label == 0, "Non-Fraud").otherwise("Unknown")


def risk_segment(
    ratio: Column, high: float = SEGMENT_HIGH, medium: float = SEGMENT_MEDIUM
) -> Column:
    return F.when(ratio >= high, HIGH_RISK).when(ratio >= medium, MEDIUM_RISK).otherwise(LOW_RISK)


def risk_band(
    probability: Column, high: float = BAND_HIGH, medium: float = BAND_MEDIUM
) -> Column:
    """Band of a probability. NaN is Low Risk, although Spark sorts it above every number."""
    known = F.when(~F.isnan(probability), probability)
    return F.when(known >= high, HIGH_RISK).when(known >= medium, MEDIUM_RISK).otherwise(LOW_RISK)
