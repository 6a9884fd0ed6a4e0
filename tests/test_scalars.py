from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.functions import scalars as S


def apply(spark, values, kind, build):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", build(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_dates(spark):
    texts = ["2009-02-01", "2009-02-30", "NA", "", None, "2009-2-1", "2009", " 2009-02-01", "x"]
    day = dt.date(2009, 2, 1)
    assert apply(spark, texts, "string", S.parse_date) == [day] + [None] * 8
    assert apply(spark, texts, "string", S.parse_optional_date) == [day] + [None] * 8


PIECES = st.lists(
    st.sampled_from([*"0123456789", "-", " ", "+", "T", ":", "2009-", "-02-", "30", "Z", "é"]),
    max_size=11,
).map("".join)
WRITTEN = st.builds(
    "{:04d}-{:02d}-{:02d}".format, st.integers(1, 9999), st.integers(0, 14), st.integers(0, 33)
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(PIECES, WRITTEN), min_size=150, max_size=300))
def test_parse_date_equals_the_pattern_parser(spark, texts):
    by_pattern = apply(spark, texts, "string", lambda c: F.try_to_date(c, "yyyy-MM-dd"))
    assert apply(spark, texts, "string", S.parse_date) == by_pattern


def test_numbers(spark):
    texts = ["-1", "0", "4999.99", "5000", "NA", None, ""]
    numbers = [-1.0, 0.0, 4999.99, 5000.0, None, None, None]
    assert apply(spark, texts, "string", S.to_number) == numbers
    assert apply(spark, [1.5, None], "double", S.to_number) == [1.5, None]


def test_age_boundaries(spark):
    as_of = F.lit("2009-12-01").cast("date")
    births = ["2009-12-01", "1889-11-30", "1888-11-29", "2010-12-02", None, "1950-06-15"]
    ages = apply(spark, births, "string", lambda c: S.age_in_years(c.cast("date"), as_of))
    assert ages == [0, 120, 121, -2, None, 59]


def test_text_codes(spark):
    codes = [1, 2, 0, None]
    assert apply(spark, codes, "int", S.gender_text) == ["Male", "Female", "Unknown", "Unknown"]
    assert apply(spark, codes, "int", S.as_text) == ["1", "2", "0", None]
    answers = ["Yes", "No", "Unknown", None, "yes"]
    assert apply(spark, answers, "string", S.label_code) == [1, 0, None, None, None]
    assert apply(spark, [1, 0, None], "int", S.label_status) == ["Fraud", "Non-Fraud", "Unknown"]


def test_flags(spark):
    deaths = [dt.date(2009, 6, 1), None]
    assert apply(spark, deaths, "date", S.is_deceased) == [1, 0]
    amounts = [4999.99, 5000.0, None, -1.0]
    assert apply(spark, amounts, "double", S.is_high_reimbursement) == [0, 1, 0, 0]


def test_durations(spark):
    df = spark.createDataFrame(
        [("2009-01-01", "2009-01-01"), ("2009-01-05", "2009-01-01"), (None, "2009-01-01")],
        "a string, b string",
    ).select(S.inclusive_days(F.col("a").cast("date"), F.col("b").cast("date")).alias("d"))
    assert [r["d"] for r in df.collect()] == [1, -3, None]


@pytest.mark.parametrize(
    "ratio, segment",
    [
        (-0.01, "Low Risk"),
        (0.0, "Low Risk"),
        (0.0999, "Low Risk"),
        (0.10, "Medium Risk"),
        (0.2999, "Medium Risk"),
        (0.30, "High Risk"),
        (1.0, "High Risk"),
        (1.01, "High Risk"),
        (None, "Low Risk"),
    ],
)
def test_risk_segment(spark, ratio, segment):
    assert apply(spark, [ratio], "double", S.risk_segment) == [segment]


def test_risk_band_including_nan(spark):
    scores = [-0.1, 0.0, 0.4999, 0.50, 0.7999, 0.80, 1.0, 1.1, float("nan"), None]
    low, medium, high = "Low Risk", "Medium Risk", "High Risk"
    assert apply(spark, scores, "double", S.risk_band) == [
        low, low, low, medium, medium, high, high, high, low, low,
    ]


def test_any_equals_one(spark):
    df = spark.createDataFrame(
        [(1, 2), (2, 2), (None, 1), (None, 2), (None, None)], "a int, b int"
    ).select(S.any_equals_one(["a", "b"]).alias("r"))
    assert [r["r"] for r in df.collect()] == [1, 0, 1, 0, 0]
