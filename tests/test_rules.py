from __future__ import annotations

from tallyward.functions import rules as R


def flags_of(spark, rule_kind, rows, schema):
    df = spark.createDataFrame(rows, schema)
    flagged = R.flag_rows(df, [R.Rule("bad", "Bad", rule_kind)])
    return [r["bad"] for r in flagged.collect()]


def test_null_fails_only_where_stated(spark):
    assert flags_of(spark, R.missing("a"), [(None,), (1,)], "a int") == [1, 0]
    values = [(None,), (-1.0,), (0.0,), (120.0,), (120.5,), (float("nan"),)]
    assert flags_of(spark, R.outside("a", 0, 120), values, "a double") == [0, 1, 0, 0, 1, 1]
    assert flags_of(spark, R.negative("a"), [(None,), (-1.0,), (0.0,)], "a double") == [0, 1, 0]
    assert flags_of(spark, R.not_positive("a"), [(None,), (0,), (1,)], "a int") == [0, 1, 0]
    assert flags_of(spark, R.not_in("a", ["x"]), [(None,), ("x",), ("y",)], "a string") == [0, 0, 1]
    pairs = [(None, 1), (1, None), (2, 1), (1, 1), (1, 2)]
    assert flags_of(spark, R.disordered("a", "b"), pairs, "a int, b int") == [1, 1, 1, 0, 0]


RULES = [
    R.Rule("dq_a", "Missing A", R.missing("a")),
    R.Rule("dq_b", "Negative B", R.negative("b")),
]


def test_split_and_reasons(spark):
    rows = [(1, 1), (None, 1), (1, -1), (None, -1), (1, None)]
    flagged = R.flag_rows(spark.createDataFrame(rows, "a int, b int"), RULES)
    good, bad = R.valid_rows(flagged), R.quarantined_rows(flagged, RULES)
    assert good.count() == 2
    assert sorted(r["quarantine_reason"] for r in bad.collect()) == [
        "Missing A",
        "Missing A, Negative B",
        "Negative B",
    ]
    assert good.count() + bad.count() == len(rows)


def test_reasons_of_a_good_row_are_empty_text(spark):
    df = spark.createDataFrame([(1, 1)], "a int, b int")
    assert df.select(R.reasons(RULES).alias("r")).first()["r"] == ""


def test_empty_table(spark):
    flagged = R.flag_rows(spark.createDataFrame([], "a int, b int"), RULES)
    assert flagged.count() == 0
    assert flagged.columns == ["a", "b", "dq_a", "dq_b", "dq_is_valid"]
