from __future__ import annotations

import datetime as dt
import random

import pytest

from tallyward.operators import dashboard as D
from tallyward.sources.contracts import CONTRACTS


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def history(spark, rows):
    return spark.createDataFrame(rows, CONTRACTS["quality.data_quality_metrics"])


ROWS = [
    ("t", "a", 1.0, at(1)),
    ("t", "a", 5.0, at(2)),
    ("t", "b", 7.0, at(1)),
    ("t", "b", 8.0, at(1)),
    ("u", "a", 9.0, at(3)),
    ("u", None, 1.0, at(3)),
]


def test_latest_value_belongs_to_the_latest_time(spark):
    found = {(r[0], r[1]): (r[2], r[3]) for r in D.latest_values(history(spark, ROWS)).collect()}
    assert found == {
        ("t", "a"): (at(2), 5.0),
        ("t", "b"): (at(1), 8.0),
        ("u", "a"): (at(3), 9.0),
        ("u", None): (at(3), 1.0),
    }


def test_latest_rows_keep_ties(spark):
    found = sorted(tuple(r) for r in D.latest_rows(history(spark, ROWS)).collect())
    assert found == [
        ("t", "a", 5.0, at(2)),
        ("t", "b", 7.0, at(1)),
        ("t", "b", 8.0, at(1)),
        ("u", "a", 9.0, at(3)),
    ]


def test_listings(spark):
    rows = [
        ("t", "quarantine_records", 1.0, at(1)),
        ("t", "quarantine_records", 2.0, at(2)),
        ("t", "null_percent_a", 5.0, at(1)),
        ("t", "null_percent_b", 50.0, at(1)),
        ("t", "fraud_label_1", 3.0, at(1)),
        ("t", "fraudXlabelX1", 4.0, at(1)),
        ("t", "fraud_label", 4.0, at(1)),
    ]
    frame = history(spark, rows)
    assert [r["metric_value"] for r in D.quarantine_metrics(frame).collect()] == [2.0, 1.0]
    names = [r["metric_name"] for r in D.null_percentages(frame).collect()]
    assert names == ["null_percent_b", "null_percent_a"]
    matched = {r["metric_name"] for r in D.label_metrics(frame).collect()}
    assert matched == {"fraud_label_1", "fraudXlabelX1"}
    summary = D.quality_summary(D.latest_rows(frame)).collect()
    assert [r["metric_name"] for r in summary] == sorted(r["metric_name"] for r in summary)


@pytest.mark.parametrize("unit", ["hour", "day", "month"])
def test_drift_equals_a_plain_walk(spark, unit):
    """One metric holds most of the rows and spans many slices."""
    rng = random.Random(5)
    rows = [
        (t, m, float(rng.choice([0, 1, 2, 5])), at(rng.randint(1, 28), rng.randint(0, 23)))
        for t, m in [("t", "hot")] * 300 + [("t", "cold")] * 20 + [("u", None)] * 3
    ]
    rows += [("t", "gap", 1.0, at(1)), ("t", "gap", None, at(2)), ("t", "gap", 3.0, at(3))]
    wanted = []
    for key in {(t, m) for t, m, _, _ in rows}:
        series = [r for r in rows if (r[0], r[1]) == key]
        series.sort(key=lambda r: (r[3], r[2] is not None, r[2] or 0.0))
        before = None
        for t, m, value, when in series:
            known = value is not None and before is not None
            change = value - before if known else None
            relative = change / before if known and before else None
            wanted.append((t, m, when, value, before, change, relative))
            before = value
    found = [tuple(r) for r in D.metric_drift(history(spark, rows), unit).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
