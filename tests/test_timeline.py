from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.operators.timeline import as_of_join, overlapping, rolling, with_rolling

DAY0 = dt.date(2009, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def some(rng, *values):
    return rng.choice([None, *values])


# As-of ---------------------------------------------------------------------------


def known_at(history, key, at):
    seen = [(t, v) for k, t, v in history if k is not None and k == key and t is not None and t <= at]
    if not seen:
        return None
    last = max(t for t, _ in seen)
    return max((v for t, v in seen if t == last), key=lambda v: (v is not None, v or 0))


@pytest.mark.parametrize("slice_days", [1, 7, 400])
def test_as_of_equals_brute_force(spark, slice_days):
    rng = random.Random(slice_days)
    left = [(i, some(rng, "a", "b", "c"), day(some(rng, *range(60)))) for i in range(150)]
    right = [(some(rng, "a", "b"), day(some(rng, *range(0, 60, 4))), some(rng, 1, 2, 3)) for _ in range(40)]
    got = as_of_join(
        spark.createDataFrame(left, "id int, k string, at date").repartition(4),
        spark.createDataFrame(right, "k string, since date, v int"),
        "k", "at", "since", ["v"], slice_days,
    )
    assert got.columns == ["id", "k", "at", "v"]
    want = Counter(
        (i, k, t, known_at(right, k, t) if k is not None and t is not None else None) for i, k, t in left
    )
    assert bag(got) == want


def test_as_of_edges(spark):
    left = spark.createDataFrame([(1, "a", day(5)), (2, "a", day(5)), (3, "a", day(0))], "id int, k string, at date")
    right = spark.createDataFrame(
        [("a", day(1), 1), ("a", day(5), None), ("z", day(0), 9)], "k string, since date, v int"
    )
    got = as_of_join(left, right, "k", "at", "since", ["v"])
    # a value that is known to be null hides the one before it
    assert bag(got.select("id", "v")) == Counter([(1, None), (2, None), (3, None)])
    assert bag(as_of_join(left, right.limit(0), "k", "at", "since", ["v"]).select("id", "v")) == Counter(
        [(1, None), (2, None), (3, None)]
    )
    assert as_of_join(left.limit(0), right, "k", "at", "since", ["v"]).count() == 0


def test_as_of_times_of_day(spark):
    at = lambda h, m: dt.datetime(2009, 1, 1, h, m)
    left = spark.createDataFrame([(1, "a", at(9, 0)), (2, "a", at(9, 30))], "id int, k string, at timestamp")
    right = spark.createDataFrame(
        [("a", at(9, 0), 1), ("a", at(9, 31), 2), ("a", at(8, 0), 0)], "k string, since timestamp, v int"
    )
    assert bag(as_of_join(left, right, "k", "at", "since", ["v"]).select("id", "v")) == Counter([(1, 1), (2, 1)])


def test_as_of_puts_only_distinct_times_in_order(spark):
    """A key with very many rows is as many rows of a window as it has times."""
    left = spark.range(30_000).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "date_add(DATE '2009-01-01', CAST(id % 700 AS INT)) AS at"
    )
    right = spark.createDataFrame([("hot", day(0), 1), ("hot", day(300), 2)], "k string, since date, v int")
    got = as_of_join(left, right, "k", "at", "since", ["v"])
    counts = {r.v: r["count"] for r in got.filter("k = 'hot'").groupBy("v").count().collect()}
    assert counts == {
        1: left.filter("k = 'hot' AND at < DATE '2009-10-28'").count(),
        2: left.filter("k = 'hot' AND at >= DATE '2009-10-28'").count(),
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and "Aggregate" in plan[plan.rindex("Window") :]


# Overlapping stays ----------------------------------------------------------------


def pairs_of(rows):
    found = Counter()
    for a, ka, s, e, p in rows:
        for b, kb, t, f, q in rows:
            if None in (a, b, ka, kb, s, e, t, f) or ka != kb or a >= b or s > e or t > f:
                continue
            if s <= f and t <= e:
                found[ka, a, b, (min(e, f) - max(s, t)).days + 1, p, q] += 1
    return found


@pytest.mark.parametrize("days", [1, 5, 1000])
def test_overlaps_equal_brute_force(spark, days):
    rng = random.Random(days)
    rows = []
    for i in range(120):
        start = some(rng, *range(-20, 60))
        end = None if start is None else start + rng.choice([-1, 0, 0, 1, 4, 30])
        rows.append((some(rng, *range(90)), some(rng, "a", "b"), day(start), day(end), f"p{i % 7}"))
    df = spark.createDataFrame(rows, "id int, k string, s date, e date, p string")
    got = bag(overlapping(df, "k", "id", "s", "e", ["p"], days))
    assert got == pairs_of(rows) and sum(got.values()) > 50
    assert overlapping(df.limit(0), "k", "id", "s", "e").count() == 0


def test_a_beneficiary_with_very_many_stays(spark):
    stays = spark.range(2000).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k",
        "date_add(DATE '2000-01-01', CAST(id * 2 AS INT)) AS s", "date_add(DATE '2000-01-01', CAST(id * 2 + 6 AS INT)) AS e",
    )
    got = overlapping(stays, "k", "id", "s", "e", days=8)
    assert got.count() == 666 and {r.days for r in got.collect()} == {1}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "_bin" in plan[plan.index("Join") :].split("\n")[0]


# Rolling sums ---------------------------------------------------------------------


def rolled(rows, days):
    found = {}
    for key, at, _ in rows:
        if at is None:
            continue
        window = [v for k, t, v in rows if k == key and t is not None and 0 <= (at - t).days < days]
        values = [v for v in window if v is not None]
        found[key, at] = (len(window), sum(values) if values else None)
    return found


@pytest.mark.parametrize("slice_days", [1, 10, 360])
def test_rolling_sums_equal_brute_force(spark, slice_days):
    rng = random.Random(slice_days)
    rows = [(some(rng, "a", "b"), day(some(rng, *range(-30, 90))), some(rng, 1, 2, 3)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, at date, v int").repartition(3)
    measures = {"n": F.lit(1), "total": F.col("v")}
    got = {(r.k, r.at): (r.n, r.total) for r in rolling(df, "k", "at", 14, measures, slice_days).collect()}
    assert got == rolled(rows, 14)
    whole = bag(with_rolling(df, "k", "at", 14, measures))
    want = rolled(rows, 14)
    assert whole == Counter((k, t, v, *(want[k, t] if t else (None, None))) for k, t, v in rows)
    assert rolling(df.limit(0), "k", "at", 14, measures).count() == 0


def test_a_hot_provider_is_one_row_per_day(spark):
    rows = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id % 50 AS STRING)) AS k", "date_add(DATE '2009-01-01', CAST(id % 900 AS INT)) AS at"
    )
    got = rolling(rows, "k", "at", 30, {"n": F.lit(1)}, slice_days=90)
    assert got.filter("k = 'hot'").agg(F.max("n")).first()[0] == 670  # ten days of 67 rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Window") :]
