from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyward.operators.dedupe import dedupe

SCHEMA = "k string, a int, b string"
CELL = st.one_of(st.none(), st.integers(0, 2))
ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from("pqr")),
        CELL,
        st.one_of(st.none(), st.sampled_from(["", "x", "Y", "é"])),
    ),
    max_size=40,
)


def sorts_first(row):
    """Order by the other columns, nulls first, text by bytes."""
    return tuple((v is not None, v.encode() if isinstance(v, str) else v or 0) for v in row[1:])


def model(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return {(*min(g, key=sorts_first), len(g)) for g in groups.values()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_keeps_the_smallest_row_of_each_key(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert {tuple(r) for r in dedupe(df, "k", "n").collect()} == model(rows)


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, "c"), ("p", 1, "a")], SCHEMA)
    assert {tuple(r) for r in dedupe(df, "k").collect()} == {(None, 1, "c"), ("p", 1, "a")}


def test_result_does_not_depend_on_partitioning(spark):
    rows = [(f"k{i % 50}", i % 7, str(i % 11)) for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    results = [
        sorted(map(tuple, dedupe(df.repartition(n), "k").collect())) for n in (1, 3, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_column_order_stays(spark):
    df = spark.createDataFrame([(1, "k", "x")], "a int, k string, b string")
    assert dedupe(df, "k").columns == ["a", "k", "b"]
    assert dedupe(df, "k", "n").columns == ["a", "k", "b", "n"]


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """Two thirds of the rows share the null key; each task may send one of them."""
    rows = [(None if i % 3 else f"k{i}", i, "x") for i in range(3000)]
    out = dedupe(spark.createDataFrame(rows, SCHEMA).repartition(6), "k", "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    by_key = {r["k"]: r for r in out.collect()}
    assert by_key[None]["n"] == 2000 and by_key[None]["a"] == 1
    assert len(by_key) == 1001
