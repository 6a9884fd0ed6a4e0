"""What the steps shared by many queries read, sort and shuffle, seen in plans and in counted rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyward.functions import scalars as S
from tallyward.operators import features, silver, sketches, timeline
from tallyward.operators import modeling as M
from tallyward.operators.dedupe import dedupe
from tallyward.plans import queries as Q
from tallyward.plans import queries_h as H
from tallyward.sources import derived
from tallyward.sources.store import TableStore
from tallyward.streaming.ingest import FileIngest

COLUMNS = """
    ClaimID string, BeneID string, Provider string, ClaimStartDt string, ClaimEndDt string,
    AdmissionDt string, DischargeDt string, InscClaimAmtReimbursed double, DeductibleAmtPaid string
"""
ROWS = [
    ("c1", "b1", "p1", "2009-01-02", "2009-01-03", "2009-01-02", "2009-01-03", 10.0, "5"),
    ("c1", "b1", "p1", "2009-01-01", "2009-01-03", "2009-01-02", "2009-01-03", 10.0, "NA"),
    ("c2", None, "p1", "2009-1-1", None, "x", "2009-01-03", None, "1.5"),
    (None, "b2", "p2", "2009-01-01", "2008-01-03", "2009-01-02", "2009-01-03", -1.0, None),
    (None, "b2", "p2", None, "2008-01-03", "2009-01-02", "2009-01-03", -1.0, None),
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, rows, schema):
    """A frame that is made again by every pass over it, and the number of rows made."""
    made = spark.sparkContext.accumulator(0)

    def count(row):
        made.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), schema), made


@pytest.fixture
def deduped(monkeypatch):
    """The keys that tables were deduplicated on."""
    keys = []
    monkeypatch.setattr(silver, "dedupe", lambda df, key, *more: keys.append(key) or dedupe(df, key, *more))
    return keys


def test_text_is_parsed_once_per_claim(spark):
    """The conditions on valid claims look at parsed columns, and rows are as parsed afterwards."""
    raw = spark.createDataFrame(ROWS, COLUMNS)
    entity = silver.INPATIENT_CLAIMS
    flagged = entity.flagged(raw, Q.as_of(), Q.run_ts())
    conditions = re.findall(r"Filter .*", plan_of(entity.valid(flagged)))
    assert conditions and not any("try_cast" in c for c in conditions)
    afterwards = entity.derive(dedupe(raw, "ClaimID", silver.COPIES), Q.as_of(), Q.run_ts())
    clean = entity.clean(raw, Q.as_of(), Q.run_ts())
    assert clean.dtypes == afterwards.dtypes
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, afterwards.collect()))


def test_parsers_see_the_kept_row(spark):
    """The row is chosen by its text, although a text that is no date would parse to null."""
    rows = [("k", "0-no-date", 1), ("k", "2009-01-01", 0)]
    df = spark.createDataFrame(rows, "k string, day string, n int")
    assert [tuple(r) for r in dedupe(df, "k", None, {"day": S.parse_date}).collect()] == [("k", None, 1)]


def test_amounts_are_shuffled_once(spark, sf_dir):
    claims = features.claim_indicators(Q.claims(spark, sf_dir))
    plan = plan_of(features.provider_totals(claims, Q.valid(Q.BENE, spark, sf_dir)))
    visits = re.findall(r"HashAggregate\(keys=\[Provider#\d+, BeneID#\d+\].*", plan)
    assert visits and not any("sum(" in v or "max(" in v for v in visits)


def test_history_cleans_each_table_once(spark, sf_dir, deduped):
    Q.history(spark, sf_dir)
    assert sorted(deduped) == ["BeneID", "ClaimID", "ClaimID", "Provider"]


def test_consistency_cleans_claims_once(spark, sf_dir, deduped):
    Q.QUERIES["i02_aggregate_consistency"](spark, sf_dir)
    assert deduped.count("ClaimID") == 2


def test_as_of_join_carries_known_values_alone(spark):
    """What a slice leaves to the next is taken from the right side, not from every question."""
    left = spark.createDataFrame([("a", "2009-08-01"), ("a", "2009-01-01"), ("b", "2009-08-01")], "k string, t string")
    right = spark.createDataFrame([("a", "2009-02-01", 1), ("a", "2009-08-02", 2)], "k string, t string, v int")
    left, right = (df.withColumn("t", F.to_date("t")) for df in (left, right))
    found = timeline.as_of_join(left, right, "k", "t", "t", ["v"])
    assert "max(CASE" not in plan_of(found)
    assert sorted((r["k"], str(r["t"]), r["v"]) for r in found.collect() if r["v"]) == [("a", "2009-08-01", 1)]


def test_a_batch_is_read_once_and_an_empty_one_changes_nothing(spark, tmp_path):
    schema = "ClaimID string, amount double"
    empty = spark.createDataFrame([], schema)
    ingest = FileIngest(
        TableStore(spark, str(tmp_path / "tables")), "", empty.schema, "silver.claims", "ClaimID", "c", buckets=4
    )
    ingest.take(spark.createDataFrame([("c1", 2.0), ("c2", 2.0)], schema), 0)
    batch, made = counted(spark, [("c1", 1.0), ("c2", 3.0), (None, 1.0)], schema)
    ingest.take(batch, 1)
    assert made.value == 3
    kept = {("c1", 1.0), ("c2", 2.0), (None, 1.0)}
    assert set(map(tuple, ingest.store.read("silver.claims").collect())) == kept
    numbers = ingest.store.log("silver.claims").numbers()
    ingest.take(empty, 2)
    assert ingest.store.log("silver.claims").numbers() == numbers


def test_a_fit_makes_its_rows_once(spark):
    """One pass weighs the labels, one makes the rows; the fit itself reads what is kept."""
    names = ["Provider", M.LABEL, *M.FEATURES]
    rows = [(f"p{i}", i % 2, *[float(i % 2 * j + i % 5) for j in range(len(M.FEATURES))]) for i in range(40)]
    schema = f"Provider string, {M.LABEL} int, " + ", ".join(f"{f} double" for f in M.FEATURES)
    train, made = counted(spark, rows, schema)
    model = M.fit_forest(train.select(names), M.ForestSpec("small", trees=3, depth=2, partitions=2))
    assert made.value <= 2 * len(rows)
    assert model.stages[-1].getNumTrees == 3


def shuffled_by(plan, key):
    """What the columns of the rows are that go through the shuffles by a key, one list per shuffle."""
    lines = re.split(r"\n", plan)
    after = [b for a, b in zip(lines, lines[1:]) if re.search(rf"Exchange hashpartitioning\({key}#", a)]
    return [re.findall(r"(?:AS )?(\w+)#\d+L?(?=[,\]])", b) for b in after]


@pytest.mark.parametrize("grain", [Q.SUPPLIER, Q.PART, derived.LEARNABLE_GRAIN])
def test_lines_are_shuffled_with_what_claims_need_alone(spark, sf_dir, grain):
    """The join with orders gets an amount, not the four columns that it is made of."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(derived.inpatient(spark, sf_dir, grain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    (lines,) = shuffled_by(plan, "l_orderkey")
    assert "amount" in lines and not {"l_extendedprice", "l_discount", "l_tax", "l_returnflag"} & set(lines)


def test_history_stores_claims_with_a_tight_codec(spark, sf_dir):
    files = Q.history(spark, sf_dir).inputFiles()
    assert sum(f.endswith(".zstd.parquet") for f in files) >= 2


def test_rows_of_a_group_meet_before_states_are_made(spark):
    """20 groups over 10 partitions: states are made once per group, not once per group and task."""
    rows = spark.createDataFrame([(f"p{i % 20}", f"b{i % 7}", float(i), "x") for i in range(400)], "p string, b string, a double, more string")
    found = sketches.states(rows.repartition(10), ["p"], "b", "a")
    plan = plan_of(found)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    sizes = found.select("p", "n", sketches.distinct_count().alias("d"), sketches.quantile(1.0).alias("top"))
    assert {tuple(r) for r in sizes.collect()} == {(f"p{g}", 20, 7, 380.0 + g) for g in range(20)}


def test_sketches_make_the_figures_of_providers_once(spark, sf_dir, monkeypatch):
    """Both joins read what was merged from the states, and claims are stored with four columns."""
    written = []
    stored = Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, *more: written.append(df.columns) or stored(df, *more))
    H.QUERIES["h07_sketches"](spark, sf_dir)
    assert written[0] == ["Provider", "month", "BeneID", "amount"]
    assert written[-1] == ["Provider", "n", "about", "median"]
