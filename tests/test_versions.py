"""Versions of stored tables: whole writes, batches that come in once, merges by key."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators.merge import last_changes, upsert
from tallyward.sources.contracts import ContractError
from tallyward.sources.store import TableStore
from tallyward.sources.versions import VersionLog

NAME = "silver.thing"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def frame(spark, rows, schema="k bigint, v string"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Lost(Exception):
    """A writer that dies between its data and its version."""


@pytest.fixture
def lost_writer(monkeypatch):
    def lose(self, version):
        raise Lost

    def switch(on):
        monkeypatch.undo()
        if on:
            monkeypatch.setattr(VersionLog, "commit", lose)

    return switch


@pytest.mark.parametrize("write", ["overwrite", "overwrite_checked", "append", "merge"])
def test_a_lost_write_leaves_the_table_as_it_was(spark, store, lost_writer, write):
    def run(values):
        if write == "merge":
            return store.merge(frame(spark, values), NAME, ["k"], buckets=4)
        return getattr(store, write)(frame(spark, values), NAME)

    before = rows(run([(1, "a"), (2, "b")]))
    lost_writer(True)
    with pytest.raises(Lost):
        run([(2, "c"), (3, "d")])
    lost_writer(False)
    assert rows(store.read(NAME)) == before
    after = rows(run([(2, "c"), (3, "d")]))
    assert after != before and rows(store.read(NAME)) == after


def test_a_reader_keeps_the_version_it_has(spark, store):
    old = store.overwrite(frame(spark, [(1, "a")]), NAME)
    store.overwrite(spark.createDataFrame([(2.0,)], "x double"), NAME)
    assert rows(old) == [(1, "a")] and rows(store.read(NAME)) == [(2.0,)]
    assert rows(store.read(NAME, version=1)) == [(1, "a")]


def test_a_table_can_be_made_from_itself(spark, store):
    store.overwrite(frame(spark, [(1, "a"), (2, "b")]), NAME)
    out = store.overwrite(store.read(NAME).filter("k = 2"), NAME)
    assert rows(out) == [(2, "b")]


def test_old_versions_and_their_data_go(spark, store, tmp_path):
    for i in range(5):
        store.overwrite(frame(spark, [(i, "x")]), NAME)
    assert store.log(NAME).numbers() == [4, 5]
    assert len(list((tmp_path / "silver/thing/data").glob("_written=*"))) == 2
    for i in range(4):
        store.append(frame(spark, [(i, "y")]), NAME)
    assert store.read(NAME).count() == 5


def test_a_number_is_given_once(store):
    from tallyward.sources.versions import Version

    log = store.log(NAME)
    assert log.commit(Version(1, "{}")) and not log.commit(Version(1, "{}"))
    assert log.numbers() == [1]


def test_a_batch_is_appended_once(spark, store):
    for _ in range(2):
        store.append(frame(spark, [(1, "a")]), NAME, batch="one")
        store.append(frame(spark, [(1, "a")]), NAME, batch="two")
    assert rows(store.read(NAME)) == [(1, "a"), (1, "a")]
    store.append(frame(spark, [(1, "a")]), NAME)
    assert store.read(NAME).count() == 3
    with pytest.raises(ContractError):
        TableStore(spark).append(frame(spark, [(1, "a")]), "x", batch="one")


def test_an_append_after_another_writer_keeps_both(spark, store, monkeypatch):
    store.append(frame(spark, [(1, "a")]), NAME)
    commit, other = VersionLog.commit, []

    def race(self, version):
        if not other:
            other.append(True)
            monkeypatch.setattr(VersionLog, "commit", commit)
            TableStore(spark, store.root).append(frame(spark, [(2, "b")]), NAME)
        return commit(self, version)

    monkeypatch.setattr(VersionLog, "commit", race)
    store.append(frame(spark, [(3, "c")]), NAME)
    assert rows(store.read(NAME)) == [(1, "a"), (2, "b"), (3, "c")]


def test_partitions_and_columns_with_odd_names(spark, store):
    df = spark.createDataFrame([(1, "a.b", None), (2, "c", 5)], "`x.y` int, p string, q int")
    out = store.overwrite(df, NAME, ["p"])
    assert out.columns == ["x.y", "p", "q"] and rows(out) == rows(df)
    plan = out.filter("p = 'c'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    empty = store.overwrite(df.limit(0), NAME, ["p"])
    assert empty.columns == ["x.y", "p", "q"] and empty.count() == 0


# Merge --------------------------------------------------------------------------


def merged_by_hand(before, changes):
    table = dict(before)
    last = {}
    for key, value, order, gone in sorted(changes, key=lambda c: (c[2], c[1] or "", bool(c[3]))):
        last[key] = value, gone
    for key, (value, gone) in last.items():
        table.pop(key, None)
        if not gone:
            table[key] = value
    return sorted(table.items(), key=repr)


CHANGE = "k bigint, v string, at int, gone boolean"


def test_merges_equal_the_same_by_hand(spark, store):
    rng = random.Random(1)
    want = []
    for turn in range(4):
        changes = [
            (rng.choice([None, *range(40)]), f"v{turn}-{i}", i, rng.random() < 0.2)
            for i in range(50 if turn else 30)
        ]
        if not turn:
            changes = [(k, f"v{k}", 0, False) for k in [None, *range(20)]]
            store.merge(frame(spark, [c[:2] for c in changes]), NAME, ["k"], buckets=4)
        else:
            store.merge(
                frame(spark, changes, CHANGE), NAME, ["k"], delete=F.col("gone"), order=["at"]
            )
        want = merged_by_hand(want, changes)
        assert rows(store.read(NAME)) == want


def test_merge_again_changes_nothing(spark, store):
    changes = frame(spark, [(1, "a"), (2, "b"), (None, "c")])
    one = rows(store.merge(changes, NAME, ["k"], buckets=4))
    assert rows(store.merge(changes, NAME, ["k"])) == one
    numbers = store.log(NAME).numbers()
    store.merge(frame(spark, [(9, "z")]), NAME, ["k"], batch="b")
    store.merge(frame(spark, [(9, "other")]), NAME, ["k"], batch="b")
    assert rows(store.read(NAME)) == sorted([*one, (9, "z")], key=repr)
    assert store.log(NAME).numbers()[-1] == numbers[-1] + 1


def test_only_touched_buckets_are_rewritten(spark, store):
    store.merge(frame(spark, [(i, "old") for i in range(200)]), NAME, ["k"], buckets=8)
    before = set(store.log(NAME).latest().parts)
    store.merge(frame(spark, [(7, "new")]), NAME, ["k"])
    after = set(store.log(NAME).latest().parts)
    assert len(before) == len(after) == 8 and len(before & after) == 7
    assert dict(rows(store.read(NAME)))[7] == "new"


def test_a_bucket_can_end_empty_and_a_merge_can_bring_nothing(spark, store):
    store.merge(frame(spark, [(1, "a"), (2, "b")]), NAME, ["k"], buckets=64)
    gone = frame(spark, [(1, None, 1, True), (5, None, 1, True)], CHANGE)
    assert rows(store.merge(gone, NAME, ["k"], delete=F.col("gone"))) == [(2, "b")]
    assert rows(store.merge(frame(spark, []), NAME, ["k"])) == [(2, "b")]
    fresh = TableStore(spark, store.root)
    assert fresh.merge(frame(spark, []), "silver.empty", ["k"]).count() == 0
    assert rows(fresh.merge(frame(spark, [(3, "c")]), "silver.empty", ["k"])) == [(3, "c")]


def test_two_merges_at_once_fail_loudly(spark, store, monkeypatch):
    store.merge(frame(spark, [(1, "a")]), NAME, ["k"], buckets=2)
    write = TableStore._write_part

    def slow(self, *args):
        part = write(self, *args)
        monkeypatch.setattr(TableStore, "_write_part", write)
        TableStore(spark, store.root).merge(frame(spark, [(1, "other")]), NAME, ["k"])
        return part

    monkeypatch.setattr(TableStore, "_write_part", slow)
    with pytest.raises(ContractError, match="another writer"):
        store.merge(frame(spark, [(1, "mine")]), NAME, ["k"])
    assert rows(store.read(NAME)) == [(1, "other")]


def test_merges_are_refused_where_they_make_no_sense(spark, store):
    store.merge(frame(spark, [(1, "a")]), NAME, ["k"])
    with pytest.raises(ContractError, match="merged by"):
        store.merge(frame(spark, [(1, "a")]), NAME, ["v"])
    with pytest.raises(ContractError, match="missing or of another type: v"):
        store.merge(frame(spark, [(1, 2)], "k bigint, v int"), NAME, ["k"])
    with pytest.raises(ContractError, match="come by merge"):
        store.append(frame(spark, [(1, "a")]), NAME)
    with pytest.raises(ContractError):
        TableStore(spark).merge(frame(spark, [(1, "a")]), "x", ["k"])


def test_a_hot_key_is_one_row_per_task(spark):
    changes = spark.range(20_000).selectExpr("IF(id % 3 = 0, 7L, id) AS k", "CAST(id AS STRING) AS v")
    out = upsert(frame(spark, [(7, "old"), (-1, "kept")]), changes, ["k"])
    assert out.count() == changes.select("k").distinct().count() + 1
    plan = last_changes(changes, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2 and "Window" not in plan


def test_keys_of_several_columns(spark, store):
    schema = "a string, b int, v int"
    store.merge(spark.createDataFrame([("x", 1, 1), ("x", None, 2), (None, 1, 3)], schema), NAME, ["a", "b"])
    out = store.merge(spark.createDataFrame([("x", None, 20), (None, None, 4)], schema), NAME, ["a", "b"])
    assert rows(out) == sorted([("x", 1, 1), ("x", None, 20), (None, 1, 3), (None, None, 4)], key=repr)
    assert rows(store.merge(spark.createDataFrame([("k",)], "a string"), "silver.keys", ["a"])) == [("k",)]
