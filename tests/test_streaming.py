from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyward.operators.dedupe import dedupe
from tallyward.sources.contracts import ContractError
from tallyward.sources.store import TableStore
from tallyward.streaming.ingest import FileIngest

SCHEMA = "ClaimID string, Provider string, amount double"


@pytest.fixture
def ingest(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    schema = spark.createDataFrame([], SCHEMA).schema

    def make(**options):
        return FileIngest(
            TableStore(spark, str(tmp_path / "tables")), str(tmp_path / "landing"), schema,
            "silver.claims", "ClaimID", str(tmp_path / "checkpoint"),
            **{"files_per_batch": 2, "buckets": 4} | options,
        )

    return make


def deliver(spark, ingest, rows):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    df.write.mode("append").parquet(ingest.folder)
    return df


def claims(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *(f"c{i}" for i in range(30))]), rng.choice([None, "p", "q"]), rng.choice([1.0, 2.0])) for _ in range(n)]


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_many_triggers_and_a_restart_equal_the_batch(spark, ingest):
    files = [deliver(spark, ingest(), claims(i, 20)) for i in range(5)]
    ingest().run()
    files += [deliver(spark, ingest(), claims(i, 20)) for i in (2, 9, 10)]  # one of them again
    got = ingest().run()  # a new object on the same checkpoint, as after a restart
    everything = files[0]
    for more in files[1:]:
        everything = everything.unionByName(more)
    assert rows(got) == rows(dedupe(everything, "ClaimID").select(got.columns))
    batches = ingest().store.log("silver.claims").latest().batches
    assert len(batches) >= 4


def test_nothing_new_changes_nothing(spark, ingest):
    deliver(spark, ingest(), claims(1, 10))
    before = rows(ingest().run())
    numbers = ingest().store.log("silver.claims").numbers()
    assert rows(ingest().run()) == before
    assert ingest().store.log("silver.claims").numbers() == numbers


def test_a_batch_that_is_run_again_changes_nothing(spark, ingest):
    one = ingest()
    batch = deliver(spark, one, claims(3, 10))
    one.take(batch, 7)
    before = rows(one.store.read("silver.claims"))
    one.take(spark.createDataFrame([("c1", "a", 0.0)], SCHEMA), 7)
    assert rows(one.store.read("silver.claims")) == before


def test_a_batch_lost_before_its_version_comes_in_once(spark, ingest, monkeypatch):
    from tallyward.sources.versions import VersionLog

    df = deliver(spark, ingest(), claims(4, 20))
    commit = VersionLog.commit

    def lose(self, version):
        monkeypatch.setattr(VersionLog, "commit", commit)
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionLog, "commit", lose)
    with pytest.raises(Exception, match="lost"):
        ingest().run()
    got = ingest().run()
    assert rows(got) == rows(dedupe(df, "ClaimID").select(got.columns))


def test_rows_that_are_too_late_are_an_error(spark, ingest):
    deliver(spark, ingest(), [("c1", "p", 1.0)])
    ingest().run()
    deliver(spark, ingest(), [("c2", "p", 1.0)])
    ingest().run()  # the watermark moves on with the batch after
    deliver(spark, ingest(), [("c3", "p", 1.0)])
    newest = max((f.path for f in os.scandir(ingest().folder) if f.name.endswith(".parquet")), key=os.path.getmtime)
    os.utime(newest, (1e9, 1e9))
    with pytest.raises(ContractError, match="older than the newest"):
        ingest().run()


def test_a_hot_claim_is_one_row(spark, ingest):
    hot = [("c1", "p", float(i)) for i in range(400)] + [(f"c{i}", "p", 1.0) for i in range(2, 50)]
    deliver(spark, ingest(), hot)
    got = ingest().run()
    assert got.count() == 49 and got.filter(F.col("ClaimID") == "c1").first()["amount"] == 0.0


def state_files(ingest):
    found = (name for _, _, names in os.walk(f"{ingest.checkpoint}/state") for name in names)
    return {os.path.splitext(name)[1] for name in found if not name.startswith(".")}


def test_state_is_on_disk_in_bounded_memory_and_the_session_keeps_its_settings(spark, ingest):
    kind = "spark.sql.streaming.stateStore.providerClass"
    bound = "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
    before = spark.conf.get(kind)
    spark.conf.set(bound, "77")
    try:
        deliver(spark, ingest(), claims(5, 20))
        ingest().run()
        assert (spark.conf.get(kind), spark.conf.get(kind, None)) == (before, None)
        assert spark.conf.get(bound) == "77"
    finally:
        spark.conf.unset(bound)
    assert ".zip" in state_files(ingest()) and ".delta" not in state_files(ingest())
    with open(f"{ingest().checkpoint}/offsets/0") as note:
        text = note.read()
    assert "RocksDBStateStoreProvider" in text


def test_a_checkpoint_with_state_on_the_heap_is_gone_on_with(spark, ingest, monkeypatch):
    files = [deliver(spark, ingest(), claims(6, 20))]
    with monkeypatch.context() as before:
        before.setattr("tallyward.streaming.ingest.STATE_STORE", {})
        ingest().run()
    assert ".delta" in state_files(ingest())
    files.append(deliver(spark, ingest(), claims(7, 20)))
    files.append(deliver(spark, ingest(), claims(6, 20)))
    got = ingest().run()
    everything = files[0].unionByName(files[1]).unionByName(files[2])
    assert rows(got) == rows(dedupe(everything, "ClaimID").select(got.columns))
