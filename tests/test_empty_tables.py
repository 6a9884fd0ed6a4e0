"""The batch over tables without rows, and over claims that are all invalid."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyward.operators import silver
from tallyward.plans import pipeline as P
from tallyward.plans import queries as Q
from tallyward.sources import derived
from tallyward.sources.store import TableStore

RAW = [e.raw for e in silver.ENTITIES]


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    """Few rows of each raw table, with beneficiaries and providers that the claims name."""
    tables = derived.bronze_tables(spark, sf_dir, derived.PART_GRAIN)
    kept = {}
    for name, df in tables.items():
        rows = df.limit(40).collect() if "data" in name and "beneficiary" not in name else df.collect()
        kept[name] = spark.createDataFrame(rows, df.schema)
    return kept


def built(spark, tables, folder):
    store = TableStore(spark, str(folder))
    for name, df in tables.items():
        store.overwrite(df, name)
    batch = P.Batch(store, Q.as_of(), Q.run_ts())
    batch.build_silver()
    batch.build_gold()
    return batch


@pytest.mark.parametrize("empty", RAW)
def test_one_empty_raw_table(spark, raw, tmp_path, empty):
    batch = built(spark, raw | {empty: raw[empty].limit(0)}, tmp_path)
    entity = next(e for e in silver.ENTITIES if e.raw == empty)
    assert batch.store.read(entity.silver).count() == 0
    assert batch.store.read(entity.quarantine).count() == 0
    logged = batch.store.read(P.HISTORY).filter(F.col("table_name") == entity.name)
    assert {r["metric_value"] for r in logged.collect()} == {0.0}
    claims = batch.store.read("silver.unified_claims")
    assert claims.count() > 0 and batch.store.read(P.FEATURES).count() > 0


def test_no_valid_claim(spark, raw, tmp_path):
    broken = {
        n: df.withColumn("Provider", F.lit(None).cast("string")) if "patient" in n else df
        for n, df in raw.items()
    }
    batch = built(spark, broken, tmp_path)
    assert batch.store.read(silver.INPATIENT_CLAIMS.quarantine).count() > 0
    assert batch.store.read("silver.unified_claims").count() == 0
    assert batch.store.read(P.FEATURES).count() == 0
    with pytest.raises(ValueError, match="no rows for"):
        batch.train(str(tmp_path / "models"))
