from __future__ import annotations

import pytest

from tallyward.sources.contracts import (
    CONTRACTS,
    DECLARED_TABLES,
    ContractError,
    column_names,
    conform,
    contract,
    contract_report,
    declare_tables,
    describe_schema,
)
from tallyward.sources.store import (
    TableStore,
    preview,
    shared_folder,
    source_access,
    source_counts,
)


@pytest.fixture(params=["path", "catalog"])
def store(request, spark, tmp_path):
    store = TableStore(spark, str(tmp_path) if request.param == "path" else None)
    store.create_layers()
    yield store
    if store.root is None:
        spark.sql("DROP TABLE IF EXISTS silver.thing")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_overwrite_replaces_the_schema(spark, store):
    store.overwrite(spark.createDataFrame([(1,)], "a int"), "silver.thing")
    out = store.overwrite(spark.createDataFrame([("x", 2.0)], "b string, c double"), "silver.thing")
    assert rows(out) == [("x", 2.0)] and out.columns == ["b", "c"]


def test_checked_overwrite_keeps_the_schema(spark, store):
    assert not store.exists("silver.thing")
    store.overwrite_checked(spark.createDataFrame([(1, "x")], "a int, b string"), "silver.thing")
    assert store.exists("silver.thing")
    out = store.overwrite_checked(
        spark.createDataFrame([("y", 2)], "b string, a int"), "silver.thing"
    )
    assert rows(out) == [(2, "y")]
    with pytest.raises(ContractError, match="a: expected int, found bigint"):
        store.overwrite_checked(
            spark.createDataFrame([("y", 2)], "b string, a bigint"), "silver.thing"
        )
    assert rows(store.read("silver.thing")) == [(2, "y")]


def test_append_adds_rows_by_name(spark, store):
    store.append(spark.createDataFrame([(1, "x")], "a int, b string"), "silver.thing")
    out = store.append(spark.createDataFrame([("y", 2)], "b string, a int"), "silver.thing")
    assert rows(out) == [(1, "x"), (2, "y")]
    with pytest.raises(ContractError, match="c: expected None"):
        store.append(spark.createDataFrame([(1, "x", 0)], "a int, b string, c int"), "silver.thing")


def test_absent_sources_are_reported(spark, store):
    store.overwrite(spark.createDataFrame([(1,)], "a int"), "silver.thing")
    found = store.sources(["silver.thing", "silver.nothing"])
    assert rows(source_access(spark, found)) == [
        ("silver.nothing", False, 0),
        ("silver.thing", True, 1),
    ]


def test_declared_tables(spark):
    declare_tables(spark)
    assert len(DECLARED_TABLES) == 8
    for name in DECLARED_TABLES:
        assert spark.table(name).schema.simpleString() == contract(name).simpleString()
    declare_tables(spark)
    for name in DECLARED_TABLES:
        spark.sql(f"DROP TABLE {name}")


def test_names_agree_with_the_schemas(spark):
    for name in CONTRACTS:
        assert column_names(name) == contract(name).fieldNames()


def test_describe_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a int not null, b string")
    assert rows(describe_schema(df)) == [("a", "int", False), ("b", "string", True)]


def test_contract_report_and_conform(spark):
    expected = contract("bronze.provider")
    good = spark.createDataFrame([("Yes", "P1")], "PotentialFraud string, Provider string")
    assert {r["status"] for r in contract_report(good, expected).collect()} == {"ok"}
    assert conform(good, expected).columns == ["Provider", "PotentialFraud"]
    bad = spark.createDataFrame([(1, 2)], "Provider int, other int")
    assert {(r["column_name"], r["status"]) for r in contract_report(bad, expected).collect()} == {
        ("Provider", "type differs"),
        ("PotentialFraud", "missing"),
        ("other", "unexpected"),
    }
    with pytest.raises(ContractError):
        conform(bad, expected)


def test_source_reports(spark):
    tables = {"t": spark.range(7).toDF("a"), "empty": spark.range(0).toDF("a")}
    assert rows(source_counts(tables)) == [("empty", 0), ("t", 7)]
    tables["absent"] = None
    assert rows(source_access(spark, tables)) == [
        ("absent", False, 0),
        ("empty", True, 0),
        ("t", True, 5),
    ]
    tables.pop("absent")
    assert rows(preview(tables["t"], 2, ["a"])) == [(0,), (1,)]


def test_shared_folder_lies_below_the_checkpoint_dir(spark):
    one, two = shared_folder(spark), shared_folder(spark)
    assert one != two
    assert one.startswith(spark.conf.get("spark.checkpoint.dir"))
