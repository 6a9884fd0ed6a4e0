"""Every query of the library against its SQL in DuckDB."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tallyward.plans import oracle, oracle_h, queries_h
from tallyward.plans import queries as plain
from tests.compare import connect, differences

SQL = oracle.SQL | oracle_h.SQL
QUERIES = plain.QUERIES | queries_h.QUERIES

# One query of each kind of plan, run with code generation as in production.
COMPILED = ("b01_dedupe_inpatient", "c21_inpatient_valid", "d08_filled_features", "g05_concentrated")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(queries()[name](spark, sf_dir), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", COMPILED)
def test_compiled_query_equals_sql(spark, sf_dir, con, name):
    settings = {"spark.sql.codegen.factoryMode": "FALLBACK", "spark.sql.codegen.wholeStage": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert differences(queries()[name](spark, sf_dir), con, SQL[name]) == []
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_query_of_the_library_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows_and_columns(spark):
    df = entry(spark)
    assert df.columns == [
        "Provider",
        "total_claims",
        "high_reimbursement_claim_ratio",
        "avg_reimbursement_amount",
        "max_reimbursement_amount",
        "claims_per_beneficiary",
    ]
    assert 0 < df.count() <= 50
