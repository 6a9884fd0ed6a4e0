"""Raw claim tables derived from the order tables, for tests, checks and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyward.sources.contracts import CONDITION_COLUMNS, column_names

SUPPLIER_GRAIN, PART_GRAIN = "l_suppkey", "l_partkey"
# The part grain with ten times the amounts for labelled parts, so that a model can learn the label.
LEARNABLE_GRAIN = "learnable"

# The columns used here; a given schema spares a look into the files before each read.
ORDER_TABLES = {
    "customer": "c_custkey bigint, c_nationkey int",
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
        l_linestatus string, l_shipdate timestamp_ntz
    """,
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(ORDER_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _claims(spark: SparkSession, sf_dir: str, status: str, provider: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter(f"l_linestatus = '{status}'")
    orders = table(spark, sf_dir, "orders")
    factor = "1"
    if provider == LEARNABLE_GRAIN:
        provider, factor = PART_GRAIN, "IF(p_size <= 10, 10, 1)"
        part = table(spark, sf_dir, "part")
        lines = lines.join(part, lines["l_partkey"] == part["p_partkey"])
    stay = status == "F"
    deductible = "CAST(CAST(round(l_tax * 10000) AS BIGINT) AS STRING)"
    if stay:
        deductible = f"IF(l_discount = 0, 'NA', {deductible})"
    # formed before the join, whose shuffle is the narrower for it
    lines = lines.selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{provider} AS provider",
        "CAST(l_shipdate AS DATE) AS shipped",
        "CAST(l_quantity AS INT) % 10 AS stay_days",
        f"IF(l_returnflag = 'R' AND l_tax = 0, -1, 1) * {factor} * (l_extendedprice / 10) AS amount",
        f"{deductible} AS deductible",
    )
    columns = {
        "ClaimID": "concat('CLM', l_orderkey, '-', l_linenumber)",
        "BeneID": "concat('BENE', o_custkey)",
        "Provider": f"CASE WHEN l_orderkey % 97 <> 0 THEN concat('PRV', provider) END",
        "ClaimStartDt": "CAST(shipped AS STRING)",
        "ClaimEndDt": "CAST(date_add(shipped, l_linenumber - 2) AS STRING)",
        "AdmissionDt": "CAST(shipped AS STRING)",
        "DischargeDt": "CAST(date_add(shipped, stay_days - 1) AS STRING)",
        "InscClaimAmtReimbursed": "amount",
        "DeductibleAmtPaid": "deductible",
    }
    kind = "bronze.inpatientdata" if stay else "bronze.outpatientdata"
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .selectExpr(*[f"{columns[c]} AS {c}" for c in column_names(kind)])
    )


def inpatient(spark: SparkSession, sf_dir: str, provider: str = SUPPLIER_GRAIN) -> DataFrame:
    return _claims(spark, sf_dir, "F", provider)


def outpatient(spark: SparkSession, sf_dir: str, provider: str = SUPPLIER_GRAIN) -> DataFrame:
    return _claims(spark, sf_dir, "O", provider)


def beneficiaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    birth = "date_add(DATE '1885-01-01', CAST((c_custkey * 7919) % 47000 AS INT))"
    conditions = [
        f"IF((c_custkey + {i}) % 23 = 0, 1, 2) AS {c}" for i, c in enumerate(CONDITION_COLUMNS)
    ]
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('BENE', c_custkey) AS BeneID",
        f"CASE WHEN c_custkey % 50 <> 0 THEN CAST({birth} AS STRING) END AS DOB",
        "IF(c_custkey % 10 = 0, '2009-06-01', 'NA') AS DOD",
        "CAST(c_custkey % 3 AS INT) AS Gender",
        "c_nationkey AS Race",
        *conditions,
    )


def provider_labels(spark: SparkSession, sf_dir: str, provider: str = SUPPLIER_GRAIN) -> DataFrame:
    if provider in (PART_GRAIN, LEARNABLE_GRAIN):
        return table(spark, sf_dir, "part").selectExpr(
            "concat('PRV', p_partkey) AS Provider",
            "IF(p_size <= 10, 'Yes', 'No') AS PotentialFraud",
        )
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('PRV', s_suppkey) AS Provider",
        "CASE WHEN s_nationkey = 24 THEN 'Unknown' WHEN s_acctbal < 1000 THEN 'Yes' ELSE 'No' END "
        "AS PotentialFraud",
    )


BRONZE = {
    "bronze.beneficiarydata": lambda spark, sf_dir, _: beneficiaries(spark, sf_dir),
    "bronze.inpatientdata": inpatient,
    "bronze.outpatientdata": outpatient,
    "bronze.provider": provider_labels,
}


def bronze_table(
    spark: SparkSession, sf_dir: str, name: str, provider: str = SUPPLIER_GRAIN
) -> DataFrame:
    """One raw table by name."""
    return BRONZE[name](spark, sf_dir, provider)


def bronze_tables(
    spark: SparkSession, sf_dir: str, provider: str = SUPPLIER_GRAIN
) -> dict[str, DataFrame]:
    """The four raw tables by name."""
    return {name: bronze_table(spark, sf_dir, name, provider) for name in BRONZE}
