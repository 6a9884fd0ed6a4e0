"""Checkable queries of the operators that go beyond single tables and plain joins.

Merge by key, file streams, joins and sums along time, groupings, sketches, reconciliation, JSON.
Every query reads whole tables; see `queries` for what makes outputs comparable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators import groupings, nested, reconcile, silver, sketches, timeline
from tallyward.operators.dedupe import dedupe
from tallyward.plans import queries as Q
from tallyward.sources import derived
from tallyward.sources.contracts import contract
from tallyward.sources.store import TableStore, shared_folder
from tallyward.streaming.ingest import FileIngest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

INPATIENT = silver.INPATIENT_CLAIMS


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


def store_of(spark) -> TableStore:
    return TableStore(spark, shared_folder(spark))


@query("h01_merge")
def h01(spark, sf_dir):
    """Claims up to 1993, then a batch from 1993 on that corrects, adds and removes, sent twice."""
    store, name = store_of(spark), "silver.claims"
    rows = dedupe(Q.raw(INPATIENT, spark, sf_dir), "ClaimID").select(
        "ClaimID", "Provider", "ClaimStartDt", "InscClaimAmtReimbursed"
    )
    store.merge(rows.filter("ClaimStartDt < '1994-01-01'"), name, ["ClaimID"])
    changes = rows.filter("ClaimStartDt >= '1993-01-01'").select(
        "ClaimID",
        "Provider",
        "ClaimStartDt",
        (F.col("InscClaimAmtReimbursed") + 1).alias("InscClaimAmtReimbursed"),
        (F.col("InscClaimAmtReimbursed") < 0).alias("gone"),
    )
    for _ in range(2):
        store.merge(changes, name, ["ClaimID"], delete=F.col("gone"))
    return Q.stable(store.read(name))


@query("h02_stream_ingest")
def h02(spark, sf_dir):
    """Raw claims that arrive as files, a third of them twice, with a restart in between."""
    store = store_of(spark)
    rows = Q.raw(INPATIENT, spark, sf_dir)
    part = F.pmod(F.xxhash64("ClaimID", "ClaimStartDt"), F.lit(3))

    def deliver(*numbers: int) -> None:
        rows.filter(part.isin(*numbers)).write.mode("append").parquet(f"{store.root}/landing")

    def ingest() -> DataFrame:
        return FileIngest(
            store,
            f"{store.root}/landing",
            contract(INPATIENT.raw),
            "silver.arrived",
            "ClaimID",
            f"{store.root}/checkpoint",
        ).run()

    deliver(0, 1)
    ingest()
    deliver(1, 2)
    return Q.stable(ingest())


@query("h03_as_of_join")
def h03(spark, sf_dir):
    """Each claim with its provider's number of claims in the last month that was over by then."""
    claims = Q.stored_claims(spark, sf_dir)
    known_from = F.add_months(F.trunc("ClaimStartDt", "month"), 1)
    months = claims.groupBy("Provider", known_from.alias("known_from")).agg(
        F.count("*").alias("known_claims")
    )
    found = timeline.as_of_join(
        claims, months, "Provider", "ClaimStartDt", "known_from", ["known_claims"]
    )
    return found.select("ClaimID", "claim_type", "Provider", "known_claims")


@query("h04_interval_join")
def h04(spark, sf_dir):
    """Hospital stays of one beneficiary that overlap."""
    stays = Q.valid(INPATIENT, spark, sf_dir)
    return timeline.overlapping(
        stays, "BeneID", "ClaimID", "AdmissionDt", "DischargeDt", ["Provider"]
    )


def grouped_claims(spark, sf_dir) -> DataFrame:
    """Claims with the label of their provider and a band of their amount, either of them null too."""
    labels = Q.valid(silver.PROVIDER_LABELS, spark, sf_dir).select("Provider", "PotentialFraud")
    amount = F.col("InscClaimAmtReimbursed")
    return (
        Q.claims(spark, sf_dir)
        .join(labels, "Provider", "left")
        .select(
            "claim_type",
            F.col("PotentialFraud").alias("status"),
            F.when(amount >= 5000, "high").when(amount >= 1000, "middle").alias("band"),
            F.date_format("ClaimStartDt", "yyyy").alias("year"),
            F.date_format("ClaimStartDt", "MM").alias("month"),
            amount.alias("amount"),
        )
    )


def totals() -> dict:
    return {"n": F.count("*"), "amount": F.sum("amount")}


@query("h05_cube")
def h05_cube(spark, sf_dir):
    sets = groupings.cube_sets(["claim_type", "status", "band"])
    return Q.stable(groupings.grouped_sets(grouped_claims(spark, sf_dir), sets, totals()))


@query("h05_rollup")
def h05_rollup(spark, sf_dir):
    sets = groupings.rollup_sets(["year", "month", "status"])
    return Q.stable(groupings.grouped_sets(grouped_claims(spark, sf_dir), sets, totals()))


@query("h05_grouping_sets")
def h05_sets(spark, sf_dir):
    sets = [["claim_type", "year"], ["status"], ["band", "status"]]
    return Q.stable(groupings.grouped_sets(grouped_claims(spark, sf_dir), sets, totals()))


@query("h05_cross_table")
def h05_cross(spark, sf_dir):
    rows = grouped_claims(spark, sf_dir)
    return groupings.cross_table(rows, ["claim_type", "year"], "band", ["high"])


@query("h06_rolling")
def h06(spark, sf_dir):
    """Each claim with its provider's claims and reimbursement of the 30 days up to its start."""
    claims = Q.stored_claims(spark, sf_dir).select(
        "ClaimID", "claim_type", "Provider", "ClaimStartDt", "InscClaimAmtReimbursed"
    )
    measures = {"claims_30d": F.lit(1), "amount_30d": F.col("InscClaimAmtReimbursed")}
    found = timeline.with_rolling(claims, "Provider", "ClaimStartDt", 30, measures)
    return Q.stable(found.drop("InscClaimAmtReimbursed"))


@query("h07_sketches")
def h07(spark, sf_dir):
    """Figures of providers from states stored by provider and month, held against exact ones."""
    claims = Q.stored(
        Q.claims(spark, sf_dir).select(
            "Provider",
            F.trunc("ClaimStartDt", "month").alias("month"),
            "BeneID",
            F.col("InscClaimAmtReimbursed").alias("amount"),
        )
    )
    stored = Q.stored(sketches.states(claims, ["Provider", "month"], "BeneID", "amount"))
    # stored, since both joins below read it
    found = Q.stored(
        sketches.merged(stored, ["Provider"]).select(
            "Provider",
            "n",
            sketches.distinct_count().alias("about"),
            sketches.quantile(0.5).alias("median"),
        )
    )
    exact = (
        claims.join(found.select("Provider", "median"), "Provider")
        .groupBy("Provider")
        .agg(
            F.count_distinct("BeneID").alias("unique"),
            F.count_if(F.col("amount") < F.col("median")).alias("below"),
            F.count_if(F.col("amount") <= F.col("median")).alias("upto"),
        )
    )
    return found.join(exact, "Provider").select(
        "Provider",
        "n",
        F.col("unique").alias("unique_beneficiaries"),
        (F.abs(F.col("about") - F.col("unique")) <= 0.08 * F.col("unique") + 1).alias("count_near"),
        ((F.col("below") <= 0.52 * F.col("n")) & (F.col("upto") >= 0.48 * F.col("n"))).alias(
            "median_near"
        ),
    )


@query("h08_orphans")
def h08(spark, sf_dir):
    claims = Q.stored_claims(spark, sf_dir)
    raw = Q.raw(INPATIENT, spark, sf_dir)
    people = Q.valid(silver.BENEFICIARY, spark, sf_dir)
    labels = Q.valid(silver.PROVIDER_LABELS, spark, sf_dir)
    kinds = [
        ("claims of beneficiaries", claims, "BeneID", people, "BeneID"),
        ("claims of labels", claims, "Provider", labels, "Provider"),
        ("raw claims of labels", raw, "Provider", labels, "Provider"),
        ("beneficiaries of claims", people, "BeneID", claims, "BeneID"),
        ("labels of claims", labels, "Provider", claims, "Provider"),
    ]
    found = [reconcile.orphan_counts(*kind) for kind in kinds]
    total = found[0]
    for more in found[1:]:
        total = total.unionByName(more)
    return total


@query("h08_semi_join")
def h08_semi(spark, sf_dir):
    """Valid claims of valid beneficiaries."""
    people = Q.valid(silver.BENEFICIARY, spark, sf_dir)
    found = reconcile.with_partner(Q.claims(spark, sf_dir), "BeneID", people, "BeneID")
    return found.select("ClaimID", "claim_type", "BeneID")


COMPARED = ["Provider", "total_claims", "inpatient_claims", "outpatient_claims", "fraud_label"]


def stored_and_fresh(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A stored feature table that lacks, changes and repeats rows, and the table made again."""
    fresh = Q.stored_gold(spark, sf_dir).select(COMPARED)
    kept = fresh.filter("outpatient_claims <> 3").withColumn(
        "fraud_label", F.when(F.col("inpatient_claims") != 5, F.col("fraud_label"))
    )
    return kept.unionByName(kept.filter("inpatient_claims = 4")), fresh


@query("h09_differences")
def h09(spark, sf_dir):
    return reconcile.differences(*stored_and_fresh(spark, sf_dir), COMPARED)


@query("h09_except_all")
def h09_except(spark, sf_dir):
    return reconcile.except_all(*stored_and_fresh(spark, sf_dir), COMPARED)


@query("h09_overlap")
def h09_overlap(spark, sf_dir):
    columns = COMPARED[1:]
    stored, fresh = stored_and_fresh(spark, sf_dir)
    return reconcile.overlap_summary(stored.select(columns), fresh.select(columns), columns)


@query("h10_reason_counts")
def h10(spark, sf_dir):
    return nested.reason_counts(Q.flagged(INPATIENT, spark, sf_dir), silver.INPATIENT_RULES)


@query("h10_reason_pairs")
def h10_pairs(spark, sf_dir):
    return nested.reason_pairs(Q.flagged(INPATIENT, spark, sf_dir), silver.INPATIENT_RULES)


@query("h10_json_tags")
def h10_tags(spark, sf_dir):
    """Tags written as JSON and read back; texts of unknown labels are cut short."""
    labels = derived.provider_labels(spark, sf_dir).select(
        "Provider",
        F.create_map(
            F.lit("label"), "PotentialFraud", F.lit("source"), F.lit('a "quoted, name"')
        ).alias("tags"),
        "PotentialFraud",
    )
    text = nested.tags_as_json("tags")
    cut = F.when(F.col("PotentialFraud") == "Unknown", F.left(text, F.lit(12))).otherwise(text)
    rows = labels.select("Provider", cut.alias("text"))
    found = nested.parsed(rows, "text", "label string, source string")
    return found.drop("text").withColumnRenamed(nested.CORRUPT, "corrupt")
