from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.operators import features as G
from tallyward.plans import queries as Q
from tallyward.sources.contracts import CONDITION_COLUMNS, CONTRACTS, column_names, contract

UNIFIED = column_names("silver.unified_claims")
DAY = dt.date(2009, 1, 1)


def unified(spark, rows):
    """Claims as (claim, beneficiary, provider, amount, deductible, days, stay, type)."""
    names = (
        "ClaimID", "BeneID", "Provider", "InscClaimAmtReimbursed", "DeductibleAmtPaid",
        "claim_duration_days", "hospital_stay_days", "claim_type",
    )
    data = [tuple(dict(zip(names, r)).get(c) for c in UNIFIED) for r in rows]
    return spark.createDataFrame(data, CONTRACTS["silver.unified_claims"])


def people(spark, chronic):
    """Beneficiaries with and without conditions: {id: bool}."""
    rows = [
        (b, *[1 if has and i == 3 else 2 for i in range(len(CONDITION_COLUMNS))])
        for b, has in chronic.items()
    ]
    return spark.createDataFrame(
        rows, "BeneID string, " + ", ".join(f"{c} int" for c in CONDITION_COLUMNS)
    )


def labels(spark, rows):
    return spark.createDataFrame(rows, "Provider string, fraud_label int")


def build(spark, rows, chronic, **options):
    out = G.provider_features(
        unified(spark, rows), people(spark, chronic), labels(spark, [("P1", 1)]), **options
    )
    return {r["Provider"]: r.asDict() for r in out.collect()}


def model(rows, chronic):
    """The measures of each provider in plain Python."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)

    def known(group, i):
        return [r[i] for r in group if r[i] is not None]

    def mean(values):
        return sum(values) / len(values) if values else None

    result = {}
    for provider, g in groups.items():
        claims, patients = len(set(known(g, 0))), len(set(known(g, 1)))
        inpatient = sum(r[7] == "inpatient" for r in g)
        outpatient = sum(r[7] == "outpatient" for r in g)
        high = sum(r[3] is not None and r[3] >= 5000 for r in g)
        ill = sum(bool(chronic.get(r[1])) for r in g)

        def ratio(part, whole=claims):
            return part / whole if whole else None

        result[provider] = {
            "total_claims": claims,
            "unique_beneficiaries": patients,
            "inpatient_claims": inpatient,
            "outpatient_claims": outpatient,
            "avg_reimbursement_amount": mean(known(g, 3)),
            "total_reimbursement_amount": sum(known(g, 3)) if known(g, 3) else None,
            "max_reimbursement_amount": max(known(g, 3), default=None),
            "avg_deductible_amount": mean(known(g, 4)),
            "total_deductible_amount": sum(known(g, 4)) if known(g, 4) else None,
            "avg_claim_duration_days": mean(known(g, 5)),
            "avg_hospital_stay_days": mean(known(g, 6)) or 0.0,
            "high_reimbursement_claims": high,
            "chronic_condition_claims": ill,
            "inpatient_claim_ratio": ratio(inpatient),
            "outpatient_claim_ratio": ratio(outpatient),
            "high_reimbursement_claim_ratio": ratio(high),
            "chronic_condition_claim_ratio": ratio(ill),
            "claims_per_beneficiary": ratio(claims, patients),
            "fraud_label": 1 if provider == "P1" else 0,
        }
    return result


CLAIMS = st.lists(
    st.tuples(
        st.sampled_from(["c1", "c2", "c3", "c4", None]),
        st.sampled_from(["b1", "b2", "stranger", None]),
        st.sampled_from(["P1", "P2", None]),
        st.sampled_from([None, 0.0, 4999.99, 5000.0, 7500.25]),
        st.sampled_from([None, 0.0, 12.5]),
        st.sampled_from([None, 1, 4]),
        st.sampled_from([None, 2, 3]),
        st.sampled_from(["inpatient", "outpatient"]),
    ),
    max_size=25,
)
CHRONIC = {"b1": True, "b2": False}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CLAIMS)
def test_features_equal_a_plain_model(spark, rows):
    found, wanted = build(spark, rows, CHRONIC), model(rows, CHRONIC)
    assert set(found) == set(wanted)
    for provider, measures in wanted.items():
        row = {k: found[provider][k] for k in measures}
        assert row == pytest.approx(measures), provider


def test_an_id_of_both_kinds_counts_once_but_sums_twice(spark):
    rows = [
        ("c1", "b1", "P1", 10.0, 1.0, 1, 1, "inpatient"),
        ("c1", "b1", "P1", 20.0, 1.0, 1, None, "outpatient"),
    ]
    row = build(spark, rows, CHRONIC)["P1"]
    assert row["total_claims"] == 1 and row["total_reimbursement_amount"] == 30.0
    assert row["inpatient_claim_ratio"] + row["outpatient_claim_ratio"] == 2.0


def test_unknown_beneficiary_counts_as_not_chronic(spark):
    rows = [("c1", "stranger", "P1", 10.0, 1.0, 1, None, "outpatient")]
    assert build(spark, rows, CHRONIC)["P1"]["chronic_condition_claims"] == 0


def test_missing_label_may_stay_missing(spark):
    rows = [("c1", "b1", "P2", 10.0, 1.0, 1, None, "outpatient")]
    assert build(spark, rows, CHRONIC)["P2"]["fraud_label"] == 0
    assert build(spark, rows, CHRONIC, fill_label=False)["P2"]["fraud_label"] is None


def test_schema_and_empty_input(spark):
    out = G.provider_features(unified(spark, []), people(spark, {}), labels(spark, []))
    assert out.count() == 0
    expected = contract("gold.provider_fraud_features")
    assert out.schema.simpleString() == expected.simpleString()
    analytics = contract("gold.provider_fraud_analytics")
    assert G.provider_analytics(out).schema.simpleString() == analytics.simpleString()


def test_result_does_not_depend_on_partitioning(spark, sf_dir):
    claims = Q.claims(spark, sf_dir)
    someone = Q.valid(Q.BENE, spark, sf_dir)
    some_labels = Q.valid(Q.LABELS, spark, sf_dir)
    results = [
        Q.stable(
            G.provider_features(claims.repartition(n), someone, some_labels, Q.run_ts())
        ).orderBy("Provider").collect()
        for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_counts_agree_with_the_claims(spark, sf_dir):
    claims, gold = Q.claims(spark, sf_dir), Q.gold(spark, sf_dir)
    sums = gold.agg(F.sum("inpatient_claims") + F.sum("outpatient_claims")).first()[0]
    assert sums == claims.count()
    counted = G.group_counts(gold, "fraud_label").agg(F.sum("count")).first()[0]
    assert counted == gold.count()


def test_approximate_claim_counts_are_close(spark, sf_dir):
    exact = {r["Provider"]: r["total_claims"] for r in Q.gold(spark, sf_dir).collect()}
    rough = {r["Provider"]: r["total_claims"] for r in Q.gold(spark, sf_dir, approx=True).collect()}
    assert rough.keys() == exact.keys()
    assert all(abs(rough[p] - n) <= 0.2 * n for p, n in exact.items())


def test_fill_numbers_leaves_text(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b double, c string")
    assert tuple(G.fill_numbers(df).first()) == (0, 0.0, None)
