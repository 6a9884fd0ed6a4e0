from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyward.operators import silver
from tallyward.plans import queries as Q
from tallyward.sources.contracts import CONTRACTS, contract


def as_of():
    return F.lit("2009-12-01").cast("date")


def run_ts():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def frame(spark, name, rows):
    """Rows given as dicts; columns left out are null."""
    names = contract(name).fieldNames()
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], contract(name))


def claim(key, **over):
    row = {
        "ClaimID": key,
        "BeneID": "B1",
        "Provider": "P1",
        "ClaimStartDt": "2009-01-01",
        "ClaimEndDt": "2009-01-03",
        "AdmissionDt": "2009-01-01",
        "DischargeDt": "2009-01-02",
        "InscClaimAmtReimbursed": 100.0,
        "DeductibleAmtPaid": "10",
    }
    return row | over


def reasons(entity, flagged, key):
    found = {r[key]: None for r in entity.valid(flagged).collect()}
    return found | {r[key]: r["quarantine_reason"] for r in entity.quarantined(flagged).collect()}


def test_inpatient_rules(spark):
    rows = [
        claim("ok"),
        claim(None),
        claim("no provider", Provider=None),
        claim("no beneficiary", BeneID=None),
        claim("ends early", ClaimEndDt="2008-12-31"),
        claim("bad date", ClaimStartDt="2009-02-30"),
        claim("NA date", ClaimStartDt="NA"),
        claim("discharged early", DischargeDt="2008-12-31"),
        claim("refund", InscClaimAmtReimbursed=-1.0),
        claim("no amount", InscClaimAmtReimbursed=None),
        claim("NA deductible", DeductibleAmtPaid="NA"),
        claim("negative deductible", DeductibleAmtPaid="-5"),
        claim("several", Provider=None, ClaimEndDt=None, DeductibleAmtPaid="-5"),
    ]
    entity = silver.INPATIENT_CLAIMS
    flagged = entity.flagged(frame(spark, entity.raw, rows), as_of(), run_ts())
    assert reasons(entity, flagged, "ClaimID") == {
        "ok": None,
        None: "Missing ClaimID",
        "no provider": "Missing Provider",
        "no beneficiary": "Missing BeneID",
        "ends early": "Invalid Claim Dates",
        "bad date": "Invalid Claim Dates",
        "NA date": "Invalid Claim Dates",
        "discharged early": "Invalid Admission/Discharge Dates",
        "refund": "Negative Reimbursement",
        "no amount": None,
        "NA deductible": None,
        "negative deductible": "Negative Deductible",
        "several": "Missing Provider, Invalid Claim Dates, Negative Deductible",
    }
    ok = flagged.filter("ClaimID = 'ok'").first()
    assert (ok["claim_duration_days"], ok["hospital_stay_days"]) == (3, 2)
    assert ok["ClaimStartDt"] == dt.date(2009, 1, 1) and ok["DeductibleAmtPaid"] == 10.0


def test_outpatient_has_no_admission_rule(spark):
    entity = silver.OUTPATIENT_CLAIMS
    rows = [claim("ok"), claim("bad amount", DeductibleAmtPaid="NA")]
    flagged = entity.flagged(frame(spark, entity.raw, rows), as_of(), run_ts())
    assert "dq_invalid_admission_dates" not in flagged.columns
    assert reasons(entity, flagged, "ClaimID") == {"ok": None, "bad amount": None}


def test_beneficiary_rules(spark):
    entity = silver.BENEFICIARY
    rows = [
        {"BeneID": "ok", "DOB": "1950-01-01", "DOD": "NA", "Gender": 1, "Race": 3},
        {"BeneID": "dead", "DOB": "1950-01-01", "DOD": "2009-06-01", "Gender": 2},
        {"BeneID": "bad death", "DOB": "1950-01-01", "DOD": "2009-06-31"},
        {"BeneID": "no birth", "DOB": None},
        {"BeneID": "unborn", "DOB": "2011-01-01"},
        {"BeneID": "120", "DOB": "1889-11-30"},
        {"BeneID": "121", "DOB": "1888-11-29"},
        {"BeneID": None, "DOB": "2011-01-01"},
    ]
    flagged = entity.flagged(frame(spark, entity.raw, rows), as_of(), run_ts())
    assert reasons(entity, flagged, "BeneID") == {
        "ok": None,
        "dead": None,
        "bad death": None,
        "no birth": "Invalid DOB",
        "unborn": "Invalid Age",
        "120": None,
        "121": "Invalid Age",
        None: "Missing BeneID, Invalid Age",
    }
    by_key = {r["BeneID"]: r for r in flagged.collect()}
    assert [by_key[k]["is_deceased"] for k in ("ok", "dead", "bad death")] == [0, 1, 0]
    assert [by_key[k]["gender_desc"] for k in ("ok", "dead", "120")] == ["Male", "Female", "Unknown"]
    assert by_key["ok"]["race_desc"] == "3" and by_key["ok"]["DOD"] is None


def test_label_rules(spark):
    entity = silver.PROVIDER_LABELS
    rows = [
        {"Provider": "y", "PotentialFraud": "Yes"},
        {"Provider": "n", "PotentialFraud": "No"},
        {"Provider": "u", "PotentialFraud": "Unknown"},
        {"Provider": None, "PotentialFraud": None},
    ]
    flagged = entity.flagged(frame(spark, entity.raw, rows), as_of(), run_ts())
    assert reasons(entity, flagged, "Provider") == {
        "y": None,
        "n": None,
        "u": "Invalid Fraud Label",
        None: "Missing Provider, Invalid Fraud Label",
    }


def test_unified_rules_on_direct_input(spark):
    schema = CONTRACTS["silver.unified_claims"]
    rows = [
        ("a", "inpatient", 1),
        ("b", "dental", 1),
        ("c", "outpatient", 0),
        ("d", None, None),
        ("e", "dental", -1),
    ]
    names = contract("silver.unified_claims").fieldNames()
    data = [
        tuple(dict(ClaimID=i, claim_type=t, claim_duration_days=d).get(c) for c in names)
        for i, t, d in rows
    ]
    flagged = silver.flag_unified(spark.createDataFrame(data, schema))
    bad = {r["ClaimID"]: r["quarantine_reason"] for r in silver.quarantined_unified(flagged).collect()}
    assert bad == {
        "b": "Invalid Claim Type",
        "c": "Invalid Claim Duration",
        "e": "Invalid Claim Type, Invalid Claim Duration",
    }
    assert {r["ClaimID"] for r in silver.valid_unified(flagged).collect()} == {"a", "d"}


def test_unify_keeps_an_id_of_both_kinds_twice(spark):
    inp, outp = silver.INPATIENT_CLAIMS, silver.OUTPATIENT_CLAIMS
    one = [claim("both"), claim("in")]
    unified = silver.unify_claims(
        inp.clean(frame(spark, inp.raw, one), as_of(), run_ts()),
        outp.clean(frame(spark, outp.raw, [claim("both")]), as_of(), run_ts()),
    )
    assert unified.schema.simpleString() == contract("silver.unified_claims").simpleString()
    assert sorted((r["ClaimID"], r["claim_type"]) for r in unified.collect()) == [
        ("both", "inpatient"),
        ("both", "outpatient"),
        ("in", "inpatient"),
    ]


@pytest.mark.parametrize("entity", silver.ENTITIES, ids=lambda e: e.name)
def test_rows_add_up(spark, sf_dir, entity):
    """Raw rows = valid + quarantined + removed duplicates; keys unique on each side."""
    raw, flagged = Q.raw(entity, spark, sf_dir), Q.flagged(entity, spark, sf_dir)
    good, bad = entity.valid(flagged), entity.quarantined(flagged)
    assert good.count() + bad.count() == raw.select(entity.key).distinct().count()
    assert flagged.agg(F.sum(silver.COPIES)).first()[0] == raw.count()
    assert bad.filter("quarantine_reason = ''").count() == 0


@pytest.mark.parametrize("entity", silver.ENTITIES, ids=lambda e: e.name)
def test_empty_input(spark, entity):
    flagged = entity.flagged(frame(spark, entity.raw, []), as_of(), run_ts())
    assert flagged.count() == 0


def test_clock_defaults_to_now(spark):
    entity = silver.BENEFICIARY
    rows = [{"BeneID": "x", "DOB": "1950-01-01"}]
    row = entity.clean(frame(spark, entity.raw, rows)).first()
    assert row["age"] >= 75
    assert row[silver.STAMP].year >= 2025
