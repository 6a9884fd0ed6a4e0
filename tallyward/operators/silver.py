"""Cleansing of the raw tables: deduplicate, parse, derive, flag."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import scalars as S
from tallyward.functions.rules import (
    Rule,
    disordered,
    flag_rows,
    flagged_reasons,
    missing,
    negative,
    not_in,
    not_positive,
    outside,
    quarantined_rows,
    valid_rows,
)
from tallyward.operators.dedupe import dedupe
from tallyward.sources.contracts import column_names

COPIES = "dq_source_rows"
INPATIENT, OUTPATIENT = "inpatient", "outpatient"
STAMP = "silver_processed_timestamp"


def now_or(run_ts: Column | None) -> Column:
    return F.current_timestamp() if run_ts is None else run_ts


def today_or(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of


def derive_beneficiary(parsed: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
    return parsed.withColumns(
        {
            "age": S.age_in_years(F.col("DOB"), as_of),
            "is_deceased": S.is_deceased(F.col("DOD")),
            "gender_desc": S.gender_text(F.col("Gender")),
            "race_desc": S.as_text(F.col("Race")),
            STAMP: run_ts,
        }
    )


def derive_claims(parsed: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
    """Duration of the claim; the stay only where the table has admissions."""
    derived = {"claim_duration_days": S.inclusive_days(F.col("ClaimStartDt"), F.col("ClaimEndDt"))}
    if "AdmissionDt" in parsed.columns:
        derived["hospital_stay_days"] = S.inclusive_days(F.col("AdmissionDt"), F.col("DischargeDt"))
    return parsed.withColumns(derived | {STAMP: run_ts})


def derive_labels(df: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
    return df.withColumns({"fraud_label": S.label_code(F.col("PotentialFraud")), STAMP: run_ts})


# What is read from the text of which column.
Parsers = Mapping[str, Callable[[Column], Column]]
BENEFICIARY_PARSERS: Parsers = {"DOB": S.parse_date, "DOD": S.parse_optional_date}
OUTPATIENT_PARSERS: Parsers = {
    "ClaimStartDt": S.parse_date,
    "ClaimEndDt": S.parse_date,
    "InscClaimAmtReimbursed": S.to_number,
    "DeductibleAmtPaid": S.to_number,
}
INPATIENT_PARSERS: Parsers = OUTPATIENT_PARSERS | {
    "AdmissionDt": S.parse_date,
    "DischargeDt": S.parse_date,
}

# Flag names, reason texts and their order.
BENEFICIARY_RULES = (
    Rule("dq_missing_bene_id", "Missing BeneID", missing("BeneID")),
    Rule("dq_invalid_dob", "Invalid DOB", missing("DOB")),
    Rule("dq_invalid_age", "Invalid Age", outside("age", 0, 120)),
)
CLAIM_KEY_RULES = (
    Rule("dq_missing_claim_id", "Missing ClaimID", missing("ClaimID")),
    Rule("dq_missing_provider", "Missing Provider", missing("Provider")),
    Rule("dq_missing_bene_id", "Missing BeneID", missing("BeneID")),
    Rule("dq_invalid_claim_dates", "Invalid Claim Dates", disordered("ClaimStartDt", "ClaimEndDt")),
)
ADMISSION_RULES = (
    Rule(
        "dq_invalid_admission_dates",
        "Invalid Admission/Discharge Dates",
        disordered("AdmissionDt", "DischargeDt"),
    ),
)
CLAIM_AMOUNT_RULES = (
    Rule("dq_negative_reimbursement", "Negative Reimbursement", negative("InscClaimAmtReimbursed")),
    Rule("dq_negative_deductible", "Negative Deductible", negative("DeductibleAmtPaid")),
)
INPATIENT_RULES = CLAIM_KEY_RULES + ADMISSION_RULES + CLAIM_AMOUNT_RULES
OUTPATIENT_RULES = CLAIM_KEY_RULES + CLAIM_AMOUNT_RULES
LABEL_RULES = (
    Rule("dq_missing_provider", "Missing Provider", missing("Provider")),
    Rule("dq_invalid_fraud_label", "Invalid Fraud Label", missing("fraud_label")),
)
UNIFIED_RULES = (
    Rule(
        "dq_invalid_claim_type", "Invalid Claim Type", not_in("claim_type", [INPATIENT, OUTPATIENT])
    ),
    Rule(
        "dq_invalid_claim_duration", "Invalid Claim Duration", not_positive("claim_duration_days")
    ),
)
UNIFIED_VALID = "dq_is_valid_unified"


@dataclass(frozen=True)
class Entity:
    """How one raw table becomes valid and quarantined rows."""

    name: str
    raw: str
    silver: str
    quarantine: str
    key: str
    parsers: Parsers
    derived: Callable[[DataFrame, Column, Column], DataFrame]
    rules: Sequence[Rule]
    duplicates_metric: str

    def clean(
        self, raw: DataFrame, as_of: Column | None = None, run_ts: Column | None = None
    ) -> DataFrame:
        """One parsed row per key, with the number of raw rows behind it."""
        kept = dedupe(raw, self.key, COPIES, self.parsers)
        return self.derived(kept, today_or(as_of), now_or(run_ts))

    def derive(self, rows: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
        """Raw rows, parsed and with their derived columns."""
        parsed = rows.withColumns({c: read(F.col(c)) for c, read in self.parsers.items()})
        return self.derived(parsed, as_of, run_ts)

    def flagged(
        self, raw: DataFrame, as_of: Column | None = None, run_ts: Column | None = None
    ) -> DataFrame:
        return flag_rows(self.clean(raw, as_of, run_ts), self.rules)

    def staged(
        self, raw: DataFrame, as_of: Column | None = None, run_ts: Column | None = None
    ) -> DataFrame:
        """Flagged rows with their reasons: what a run stores once and splits by reading."""
        return self.flagged(raw, as_of, run_ts).withColumn(
            "quarantine_reason", flagged_reasons(self.rules)
        )

    def valid(self, flagged: DataFrame) -> DataFrame:
        return valid_rows(flagged).drop(COPIES)

    def quarantined(self, flagged: DataFrame) -> DataFrame:
        return quarantined_rows(flagged, self.rules).drop(COPIES)


BENEFICIARY = Entity(
    "beneficiary",
    "bronze.beneficiarydata",
    "silver.beneficiary",
    "monitoring.quarantine_beneficiary",
    "BeneID",
    BENEFICIARY_PARSERS,
    derive_beneficiary,
    BENEFICIARY_RULES,
    "duplicate_beneid_removed",
)
INPATIENT_CLAIMS = Entity(
    "inpatient_claims",
    "bronze.inpatientdata",
    "silver.inpatient_claims",
    "monitoring.quarantine_inpatient_claims",
    "ClaimID",
    INPATIENT_PARSERS,
    derive_claims,
    INPATIENT_RULES,
    "duplicate_claimid_removed",
)
OUTPATIENT_CLAIMS = Entity(
    "outpatient_claims",
    "bronze.outpatientdata",
    "silver.outpatient_claims",
    "monitoring.quarantine_outpatient_claims",
    "ClaimID",
    OUTPATIENT_PARSERS,
    derive_claims,
    OUTPATIENT_RULES,
    "duplicate_claimid_removed",
)
PROVIDER_LABELS = Entity(
    "provider_labels",
    "bronze.provider",
    "silver.provider_labels",
    "monitoring.quarantine_provider_labels",
    "Provider",
    {},
    derive_labels,
    LABEL_RULES,
    "duplicate_provider_removed",
)
ENTITIES = (BENEFICIARY, INPATIENT_CLAIMS, OUTPATIENT_CLAIMS, PROVIDER_LABELS)


def tag_claim_type(claims: DataFrame, claim_type: str) -> DataFrame:
    return claims.withColumn("claim_type", F.lit(claim_type))


def align_outpatient(outpatient: DataFrame) -> DataFrame:
    """Add the columns only inpatient claims have, as typed nulls."""
    return outpatient.withColumns(
        {
            "AdmissionDt": F.lit(None).cast("date"),
            "DischargeDt": F.lit(None).cast("date"),
            "hospital_stay_days": F.lit(None).cast("int"),
        }
    )


def common_claim_columns(claims: DataFrame) -> DataFrame:
    return claims.select(column_names("silver.unified_claims"))


def unify_claims(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """All claims of both kinds; an id used by both kinds stays twice."""
    parts = [
        tag_claim_type(inpatient, INPATIENT),
        tag_claim_type(align_outpatient(outpatient), OUTPATIENT),
    ]
    return reduce(DataFrame.unionByName, [common_claim_columns(p) for p in parts])


def flag_unified(unified: DataFrame) -> DataFrame:
    return flag_rows(unified, UNIFIED_RULES, UNIFIED_VALID)


def valid_unified(flagged: DataFrame) -> DataFrame:
    return valid_rows(flagged, UNIFIED_VALID)


def quarantined_unified(flagged: DataFrame) -> DataFrame:
    return quarantined_rows(flagged, UNIFIED_RULES, UNIFIED_VALID)
