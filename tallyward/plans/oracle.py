"""The same queries as plain SQL for DuckDB over the order tables, written independently."""

from __future__ import annotations

from collections.abc import Iterable

from tallyward.operators.checks import CheckSuite
from tallyward.plans.queries import AS_OF, NUDGE, RUN_TS
from tallyward.sources.contracts import CONDITION_COLUMNS, CONTRACTS

SQL: dict[str, str] = {}

NOW = f"TIMESTAMP '{RUN_TS}'"

# Fixed values, written out here as well so that a slip in the library's lists shows as a difference.
MEASURES = """
    total_claims unique_beneficiaries inpatient_claims outpatient_claims avg_reimbursement_amount
    total_reimbursement_amount max_reimbursement_amount avg_deductible_amount
    total_deductible_amount avg_claim_duration_days avg_hospital_stay_days
    high_reimbursement_claims chronic_condition_claims
""".split()
SHARES = """
    inpatient_claim_ratio outpatient_claim_ratio high_reimbursement_claim_ratio
    chronic_condition_claim_ratio
""".split()
FEATURES = [*MEASURES, *SHARES, "claims_per_beneficiary"]
CLAIM_SUITE = CheckSuite(
    "unified_claims",
    "ClaimID",
    "BeneID AdmissionDt DeductibleAmtPaid".split(),
    "InscClaimAmtReimbursed claim_duration_days".split(),
    ["hospital_stay_days"],
)
FEATURE_CHECKS = CheckSuite(
    "provider_fraud_features",
    "Provider",
    "Provider total_claims unique_beneficiaries avg_reimbursement_amount "
    "total_reimbursement_amount claims_per_beneficiary fraud_label".split(),
    "total_claims unique_beneficiaries inpatient_claims outpatient_claims "
    "avg_reimbursement_amount total_reimbursement_amount max_reimbursement_amount "
    "avg_deductible_amount total_deductible_amount avg_claim_duration_days "
    "claims_per_beneficiary".split(),
    SHARES,
)
PREDICTION_CHECKS = CheckSuite(
    "provider_fraud_predictions",
    "Provider",
    "Provider fraud_label predicted_fraud_label fraud_probability fraud_risk_category "
    "total_claims avg_reimbursement_amount claims_per_beneficiary".split(),
    "fraud_probability total_claims unique_beneficiaries claims_per_beneficiary "
    "avg_reimbursement_amount total_reimbursement_amount".split(),
    ["fraud_probability"],
)


# Column lists -----------------------------------------------------------------


def fields(ddl: str) -> list[tuple[str, str]]:
    pairs = [f.split() for f in ddl.replace("\n", " ").split(",")]
    return [(name, kind) for name, kind in pairs]


def shown(name: str, kind: str, expr: str | None = None) -> str:
    expr = expr or name
    if kind == "double":
        return f"round({expr} + {NUDGE}, 4) AS {name}"
    if kind == "date":
        return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {name}"
    if kind == "timestamp":
        return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name}"
    return f"CAST({expr} AS {kind}) AS {name}" if kind != "string" else f"{expr} AS {name}"


def show(columns: Iterable[tuple[str, str]]) -> str:
    return ", ".join(shown(n, k) for n, k in columns)


INT = "int"
BIG = "bigint"

# Bronze -----------------------------------------------------------------------


def bronze_claims(status: str, provider: str, factor: str = "1") -> str:
    stay = status == "F"
    day = "CAST(l_shipdate AS DATE)"
    deductible = "CAST(CAST(round(l_tax * 10000) AS BIGINT) AS VARCHAR)"
    if stay:
        deductible = f"CASE WHEN l_discount = 0 THEN 'NA' ELSE {deductible} END"
    admissions = (
        f"CAST({day} AS VARCHAR) AS AdmissionDt, "
        f"CAST({day} + (CAST(l_quantity AS INT) % 10 - 1) AS VARCHAR) AS DischargeDt, "
        if stay
        else ""
    )
    return f"""
        SELECT 'CLM' || l_orderkey || '-' || l_linenumber AS ClaimID,
               'BENE' || o_custkey AS BeneID,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE 'PRV' || {provider} END AS Provider,
               CAST({day} AS VARCHAR) AS ClaimStartDt,
               CAST({day} + (l_linenumber - 2) AS VARCHAR) AS ClaimEndDt,
               {admissions}
               CASE WHEN l_returnflag = 'R' AND l_tax = 0 THEN -{factor} * (l_extendedprice / 10)
                    ELSE {factor} * (l_extendedprice / 10) END AS InscClaimAmtReimbursed,
               {deductible} AS DeductibleAmtPaid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE l_linestatus = '{status}'"""


BRONZE_BENE = f"""
        SELECT 'BENE' || c_custkey AS BeneID,
               CASE WHEN c_custkey % 50 = 0 THEN NULL
                    ELSE CAST(DATE '1885-01-01' + CAST((c_custkey * 7919) % 47000 AS INT)
                              AS VARCHAR) END AS DOB,
               CASE WHEN c_custkey % 10 = 0 THEN '2009-06-01' ELSE 'NA' END AS DOD,
               CAST(c_custkey % 3 AS INT) AS Gender, c_nationkey AS Race,
               {", ".join(
                   f"CASE WHEN (c_custkey + {i}) % 23 = 0 THEN 1 ELSE 2 END AS {c}"
                   for i, c in enumerate(CONDITION_COLUMNS))}
        FROM customer"""

BRONZE_LABELS = """
        SELECT 'PRV' || s_suppkey AS Provider,
               CASE WHEN s_nationkey = 24 THEN 'Unknown' WHEN s_acctbal < 1000 THEN 'Yes'
                    ELSE 'No' END AS PotentialFraud
        FROM supplier"""

BRONZE_PART_LABELS = """
        SELECT 'PRV' || p_partkey AS Provider,
               CASE WHEN p_size <= 10 THEN 'Yes' ELSE 'No' END AS PotentialFraud
        FROM part"""


def first_rows(source: str, key: str, ddl: str) -> str:
    others = [n for n, _ in fields(ddl) if n != key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    return f"""
        SELECT *, count(*) OVER (PARTITION BY {key}) AS dq_source_rows FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


def failed(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def days(start: str, end: str) -> str:
    return f"date_diff('day', {start}, {end}) + 1"


def date_of(c: str) -> str:
    return f"TRY_CAST({c} AS DATE) AS {c}"


NUM = "TRY_CAST({0} AS DOUBLE) AS {0}"

# (flag, condition, reason) per table.
CLAIM_FLAGS = [
    ("dq_missing_claim_id", "ClaimID IS NULL", "Missing ClaimID"),
    ("dq_missing_provider", "Provider IS NULL", "Missing Provider"),
    ("dq_missing_bene_id", "BeneID IS NULL", "Missing BeneID"),
    (
        "dq_invalid_claim_dates",
        "ClaimStartDt IS NULL OR ClaimEndDt IS NULL OR ClaimEndDt < ClaimStartDt",
        "Invalid Claim Dates",
    ),
    (
        "dq_invalid_admission_dates",
        "AdmissionDt IS NULL OR DischargeDt IS NULL OR DischargeDt < AdmissionDt",
        "Invalid Admission/Discharge Dates",
    ),
    ("dq_negative_reimbursement", "InscClaimAmtReimbursed < 0", "Negative Reimbursement"),
    ("dq_negative_deductible", "DeductibleAmtPaid < 0", "Negative Deductible"),
]
OUT_FLAGS = [f for f in CLAIM_FLAGS if "admission" not in f[0]]
BENE_FLAGS = [
    ("dq_missing_bene_id", "BeneID IS NULL", "Missing BeneID"),
    ("dq_invalid_dob", "DOB IS NULL", "Invalid DOB"),
    ("dq_invalid_age", "age < 0 OR age > 120", "Invalid Age"),
]
LABEL_FLAGS = [
    ("dq_missing_provider", "Provider IS NULL", "Missing Provider"),
    ("dq_invalid_fraud_label", "fraud_label IS NULL", "Invalid Fraud Label"),
]
UNIFIED_FLAGS = [
    (
        "dq_invalid_claim_type",
        "claim_type NOT IN ('inpatient', 'outpatient')",
        "Invalid Claim Type",
    ),
    ("dq_invalid_claim_duration", "claim_duration_days <= 0", "Invalid Claim Duration"),
]


UNIFIED_VALID = "dq_is_valid_unified"


def flagged(source: str, flags, valid: str = "dq_is_valid") -> str:
    bad = " OR ".join(f"coalesce({cond}, false)" for _, cond, _ in flags)
    listed = ", ".join(f"{failed(cond)} AS {name}" for name, cond, _ in flags)
    reason = ", ".join(f"CASE WHEN {cond} THEN '{text}' END" for _, cond, text in flags)
    return f"""
        SELECT *, {listed}, CASE WHEN {bad} THEN 0 ELSE 1 END AS {valid},
               concat_ws(', ', {reason}) AS quarantine_reason
        FROM {source}"""


def clean_claims(source: str, stays: bool) -> str:
    keys = "ClaimID, BeneID, Provider"
    dates = ["ClaimStartDt", "ClaimEndDt"] + (["AdmissionDt", "DischargeDt"] if stays else [])
    stay = f", {days('AdmissionDt', 'DischargeDt')} AS hospital_stay_days" if stays else ""
    return f"""
        SELECT *, {days('ClaimStartDt', 'ClaimEndDt')} AS claim_duration_days{stay},
               {NOW} AS silver_processed_timestamp
        FROM (SELECT {keys}, {", ".join(date_of(d) for d in dates)},
                     {NUM.format('InscClaimAmtReimbursed')}, {NUM.format('DeductibleAmtPaid')},
                     dq_source_rows FROM {source})"""


CLEAN_BENE = f"""
        SELECT * REPLACE (TRY_CAST(DOB AS DATE) AS DOB, TRY_CAST(nullif(DOD, 'NA') AS DATE) AS DOD),
               CAST(floor(date_diff('day', TRY_CAST(DOB AS DATE), DATE '{AS_OF}') / 365.25)
                    AS BIGINT) AS age,
               CASE WHEN nullif(DOD, 'NA') IS NOT NULL THEN 1 ELSE 0 END AS is_deceased,
               CASE Gender WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' ELSE 'Unknown' END
                    AS gender_desc,
               CAST(Race AS VARCHAR) AS race_desc, {NOW} AS silver_processed_timestamp
        FROM bene_once"""

CLEAN_LABELS = f"""
        SELECT *, CASE PotentialFraud WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS fraud_label,
               {NOW} AS silver_processed_timestamp
        FROM labels_once"""

UNIFIED = fields(CONTRACTS["silver.unified_claims"])
UNIFIED_NAMES = ", ".join(n for n, _ in UNIFIED)


def unify(inp: str, outp: str) -> str:
    aligned = (
        "CAST(NULL AS DATE) AS AdmissionDt, CAST(NULL AS DATE) AS DischargeDt, "
        "CAST(NULL AS INT) AS hospital_stay_days"
    )
    return f"""
        SELECT {UNIFIED_NAMES} FROM (SELECT *, 'inpatient' AS claim_type FROM {inp})
        UNION ALL
        SELECT {UNIFIED_NAMES}
        FROM (SELECT *, {aligned}, 'outpatient' AS claim_type FROM {outp})"""


HAS_CHRONIC = " OR ".join(f"coalesce({c} = 1, false)" for c in CONDITION_COLUMNS)

TOTALS = f"""
        SELECT Provider,
               count(DISTINCT ClaimID) AS total_claims,
               count(DISTINCT BeneID) AS unique_beneficiaries,
               CAST(sum({failed("claim_type = 'inpatient'")}) AS BIGINT) AS inpatient_claims,
               CAST(sum({failed("claim_type = 'outpatient'")}) AS BIGINT) AS outpatient_claims,
               avg(InscClaimAmtReimbursed) AS avg_reimbursement_amount,
               sum(InscClaimAmtReimbursed) AS total_reimbursement_amount,
               max(InscClaimAmtReimbursed) AS max_reimbursement_amount,
               avg(DeductibleAmtPaid) AS avg_deductible_amount,
               sum(DeductibleAmtPaid) AS total_deductible_amount,
               avg(claim_duration_days) AS avg_claim_duration_days,
               avg(hospital_stay_days) AS avg_hospital_stay_days,
               CAST(sum({failed("InscClaimAmtReimbursed >= 5000")}) AS BIGINT)
                    AS high_reimbursement_claims,
               CAST(sum({failed(HAS_CHRONIC)}) AS BIGINT) AS chronic_condition_claims
        FROM claims LEFT JOIN bene_valid USING (BeneID)
        GROUP BY Provider"""

RATIO_PARTS = [
    ("inpatient_claim_ratio", "inpatient_claims"),
    ("outpatient_claim_ratio", "outpatient_claims"),
    ("high_reimbursement_claim_ratio", "high_reimbursement_claims"),
    ("chronic_condition_claim_ratio", "chronic_condition_claims"),
]

RATIOS = f"""
        SELECT *, {", ".join(f"{p} / nullif(total_claims, 0) AS {n}" for n, p in RATIO_PARTS)},
               total_claims / nullif(unique_beneficiaries, 0) AS claims_per_beneficiary
        FROM totals"""

GOLD = f"""
        SELECT r.* REPLACE (coalesce(avg_hospital_stay_days, 0) AS avg_hospital_stay_days),
               l.fraud_label AS known_label, coalesce(l.fraud_label, 0) AS fraud_label,
               {NOW} AS gold_processed_timestamp
        FROM ratios r LEFT JOIN labels_valid l USING (Provider)"""


def banded(column: str, high: str, medium: str) -> str:
    return (
        f"CASE WHEN {column} >= {high} THEN 'High Risk' WHEN {column} >= {medium} "
        "THEN 'Medium Risk' ELSE 'Low Risk' END"
    )


BAND = banded("fraud_probability", "0.80", "0.50")


def scored(probability: str, source: str = "gold") -> str:
    return f"""
        SELECT *, {failed("fraud_probability >= 0.5")} AS predicted_fraud_label,
               {BAND} AS fraud_risk_category, {NOW} AS prediction_timestamp
        FROM (SELECT *, {probability} AS fraud_probability FROM {source})"""


PREDICTIONS = scored(
    "least(CAST(1.0 AS DOUBLE), CAST(0.7 AS DOUBLE) * high_reimbursement_claim_ratio "
    "+ CAST(0.3 AS DOUBLE) * inpatient_claim_ratio)"
)
FAULTY = scored(
    "CASE WHEN unique_beneficiaries % 7 <> 0 THEN 2 * high_reimbursement_claim_ratio "
    "- CAST(0.5 AS DOUBLE) * inpatient_claim_ratio END",
    "(SELECT * REPLACE (CASE WHEN inpatient_claims = 5 THEN -avg_reimbursement_amount "
    "ELSE avg_reimbursement_amount END AS avg_reimbursement_amount) FROM gold)",
)
PREDICTION_FLAGS = [
    ("p1", "Provider IS NULL", "Missing Provider"),
    ("p2", "fraud_probability IS NULL", "Missing Fraud Probability"),
    ("p3", "fraud_probability < 0 OR fraud_probability > 1", "Invalid Fraud Probability"),
    ("p4", "total_claims < 0", "Negative Total Claims"),
    ("p5", "avg_reimbursement_amount < 0", "Negative Avg Reimbursement"),
    ("p6", "claims_per_beneficiary < 0", "Negative Claims Per Beneficiary"),
]


def long_sql(table: str, metrics: Iterable[tuple[str, str]], source: str, at: str = NOW) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{name}' AS metric_name, "
        f"CAST({expr} AS DOUBLE) AS metric_value, {at} AS metric_timestamp FROM {source}"
        for name, expr in metrics
    )


def layer_sql(table: str, source: str, duplicates: str) -> str:
    return long_sql(
        table,
        [
            ("total_records", "coalesce(sum(dq_source_rows), 0)"),
            ("valid_records", "count(*) FILTER (WHERE dq_is_valid = 1)"),
            ("quarantine_records", "count(*) FILTER (WHERE dq_is_valid = 0)"),
            (duplicates, "coalesce(sum(dq_source_rows), 0) - count(*)"),
        ],
        source,
    )


def suite_sql(suite: CheckSuite, source: str) -> str:
    key = suite.primary_key
    metrics = [
        ("total_records", "count(*)"),
        ("missing_primary_key_count", f"count(*) FILTER (WHERE {key} IS NULL)"),
    ]
    for c in suite.required:
        nulls = f"count(*) FILTER (WHERE {c} IS NULL)"
        metrics.append((f"null_count_{c}", nulls))
        metrics.append((f"null_percent_{c}", f"coalesce({nulls} / nullif(count(*), 0) * 100, 0)"))
    for c in suite.non_negative:
        metrics.append((f"negative_value_count_{c}", f"count(*) FILTER (WHERE {c} < 0)"))
    for c in suite.ratios:
        metrics.append((f"invalid_ratio_count_{c}", f"count(*) FILTER (WHERE {c} < 0 OR {c} > 1)"))
    repeated = f"(SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"
    duplicates = [("duplicate_primary_key_count", "count(*)")]
    return (
        long_sql(suite.table_name, metrics, source)
        + "\nUNION ALL\n"
        + long_sql(suite.table_name, duplicates, repeated)
    )


LABEL_COUNTS = f"""
        SELECT 'gold_provider_features' AS table_name, 'fraud_label_' || fraud_label AS metric_name,
               CAST(count(*) AS DOUBLE) AS metric_value, {NOW} AS metric_timestamp
        FROM gold GROUP BY fraud_label"""

YEARLY = "\nUNION ALL\n".join(
    f"""SELECT '{table}' AS table_name, '{metric}' AS metric_name,
               CAST({expr} AS DOUBLE) AS metric_value,
               CAST(date_trunc('year', ClaimStartDt) AS TIMESTAMP) AS metric_timestamp
        FROM {source} GROUP BY date_trunc('year', ClaimStartDt)"""
    for table, source in (("inpatient_claims", "inp_flagged"), ("outpatient_claims", "out_flagged"))
    for metric, expr in (
        ("total_records", "count(*)"),
        ("valid_records", "sum(dq_is_valid)"),
        ("quarantine_records", "sum(1 - dq_is_valid)"),
    )
)

def _text(name: str) -> str:
    return f"CAST(round({name} + {NUDGE}, 4) AS VARCHAR)"


PROMPT = f"""
    'Analyze this healthcare provider.\n\nProvider: ' || Provider
    || '\nFraud Probability: ' || {_text("fraud_probability")}
    || '\nTotal Claims: ' || total_claims
    || '\nAverage Reimbursement: ' || {_text("avg_reimbursement_amount")}
    || '\nClaims Per Beneficiary: ' || {_text("claims_per_beneficiary")}
    || '\nRisk Category: ' || fraud_risk_category
    || '\n\nExplain why this provider may be suspicious.'"""


def parts(grain: str) -> dict[str, str]:
    """All named parts, in order of dependence."""
    part = grain != "supplier"
    provider = "l_partkey" if part else "l_suppkey"
    factor = "(CASE WHEN p_size <= 10 THEN 10 ELSE 1 END)" if grain == "learnable" else "1"
    return {
        "inp_raw": bronze_claims("F", provider, factor),
        "out_raw": bronze_claims("O", provider, factor),
        "bene_raw": BRONZE_BENE,
        "labels_raw": BRONZE_PART_LABELS if part else BRONZE_LABELS,
        "inp_once": first_rows("inp_raw", "ClaimID", CONTRACTS["bronze.inpatientdata"]),
        "out_once": first_rows("out_raw", "ClaimID", CONTRACTS["bronze.outpatientdata"]),
        "bene_once": first_rows("bene_raw", "BeneID", CONTRACTS["bronze.beneficiarydata"]),
        "labels_once": first_rows("labels_raw", "Provider", CONTRACTS["bronze.provider"]),
        "inp_clean": clean_claims("inp_once", True),
        "out_clean": clean_claims("out_once", False),
        "bene_clean": CLEAN_BENE,
        "labels_clean": CLEAN_LABELS,
        "inp_flagged": flagged("inp_clean", CLAIM_FLAGS),
        "out_flagged": flagged("out_clean", OUT_FLAGS),
        "bene_flagged": flagged("bene_clean", BENE_FLAGS),
        "labels_flagged": flagged("labels_clean", LABEL_FLAGS),
        "inp_valid": "SELECT * FROM inp_flagged WHERE dq_is_valid = 1",
        "out_valid": "SELECT * FROM out_flagged WHERE dq_is_valid = 1",
        "bene_valid": "SELECT * FROM bene_flagged WHERE dq_is_valid = 1",
        "labels_valid": "SELECT * FROM labels_flagged WHERE dq_is_valid = 1",
        "unified": flagged(f"({unify('inp_valid', 'out_valid')})", UNIFIED_FLAGS, UNIFIED_VALID),
        "unsplit": flagged(f"({unify('inp_clean', 'out_clean')})", UNIFIED_FLAGS, UNIFIED_VALID),
        "claims": "SELECT * FROM unified WHERE dq_is_valid_unified = 1",
        "totals": TOTALS,
        "ratios": RATIOS,
        "gold": GOLD,
        "predictions": PREDICTIONS,
        "faulty": FAULTY,
        "quarantine": f"""
        SELECT *, {NOW} AS quarantine_timestamp
        FROM (SELECT *, quarantine_reason AS dq_reason
              FROM ({flagged('faulty', PREDICTION_FLAGS, 'prediction_valid')}))
        WHERE dq_reason <> ''""",
        "label_counts": LABEL_COUNTS,
        "yearly": YEARLY,
        "feature_metrics": suite_sql(FEATURE_CHECKS, "gold"),
        "history": "SELECT * FROM yearly UNION ALL SELECT * FROM feature_metrics "
        "UNION ALL SELECT * FROM label_counts UNION ALL SELECT * FROM label_counts",
        "prompts": f"SELECT *, {PROMPT} AS fraud_analysis_prompt FROM predictions",
    }


def define(name: str, select: str, grain: str = "supplier") -> None:
    """Register ``select`` with the parts it needs, and what those need, as WITH clauses."""
    known = parts(grain)

    def mentions(text: str, part: str) -> bool:
        words = "".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split()
        return part in words

    wanted: set[str] = set()
    texts = [select]
    while texts:
        text = texts.pop()
        for part in known:
            if part not in wanted and mentions(text, part):
                wanted.add(part)
                texts.append(known[part])
    clauses = ",\n".join(
        f"{p} AS {'MATERIALIZED ' if p in MATERIALIZED else ''}({known[p]})"
        for p in known
        if p in wanted
    )
    SQL[name] = f"WITH {clauses}\n{select}" if clauses else select


MATERIALIZED = {"inp_flagged", "out_flagged", "gold", "totals"}


def part_define(name: str, select: str) -> None:
    define(name, select, grain="part")


# Registered statements ---------------------------------------------------------

INP_RAW = fields(CONTRACTS["bronze.inpatientdata"])
OUT_RAW = fields(CONTRACTS["bronze.outpatientdata"])
BENE_RAW = fields(CONTRACTS["bronze.beneficiarydata"])
LABEL_RAW = fields(CONTRACTS["bronze.provider"])
FEATURE = fields(CONTRACTS["gold.provider_fraud_features"])
ANALYTICS = fields(CONTRACTS["gold.provider_fraud_analytics"])
PREDICTION = fields(CONTRACTS["gold.provider_fraud_predictions"])
METRIC = fields(CONTRACTS["quality.data_quality_metrics"])
SUMMARY = fields(CONTRACTS["quality.dq_dashboard_summary"])
QUARANTINE = fields(CONTRACTS["quality.quarantine_provider_fraud_predictions"])

DATES = ("ClaimStartDt", "ClaimEndDt", "AdmissionDt", "DischargeDt", "DOB", "DOD")
STAMP = ("silver_processed_timestamp", "timestamp")


def clean_fields(raw, extra) -> list[tuple[str, str]]:
    kinds = dict(raw)
    kinds.update({c: "date" for c in DATES if c in kinds})
    kinds.update({c: "double" for c in kinds if c == "DeductibleAmtPaid"})
    return [*kinds.items(), *extra, STAMP]


def flag_fields(flags, valid="dq_is_valid") -> list[tuple[str, str]]:
    return [(f, INT) for f, _, _ in flags] + [(valid, INT)]


REASON = [("quarantine_reason", "string")]
INP_CLEAN = clean_fields(INP_RAW, [("claim_duration_days", INT), ("hospital_stay_days", INT)])
OUT_CLEAN = clean_fields(OUT_RAW, [("claim_duration_days", INT)])
BENE_CLEAN = clean_fields(
    BENE_RAW,
    [("age", BIG), ("is_deceased", INT), ("gender_desc", "string"), ("race_desc", "string")],
)
LABEL_CLEAN = clean_fields(LABEL_RAW, [("fraud_label", INT)])

define("a01_scan", f"SELECT {show(INP_RAW)} FROM inp_raw")
SOURCES = {
    "bronze.beneficiarydata": "bene_raw",
    "bronze.inpatientdata": "inp_raw",
    "bronze.outpatientdata": "out_raw",
    "bronze.provider": "labels_raw",
}
define(
    "a03_source_access",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, true AS present, least(5, count(*)) AS rows_read FROM {s}"
        for n, s in SOURCES.items()
    ),
)
define(
    "a04_source_row_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {s}" for n, s in SOURCES.items()
    ),
)
define("a05_preview", f"SELECT {show(BENE_RAW)} FROM bene_raw ORDER BY BeneID LIMIT 20")

bene_valid = [c for c in BENE_CLEAN + flag_fields(BENE_FLAGS) if c != STAMP]
define("a07_overwrite", f"SELECT {show(bene_valid)} FROM bene_valid")
define("a08_overwrite_checked", f"SELECT {show(UNIFIED)} FROM claims")

LAYERS = {
    "beneficiary": ("bene_flagged", "duplicate_beneid_removed"),
    "inpatient_claims": ("inp_flagged", "duplicate_claimid_removed"),
    "outpatient_claims": ("out_flagged", "duplicate_claimid_removed"),
    "provider_labels": ("labels_flagged", "duplicate_provider_removed"),
}
ENTITY_METRICS = "\nUNION ALL\n".join(layer_sql(t, s, d) for t, (s, d) in LAYERS.items())
UNIFIED_METRICS = long_sql(
    "unified_claims",
    [
        ("total_records", "count(*)"),
        ("valid_records", "count(*) FILTER (WHERE dq_is_valid_unified = 1)"),
        ("quarantine_records", "count(*) FILTER (WHERE dq_is_valid_unified = 0)"),
    ],
    "unified",
)
define("a09_append", f"SELECT {show(METRIC)} FROM ({ENTITY_METRICS})")

define("a10_declared_table", f"SELECT {show(FEATURE)} FROM gold")

COPIES = [("dq_source_rows", BIG)]
define("b01_dedupe_beneficiary", f"SELECT {show(BENE_RAW)} FROM bene_once")
define("b01_dedupe_inpatient", f"SELECT {show(INP_RAW + COPIES)} FROM inp_once")
define("b01_dedupe_outpatient", f"SELECT {show(OUT_RAW + COPIES)} FROM out_once")
define(
    "b02_parse_date",
    f"SELECT ClaimID, {show((d, 'date') for d in DATES[:4])} FROM inp_raw",
)
define(
    "b03_parse_optional_date",
    f"SELECT BeneID, {shown('DOD', 'date', expr=chr(39).join(['nullif(DOD, ', 'NA', ')']))} "
    "FROM bene_raw",
)
define(
    "b04_numeric_cast",
    "SELECT ClaimID, "
    + shown("InscClaimAmtReimbursed", "double")
    + " FROM out_raw",
)
define(
    "b05_tolerant_cast",
    "SELECT ClaimID, "
    + shown("DeductibleAmtPaid", "double", "TRY_CAST(DeductibleAmtPaid AS DOUBLE)")
    + " FROM inp_raw",
)


def bene_columns(name: str, *columns: str) -> None:
    kinds = dict(BENE_CLEAN)
    define(name, f"SELECT {show((c, kinds[c]) for c in ('BeneID', *columns))} FROM bene_clean")


bene_columns("b06_age", "DOB", "age")
bene_columns("b07_deceased", "DOD", "is_deceased")
bene_columns("b08_gender", "Gender", "gender_desc")
bene_columns("b09_race", "race_desc")
define(
    "b10_claim_duration",
    f"SELECT ClaimID, {shown('claim_duration_days', INT)} FROM out_clean",
)
define("b11_hospital_stay", f"SELECT ClaimID, {shown('hospital_stay_days', INT)} FROM inp_clean")
define("b12_processing_timestamp", f"SELECT Provider, {shown(*STAMP)} FROM labels_clean")
define("b13_label_decode", "SELECT Provider, PotentialFraud, fraud_label FROM labels_clean")
define("b14_claim_type", "SELECT ClaimID, 'inpatient' AS claim_type FROM inp_once")
define(
    "b15_align_outpatient",
    "SELECT ClaimID, CAST(NULL AS VARCHAR) AS AdmissionDt, CAST(NULL AS VARCHAR) AS DischargeDt, "
    "CAST(NULL AS INT) AS hospital_stay_days FROM out_once",
)
define(
    "b16_common_columns",
    f"SELECT {show(UNIFIED)} FROM (SELECT *, 'inpatient' AS claim_type FROM inp_valid)",
)
define("b17_union", f"SELECT {show(UNIFIED)} FROM unified")


def flag_columns(name: str, source: str, *columns: str) -> None:
    define(name, f"SELECT {', '.join(columns)} FROM {source}")


flag_columns(
    "c01_missing",
    "inp_flagged",
    "ClaimID",
    "dq_missing_claim_id",
    "dq_missing_provider",
    "dq_missing_bene_id",
)
flag_columns("c02_out_of_range", "bene_flagged", "BeneID", "dq_invalid_dob", "dq_invalid_age")
flag_columns(
    "c03_date_order",
    "inp_flagged",
    "ClaimID",
    "dq_invalid_claim_dates",
    "dq_invalid_admission_dates",
)
flag_columns(
    "c04_negative", "out_flagged", "ClaimID", "dq_negative_reimbursement", "dq_negative_deductible"
)
define(
    "c05_not_in_set",
    f"SELECT BeneID, {failed('Gender NOT IN (1, 2)')} AS dq_unknown_gender FROM bene_once",
)
flag_columns(
    "c06_not_positive",
    "unsplit",
    "ClaimID",
    "claim_type",
    "dq_invalid_claim_type",
    "dq_invalid_claim_duration",
)
flag_columns("c07_validity", "out_flagged", "ClaimID", "dq_is_valid")
label_valid = [c for c in LABEL_CLEAN + flag_fields(LABEL_FLAGS) if c != STAMP]
define("c08_valid_split", f"SELECT {show(label_valid)} FROM labels_valid")
define(
    "c09_quarantine_split",
    "SELECT BeneID, quarantine_reason FROM bene_flagged WHERE dq_is_valid = 0",
)
define(
    "c10_layer_metrics",
    f"SELECT {show(METRIC)} FROM ({ENTITY_METRICS}\nUNION ALL\n{UNIFIED_METRICS})",
)
define(
    "c11_single_pass_metrics",
    f"SELECT {show(METRIC)} FROM "
    f"({layer_sql('provider_labels', 'labels_flagged', 'duplicate_provider_removed')})",
)

for prefix, source, columns, flags in (
    ("c20_beneficiary", "bene", BENE_CLEAN, BENE_FLAGS),
    ("c21_inpatient", "inp", INP_CLEAN, CLAIM_FLAGS),
    ("c22_outpatient", "out", OUT_CLEAN, OUT_FLAGS),
    ("c24_labels", "labels", LABEL_CLEAN, LABEL_FLAGS),
):
    everything = columns + flag_fields(flags)
    define(f"{prefix}_valid", f"SELECT {show(everything)} FROM {source}_valid")
    define(
        f"{prefix}_quarantine",
        f"SELECT {show(everything + REASON)} FROM {source}_flagged WHERE dq_is_valid = 0",
    )

unified_all = UNIFIED + flag_fields(UNIFIED_FLAGS, "dq_is_valid_unified")
define("c23_unified_valid", f"SELECT {show(unified_all)} FROM claims")
define(
    "c23_unified_quarantine",
    f"SELECT {show(unified_all + REASON)} FROM unsplit WHERE dq_is_valid_unified = 0",
)

define(
    "d01_claims_with_beneficiary",
    "SELECT c.BeneID, ClaimID, claim_type, age, gender_desc "
    "FROM claims c LEFT JOIN bene_valid b ON c.BeneID = b.BeneID",
)
define(
    "d02_claim_type_indicators",
    f"""SELECT ClaimID, claim_type, {failed("claim_type = 'inpatient'")} AS is_inpatient_claim,
        {failed("claim_type = 'outpatient'")} AS is_outpatient_claim FROM claims""",
)
define(
    "d03_high_reimbursement",
    f"SELECT ClaimID, claim_type, {failed('InscClaimAmtReimbursed >= 5000')} "
    "AS is_high_reimbursement_claim FROM claims",
)
define(
    "d04_chronic_condition",
    f"SELECT BeneID, {failed(HAS_CHRONIC)} AS has_chronic_condition FROM bene_valid",
)
MEASURED = [c for c in FEATURE if c[0] in ("Provider", *MEASURES)]
define("d05_provider_totals", f"SELECT {show(MEASURED)} FROM totals")
RATIO_FIELDS = [(n, "double") for n, _ in RATIO_PARTS] + [("claims_per_beneficiary", "double")]
define("d06_ratios", f"SELECT Provider, {show(RATIO_FIELDS)} FROM ratios")
define("d07_labelled", "SELECT Provider, total_claims, known_label AS fraud_label FROM gold")
define("d08_filled_features", f"SELECT {show(FEATURE)} FROM gold")
define("d08_unfilled_label", "SELECT Provider, known_label AS fraud_label FROM gold")
part_define("d08_part_features", f"SELECT {show(FEATURE)} FROM gold")
define(
    "d09_fill_numbers",
    f"SELECT Provider, {shown('avg_hospital_stay_days', 'double')}, fraud_label FROM gold",
)
define(
    "d10_fraud_status",
    "SELECT Provider, CASE known_label WHEN 1 THEN 'Fraud' WHEN 0 THEN 'Non-Fraud' "
    "ELSE 'Unknown' END AS fraud_status FROM gold",
)
SEGMENT = banded("high_reimbursement_claim_ratio", "0.30", "0.10")
part_define("d11_risk_segment", f"SELECT Provider, {SEGMENT} AS risk_segment FROM gold")
STATUS = "CASE fraud_label WHEN 1 THEN 'Fraud' WHEN 0 THEN 'Non-Fraud' ELSE 'Unknown' END"
analytics = f"(SELECT *, {STATUS} AS fraud_status, {SEGMENT} AS risk_segment FROM gold)"
define("d12_analytics", f"SELECT {show(ANALYTICS)} FROM {analytics}")
define("d13_counts_by_label", "SELECT fraud_label, count(*) AS count FROM gold GROUP BY 1")
part_define(
    "d13_counts_by_segment",
    f"SELECT fraud_status, risk_segment, count(*) AS count FROM {analytics} GROUP BY 1, 2",
)
part_define(
    "d13_counts_by_risk",
    "SELECT fraud_risk_category, count(*) AS count FROM predictions GROUP BY 1",
)

define("e01_claim_checks", f"SELECT {show(METRIC)} FROM ({suite_sql(CLAIM_SUITE, 'unsplit')})")
part_define("e02_feature_checks", f"SELECT {show(METRIC)} FROM feature_metrics")
part_define(
    "e03_prediction_checks",
    f"SELECT {show(METRIC)} FROM ({suite_sql(PREDICTION_CHECKS, 'faulty')})",
)
part_define(
    "e04_metric_union",
    f"SELECT {show(METRIC)} FROM (SELECT * FROM feature_metrics UNION ALL "
    f"{suite_sql(PREDICTION_CHECKS, 'faulty')})",
)
part_define("e05_prediction_quarantine", f"SELECT {show(QUARANTINE)} FROM quarantine")

LATEST = """
        SELECT table_name, metric_name, max(metric_timestamp) AS latest_metric_timestamp
        FROM history GROUP BY table_name, metric_name"""
TIED = f"""(
        SELECT h.table_name, h.metric_name, h.metric_value AS latest_metric_value,
               l.latest_metric_timestamp
        FROM history h JOIN ({LATEST}) l
          ON h.table_name = l.table_name AND h.metric_name = l.metric_name
         AND h.metric_timestamp = l.latest_metric_timestamp)"""
ONE_EACH = f"""(
        SELECT table_name, metric_name, latest_metric_timestamp,
               max(latest_metric_value) AS latest_metric_value
        FROM {TIED} GROUP BY ALL)"""
define("e06_latest_values", f"SELECT {show(SUMMARY)} FROM {ONE_EACH}")
define("e07_latest_rows", f"SELECT {show(SUMMARY)} FROM {TIED}")
OFF = " OR ".join(f"{n} < 0 OR {n} > 1" for n, _ in RATIO_PARTS)
part_define(
    "e08_gold_validation",
    f"SELECT {show(METRIC)} FROM ("
    + long_sql(
        "gold_provider_features",
        [
            ("total_records", "count(*)"),
            ("missing_provider", "count(*) FILTER (WHERE Provider IS NULL)"),
            ("missing_fraud_label", "count(*) FILTER (WHERE known_label IS NULL)"),
            ("duplicate_provider", "count(*) - count(DISTINCT Provider)"),
            ("negative_total_claims", "count(*) FILTER (WHERE total_claims < 0)"),
            ("invalid_ratio_values", f"count(*) FILTER (WHERE {OFF})"),
        ],
        "gold",
    )
    + ")",
)
define("e09_label_distribution", f"SELECT {show(METRIC)} FROM label_counts")
define(
    "e10_quality_summary", f"SELECT {show(SUMMARY)} FROM {TIED} ORDER BY table_name, metric_name"
)
define(
    "e11_quarantine_metrics",
    f"SELECT {show(METRIC)} FROM history WHERE metric_name LIKE '%quarantine%'",
)
define(
    "e12_null_percentages",
    f"SELECT {show(METRIC[:3])} FROM history WHERE metric_name LIKE 'null_percent%'",
)
define(
    "e13_label_metrics",
    f"SELECT {show(METRIC[1:3])} FROM history WHERE metric_name LIKE 'fraud_label_%'",
)

MODEL = [(n, k) for n, k in FEATURE if n in ("Provider", "fraud_label", *FEATURES)]
part_define(
    "f01_model_frame",
    "SELECT "
    + ", ".join(shown(n, k, n if k == "string" else f"coalesce({n}, 0)") for n, k in MODEL)
    + " FROM gold",
)
SPLIT_COUNTS = """(
        SELECT split, fraud_label, CAST(CASE split WHEN 'test' THEN quota ELSE n - quota END
                                        AS BIGINT) AS count
        FROM (SELECT fraud_label, count(*) AS n, round(count(*) * 0.2) AS quota
              FROM gold GROUP BY fraud_label),
             (VALUES ('test'), ('train')) AS s(split))"""
DRAW = "CAST('0x' || substr(md5(Provider || ':42'), 1, 15) AS BIGINT)"
part_define(
    "f02_split",
    f"SELECT Provider, fraud_label, CASE WHEN {DRAW} % 1000 < 200 THEN 'test' ELSE 'train' END "
    "AS split FROM gold",
)
part_define(
    "f02_split_exact",
    f"""SELECT Provider, fraud_label, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
        FROM (SELECT Provider, fraud_label,
                     row_number() OVER (PARTITION BY fraud_label
                                        ORDER BY {DRAW} % 4096, {DRAW}, Provider) AS place,
                     round(count(*) OVER (PARTITION BY fraud_label) * 0.2) AS quota
              FROM gold)""",
)
SPLIT = f"""(
        SELECT *, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, row_number() OVER (PARTITION BY fraud_label
                                           ORDER BY {DRAW} % 4096, {DRAW}, Provider) AS place,
                     round(count(*) OVER (PARTITION BY fraud_label) * 0.2) AS quota
              FROM gold))"""
# Ten times the amounts part the labels by a wide margin, so every fitted forest must find them.
for forest in ("f03_forest_a", "f04_forest_b"):
    define(
        forest,
        "SELECT Provider, fraud_label, fraud_label AS predicted_fraud_label, true AS score_decides "
        f"FROM {SPLIT} WHERE split = 'test'",
        "learnable",
    )
define(
    "f06_predictions",
    "SELECT Provider, split, fraud_label AS predicted_fraud_label, true AS score_decides "
    f"FROM {SPLIT}",
    "learnable",
)
SCORED = [c for c in PREDICTION if c[0] not in ("fraud_probability", "fraud_risk_category")]
define(
    "f14_batch_scoring",
    f"SELECT {show(SCORED)}, true AS score_decides, true AS band_agrees "
    "FROM (SELECT *, fraud_label AS predicted_fraud_label, "
    f"{NOW} AS prediction_timestamp FROM gold)",
    "learnable",
)
SQL["f10_feature_importance"] = (
    "SELECT unnest(["
    + ", ".join(f"'{f}'" for f in FEATURES)
    + "]) AS feature_name, true AS is_share, CAST(1.0 AS DOUBLE) AS total"
)
SQL["g06_feature_importance"] = (
    f"SELECT CAST(unnest(range(1, {len(FEATURES) + 1})) AS INT) AS rank, true AS no_larger, "
    "true AS carrier_on_top"
)
SQL["f11_run_log"] = f"""
    SELECT run_name, 'RandomForestClassifier' AS model_type, CAST(trees AS INT) AS n_estimators,
           CAST(depth AS INT) AS max_depth, 'balanced' AS class_weight,
           CAST(32 AS INT) AS training_partitions, true AS separates, '{RUN_TS}' AS created_at
    FROM (VALUES ('random_forest_provider_fraud', 100, 8), ('random_forest_deeper_model', 200, 12))
        AS r(run_name, trees, depth)"""
SUPPLIER_RUNS = f"""(
        SELECT 'run-' || s_suppkey AS run_id, 'nation-' || s_nationkey AS run_name,
               'RandomForestClassifier' AS model_type, CAST(100 AS INT) AS n_estimators,
               CAST(8 AS INT) AS max_depth, 'balanced' AS class_weight,
               CAST(32 AS INT) AS training_partitions, CAST(0 AS DOUBLE) AS accuracy,
               CAST(0 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall,
               CAST(0 AS DOUBLE) AS f1_score,
               CASE WHEN s_suppkey % 10 > 0 AND s_suppkey % 7 > 0
                    THEN CAST(floor(abs(s_acctbal) / 1000) / 10 AS DOUBLE) END AS roc_auc,
               'models/' || s_suppkey AS path,
               {NOW} + to_days(CAST(s_nationkey AS INT)) AS created_at
        FROM supplier)"""
BEST = f"""(SELECT * FROM {SUPPLIER_RUNS}
        ORDER BY roc_auc DESC NULLS LAST, created_at DESC, run_id LIMIT 1)"""
RUN_COLUMNS = [tuple(f.split()) for f in CONTRACTS["models.model_runs"].split(", ")]
SQL["f12_best_run"] = f"SELECT {show(RUN_COLUMNS)} FROM {BEST}"
SQL["f13_champion"] = f"""
    SELECT 'provider_risk_model' AS model, CAST(2 AS INT) AS version, 'champion' AS alias, run_id,
           path, 'Random forest on the provider features.' AS description,
           '{{"project":"provider_risk","source_table":"gold.provider_fraud_features",'
           || '"metric_roc_auc":"' || CAST(roc_auc AS VARCHAR) || '"}}' AS tags,
           '{RUN_TS}' AS created_at
    FROM {BEST}"""
part_define(
    "f05_class_weights",
    "SELECT fraud_label, "
    + shown("class_weight", "double", "sum(n) OVER () / (count(*) OVER () * n)")
    + " FROM (SELECT fraud_label, count(*) AS n FROM gold GROUP BY fraud_label)",
)
CELLS = """(SELECT count(*) FILTER (WHERE fraud_label = 1 AND predicted_fraud_label = 1) AS tp,
        count(*) FILTER (WHERE fraud_label = 0 AND predicted_fraud_label = 1) AS fp,
        count(*) FILTER (WHERE fraud_label = 1 AND predicted_fraud_label = 0) AS fn,
        count(*) FILTER (WHERE fraud_label = 0 AND predicted_fraud_label = 0) AS tn
        FROM predictions)"""
SCORES = {
    "accuracy": "(tp + tn) / nullif(tp + fp + fn + tn, 0)",
    "precision": "tp / nullif(tp + fp, 0)",
    "recall": "tp / nullif(tp + fn, 0)",
    "f1_score": "2 * tp / nullif(2 * tp + fp + fn, 0)",
}
part_define(
    "f07_classification_metrics",
    "SELECT "
    + ", ".join(shown(n, "double", f"coalesce({e}, 0)") for n, e in SCORES.items())
    + f" FROM {CELLS}",
)
part_define(
    "f08_roc_auc",
    "SELECT "
    + shown("roc_auc", "double", "sum(neg_below * pos + pos * neg / 2) / (sum(pos) * sum(neg))")
    + """ FROM (SELECT pos, neg,
                 coalesce(sum(neg) OVER (ORDER BY fraud_probability
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
          FROM (SELECT fraud_probability, CAST(sum(fraud_label) AS DOUBLE) AS pos,
                       CAST(sum(1 - fraud_label) AS DOUBLE) AS neg
                FROM predictions GROUP BY fraud_probability))""",
)
part_define(
    "f09_class_balance",
    f"SELECT split, fraud_label, count, "
    f"{shown('proportion', 'double', 'count / sum(count) OVER (PARTITION BY split)')} "
    f"FROM {SPLIT_COUNTS}",
)
part_define(
    "f15_risk_band",
    f"SELECT Provider, {shown('fraud_probability', 'double')}, fraud_risk_category FROM faulty",
)
part_define("f16_prediction_columns", f"SELECT {show(PREDICTION)} FROM predictions")
part_define("f17_prompts", "SELECT Provider, fraud_analysis_prompt FROM prompts")

PREDICTION_KINDS = dict(PREDICTION) | {"fraud_analysis_prompt": "string"}


def top(name: str, columns: str, rows: int, source: str = "predictions") -> None:
    listed = show((c, PREDICTION_KINDS[c]) for c in columns.split())
    part_define(
        name,
        f"SELECT {listed} FROM (SELECT * FROM {source} "
        f"ORDER BY fraud_probability DESC, Provider LIMIT {rows})",
    )


top(
    "g01_top_providers",
    "Provider fraud_probability fraud_risk_category total_claims unique_beneficiaries "
    "claims_per_beneficiary avg_reimbursement_amount total_reimbursement_amount "
    "high_reimbursement_claim_ratio chronic_condition_claim_ratio",
    25,
)
part_define(
    "g02_high_risk",
    f"SELECT {show(PREDICTION)} FROM predictions WHERE fraud_risk_category = 'High Risk'",
)
part_define(
    "g03_risk_distribution",
    "SELECT fraud_risk_category, count(*) AS provider_count, "
    + ", ".join(
        shown(alias, "double", f"avg({c})")
        for alias, c in (
            ("avg_fraud_probability", "fraud_probability"),
            ("avg_total_claims", "total_claims"),
            ("avg_reimbursement_amount", "avg_reimbursement_amount"),
        )
    )
    + " FROM predictions p GROUP BY fraud_risk_category",
)
part_define(
    "g04_actual_and_predicted",
    "SELECT fraud_label, predicted_fraud_label, count(*) AS provider_count "
    "FROM predictions GROUP BY 1, 2",
)
CONCENTRATED = (
    "total_claims high_reimbursement_claim_ratio avg_reimbursement_amount "
    "max_reimbursement_amount claims_per_beneficiary"
).split()
KINDS = dict(FEATURE) | PREDICTION_KINDS
CONCENTRATED_ROWS = """(SELECT * FROM {} WHERE total_claims >= 10
        ORDER BY high_reimbursement_claim_ratio DESC, avg_reimbursement_amount DESC, Provider
        LIMIT 50)"""
define(
    "g05_concentrated",
    f"SELECT {show((c, KINDS[c]) for c in ['Provider', *CONCENTRATED])} "
    f"FROM {CONCENTRATED_ROWS.format('gold')}",
)
scored_columns = ["Provider", "fraud_probability", "fraud_risk_category", *CONCENTRATED]
part_define(
    "g05_concentrated_scored",
    f"SELECT {show((c, KINDS[c]) for c in scored_columns)} "
    f"FROM {CONCENTRATED_ROWS.format('predictions')}",
)
top(
    "g07_top_prompts",
    "Provider fraud_probability fraud_risk_category fraud_analysis_prompt",
    20,
    "prompts",
)
define("g08_quality_summary", f"SELECT {show(SUMMARY)} FROM {ONE_EACH}")
part_define("g09_quarantined_predictions", f"SELECT {show(QUARANTINE)} FROM quarantine")
top(
    "g10_suspicious_providers",
    "Provider fraud_probability fraud_risk_category total_claims avg_reimbursement_amount "
    "high_reimbursement_claim_ratio claims_per_beneficiary",
    20,
)

part_define(
    "i02_aggregate_consistency",
    " UNION ALL ".join(
        f"SELECT '{m}' AS measure, count(*) FILTER (WHERE (outpatient_claims = 3 "
        f"AND {m} IS NOT NULL)"
        + (" OR inpatient_claims = 4" if m == "total_claims" else "")
        + ") AS differing_providers FROM gold"
        for m in MEASURES
    ),
)
BEFORE = (
    "lag(metric_value) OVER (PARTITION BY table_name, metric_name "
    "ORDER BY metric_timestamp, metric_value)"
)
define(
    "i03_metric_drift",
    f"SELECT {show(METRIC)}, {shown('previous_value', 'double')}, "
    f"{shown('change', 'double', 'metric_value - previous_value')}, "
    + shown(
        "relative_change", "double", "(metric_value - previous_value) / nullif(previous_value, 0)"
    )
    + f" FROM (SELECT *, {BEFORE} AS previous_value FROM yearly)",
)
context = [c for c in PREDICTION if c[0] != "prediction_timestamp"]
context_names = {n for n, _ in context}
more = [c for c in FEATURE if c[0] not in context_names and c[1] != "timestamp"]
part_define(
    "i04_investigation_context",
    f"SELECT {show(context + more)}, dq_reason "
    "FROM faulty LEFT JOIN (SELECT Provider, dq_reason FROM quarantine) q USING (Provider)",
)
part_define(
    "i05_risk_by_quality",
    "SELECT fraud_risk_category, coalesce(dq_reason, '') AS quality_finding, "
    "count(*) AS provider_count, "
    + shown("avg_fraud_probability", "double", "avg(fraud_probability)")
    + " FROM faulty LEFT JOIN (SELECT Provider, dq_reason FROM quarantine) q USING (Provider) "
    "GROUP BY 1, 2",
)
