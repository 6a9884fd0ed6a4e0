"""The queries of `queries_h` as plain SQL for DuckDB."""

from __future__ import annotations

from tallyward.operators import silver
from tallyward.plans import oracle as O

SQL: dict[str, str] = {}


def define(name: str, select: str, grain: str = "supplier") -> None:
    O.define(name, select, grain)
    SQL[name] = O.SQL.pop(name)


AMOUNT = ("InscClaimAmtReimbursed", "double")

define(
    "h01_merge",
    f"""
    SELECT ClaimID, Provider, ClaimStartDt, {O.shown(*AMOUNT)} FROM inp_once
    WHERE ClaimStartDt < '1993-01-01'
    UNION ALL
    SELECT ClaimID, Provider, ClaimStartDt, {O.shown(*AMOUNT, "InscClaimAmtReimbursed + 1")}
    FROM inp_once WHERE ClaimStartDt >= '1993-01-01' AND coalesce(InscClaimAmtReimbursed, 0) >= 0
    """,
)
define("h02_stream_ingest", f"SELECT {O.show(O.INP_RAW)} FROM inp_once")
define(
    "h03_as_of_join",
    """
    SELECT c.ClaimID, c.claim_type, c.Provider, m.known_claims
    FROM claims c ASOF LEFT JOIN (
        SELECT Provider, count(*) AS known_claims,
               CAST(date_trunc('month', ClaimStartDt) + INTERVAL 1 MONTH AS DATE) AS known_from
        FROM claims GROUP BY ALL
    ) m ON c.Provider = m.Provider AND c.ClaimStartDt >= m.known_from
    """,
)
define(
    "h04_interval_join",
    """
    SELECT x.BeneID, x.ClaimID AS a, y.ClaimID AS b,
           CAST(least(x.DischargeDt, y.DischargeDt) - greatest(x.AdmissionDt, y.AdmissionDt) + 1
                AS INTEGER) AS days,
           x.Provider AS Provider_a, y.Provider AS Provider_b
    FROM inp_valid x JOIN inp_valid y
      ON x.BeneID = y.BeneID AND x.ClaimID < y.ClaimID
     AND x.AdmissionDt <= y.DischargeDt AND y.AdmissionDt <= x.DischargeDt
    """,
)

GROUPED = """(
        SELECT claim_type, PotentialFraud AS status,
               CASE WHEN InscClaimAmtReimbursed >= 5000 THEN 'high'
                    WHEN InscClaimAmtReimbursed >= 1000 THEN 'middle' END AS band,
               strftime(ClaimStartDt, '%Y') AS year, strftime(ClaimStartDt, '%m') AS month,
               InscClaimAmtReimbursed AS amount
        FROM claims LEFT JOIN labels_valid USING (Provider)
    )"""


def grouped(name: str, columns: list[str], grouping: str) -> None:
    marks = ", ".join(f"CAST(grouping({c}) AS INTEGER) AS all_{c}" for c in columns)
    define(
        name,
        f"SELECT {', '.join(columns)}, {marks}, count(*) AS n, "
        f"{O.shown('amount', 'double', 'sum(amount)')} FROM {GROUPED} GROUP BY {grouping}",
    )


grouped("h05_cube", ["claim_type", "status", "band"], "CUBE (claim_type, status, band)")
grouped("h05_rollup", ["year", "month", "status"], "ROLLUP (year, month, status)")
grouped(
    "h05_grouping_sets",
    ["claim_type", "year", "status", "band"],
    "GROUPING SETS ((claim_type, year), (status), (band, status))",
)
define(
    "h05_cross_table",
    f"""
    SELECT claim_type, year, count(*) FILTER (band = 'high') AS n_high,
           count(*) FILTER (band IS NULL) AS n_null,
           count(*) FILTER (band NOT IN ('high')) AS n_other
    FROM {GROUPED} GROUP BY ALL
    """,
)
define(
    "h06_rolling",
    f"""
    SELECT ClaimID, claim_type, Provider, {O.shown("ClaimStartDt", "date")},
           count(*) OVER month AS claims_30d,
           {O.shown("amount_30d", "double", "sum(InscClaimAmtReimbursed) OVER month")}
    FROM claims
    WINDOW month AS (PARTITION BY Provider ORDER BY ClaimStartDt
                     RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)
    """,
)
define(
    "h07_sketches",
    """
    SELECT Provider, count(*) AS n, count(DISTINCT BeneID) AS unique_beneficiaries,
           true AS count_near, true AS median_near
    FROM claims GROUP BY Provider
    """,
)


def orphans(name: str, rows: str, key: str, parents: str) -> str:
    lone = f"{key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parents} WHERE {key} IS NOT NULL)"
    return " UNION ALL ".join(
        f"SELECT '{name}: {kind}' AS kind, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys "
        f"FROM {rows} WHERE {where}"
        for kind, where in (("no partner", lone), ("no key", f"{key} IS NULL"))
    )


define(
    "h08_orphans",
    " UNION ALL ".join(
        [
            orphans("claims of beneficiaries", "claims", "BeneID", "bene_valid"),
            orphans("claims of labels", "claims", "Provider", "labels_valid"),
            orphans("raw claims of labels", "inp_raw", "Provider", "labels_valid"),
            orphans("beneficiaries of claims", "bene_valid", "BeneID", "claims"),
            orphans("labels of claims", "labels_valid", "Provider", "claims"),
        ]
    ),
)
define(
    "h08_semi_join",
    "SELECT ClaimID, claim_type, BeneID FROM claims WHERE BeneID IN (SELECT BeneID FROM bene_valid)",
)

FRESH = (
    "SELECT Provider, total_claims, inpatient_claims, outpatient_claims, fraud_label FROM gold"
)
KEPT = (
    "SELECT Provider, total_claims, inpatient_claims, outpatient_claims, "
    "CASE WHEN inpatient_claims <> 5 THEN fraud_label END AS fraud_label "
    "FROM gold WHERE outpatient_claims <> 3"
)
STORED = f"{KEPT} UNION ALL SELECT * FROM ({KEPT}) WHERE inpatient_claims = 4"
define(
    "h09_differences",
    f"""
    SELECT Provider, total_claims, inpatient_claims, outpatient_claims, fraud_label,
           count(*) FILTER (side = 1) AS n_left, count(*) FILTER (side = 2) AS n_right
    FROM (SELECT *, 1 AS side FROM ({STORED}) UNION ALL SELECT *, 2 FROM ({FRESH}))
    GROUP BY ALL HAVING n_left <> n_right
    """,
    "part",
)
define(
    "h09_except_all", f"SELECT * FROM ({STORED}) EXCEPT ALL SELECT * FROM ({FRESH})", "part"
)
PLAIN = "total_claims, inpatient_claims, outpatient_claims, fraud_label"


def counted(sql: str) -> str:
    return f"(SELECT count(*) FROM ({sql}))"


LEFT, RIGHT = f"SELECT {PLAIN} FROM ({STORED})", f"SELECT {PLAIN} FROM ({FRESH})"
define(
    "h09_overlap",
    f"""
    SELECT {counted(LEFT)} AS n_left, {counted(RIGHT)} AS n_right,
           {counted(f"({LEFT}) INTERSECT ALL ({RIGHT})")} AS n_common,
           {counted(f"({LEFT}) EXCEPT ALL ({RIGHT})")} AS n_left_only,
           {counted(f"({RIGHT}) EXCEPT ALL ({LEFT})")} AS n_right_only
    """,
    "part",
)

FLAGS = [(r.flag_column, r.reason) for r in silver.INPATIENT_RULES]
define(
    "h10_reason_counts",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{reason}' AS reason, count(*) AS n_rows FROM inp_flagged WHERE {flag} = 1"
        for flag, reason in FLAGS
    )
    + ") WHERE n_rows > 0",
)
define(
    "h10_reason_pairs",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{reason}' AS reason, '{other}' AS other, count(*) AS n_rows FROM inp_flagged "
        f"WHERE {flag} = 1 AND {second} = 1"
        for i, (flag, reason) in enumerate(FLAGS)
        for second, other in FLAGS[i + 1 :]
    )
    + ") WHERE n_rows > 0",
)
define(
    "h10_json_tags",
    """
    SELECT Provider, nullif(PotentialFraud, 'Unknown') AS label,
           CASE WHEN PotentialFraud <> 'Unknown' THEN 'a "quoted, name"' END AS source,
           CASE WHEN PotentialFraud = 'Unknown' THEN '{"label":"Un' END AS corrupt
    FROM labels_raw
    """,
)
