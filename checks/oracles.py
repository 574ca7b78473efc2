"""The registered queries in plain SQL, written from the column definitions.

Nothing here goes through the library: each layer is one more subquery.
Doubles are rounded by their shortest decimal text, half away from zero, which
is how Spark rounds them.
"""

from __future__ import annotations

from collections.abc import Iterable

from checks.views import BATCH, VIEWS, View


def _order(view: View) -> str:
    clocks = []
    if "updated_at" in view.columns:
        clocks.append("TRY_CAST(updated_at AS TIMESTAMP) DESC NULLS LAST")
    if "ingestion_timestamp" in view.lineage:
        clocks.append("ingestion_timestamp DESC NULLS LAST")
    return ", ".join([*clocks, f"{BATCH} DESC NULLS LAST", "record_hash ASC"])


def latest(name: str, keys: str, all_null_keys: bool = False) -> str:
    view = VIEWS[name]
    extra = "".join(f" OR {key} IS NULL" for key in keys.split(", ")) if all_null_keys else ""
    ranked = (
        f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {_order(view)}) AS rn"
        f" FROM ({view.oracle_sql}) AS b"
    )
    return f"SELECT * EXCLUDE (rn) FROM ({ranked}) AS r WHERE rn = 1{extra}"


def reasons(*rules: tuple[str, str]) -> str:
    cases = (f"CASE WHEN {test} THEN NULL ELSE '{text}' END" for test, text in rules)
    return f"concat_ws(' | ', {', '.join(cases)})"


def _checked(typed: str, rules: Iterable[tuple[str, str]]) -> str:
    with_reason = f"SELECT *, {reasons(*rules)} AS reject_reason FROM ({typed}) AS t"
    return (
        "SELECT *, CASE WHEN reject_reason <> '' THEN 'reject'"
        " WHEN source_delete_flag = 'Y' THEN 'deleted' ELSE 'valid' END AS row_outcome"
        f" FROM ({with_reason}) AS w"
    )


def having(checked: str, outcome: str) -> str:
    return f"SELECT * EXCLUDE (row_outcome) FROM ({checked}) AS c WHERE row_outcome = '{outcome}'"


_UPDATED = "CAST(TRY_CAST(updated_at AS TIMESTAMP) AS STRING)"
_DELETE = "upper(trim(COALESCE(source_delete_flag, 'N')))"

CLAIMS_CHECKED = _checked(
    f"""SELECT claim_id, claim_line_id, member_id, provider_id, payer_id, diagnosis_code,
  procedure_code, TRY_CAST(claim_amount AS DOUBLE) AS claim_amount,
  TRY_CAST(approved_amount AS DOUBLE) AS approved_amount,
  TRY_CAST(paid_amount AS DOUBLE) AS paid_amount, upper(trim(claim_status)) AS claim_status,
  TRY_CAST(service_date AS DATE) AS service_date, TRY_CAST(received_date AS DATE) AS received_date,
  {_UPDATED} AS updated_at, {_DELETE} AS source_delete_flag, bronze_batch_id, record_hash,
  CAST(NULL AS DOUBLE) AS copay_amount, CAST(NULL AS DOUBLE) AS coinsurance_amount,
  CAST(NULL AS DOUBLE) AS deductible_amount, CAST(NULL AS DATE) AS service_from_date,
  CAST(NULL AS DATE) AS service_to_date, CAST(NULL AS DATE) AS processed_date,
  CAST(NULL AS DATE) AS admit_date, CAST(NULL AS DATE) AS discharge_date,
  'N' AS network_flag, 'N' AS is_emergency, 1 AS claim_version
FROM ({latest("claims", "claim_id, claim_line_id")}) AS k""",
    [
        ("claim_id IS NOT NULL", "claim_id is null"),
        ("claim_line_id IS NOT NULL", "claim_line_id is null"),
        ("member_id IS NOT NULL", "member_id is null"),
        ("provider_id IS NOT NULL", "provider_id is null"),
        ("claim_amount IS NOT NULL", "claim_amount is null"),
        ("claim_amount >= 0", "claim_amount is negative"),
        ("service_date IS NOT NULL", "service_date is invalid"),
        ("claim_status IN ('APPROVED', 'DENIED', 'PENDING')", "claim_status is invalid"),
    ],
)

_CLAIM_KEYS = "claims", "claim_id, claim_line_id"
CLAIMS_CHECKED_NULL_KEYS = CLAIMS_CHECKED.replace(latest(*_CLAIM_KEYS), latest(*_CLAIM_KEYS, all_null_keys=True))

MEMBERS_CHECKED = _checked(
    f"""SELECT member_id, full_name, gender, TRY_CAST(dob AS DATE) AS dob, city, state, plan_id,
  TRY_CAST(risk_score AS DOUBLE) AS risk_score,
  upper(trim(COALESCE(member_status, 'ACTIVE'))) AS member_status, {_UPDATED} AS updated_at,
  {_DELETE} AS source_delete_flag, bronze_batch_id, record_hash,
  CAST(TRY_CAST(updated_at AS TIMESTAMP) AS DATE) AS effective_date,
  CAST(NULL AS DATE) AS termination_date, 'PAYER_UNKNOWN' AS payer_id
FROM ({latest("members", "member_id")}) AS k""",
    [("member_id IS NOT NULL", "member_id is null")],
)

PROVIDERS_CHECKED = _checked(
    f"""SELECT provider_id, provider_name, specialty,
  upper(trim(COALESCE(network_flag, 'N'))) AS network_flag, address, city, state,
  TRY_CAST(quality_score AS DOUBLE) AS quality_score, {_UPDATED} AS updated_at,
  {_DELETE} AS source_delete_flag, bronze_batch_id, record_hash,
  CAST(TRY_CAST(updated_at AS TIMESTAMP) AS DATE) AS contract_start_date,
  CAST(NULL AS DATE) AS contract_end_date, 'ACTIVE' AS provider_status
FROM ({latest("providers", "provider_id")}) AS k""",
    [("provider_id IS NOT NULL", "provider_id is null")],
)


def _payments_checked(name: str) -> str:
    linked = ", claim_line_id, member_id, provider_id" if name == "linked_payments" else ""
    return _checked(
        f"""SELECT payment_id, claim_id{linked}, paid_amount,
  TRY_CAST(payment_date AS DATE) AS payment_date, upper(trim(payment_status)) AS payment_status,
  bronze_batch_id, record_hash, CAST(NULL AS DOUBLE) AS adjustment_amount,
  CAST(NULL AS DOUBLE) AS interest_amount, CAST(NULL AS DOUBLE) AS withhold_amount,
  CAST(NULL AS STRING) AS updated_at, 'N' AS source_delete_flag,
  TRY_CAST(paid_amount AS DOUBLE) AS payment_amount
FROM ({latest(name, "payment_id")}) AS k""",
        [
            ("payment_id IS NOT NULL", "payment_id is null"),
            ("claim_id IS NOT NULL", "claim_id is null"),
            ("payment_amount IS NOT NULL", "payment_amount is null"),
            ("payment_amount >= 0", "payment_amount is negative"),
        ],
    )


PAYMENTS_CHECKED = _payments_checked("payments")
LINKED_PAYMENTS_CHECKED = _payments_checked("linked_payments")

CHECKED = {
    "claims": CLAIMS_CHECKED,
    "members": MEMBERS_CHECKED,
    "providers": PROVIDERS_CHECKED,
    "payments": PAYMENTS_CHECKED,
}

REJECT_PROFILE = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, reject_reason, count(*) AS count"
    f" FROM ({having(sql, 'reject')}) AS p GROUP BY reject_reason"
    for name, sql in CHECKED.items()
)


def two_decimals(value: str) -> str:
    exact = f"CAST(CAST({value} AS STRING) AS DECIMAL(34, 18))"
    return f"CAST(round({exact}, 2) AS DOUBLE)"


def percent(part: str, whole: str) -> str:
    share = two_decimals(f"(CAST({part} AS DOUBLE) / {whole} * 100)")
    return f"CASE WHEN {whole} > 0 THEN {share} ELSE 0.0 END"


def mean(value: str) -> str:
    return two_decimals(f"(CAST(sum({value}) AS DOUBLE) / count({value}))")


def money_mean(value: str) -> str:
    return two_decimals(f"({total(value)} / count({value}))")


def total(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(18, 2))) AS DOUBLE)"


DQ_SUMMARY = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, valid_rows, reject_rows,"
    f" {percent('reject_rows', '(valid_rows + reject_rows)')} AS reject_rate_pct FROM"
    " (SELECT count(*) FILTER (WHERE row_outcome = 'valid') AS valid_rows,"
    f" count(*) FILTER (WHERE row_outcome = 'reject') AS reject_rows FROM ({sql}) AS c) AS s"
    for name, sql in CHECKED.items()
)


def names(full_name: str = "full_name") -> str:
    words = f"string_split(trim({full_name}), ' ')"
    return f"{words}[1] AS first_name, {words}[2] AS last_name"


DIM_MEMBER = f"""SELECT member_id, member_id AS enterprise_member_id, {names()}, gender, dob,
  CAST(NULL AS STRING) AS phone, CAST(NULL AS STRING) AS email,
  CAST(NULL AS STRING) AS address_line1, city, state, CAST(NULL AS STRING) AS zip_code,
  'INDIA' AS country, plan_id, CAST(NULL AS STRING) AS plan_name, payer_id, member_status,
  effective_date, termination_date, CAST(NULL AS STRING) AS primary_provider_id, risk_score,
  updated_at, row_number() OVER (ORDER BY member_id ASC NULLS LAST) AS member_sk
FROM ({having(MEMBERS_CHECKED, 'valid')}) AS m"""

_PROVIDER_COLUMNS = """provider_id AS enterprise_provider_id, CAST(NULL AS STRING) AS npi,
  provider_name, 'HOSPITAL' AS provider_type, specialty, CAST(NULL AS STRING) AS taxonomy_code,
  network_flag, CAST(NULL AS STRING) AS hospital_affiliation, address_line1, city, state,
  CAST(NULL AS STRING) AS zip_code, 'INDIA' AS country, CAST(NULL AS STRING) AS phone,
  CAST(NULL AS STRING) AS email, contract_start_date, contract_end_date, provider_status,
  quality_score"""

DIM_PROVIDER = f"""SELECT provider_id, {_PROVIDER_COLUMNS}, updated_at,
  row_number() OVER (ORDER BY provider_id ASC NULLS LAST) AS provider_current_sk
FROM (SELECT *, address AS address_line1 FROM ({having(PROVIDERS_CHECKED, 'valid')}) AS v) AS p"""

FACT_CLAIM = f"""SELECT c.claim_id, c.claim_line_id, m.member_sk, p.provider_current_sk,
  c.member_id, c.provider_id, c.payer_id, c.diagnosis_code, c.procedure_code, c.claim_amount,
  c.approved_amount, c.paid_amount, c.claim_status, c.service_date, c.received_date,
  c.claim_version, c.updated_at, c.record_hash,
  strftime(c.service_date, '%Y-%m') AS claim_year_month,
  CASE WHEN c.claim_status = 'APPROVED' THEN 1 ELSE 0 END AS approved_flag,
  CASE WHEN c.claim_status = 'DENIED' THEN 1 ELSE 0 END AS denied_flag,
  CASE WHEN c.claim_status = 'PENDING' THEN 1 ELSE 0 END AS pending_flag,
  row_number() OVER (ORDER BY c.claim_id ASC NULLS LAST, c.claim_line_id ASC NULLS LAST) AS claim_sk
FROM ({having(CLAIMS_CHECKED, 'valid')}) AS c
LEFT JOIN ({DIM_MEMBER}) AS m ON c.member_id = m.member_id
LEFT JOIN ({DIM_PROVIDER}) AS p ON c.provider_id = p.provider_id"""


_LINED = f"""SELECT *, count(*) OVER (PARTITION BY claim_id) AS lines
  FROM ({FACT_CLAIM}) AS l"""


def _fact_payment(checked: str, ids: str) -> str:
    """``ids`` says where line, member and provider come from: absent, linked or by_claim."""
    id_columns = ("claim_line_id", "member_id", "provider_id")
    column = {"absent": "CAST(NULL AS STRING)", "linked": "p.{}", "by_claim": "s.{}"}[ids]
    value = {name: column.format(name) for name in id_columns}
    on = {name: "NULL" if ids == "absent" else value[name] for name in id_columns}
    single = f"LEFT JOIN ({_LINED}) AS s ON s.claim_id = p.claim_id AND s.lines = 1" if ids == "by_claim" else ""
    return f"""SELECT p.payment_id, c.claim_sk, m.member_sk, r.provider_current_sk, p.claim_id,
  {value["claim_line_id"]} AS claim_line_id, {value["member_id"]} AS member_id,
  {value["provider_id"]} AS provider_id, CAST(NULL AS STRING) AS payer_id, p.payment_amount,
  p.payment_date, CAST(NULL AS STRING) AS payment_method, p.payment_status,
  CAST(NULL AS STRING) AS bank_reference_number, CAST(NULL AS STRING) AS check_number,
  CAST(NULL AS STRING) AS remittance_number, p.adjustment_amount, p.interest_amount,
  p.withhold_amount, 'INR' AS currency_code, CAST(NULL AS STRING) AS payment_run_id,
  p.updated_at, p.record_hash, strftime(p.payment_date, '%Y-%m') AS payment_year_month,
  CASE WHEN p.payment_status = 'PAID' THEN 1 ELSE 0 END AS paid_flag,
  CASE WHEN p.payment_status = 'PARTIAL' THEN 1 ELSE 0 END AS partial_flag,
  CASE WHEN p.payment_status = 'ON_HOLD' THEN 1 ELSE 0 END AS on_hold_flag,
  row_number() OVER (ORDER BY p.payment_id ASC NULLS LAST) AS payment_sk
FROM ({having(checked, 'valid')}) AS p
{single}
LEFT JOIN ({FACT_CLAIM}) AS c
  ON p.claim_id = c.claim_id AND c.claim_line_id = {on["claim_line_id"]}
LEFT JOIN ({DIM_MEMBER}) AS m ON m.member_id = {on["member_id"]}
LEFT JOIN ({DIM_PROVIDER}) AS r ON r.provider_id = {on["provider_id"]}"""


FACT_PAYMENT = _fact_payment(PAYMENTS_CHECKED, "absent")
FACT_LINKED_PAYMENT = _fact_payment(LINKED_PAYMENTS_CHECKED, "linked")
FACT_PAYMENT_BY_CLAIM = _fact_payment(PAYMENTS_CHECKED, "by_claim")

FACT_CLAIM_TEXT_KEYS = f"""SELECT * REPLACE (
    CASE WHEN member_id % 3 = 0 THEN NULL ELSE member_sk END AS member_sk,
    CASE WHEN member_id % 3 = 0 THEN 'abc' ELSE CAST(member_id AS STRING) END AS member_id,
    CAST(provider_id AS STRING) AS provider_id)
FROM ({FACT_CLAIM}) AS f"""

_TRACKED = (
    "specialty, network_flag, address_line1, city, state, provider_status, source_delete_flag"
)
_TRACKED_TEXT = ", ".join(f"COALESCE(CAST({c} AS STRING), 'NULL')" for c in _TRACKED.split(", "))


def _history(view: str) -> str:
    return f"""SELECT provider_id, provider_name, specialty,
  upper(trim(COALESCE(network_flag, 'N'))) AS network_flag, address AS address_line1, city, state,
  TRY_CAST(quality_score AS DOUBLE) AS quality_score,
  TRY_CAST(updated_at AS TIMESTAMP) AS updated_at, {_DELETE} AS source_delete_flag,
  bronze_batch_id, record_hash, CAST(TRY_CAST(updated_at AS TIMESTAMP) AS DATE)
    AS contract_start_date, CAST(NULL AS DATE) AS contract_end_date, 'ACTIVE' AS provider_status
FROM ({VIEWS[view].oracle_sql}) AS b
WHERE provider_id IS NOT NULL AND specialty IS NOT NULL
  AND TRY_CAST(updated_at AS TIMESTAMP) IS NOT NULL
  AND upper(trim(COALESCE(network_flag, 'N'))) IN ('Y', 'N')"""


def distinct_history(view: str) -> str:
    ranked = (
        "SELECT *, row_number() OVER (PARTITION BY provider_id, updated_at, "
        f"{_TRACKED} ORDER BY bronze_batch_id, record_hash) AS rn FROM ({_history(view)}) AS h"
    )
    return f"SELECT * EXCLUDE (rn) FROM ({ranked}) AS r WHERE rn = 1"


def change_rows(view: str) -> str:
    order = "PARTITION BY provider_id ORDER BY updated_at, bronze_batch_id, record_hash"
    hashed = (
        f"SELECT *, sha256(concat_ws('||', {_TRACKED_TEXT})) AS change_hash"
        f" FROM ({distinct_history(view)}) AS d"
    )
    lagged = f"SELECT *, lag(change_hash) OVER ({order}) AS previous FROM ({hashed}) AS g"
    return (
        f"SELECT * EXCLUDE (previous) FROM ({lagged}) AS p"
        " WHERE previous IS NULL OR previous <> change_hash"
    )


def versions(view: str) -> str:
    after = (
        "lead(updated_at) OVER (PARTITION BY provider_id"
        " ORDER BY updated_at, bronze_batch_id, record_hash)"
    )
    kept = f"SELECT *, {after} AS next_at FROM ({change_rows(view)}) AS k"
    return f"""SELECT row_number() OVER (
    ORDER BY provider_id, updated_at, bronze_batch_id, record_hash) AS provider_scd2_sk,
  provider_id, {_PROVIDER_COLUMNS}, source_delete_flag,
  CASE WHEN source_delete_flag = 'Y' THEN 'Y' ELSE 'N' END AS is_deleted,
  CAST(updated_at AS STRING) AS effective_from, CAST(next_at AS STRING) AS effective_to,
  CASE WHEN next_at IS NULL THEN 'Y' ELSE 'N' END AS is_current,
  CAST(updated_at AS STRING) AS updated_at
FROM ({kept}) AS s"""


def current(view: str) -> str:
    return (
        "SELECT provider_id, provider_name, provider_type, specialty, network_flag,"
        " provider_status, quality_score, city, state"
        f" FROM ({versions(view)}) AS v WHERE is_current = 'Y' AND is_deleted = 'N'"
    )


_DAYS = "datediff('day', service_date, received_date)"
_CLAIM_COUNT = "count(DISTINCT claim_id) AS total_claims"


def _lines(*kinds: str) -> str:
    return ", ".join(f"CAST(sum({k}_flag) AS BIGINT) AS {k}_claims" for k in kinds)


COST_BY_MONTH = f"""SELECT claim_year_month, payer_id, {_CLAIM_COUNT},
  {total("claim_amount")} AS total_claim_amount, {total("approved_amount")} AS total_approved_amount,
  {total("paid_amount")} AS total_paid_amount, {money_mean("claim_amount")} AS avg_claim_amount
FROM ({FACT_CLAIM}) AS f GROUP BY claim_year_month, payer_id"""

DENIALS = f"""SELECT d.provider_id, d.claim_year_month, d.denial_reason_code,
  d.denial_reason_claims, b.total_claims, b.denied_claims, r.* EXCLUDE (provider_id),
  {percent("b.denied_claims", "b.total_claims")} AS denial_rate_pct
FROM (SELECT claim_year_month, provider_id, COALESCE(procedure_code, 'UNKNOWN')
    AS denial_reason_code, count(DISTINCT claim_id) AS denial_reason_claims
  FROM ({FACT_CLAIM}) AS f WHERE claim_status = 'DENIED' GROUP BY 1, 2, 3) AS d
LEFT JOIN (SELECT claim_year_month, provider_id, {_CLAIM_COUNT}, {_lines("denied")}
  FROM ({FACT_CLAIM}) AS f GROUP BY 1, 2) AS b
  ON d.claim_year_month = b.claim_year_month AND d.provider_id = b.provider_id
LEFT JOIN ({current("providers")}) AS r ON d.provider_id = r.provider_id"""


def _payments_by(key: str) -> str:
    return (
        f"SELECT {key}, {total('payment_amount')} AS total_payment_amount,"
        f" count(DISTINCT payment_id) AS total_payments FROM ({FACT_LINKED_PAYMENT}) AS f GROUP BY 1"
    )


PROVIDER_PERFORMANCE = f"""SELECT c.*,
  COALESCE(y.total_payment_amount, 0.0) AS total_payment_amount,
  COALESCE(y.total_payments, 0) AS total_payments, r.* EXCLUDE (provider_id),
  {percent("c.approved_claims", "c.total_claims")} AS approval_rate_pct,
  {percent("c.denied_claims", "c.total_claims")} AS denial_rate_pct
FROM (SELECT provider_id, {_CLAIM_COUNT}, {_lines("approved", "denied", "pending")},
    CAST(0 AS BIGINT) AS emergency_claims, {total("claim_amount")} AS total_claim_amount,
    {total("approved_amount")} AS total_approved_amount, {mean(_DAYS)} AS avg_turnaround_days
  FROM ({FACT_CLAIM}) AS f GROUP BY provider_id) AS c
LEFT JOIN ({_payments_by("provider_id")}) AS y ON c.provider_id = y.provider_id
LEFT JOIN ({current("providers")}) AS r ON c.provider_id = r.provider_id"""

MEMBER_UTILIZATION = f"""SELECT c.*,
  COALESCE(y.total_payment_amount, 0.0) AS total_payment_amount,
  COALESCE(y.total_payments, 0) AS total_payments, m.member_sk, m.enterprise_member_id,
  m.first_name, m.last_name, m.gender, m.dob, m.city, m.state, m.member_status
FROM (SELECT member_id, payer_id, {_CLAIM_COUNT}, {_lines("approved", "denied")},
    CAST(0 AS BIGINT) AS emergency_claims, {total("claim_amount")} AS total_claim_amount,
    {total("approved_amount")} AS total_approved_amount, {mean(_DAYS)} AS avg_turnaround_days
  FROM ({FACT_CLAIM}) AS f GROUP BY member_id, payer_id) AS c
LEFT JOIN ({_payments_by("member_id")}) AS y ON c.member_id = y.member_id
LEFT JOIN ({DIM_MEMBER}) AS m ON c.member_id = m.member_id"""

TURNAROUND = f"""SELECT claim_year_month, claim_status, {_CLAIM_COUNT},
  {mean(_DAYS)} AS avg_turnaround_days, CAST(min({_DAYS}) AS INT) AS min_turnaround_days,
  CAST(max({_DAYS}) AS INT) AS max_turnaround_days
FROM ({FACT_CLAIM}) AS f GROUP BY claim_year_month, claim_status"""
