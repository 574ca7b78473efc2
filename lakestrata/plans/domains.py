"""The four domains as data: fields, rules and output columns.

The values in this file are fixed: names, defaults, orders and word lists that
stored tables and their readers rely on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from lakestrata.operators.conform import Field, day, flag, moment, number, plain, status
from lakestrata.operators.quality import Rule, not_negative, one_of, parsed, present

# Accepted codes.
CLAIM_STATUSES = ("APPROVED", "DENIED", "PENDING")
MEMBER_STATUSES = ("ACTIVE", "INACTIVE", "SUSPENDED")
PROVIDER_STATUSES = ("ACTIVE", "INACTIVE")
PAYMENT_STATUSES = ("PAID", "PARTIAL", "ON_HOLD")
YES_NO = ("Y", "N")

# Defaults for columns a source does not send.
UNKNOWN_PAYER = "PAYER_UNKNOWN"
UNKNOWN_PLAN = "PLAN_UNKNOWN"
DEFAULT_SPECIALTY = "GENERAL"
DEFAULT_STATUS = "ACTIVE"
DEFAULT_COUNTRY = "INDIA"
DEFAULT_PROVIDER_TYPE = "HOSPITAL"
DEFAULT_CURRENCY = "INR"
UNKNOWN_REASON = "UNKNOWN"

CLOCKS = (moment("updated_at"), moment("ingestion_timestamp"))


@dataclass(frozen=True)
class Domain:
    """What silver needs to know about one dataset."""

    name: str
    keys: Sequence[str]
    fields: Sequence[Field]
    rules: Callable[[], list[Rule]]


CLAIMS = Domain(
    name="claims",
    keys=("claim_id", "claim_line_id"),
    fields=(
        number("claim_amount"),
        number("approved_amount"),
        number("paid_amount"),
        number("copay_amount"),
        number("coinsurance_amount"),
        number("deductible_amount"),
        day("service_date"),
        day("received_date"),
        day("service_from_date"),
        day("service_to_date"),
        day("processed_date"),
        day("admit_date"),
        day("discharge_date"),
        *CLOCKS,
        status("claim_status"),
        flag("source_delete_flag"),
        flag("network_flag"),
        flag("is_emergency"),
        Field("claim_version", "int", absent=1),
    ),
    rules=lambda: [
        present("claim_id"),
        present("claim_line_id"),
        present("member_id"),
        present("provider_id"),
        present("claim_amount"),
        not_negative("claim_amount"),
        parsed("service_date"),
        one_of("claim_status", CLAIM_STATUSES),
    ],
)

MEMBERS = Domain(
    name="members",
    keys=("member_id",),
    fields=(
        day("dob"),
        day("effective_date", fallbacks=("updated_at",)),
        day("termination_date"),
        number("risk_score"),
        *CLOCKS,
        flag("source_delete_flag"),
        status("member_status", DEFAULT_STATUS),
        Field("payer_id", absent=UNKNOWN_PAYER),
        Field("plan_id", absent=UNKNOWN_PLAN),
    ),
    rules=lambda: [present("member_id")],
)

PROVIDERS = Domain(
    name="providers",
    keys=("provider_id",),
    fields=(
        day("contract_start_date", fallbacks=("updated_at",)),
        day("contract_end_date"),
        number("quality_score"),
        *CLOCKS,
        flag("network_flag"),
        flag("source_delete_flag"),
        status("provider_status", DEFAULT_STATUS),
        Field("specialty", absent=DEFAULT_SPECIALTY),
    ),
    rules=lambda: [present("provider_id")],
)

PAYMENTS = Domain(
    name="payments",
    keys=("payment_id",),
    fields=(
        number("adjustment_amount"),
        number("interest_amount"),
        number("withhold_amount"),
        day("payment_date"),
        *CLOCKS,
        flag("source_delete_flag"),
        number("payment_amount", fallbacks=("paid_amount",)),
        status("payment_status"),
    ),
    rules=lambda: [
        present("payment_id"),
        present("claim_id"),
        present("payment_amount"),
        not_negative("payment_amount"),
    ],
)

DOMAINS = {domain.name: domain for domain in (CLAIMS, MEMBERS, PROVIDERS, PAYMENTS)}


def optional(name: str, default: object = None, *, like: str | None = None) -> Field:
    """Pass through when present, otherwise another column or a default."""
    return Field(name, dtype=None, fallbacks=(like,) if like else (), absent=default)


# Column order of the dimensions and facts.  A fact's looked-up
# keys follow its first columns; its derived columns and own key come last.
MEMBER_COLUMNS = (
    plain("member_id"),
    optional("enterprise_member_id", like="member_id"),
    plain("first_name"),
    plain("last_name"),
    plain("gender"),
    plain("dob"),
    optional("phone"),
    optional("email"),
    optional("address_line1"),
    plain("city"),
    plain("state"),
    optional("zip_code"),
    optional("country", DEFAULT_COUNTRY),
    plain("plan_id"),
    optional("plan_name"),
    plain("payer_id"),
    plain("member_status"),
    plain("effective_date"),
    plain("termination_date"),
    optional("primary_provider_id"),
    plain("risk_score"),
    plain("updated_at"),
)

_PROVIDER_IDENTITY = (
    plain("provider_id"),
    optional("enterprise_provider_id", like="provider_id"),
    optional("npi"),
    plain("provider_name"),
    optional("provider_type", DEFAULT_PROVIDER_TYPE),
    plain("specialty"),
    optional("taxonomy_code"),
    plain("network_flag"),
    optional("hospital_affiliation"),
    optional("address_line1", like="address"),
    plain("city"),
    plain("state"),
    optional("zip_code"),
    optional("country", DEFAULT_COUNTRY),
    optional("phone"),
    optional("email"),
    plain("contract_start_date"),
    plain("contract_end_date"),
    plain("provider_status"),
    plain("quality_score"),
)

PROVIDER_COLUMNS = (*_PROVIDER_IDENTITY, plain("updated_at"))

PROVIDER_HISTORY_COLUMNS = (*_PROVIDER_IDENTITY, plain("source_delete_flag"), plain("updated_at"))

PROVIDER_TRACKED = (
    "specialty",
    "network_flag",
    "address_line1",
    "city",
    "state",
    "provider_status",
    "source_delete_flag",
)

CURRENT_PROVIDER_COLUMNS = (
    "provider_id",
    "provider_name",
    "provider_type",
    "specialty",
    "network_flag",
    "provider_status",
    "quality_score",
    "city",
    "state",
)

CLAIM_FACT_COLUMNS = (
    plain("claim_id"),
    plain("claim_line_id"),
    plain("member_id"),
    plain("provider_id"),
    plain("payer_id"),
    plain("diagnosis_code"),
    plain("procedure_code"),
    plain("claim_amount"),
    plain("approved_amount"),
    number("paid_amount"),
    plain("claim_status"),
    day("service_date"),
    day("received_date"),
    Field("claim_version", "int", absent=1),
    plain("updated_at"),
    plain("record_hash"),
)

PAYMENT_FACT_COLUMNS = (
    plain("payment_id"),
    plain("claim_id"),
    optional("claim_line_id"),
    optional("member_id"),
    optional("provider_id"),
    optional("payer_id"),
    number("payment_amount", fallbacks=("paid_amount",)),
    plain("payment_date"),
    optional("payment_method"),
    plain("payment_status"),
    optional("bank_reference_number"),
    optional("check_number"),
    optional("remittance_number"),
    plain("adjustment_amount"),
    plain("interest_amount"),
    plain("withhold_amount"),
    optional("currency_code", DEFAULT_CURRENCY),
    optional("payment_run_id"),
    plain("updated_at"),
    plain("record_hash"),
)

MEMBER_MART_COLUMNS = (
    "member_sk",
    "enterprise_member_id",
    "first_name",
    "last_name",
    "gender",
    "dob",
    "city",
    "state",
    "member_status",
)
