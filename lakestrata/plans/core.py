"""Core model: current dimensions and the two facts.

A fact's rows are written once with a row number.  Surrogate keys and lookups
work on the ids alone; the other columns shuffle once, to fetch what was found.
Business keys are unique in silver, so the order needs no tie-breakers.
``ranges`` is passed on to ``add_surrogate_key``.  The ``*_measures`` are the
facts without keys: what marts read, without ordering, lookups or writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.columns import indicator, name_part, year_month
from lakestrata.operators.conform import Field, plain, project
from lakestrata.operators.lookup import lookup
from lakestrata.operators.ranges import ROW, packed, unpacked, with_row_numbers
from lakestrata.operators.surrogate import add_surrogate_key
from lakestrata.plans.domains import (
    CLAIM_FACT_COLUMNS,
    CLAIM_STATUSES,
    MEMBER_COLUMNS,
    PAYMENT_FACT_COLUMNS,
    PAYMENT_STATUSES,
    PROVIDER_COLUMNS,
)


def split_names(members: DataFrame) -> DataFrame:
    """First and second word of ``full_name``; null names when it is not sent."""
    full = F.col("full_name") if "full_name" in members.columns else F.lit(None).cast("string")
    return members.withColumns({"first_name": name_part(full, 0), "last_name": name_part(full, 1)})


def member_dimension(members: DataFrame, *, ranges: int | None = None) -> DataFrame:
    rows = project(split_names(members), MEMBER_COLUMNS)
    return add_surrogate_key(rows, ["member_id"], "member_sk", unique=True, ranges=ranges)


def provider_dimension(providers: DataFrame, *, ranges: int | None = None) -> DataFrame:
    rows = project(providers, PROVIDER_COLUMNS)
    return add_surrogate_key(rows, ["provider_id"], "provider_current_sk", unique=True, ranges=ranges)


def claim_measures(claims: DataFrame, *, carry_emergency: bool = False) -> DataFrame:
    """The columns of the claim fact that need no key: ids, amounts, dates, month and flags."""
    rows = project(claims, _claim_fields(carry_emergency))
    return rows.withColumns(_claim_derived(carry_emergency)).drop("is_emergency")


def payment_measures(payments: DataFrame) -> DataFrame:
    """The columns of the payment fact that need no key."""
    return project(payments, PAYMENT_FACT_COLUMNS).withColumns(_payment_derived())


def claim_fact(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    *,
    carry_emergency: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """One row per silver claim line with its dimension keys.

    ``carry_emergency`` adds ``emergency_flag`` from the claims' ``is_emergency``,
    which the marts then count; by default the fact does not hold it.
    """
    line = ["claim_id", "claim_line_id"]
    rows, ids = _numbered(project(claims, _claim_fields(carry_emergency)), [*line, "member_id", "provider_id"])
    placed = add_surrogate_key(ids, line, "claim_sk", unique=True, ranges=ranges)
    placed = lookup(placed, members, ["member_id"], ["member_sk"], spread_by=line)
    placed = lookup(placed, providers, ["provider_id"], ["provider_current_sk"], spread_by=line)
    placed = _with_rest(placed, rows)

    names = [field.name for field in CLAIM_FACT_COLUMNS]
    order = [*line, "member_sk", "provider_current_sk", *names[2:]]
    return _finish(placed, order, _claim_derived(carry_emergency), "claim_sk")


def payment_fact(
    payments: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    claims: DataFrame,
    *,
    resolve_by_claim: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """One row per silver payment with the keys of its claim line, member and provider.

    A payment that names no line, member or provider keeps null keys.  With
    ``resolve_by_claim`` a payment without a line takes the line of its claim,
    and the member and provider it lacks, where the claim has exactly one line.
    """
    by = ["payment_id"]
    line = ["claim_id", "claim_line_id"]
    rows = project(payments, PAYMENT_FACT_COLUMNS)
    if resolve_by_claim:
        rows = _resolved(rows, claims)
    rows, ids = _numbered(rows, [*by, *line, "member_id", "provider_id"])
    placed = add_surrogate_key(ids, by, "payment_sk", unique=True, ranges=ranges)
    placed = lookup(placed, claims, line, ["claim_sk"], spread_by=by)
    placed = lookup(placed, members, ["member_id"], ["member_sk"], spread_by=by)
    placed = lookup(placed, providers, ["provider_id"], ["provider_current_sk"], spread_by=by)
    placed = _with_rest(placed, rows)

    names = [field.name for field in PAYMENT_FACT_COLUMNS]
    order = [*by, "claim_sk", "member_sk", "provider_current_sk", *names[1:]]
    return _finish(placed, order, _payment_derived(), "payment_sk")


def _numbered(rows: DataFrame, ids: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows, written with a row number, and their ids with that number."""
    stored = with_row_numbers(packed(rows, "record_hash"), "fact")
    return stored.drop(*ids), stored.select(ROW, *ids)


def _with_rest(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """The ids with what was found for them, and the other columns of their rows."""
    return unpacked(placed.join(rows, ROW), "record_hash").drop(ROW)


def _resolved(payments: DataFrame, claims: DataFrame) -> DataFrame:
    """Payments without a line, filled from claims of a single line; the others as they are."""
    ids = ["claim_line_id", "member_id", "provider_id"]
    single = (
        claims.where(F.col("claim_id").isNotNull())
        .groupBy("claim_id")
        .agg(F.count(F.lit(1)).alias("_lines"), *[F.min(name).alias(name) for name in ids])
        .where(F.col("_lines") == 1)
    )
    found = lookup(payments, single, ["claim_id"], {name: f"_by_{name}" for name in ids}, spread_by=["payment_id"])
    lineless = F.col("claim_line_id").isNull()
    filled = {
        # A missing id column is text; the claims' own type takes its place.
        name: F.when(lineless, F.coalesce(F.col(name).try_cast(kind), F.col(f"_by_{name}")))
        .otherwise(F.col(name).try_cast(kind))
        for name, kind in ((name, single.schema[name].dataType) for name in ids)
    }
    return found.select(*[filled.get(name, F.col(name)).alias(name) for name in payments.columns])


def _claim_fields(carry_emergency: bool) -> list[Field]:
    return [*CLAIM_FACT_COLUMNS, *([plain("is_emergency")] if carry_emergency else [])]


def _claim_derived(carry_emergency: bool) -> dict[str, Column]:
    derived = {"claim_year_month": year_month(F.col("service_date"))}
    derived |= _status_flags("claim_status", CLAIM_STATUSES)
    if carry_emergency:
        derived["emergency_flag"] = indicator(F.col("is_emergency") == "Y")
    return derived


def _payment_derived() -> dict[str, Column]:
    derived = {"payment_year_month": year_month(F.col("payment_date"))}
    return derived | _status_flags("payment_status", PAYMENT_STATUSES)


def _status_flags(column: str, statuses: Sequence[str]) -> dict[str, Column]:
    return {f"{value.lower()}_flag": indicator(F.col(column) == value) for value in statuses}


def _finish(rows: DataFrame, order: Sequence[str], derived: dict[str, Column], key: str) -> DataFrame:
    extra = [value.alias(name) for name, value in derived.items()]
    return rows.select(*order, *extra, F.current_timestamp().alias("dw_created_at"), key)
