"""Type 2 provider dimension, built from all bronze versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.conform import conform, plain, project
from lakestrata.operators.history import build_versions, drop_repeats
from lakestrata.plans.domains import (
    CURRENT_PROVIDER_COLUMNS,
    PROVIDER_HISTORY_COLUMNS,
    PROVIDER_STATUSES,
    PROVIDER_TRACKED,
    PROVIDERS,
    YES_NO,
)

_LINEAGE = ("ingestion_timestamp", "bronze_batch_id", "record_hash")


def provider_history(bronze: DataFrame) -> DataFrame:
    """Every usable provider row, typed and shaped but not reduced to the latest.

    Rows without id, specialty or start date, or with unknown codes, are left
    out silently: history has no reject table.
    """
    typed = conform(bronze, PROVIDERS.fields)
    usable = typed.where(
        F.col("provider_id").isNotNull()
        & F.col("specialty").isNotNull()
        & F.col("contract_start_date").isNotNull()
        & F.col("provider_status").isin(*PROVIDER_STATUSES)
        & F.col("network_flag").isin(*YES_NO)
    )
    lineage = [plain(name) for name in _ties(usable)]
    return project(usable, [*PROVIDER_HISTORY_COLUMNS, *lineage])


def _ties(history: DataFrame) -> list[str]:
    """Lineage columns that settle the order of rows with equal update times."""
    return [name for name in _LINEAGE if name in history.columns]


def distinct_history(history: DataFrame, tracked: Sequence[str] = PROVIDER_TRACKED) -> DataFrame:
    """History without rows that repeat the tracked attributes at the same time."""
    return drop_repeats(history, ["provider_id", "updated_at", *tracked], _ties(history))


def provider_versions(
    bronze: DataFrame, *, tracked: Sequence[str] = PROVIDER_TRACKED, ranges: int | None = None
) -> DataFrame:
    """One row per run of equal tracked attributes, with its validity interval.

    A -> B -> A gives three versions; A -> A gives one.  ``ranges`` is passed on
    to ``build_versions``.
    """
    history = provider_history(bronze)
    versions = build_versions(
        history,
        key="provider_id",
        at="updated_at",
        tracked=tracked,
        ties=_ties(history),
        version_key="provider_scd2_sk",
        ranges=ranges,
    )
    names = [field.name for field in PROVIDER_HISTORY_COLUMNS if field.name != "updated_at"]
    return versions.select(
        "provider_scd2_sk",
        *names,
        F.when(F.col("source_delete_flag") == "Y", "Y").otherwise("N").alias("is_deleted"),
        "effective_from",
        "effective_to",
        F.when(F.col("effective_to").isNull(), "Y").otherwise("N").alias("is_current"),
        "updated_at",
        F.current_timestamp().alias("dw_created_at"),
    )


def current_providers(versions: DataFrame) -> DataFrame:
    """Open versions of providers that are not deleted."""
    open_rows = versions.where((F.col("is_current") == "Y") & (F.col("is_deleted") == "N"))
    return open_rows.select(*CURRENT_PROVIDER_COLUMNS)
