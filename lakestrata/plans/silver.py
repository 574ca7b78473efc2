"""Silver: current, typed and checked rows of each domain."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakestrata.operators.conform import conform
from lakestrata.operators.latest import keep_latest
from lakestrata.operators.quality import Checked, check
from lakestrata.plans.domains import CLAIMS, MEMBERS, PAYMENTS, PROVIDERS, Domain


def refine(bronze: DataFrame, domain: Domain, *, keep_null_keys: bool = False) -> Checked:
    """Latest row first, then types, rules and deletes, in that order.

    Rules must not run earlier: a bad latest version replaces a good older one.
    """
    latest = keep_latest(bronze, domain.keys, keep_null_keys=keep_null_keys)
    return check(conform(latest, domain.fields), domain.rules())


def refine_claims(bronze: DataFrame, **options) -> Checked:
    return refine(bronze, CLAIMS, **options)


def refine_members(bronze: DataFrame, **options) -> Checked:
    return refine(bronze, MEMBERS, **options)


def refine_providers(bronze: DataFrame, **options) -> Checked:
    return refine(bronze, PROVIDERS, **options)


def refine_payments(bronze: DataFrame, **options) -> Checked:
    return refine(bronze, PAYMENTS, **options)
