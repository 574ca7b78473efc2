"""Row rules, the reason a row was rejected, and counts of both."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.columns import percentage

REASON = "reject_reason"
OUTCOME = "row_outcome"
VALID, REJECT, DELETED = "valid", "reject", "deleted"


class Rule(NamedTuple):
    """A row passes when ``condition`` is true; false and unknown both fail."""

    condition: Column
    message: str


def present(name: str) -> Rule:
    return Rule(F.col(name).isNotNull(), f"{name} is null")


def not_negative(name: str) -> Rule:
    return Rule(F.col(name) >= 0, f"{name} is negative")


def parsed(name: str) -> Rule:
    """For columns where an unreadable value has already become null."""
    return Rule(F.col(name).isNotNull(), f"{name} is invalid")


def one_of(name: str, values: Sequence[str]) -> Rule:
    return Rule(F.col(name).isin(*values), f"{name} is invalid")


def reject_reason(rules: Iterable[Rule]) -> Column:
    """Messages of the failed rules in rule order, or the empty string."""
    failed = [
        F.when(~F.coalesce(rule.condition, F.lit(False)), F.lit(rule.message)) for rule in rules
    ]
    return F.concat_ws(" | ", *failed)


def passes(rules: Iterable[Rule]) -> Column:
    """True where every rule holds, which is where the reason is empty."""
    held = [F.coalesce(rule.condition, F.lit(False)) for rule in rules]
    return reduce(and_, held, F.lit(True))


def is_clean(reason: str = REASON) -> Column:
    return F.coalesce(F.col(reason), F.lit("")) == ""


def split_by_reason(df: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    return df.where(is_clean(reason)), df.where(~is_clean(reason))


@dataclass(frozen=True)
class Checked:
    """All current rows of a dataset, each with its reason and outcome.

    Reading ``valid`` and ``rejects`` off one annotated frame lets a writer
    store both with a single pass over the input.
    """

    rows: DataFrame

    def having(self, outcome: str) -> DataFrame:
        return self.rows.where(F.col(OUTCOME) == outcome).drop(OUTCOME)

    @property
    def valid(self) -> DataFrame:
        return self.having(VALID)

    @property
    def rejects(self) -> DataFrame:
        return self.having(REJECT)


def check(df: DataFrame, rules: Iterable[Rule], delete_flag: str = "source_delete_flag") -> Checked:
    """Annotate rows.  A deleted row that also fails a rule stays a reject."""
    rules = list(rules)
    deleted = F.col(delete_flag) == "Y"
    outcome = F.when(~passes(rules), REJECT).when(deleted, DELETED).otherwise(VALID)
    return Checked(df.withColumns({REASON: reject_reason(rules), OUTCOME: outcome}))


def reject_profile(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(REASON).agg(F.count("*").alias("count"))


def outcome_summary(checked: Mapping[str, Checked]) -> DataFrame:
    """Valid and reject counts with the reject rate, one row per dataset."""
    per_dataset = [
        item.rows.agg(
            F.count_if(F.col(OUTCOME) == VALID).alias("valid_rows"),
            F.count_if(F.col(OUTCOME) == REJECT).alias("reject_rows"),
        ).select(F.lit(name).alias("dataset"), "valid_rows", "reject_rows")
        for name, item in checked.items()
    ]
    counts = reduce(DataFrame.unionByName, per_dataset)
    rate = percentage(F.col("reject_rows"), F.col("valid_rows") + F.col("reject_rows"))
    return counts.withColumn("reject_rate_pct", rate)
