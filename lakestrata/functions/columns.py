"""Small column expressions shared by every layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "NULL"
HASH_SEPARATOR = "||"


def row_digest(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over columns as text, in the order given.

    Nulls enter as the word NULL, so a null and that word digest alike.
    """
    values = [F.col(f"`{item}`") if isinstance(item, str) else item for item in columns]
    as_text = [F.coalesce(value.cast("string"), F.lit(NULL_TEXT)) for value in values]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *as_text), 256)


def code(value: Column) -> Column:
    """Codes compare without case or outer blanks."""
    return F.upper(F.trim(value.cast("string")))


def name_part(full_name: Column, position: int) -> Column:
    """Word at ``position`` of a blank-separated name, null when it has fewer words."""
    return F.get(F.split(F.trim(full_name), " "), position)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def percentage(part: Column, whole: Column) -> Column:
    """Two-decimal share of ``whole``; 0.0 where there is nothing to divide by."""
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(0.0)


def rounded(value: Column) -> Column:
    return F.round(value, 2)


# Fixed value: amounts are added as decimals of this type, so no order of adding changes a total.
EXACT = "decimal(24, 6)"


def money_total(amount: Column) -> Column:
    """Exact total of an amount, to two decimals, as double.

    Amounts that the decimal cannot hold (not a number, infinite, 18 digits and
    more before the point) make it a plain sum of doubles.
    """
    return rounded(_settled(amount))


def money_mean(amount: Column) -> Column:
    """Average of an amount to two decimals, from its exact total."""
    return rounded(F.try_divide(_settled(amount), F.count(amount)))


def _settled(amount: Column) -> Column:
    exact = amount.try_cast(EXACT)
    total = F.try_sum(exact).cast("double")
    return F.when(F.count(exact) == F.count(amount), total).otherwise(F.sum(amount))
