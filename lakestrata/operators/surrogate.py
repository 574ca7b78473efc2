"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.ranges import PLACE, RANGE, TASK_BITS, in_order, range_starts


def add_surrogate_key(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    *,
    ties: Sequence[str] = (),
    unique: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Number rows 1..N in the order of ``keys`` (nulls last), then ``ties``.

    Rows are written once in that order; a key is the place inside the range
    plus the rows of all ranges before it.  At every size the full rows shuffle
    once and no task sees more than its range.  ``unique`` says that no two
    rows agree on ``keys`` and ``ties``; rows that do agree are numbered in the
    order they came in.  The ordering runs when called; the result only reads it.
    """
    rows = in_order(df, [*keys, *ties], unique=unique, ranges=ranges)
    first = F.shiftleft(F.col(RANGE), TASK_BITS)
    number = F.col(PLACE) - first + F.col("_start") + 1
    kept = [F.col(f"`{column}`") for column in df.columns]
    return rows.join(range_starts(rows), RANGE).select(*kept, number.alias(name))
