"""Put a dataset into one total order that lives in files.

Some results depend on the total order of all rows: a dense key 1..N, or the
previous and next version of an entity that may own a large part of the data.
A window over that order would run in one task.  Here Spark's range partitioner
deals the rows to ordered ranges, each task sorts its own, and the rows are
written with their places.  Everything later reads those places, so passes,
retried tasks and lost executors all agree on them.

The partitioner cuts at a sample of bounded size (its own setting,
``spark.sql.execution.rangeExchange.sampleSizePerPartition`` rows per range).
The sample and a report of every range's task go to the driver, so the number
of ranges is bounded; beyond it ranges get longer and their tasks sort on disk.
The order ends in a column that differs from row to row, so a value on any
share of the rows is parted like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.sources.scratch import written

RANGE = "_range"
PLACE = "_place"
ROW = "_row"

# Fixed value: a generated row number holds its task above this many bits.
TASK_BITS = 33

# What the driver receives grows with the number of ranges, not with the rows.
MOST_RANGES = 1000


def ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in columns]


def with_row_numbers(df: DataFrame, what: str) -> DataFrame:
    """The rows, written with ``_row``, a number that tells even equal rows apart."""
    return written(df.withColumn(ROW, F.monotonically_increasing_id()), what)


def packed(df: DataFrame, digest: str) -> DataFrame:
    """A column of hexadecimal digests as bytes, half as long to move; ``unpacked`` gives it back.

    Text that is no lower-case hexadecimal stays text, so every value comes back as it was.
    """
    value = F.col(f"`{digest}`")
    raw = F.when(value.rlike("^([0-9a-f]{2})+$") & ~value.endswith("\n"), F.unhex(value))
    return df.withColumns({f"_{digest}_bytes": raw, digest: F.when(raw.isNull(), value)})


def unpacked(df: DataFrame, digest: str) -> DataFrame:
    text = F.coalesce(F.lower(F.hex(f"_{digest}_bytes")), F.col(f"`{digest}`"))
    return df.withColumn(digest, text).drop(f"_{digest}_bytes")


def in_order(
    df: DataFrame, order: Sequence[str], *, unique: bool = False, ranges: int | None = None
) -> DataFrame:
    """The rows, written in the order of ``order`` (nulls last), with ``_range`` and ``_place``.

    Ranges and the places inside them ascend with the order.  ``unique`` says
    that no two rows agree on all of ``order``; otherwise rows are numbered and
    written first, and the number is the last tie.  ``ranges`` fixes their
    number, up to ``MOST_RANGES``; by default it is the session's number of
    shuffle partitions, of which adaptive execution joins small neighbours.
    Runs when called.
    """
    if not unique:
        df = with_row_numbers(df, "numbered")
        order = [*order, ROW]
    by = ascending(order)
    dealt = df.repartitionByRange(min(ranges, MOST_RANGES), *by) if ranges else df.repartitionByRange(*by)
    placed = dealt.sortWithinPartitions(*by).withColumn(PLACE, F.monotonically_increasing_id())
    rows = written(placed, "ordered").withColumn(RANGE, F.shiftright(PLACE, TASK_BITS))
    return rows if unique else rows.drop(ROW)


def inside(window_of: str = PLACE):
    """Window over the rows of one range in their order."""
    return Window.partitionBy(RANGE).orderBy(window_of)


def range_starts(rows: DataFrame) -> DataFrame:
    """``_range`` and ``_start``, the number of rows before the range.

    One number per range passes through the driver, which keeps a list of the
    ranges' tasks anyway.
    """
    held = sorted(rows.groupBy(RANGE).count().collect())
    starts = accumulate((count for _, count in held), initial=0)
    table = [(number, start) for (number, _), start in zip(held, starts)]
    return rows.sparkSession.createDataFrame(table, f"{RANGE} bigint, _start bigint")
