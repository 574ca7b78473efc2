"""Type 2 history: one row per change of an entity's tracked attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions.columns import row_digest
from lakestrata.operators.ranges import PLACE, RANGE, ROW, ascending, in_order, inside, with_row_numbers

HASH = "change_hash"


def drop_repeats(df: DataFrame, same: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """One row per combination of ``same``: the first in the order of ``ties``.

    Like dropDuplicates but always the same survivor.  The top-1 limit also
    runs before the shuffle, so a group of many copies stays small.
    """
    first = Window.partitionBy(*same).orderBy(*ascending(ties))
    return df.withColumn("_copy", F.row_number().over(first)).where("_copy = 1").drop("_copy")


def build_versions(
    df: DataFrame,
    *,
    key: str,
    at: str,
    tracked: Sequence[str],
    ties: Sequence[str],
    version_key: str,
    ranges: int | None = None,
) -> DataFrame:
    """Versions of every entity with validity interval and a dense version key.

    A version starts where the digest of ``tracked`` differs from the entity's
    previous row.  Adds ``change_hash``, ``effective_from`` (= ``at``),
    ``effective_to`` (``at`` of the next version, null while open) and
    ``version_key`` (1..N by key, time, ties).

    The full rows are written once with a row number.  Which of them are
    versions is settled on the ordering and tracked columns alone, and the
    full rows shuffle once, when the versions fetch them by that number.
    An entity may own any share of the history, so nothing is windowed per
    entity: the narrow rows are put in order over (key, time, ties) and the few
    facts that cross a border between ranges are carried in a table with one
    row per range.  The writing runs when called.
    """
    rows = with_row_numbers(df, "history")
    needed = dict.fromkeys([key, at, *tracked, *ties, ROW])
    single = drop_repeats(rows.select(*needed), [key, at, *tracked], [*ties, ROW])
    narrow = single.select(*dict.fromkeys([key, at, *ties, ROW]), row_digest(tracked).alias(HASH))
    placed = in_order(narrow, [key, at, *ties, ROW], unique=True, ranges=ranges)
    compared = _compare_neighbours(placed, key)

    # One row per range; Spark decides how to join it.
    kept = compared.join(_borders(compared, key, at), RANGE).where(
        F.when(F.col("_opens"), F.col("_first_changed")).otherwise(F.col("_changed"))
    )
    pair = F.struct(F.col(key).alias("key"), F.col(at).alias("at"))
    following = F.col("_following").cast(_pair_type(df, key, at))
    versions = kept.select(
        ROW,
        HASH,
        F.col(key).alias("_key"),
        F.coalesce(F.lead(pair).over(inside()), following).alias("_next"),
        (F.row_number().over(inside()).cast("bigint") + F.col("_offset")).alias(version_key),
    ).select(
        ROW,
        HASH,
        version_key,
        F.when(F.col("_next.key") == F.col("_key"), F.col("_next.at")).alias("effective_to"),
    )
    return rows.join(versions, ROW).drop(ROW).withColumn("effective_from", F.col(at))


def _pair_type(df: DataFrame, key: str, at: str) -> str:
    kinds = dict(df.dtypes)
    return f"struct<key:{kinds[key]},at:{kinds[at]}>"


def _compare_neighbours(placed: DataFrame, key: str) -> DataFrame:
    """Mark rows that open their range and rows that differ from the row before."""
    here = F.struct(F.col(key).alias("key"), F.col(HASH).alias("hash"))
    before = F.lag(here).over(inside())
    return (
        placed.withColumn("_before", before)
        .withColumn("_opens", F.col("_before").isNull())
        .withColumn("_changed", _differs(F.col("_before"), F.col(key), F.col(HASH)))
        .drop("_before")
    )


def _differs(before: Column, key: Column, digest: Column) -> Column:
    same = (before["key"] == key) & (before["hash"] == digest)
    return ~F.coalesce(same, F.lit(False))


def _borders(compared: DataFrame, key: str, at: str) -> DataFrame:
    """What each range needs to know about the ranges around it.

    A range's opening row is compared with the last row before the range; the
    successor of its last version is the next version in any later range; its
    version numbers start after all versions of earlier ranges.
    """
    pair = F.struct(F.col(key).alias("key"), F.col(at).alias("at"))
    row = F.struct(F.col(key).alias("key"), F.col(at).alias("at"), F.col(HASH).alias("hash"))
    later_change = F.col("_changed") & ~F.col("_opens")
    per_range = compared.groupBy(RANGE).agg(
        F.min_by(row, PLACE).alias("first"),
        F.max_by(row, PLACE).alias("last"),
        F.min_by(pair, F.when(later_change, F.col(PLACE))).alias("inner"),
        F.count_if(later_change).alias("inner_count"),
    )
    by_range = Window.orderBy(RANGE)
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    later = by_range.rowsBetween(1, Window.unboundedFollowing)
    changed = _differs(F.lag("last").over(by_range), F.col("first.key"), F.col("first.hash"))
    opening = F.struct(F.col("first.key").alias("key"), F.col("first.at").alias("at"))
    return (
        per_range.withColumn("_first_changed", changed)
        .withColumn("_version", F.when(F.col("_first_changed"), opening).otherwise(F.col("inner")))
        .withColumn("_versions", F.col("inner_count") + F.col("_first_changed").cast("int"))
        .select(
            RANGE,
            "_first_changed",
            F.first("_version", ignorenulls=True).over(later).alias("_following"),
            F.coalesce(F.sum("_versions").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
