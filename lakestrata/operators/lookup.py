"""Find dimension keys for fact rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Null keys match nothing, but a plain join would still hash them all to one
# task.  They are spread over this many join slots instead.
NULL_KEY_SLOTS = 4096


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    take: Mapping[str, str] | Sequence[str],
    *,
    spread_by: Sequence[str],
) -> DataFrame:
    """Left join that adds ``take`` columns; facts without a match keep nulls.

    ``dimension`` has at most one row per key.  A text key against a number or
    date is read as that type; text that cannot be read finds nothing.  Whether it is broadcast is
    left to Spark, which knows its size at run time; when it is not, adaptive
    execution splits a key that owns a large share of the facts, and null keys
    are spread by ``spread_by`` (columns that tell fact rows apart).
    """
    take = take if isinstance(take, Mapping) else {name: name for name in take}
    ours, theirs = ({f.name: f.dataType for f in df.schema.fields} for df in (facts, dimension))
    near, far = [], []
    for name in on:
        # Both sides of a comparison get one type, chosen here and not by a cast that may fail.
        text = [isinstance(kinds[name], T.StringType) for kinds in (ours, theirs)]
        near.append(F.col(name).try_cast(theirs[name]) if text == [True, False] else F.col(name))
        far.append(F.col(name).try_cast(ours[name]) if text == [False, True] else F.col(name))

    right = dimension.select(
        *[value.alias(f"_k{i}") for i, value in enumerate(far)],
        *[F.col(source).alias(f"_t_{target}") for source, target in take.items()],
    )
    # Always 0, computed from the key so that it remains part of the join key.
    right = right.withColumn("_slot0", F.pmod(F.xxhash64("_k0"), F.lit(1)).cast("int"))

    keyless = reduce(or_, [value.isNull() for value in near])
    scatter = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_KEY_SLOTS)).cast("int") + 1
    left = facts.withColumns({f"_f{i}": value for i, value in enumerate(near)})
    left = left.withColumn("_slot", F.when(keyless, scatter).otherwise(0))

    match = [F.col(f"_f{i}") == F.col(f"_k{i}") for i in range(len(on))]
    joined = left.join(right, [*match, F.col("_slot") == F.col("_slot0")], "left")
    return joined.select(
        *[F.col(f"`{name}`") for name in facts.columns],
        *[F.col(f"_t_{target}").alias(target) for target in take.values()],
    )
