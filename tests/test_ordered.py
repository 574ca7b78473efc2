"""Surrogate keys and histories against the plain global window."""

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakestrata.functions.columns import row_digest
from lakestrata.operators.history import build_versions
from lakestrata.operators.ranges import PLACE, RANGE, in_order, range_starts
from lakestrata.operators.surrogate import add_surrogate_key
from tests.conftest import plan_of


def _numbered(df, order):
    return df.withColumn("n", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])))


def _mixed(spark, rows=4000):
    """Texts, times, nulls, repeated leading values, and one name on a third of the rows."""
    i = F.col("id")
    return spark.range(0, rows, 1, 5).select(
        "id",
        F.when(i % 17 == 0, None).when(i % 3 == 0, "hot'\"\\é").otherwise(F.concat(F.lit("n"), i % 97)).alias("name"),
        F.when(i % 11 == 0, None)
        .otherwise(F.timestamp_micros(F.lit(1_700_000_000_000_000) + (i * 7919) % 5003))
        .alias("at"),
        (i % 13).cast("double").alias("score"),
    )


@pytest.mark.parametrize("order", [["id"], ["name", "id"], ["at", "name", "id"], ["score", "at", "id"]])
@pytest.mark.parametrize("ranges", [27, 3, None])
def test_keys_equal_the_global_row_number(spark, order, ranges):
    df = _mixed(spark)
    keyed = add_surrogate_key(df, order[:1], "sk", ties=order[1:], ranges=ranges)
    joined = keyed.join(_numbered(df, order).select("id", "n"), "id")
    assert joined.where("sk = n").count() == 4000
    assert dict(keyed.dtypes)["sk"] == "bigint"


def test_keys_do_not_depend_on_the_input_layout(spark):
    df = _mixed(spark)
    one = add_surrogate_key(df, ["name"], "sk", ties=["id"], ranges=13)
    two = add_surrogate_key(df.repartition(13), ["name"], "sk", ties=["id"], unique=True, ranges=4)
    assert one.select("id", "sk").exceptAll(two.select("id", "sk")).count() == 0


def test_repeated_keys_still_number_densely(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"))
    keyed = add_surrogate_key(df, ["k"], "sk", ranges=20)
    assert [row[0] for row in keyed.orderBy("sk").select("sk").collect()] == list(range(1, 1001))
    assert keyed.where("sk <= 500").agg(F.max("k")).first()[0] == 0


@pytest.mark.parametrize("rows", [0, 1])
def test_tiny_inputs(spark, rows):
    df = spark.range(rows)
    assert add_surrogate_key(df, ["id"], "sk").count() == rows
    forced = add_surrogate_key(df, ["id"], "sk", unique=True, ranges=10)
    assert [row.sk for row in forced.collect()] == [1] * rows


def _hot(spark, rows=20000):
    """One key on half of the rows, and a row that is there a thousand times."""
    once = spark.range(rows, numPartitions=6).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    return once.union(spark.range(1000).select(F.lit(7).cast("long").alias("k"), F.lit(7).cast("long").alias("v")))


@pytest.mark.parametrize("order", [["k"], ["k", "v"]])
def test_repeated_keys_are_parted_and_ranges_balanced(spark, order):
    rows = in_order(_hot(spark), order, ranges=16)
    sizes = [n for _, n in rows.groupBy(RANGE).count().collect()]
    assert len(sizes) >= 15
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_the_sample_of_the_cuts_is_bounded(spark):
    """Spark's partitioner samples a set number of rows per range, whatever the table holds."""
    per_range = int(spark.conf.get("spark.sql.execution.rangeExchange.sampleSizePerPartition"))
    assert 0 < per_range <= 1000


def test_the_number_of_ranges_is_bounded(spark):
    """Each range sends its sample and its task's report to the driver, so a large table gets no more of them."""
    df = spark.range(6000, numPartitions=4).select((F.col("id") * 7919 % 6007).alias("k"))
    assert in_order(df, ["k"], unique=True, ranges=3000).select(RANGE).distinct().count() <= 1000
    keyed = add_surrogate_key(df, ["k"], "sk", unique=True, ranges=3000)
    assert keyed.join(_numbered(df, ["k"]), "k").where("sk = n").count() == 6000


def test_places_ascend_with_the_order_over_all_ranges(spark):
    df = _mixed(spark, 5000)
    rows = in_order(df, ["name", "at", "id"], unique=True, ranges=9)
    found = [row.id for row in rows.orderBy(PLACE).select("id").collect()]
    by = [F.col(c).asc_nulls_last() for c in ("name", "at", "id")]
    assert found == [row.id for row in df.orderBy(*by).select("id").collect()]
    starts = dict(range_starts(rows).collect())
    assert min(starts.values()) == 0 and len(starts) == rows.select(RANGE).distinct().count()


def test_the_key_reads_written_places(spark):
    """No shuffle and no single task is left once the rows lie in order."""
    plan = plan_of(add_surrogate_key(_mixed(spark), ["id"], "sk", ranges=20))
    assert "Window" not in plan and "SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan


# History

COLUMNS = "k string, at timestamp, a string, batch string, digest string"


def _versions(df, ranges=None):
    return build_versions(
        df, key="k", at="at", tracked=["a"], ties=["batch", "digest"], version_key="sk", ranges=ranges
    )


def _t(day):
    return datetime(2025, 1, day)


def _rows(spark, *rows):
    return spark.createDataFrame(
        [(k, _t(day) if day else None, a, "b1", f"{i:03d}") for i, (k, day, a) in enumerate(rows)], COLUMNS
    )


@pytest.mark.parametrize("ranges", [5, 2, None])
def test_back_and_forth_makes_three_versions(spark, ranges):
    df = _rows(spark, ("p", 1, "A"), ("p", 2, "A"), ("p", 3, "B"), ("p", 4, "A"), ("q", 2, "A"))
    out = _versions(df, ranges=ranges).orderBy("sk")
    found = [(r.sk, r.k, r.a, r.effective_from, r.effective_to) for r in out.collect()]
    assert found == [
        (1, "p", "A", _t(1), _t(3)),
        (2, "p", "B", _t(3), _t(4)),
        (3, "p", "A", _t(4), None),
        (4, "q", "A", _t(2), None),
    ]


@pytest.mark.parametrize("ranges", [4, None])
def test_equal_neighbours_of_different_entities_stay_apart(spark, ranges):
    df = _rows(spark, ("p", 1, "A"), ("q", 1, "A"), ("r", 1, None), ("s", 1, None))
    assert _versions(df, ranges=ranges).count() == 4


@pytest.mark.parametrize("ranges", [4, None])
def test_copies_and_null_times(spark, ranges):
    df = _rows(spark, ("p", 1, "A"), ("p", 1, "A"), ("p", None, "B"), ("p", 1, "A"))
    out = _versions(df, ranges=ranges).orderBy("sk").collect()
    assert [(r.a, r.digest, r.effective_to) for r in out] == [("A", "000", None), ("B", "002", None)]


def _reference_versions(df):
    """The same by windows per entity."""
    copies = Window.partitionBy("k", "at", "a").orderBy("batch", "digest")
    order = [F.col(c).asc_nulls_last() for c in ("at", "batch", "digest")]
    seen = Window.partitionBy("k").orderBy(*order)
    kept = (
        df.withColumn("c", F.row_number().over(copies))
        .where("c = 1")
        .withColumn("h", row_digest(["a"]))
        .withColumn("p", F.lag("h").over(seen))
        .where("p is null or p <> h")
    )
    return kept.select(
        F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last(), *order)).alias("sk"),
        "k", "at", "a", "digest", F.lead("at").over(seen).alias("effective_to"),
    )


@pytest.mark.parametrize("ranges", [75, 5, 1])
def test_versions_equal_windows_per_entity(spark, ranges):
    """One entity owns a third of the rows; runs of equal values cross many ranges."""
    i = F.col("id")
    df = spark.range(0, 3000, 1, 4).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), i % 40)).alias("k"),
        F.timestamp_seconds(1_700_000_000 + (i * 13) % 2000).alias("at"),
        F.when((i * 13) % 2000 < 900, "same").otherwise(F.concat(F.lit("v"), i % 4)).alias("a"),
        F.concat(F.lit("b"), i % 2).alias("batch"),
        F.sha2(i.cast("string"), 256).alias("digest"),
    )
    ours = _versions(df, ranges=ranges)
    columns = ["sk", "k", "at", "a", "digest", "effective_to"]
    theirs = _reference_versions(df)
    assert ours.count() == theirs.count() > 400
    assert ours.select(*columns).exceptAll(theirs.select(*columns)).count() == 0


def test_hot_history_is_not_windowed_per_entity(spark):
    df = spark.range(500).select(
        F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("at"),
        (F.col("id") % 5).cast("string").alias("a"), F.lit("b").alias("batch"),
        F.col("id").cast("string").alias("digest"))
    out = _versions(df, ranges=10)
    plan = plan_of(out)
    assert not [line for line in plan.splitlines() if "Window" in line and "hashpartitioning(k#" in line]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert out.groupBy(F.spark_partition_id()).count().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
