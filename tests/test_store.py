"""Replacing tables, drifting types, batch discovery and control totals."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.types import common_type, common_types, disagree
from lakestrata.operators.control import control_totals
from lakestrata.plans import pipeline
from lakestrata.sources import landing as readers
from lakestrata.sources.landing import read_csv_batches, read_json_batches, read_parquet_batches
from lakestrata.sources.store import TABLES, LayerStore
from tests.test_layers import landing, store, write_text  # noqa: F401


def ids(df):
    return sorted(row.id for row in df.collect())


# Overwrites


def test_a_failing_overwrite_leaves_the_old_rows(spark, store, tmp_path):  # noqa: F811
    store.write(spark.range(4), "fact_claim")
    bad = spark.range(100, numPartitions=4).withColumn("id", F.expr("if(id = 99, raise_error('broken'), id)"))
    with pytest.raises(PySparkException):
        store.write(bad, "fact_claim")
    assert ids(store.read("fact_claim")) == [0, 1, 2, 3]
    assert sorted(p.name for p in (tmp_path / "lake/gold").iterdir()) == ["fact_claim"]


def test_a_run_lost_between_the_renames_is_undone(spark, store, tmp_path):  # noqa: F811
    store.write(spark.range(4), "fact_claim")
    gold = tmp_path / "lake/gold"
    (gold / "fact_claim").rename(gold / ".fact_claim.previous")
    assert ids(store.read("fact_claim")) == [0, 1, 2, 3]
    (gold / "fact_claim").rename(gold / ".fact_claim.previous")
    store.write(spark.range(1), "fact_claim", mode="append")
    assert ids(store.read("fact_claim")) == [0, 0, 1, 2, 3]


def test_a_table_may_be_written_from_its_own_rows(spark, store):  # noqa: F811
    store.write(spark.range(5), "fact_claim")
    store.write(store.read("fact_claim").where("id > 2"), "fact_claim")
    assert ids(store.read("fact_claim")) == [3, 4]


def test_tables_can_lie_elsewhere(spark, tmp_path):
    moved = {"fact_claim": str(tmp_path / "other/claims"), "gold_denial_analysis": "marts/denials"}
    store = LayerStore(spark, str(tmp_path / "lake"), tables=moved)
    store.write(spark.range(2), "fact_claim")
    store.write(spark.range(3), "gold_denial_analysis")
    assert spark.read.parquet(str(tmp_path / "other/claims")).count() == 2
    assert spark.read.parquet(str(tmp_path / "lake/marts/denials")).count() == 3
    with pytest.raises(KeyError):
        LayerStore(spark, str(tmp_path), tables={"fact_claims": "x"})


# Types


@pytest.mark.parametrize(
    ("one", "two", "both"),
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "int", "double"),
        ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(38,2)", "decimal(38,10)", "double"),
        ("date", "timestamp", "timestamp"), ("timestamp_ntz", "date", "timestamp_ntz"),
        ("string", "int", "string"), ("void", "int", "int"), ("boolean", "int", "string"),
        ("array<int>", "array<int>", "array<int>"), ("struct<a:int>", "int", "string"),
    ],
)
def test_common_types(spark, one, two, both):
    kinds = [T.StructType.fromDDL(f"c {kind}")["c"].dataType for kind in (one, two, both)]
    assert common_type(kinds[0], kinds[1]) == common_type(kinds[1], kinds[0]) == kinds[2]


def test_columns_of_several_schemas():
    schemas = [T.StructType.fromDDL("a int, b string"), T.StructType.fromDDL("b string, a double, c date")]
    assert disagree(schemas) and not disagree(schemas[:1] * 2)
    assert [(n, k.simpleString()) for n, k in common_types(schemas).items()] == [
        ("a", "double"), ("b", "string"), ("c", "date")]


def test_appended_json_of_another_type(spark, store, tmp_path):  # noqa: F811
    root = tmp_path / "landing/members"
    write_text(root / "batch_001/m.json", '{"member_id": "a", "score": 1}\n')
    write_text(root / "batch_002/m.json", '{"member_id": "b", "score": 1.5, "nested": {"x": 1}}\n')
    write_text(root / "batch_003/m.json", '{"member_id": "c", "score": "n/a", "nested": 2}\n')
    for batch, mode in (("batch_001", "overwrite"), ("batch_002", "append"), ("batch_003", "append")):
        assert pipeline.ingest(store, str(tmp_path / "landing"), "members", mode, batches=[batch]) == 1
    found = {r.member_id: (r.score, r.nested) for r in store.read("bronze_members").collect()}
    assert found == {"a": ("1.0", None), "b": ("1.5", '{"x":1}'), "c": ("n/a", "2")}


def test_parquet_batches_of_other_types(spark, tmp_path):
    spark.sql("select 'a' id, 1 n").coalesce(1).write.parquet(str(tmp_path / "batch_001"))
    spark.sql("select 'b' id, 1.5D n, 'x' extra").coalesce(1).write.parquet(str(tmp_path / "batch_002"))
    spark.sql("select 'c' id, 3 n").coalesce(1).write.parquet(str(tmp_path / "batch_003"))
    df = read_parquet_batches(spark, str(tmp_path), "payments")
    assert df.columns[:3] == ["id", "n", "extra"] and dict(df.dtypes)["n"] == "double"
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    found = {r.id: (r.n, r.extra, r.bronze_batch_id, r.record_hash) for r in df.collect()}
    digest = spark.sql("select sha2('a||1||NULL', 256) a, sha2('b||1.5||x', 256) b").first()
    assert found["a"] == (1.0, None, "batch_001", digest.a) and found["b"] == (1.5, "x", "batch_002", digest.b)
    assert found["c"][0] == 3.0


# Discovery


def test_only_files_of_batches_are_read(spark, tmp_path):
    write_text(tmp_path / "batch_001/a.csv", "id\n1\n")
    write_text(tmp_path / "stray.csv", "id\n2\n")
    write_text(tmp_path / "batch_001/deeper/b.csv", "id\n3\n")
    write_text(tmp_path / "_hidden/c.csv", "id\n4\n")
    write_text(tmp_path / "batch_001/.d.csv", "id\n5\n")
    write_text(tmp_path / "batch_001/notes.txt", "id\n6\n")
    assert [r.id for r in read_csv_batches(spark, str(tmp_path), "claims").collect()] == ["1"]
    write_text(tmp_path / "stray.json", '{"id": 1}\n')
    write_text(tmp_path / "batch_001/m.json", '{"id": 2}\n')
    assert [r.id for r in read_json_batches(spark, str(tmp_path), "members").collect()] == [2]


def test_known_layouts_need_no_job(spark, tmp_path, monkeypatch):
    write_text(tmp_path / "batch_001/a.csv", "id,n\n1,2\n")
    write_text(tmp_path / "batch_002/a.csv", "n,id\n4,3\n")
    spark.sparkContext.setJobGroup("layouts", "no header is read")
    layouts = {"batch_001": ["id", "n"], "batch_002": ["n", "id"]}
    df = read_csv_batches(spark, str(tmp_path), "claims", layouts=layouts)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("layouts")
    spark.sparkContext._jsc.clearJobGroup()
    assert list(jobs) == []
    assert sorted((r.id, r.n) for r in df.collect()) == [("1", "2"), ("3", "4")]
    same = read_csv_batches(spark, str(tmp_path), "claims", batches=["batch_001"], layouts=["id", "n"])
    assert same.count() == 1
    with pytest.raises(Exception, match="(?s)header does not conform"):
        read_csv_batches(spark, str(tmp_path), "claims", layouts=["id", "n"]).collect()


def test_run_all_hands_reading_on(spark, store, landing):  # noqa: F811
    schema = "member_id string, full_name string, gender string, city string, state string, plan_id string, updated_at string"
    reading = {"members": {"schema": schema, "batches": ["batch_001"]}, "claims": {"options": {"nullValue": "M404"}}}
    counts = pipeline.run_all(store, landing, reading=reading, resolve_by_claim=True)
    assert counts["bronze_members_rows"] == 2 and "dob" not in store.read("bronze_members").columns
    assert store.read("silver_claims_rejects").where("claim_id = 'C10'").count() == 1
    paid = store.read("fact_payment").where("payment_id = 'T1'").first()
    assert (paid.claim_line_id, paid.member_id, paid.claim_sk) == ("L1", "M1", 1)


# Control totals


def test_control_totals_ignore_layout_and_count_repeats(spark):
    df = spark.range(50).select("id", (F.col("id") / 3).alias("x"), F.current_timestamp().alias("t"))
    plain = df.repartition(7).orderBy(F.desc("id")).select("x", "t", "id")
    assert control_totals(df, clock="t").first() == control_totals(plain, clock="t").first()
    assert control_totals(df, clock="t").first().clock_values == 1
    twice = control_totals(df.union(df.where("id = 1")), leave_out=["t"]).first()
    assert twice.rows == 51 and twice.content_digest != control_totals(df, leave_out=["t"]).first().content_digest
    swapped = df.withColumn("id", F.when(F.col("id") < 2, 1 - F.col("id")).otherwise(F.col("id")))
    assert control_totals(swapped, clock="t").first() != control_totals(df, clock="t").first()
    empty = control_totals(df.limit(0), clock="t").first()
    assert tuple(empty) == (0, "0", 0)


def test_every_stored_table_is_reconciled(spark, store, landing):  # noqa: F811
    counts = pipeline.run_all(store, landing)
    found = {r.name: r for r in pipeline.reconcile(store, counts).collect()}
    assert set(found) == set(TABLES) and len(found) == 22
    assert all(r.agrees and r.rows == r.reported_rows for r in found.values())
    store.write(spark.range(1).select(F.lit("extra").alias("payment_id")), "fact_payment", mode="append")
    again = {r.name for r in pipeline.reconcile(store, counts).collect() if not r.agrees}
    assert again == {"fact_payment"}


def test_readers_are_known():
    assert set(readers.READERS) == set(pipeline.LANDING_FORMATS.values())


def test_compressed_landing_and_stored_tables(spark, tmp_path):
    """CSV batches may come gzipped, beside plain ones; stored tables are zstd unless asked otherwise."""
    rows = spark.createDataFrame([("1", "a"), ("2", None)], "id string, v string")
    rows.coalesce(1).write.option("header", "true").option("compression", "gzip").csv(str(tmp_path / "in/batch_001"))
    write_text(tmp_path / "in/batch_002/b.csv", "id,v\n3,c\n")
    for batches in (None, ["batch_001", "batch_002"]):
        found = read_csv_batches(spark, str(tmp_path / "in"), "claims", batches=batches)
        assert {(r.id, r.v, r.bronze_batch_id) for r in found.collect()} == {
            ("1", "a", "batch_001"), ("2", None, "batch_001"), ("3", "c", "batch_002"),
        }
    store = LayerStore(spark, str(tmp_path / "lake"))
    store.write(found, "bronze_claims")
    assert list((tmp_path / "lake/bronze/claims").glob("*.zstd.parquet"))
    plain = LayerStore(spark, str(tmp_path / "plain"), write_options={"compression": "snappy"})
    plain.write(found, "bronze_claims")
    assert list((tmp_path / "plain/bronze/claims").glob("*.snappy.parquet"))
