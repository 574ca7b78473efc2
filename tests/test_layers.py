"""Landing files, stored tables and the whole pipeline."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.quality import check, not_negative
from lakestrata.plans import pipeline
from lakestrata.sources.landing import (
    LINEAGE,
    read_csv_batches,
    read_json_batches,
    read_parquet_batches,
)
from lakestrata.sources.store import LayerStore


def write_text(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def store(spark, tmp_path):
    return LayerStore(spark, str(tmp_path / "lake"))


# Readers


def test_csv_batches_with_different_headers(spark, tmp_path):
    root = tmp_path / "claims"
    write_text(root / "batch_001" / "claims.csv", "id,amount\n1,1.50\n2,\n")
    write_text(root / "batch_002" / "claims.csv", "amount,id,channel\n3,3,PORTAL\n")
    write_text(root / "batch_003" / "claims.csv", "id,amount\n4,abc\n")
    df = read_csv_batches(spark, str(root), "claims")
    assert df.columns == ["id", "amount", "channel", *LINEAGE]
    assert {kind for name, kind in df.dtypes if name in ("id", "amount", "channel")} == {"string"}
    found = sorted(tuple(r) for r in df.select("id", F.coalesce("amount", F.lit("-")), F.coalesce("channel", F.lit("-")), "bronze_batch_id").collect())
    assert found == [
        ("1", "1.50", "-", "batch_001"), ("2", "-", "-", "batch_001"),
        ("3", "3", "PORTAL", "batch_002"), ("4", "abc", "-", "batch_003")]
    hashes = {r.id: r.record_hash for r in df.collect()}
    expected = spark.range(1).select(
        F.sha2(F.lit("2||NULL"), 256), F.sha2(F.lit("3||3||PORTAL"), 256)).first()
    assert (hashes["2"], hashes["3"]) == tuple(expected)


def test_one_scan_per_header(spark, tmp_path):
    for i in range(1, 7):
        header = "id,amount" if i < 6 else "id,amount,channel"
        write_text(tmp_path / f"batch_{i:03d}" / "a.csv", f"{header}\n1,2{',x' if i == 6 else ''}\n")
    df = read_csv_batches(spark, str(tmp_path), "claims")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert df.count() == 6


def test_lineage_columns(spark, tmp_path):
    write_text(tmp_path / "batch_007" / "claims.csv", "id\n1\n")
    write_text(tmp_path / "late" / "claims.csv", "id\n2\n")
    found = {r.id: r for r in read_csv_batches(spark, str(tmp_path), "claims").collect()}
    assert found["1"].source_file_name == "claims.csv"
    assert found["1"].source_file_path.endswith("/batch_007/claims.csv")
    assert (found["1"].bronze_batch_id, found["2"].bronze_batch_id) == ("batch_007", "")
    assert found["1"].bronze_dataset == "claims"
    assert isinstance(found["1"].ingestion_timestamp, datetime)
    assert found["1"].ingestion_timestamp == found["2"].ingestion_timestamp


def test_a_file_that_disagrees_with_its_batch_fails(spark, tmp_path):
    write_text(tmp_path / "batch_001" / "a.csv", "id,amount\n1,2\n")
    write_text(tmp_path / "batch_001" / "b.csv", "amount,id\n1,2\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv_batches(spark, str(tmp_path), "claims").collect()


def test_no_batches(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_csv_batches(spark, str(tmp_path), "claims")


def test_json_keys_are_united(spark, tmp_path):
    write_text(tmp_path / "batch_001" / "m.json", '{"id": "a", "city": "x"}\n')
    write_text(tmp_path / "batch_002" / "m.json", '{"id": "b", "plan": "p"}\n')
    df = read_json_batches(spark, str(tmp_path), "members")
    assert df.columns == ["city", "id", "plan", *LINEAGE]
    assert df.count() == 2
    given = read_json_batches(spark, str(tmp_path), "members", schema="id string", batches=["batch_002"])
    assert [tuple(r) for r in given.select("id", "bronze_batch_id").collect()] == [("b", "batch_002")]


def test_parquet_columns_are_united(spark, tmp_path):
    spark.sql("select 'a' id").coalesce(1).write.parquet(str(tmp_path / "batch_001"))
    spark.sql("select 'b' id, 2 n").coalesce(1).write.parquet(str(tmp_path / "batch_002"))
    df = read_parquet_batches(spark, str(tmp_path), "payments")
    assert sorted((r.id, r.n, r.bronze_batch_id) for r in df.collect()) == [
        ("a", None, "batch_001"), ("b", 2, "batch_002")]


# Store


def test_write_counts_rows_and_replaces(spark, store):
    assert store.write(spark.range(7), "fact_claim") == 7
    assert store.write(spark.range(3), "fact_claim") == 3
    assert store.read("fact_claim").count() == 3
    assert store.write(spark.range(2), "fact_claim", mode="append") == 2
    assert store.read("fact_claim").count() == 5
    assert store.write(spark.range(0), "fact_claim") == 0
    assert store.read("fact_claim").columns == ["id"]


def test_appended_columns_show_in_bronze(spark, store):
    store.write(spark.sql("select 'a' id"), "bronze_claims")
    store.write(spark.sql("select 'b' id, 'x' channel"), "bronze_claims", mode="append")
    assert sorted((r.id, r.channel or "") for r in store.read("bronze_claims").collect()) == [
        ("a", ""), ("b", "x")]


def test_valid_and_rejects_are_tables_of_their_own_from_one_write(spark, store):
    df = spark.range(10).select(
        (F.col("id") - 3).cast("double").alias("amount"),
        F.when(F.col("id") == 9, "Y").otherwise("N").alias("source_delete_flag"))
    assert store.write_checked(check(df, [not_negative("amount")]), "silver_claims") == (6, 3)
    valid, rejects = store.read("silver_claims"), store.read("silver_claims_rejects")
    assert (valid.count(), rejects.count()) == (6, 3)
    assert valid.columns == rejects.columns == ["amount", "source_delete_flag", "reject_reason"]
    assert spark.read.parquet(store.path("silver_claims")).exceptAll(valid).count() == 0
    assert not set(valid.inputFiles()) & set(rejects.inputFiles())


@pytest.mark.parametrize("amount", [1.0, -1.0, None])
def test_silver_without_one_side_or_both(spark, store, amount):
    df = spark.createDataFrame([(amount or 0.0, "N")], "amount double, source_delete_flag string")
    df = df if amount else df.limit(0)
    valid, rejects = store.write_checked(check(df, [not_negative("amount")]), "silver_claims")
    assert (store.read("silver_claims").count(), store.read("silver_claims_rejects").count()) == (valid, rejects)
    assert store.read("silver_claims_rejects").columns[-1] == "reject_reason"


# Pipeline

CLAIM_HEADER = (
    "claim_id,claim_line_id,member_id,provider_id,payer_id,diagnosis_code,procedure_code,"
    "claim_amount,approved_amount,claim_status,service_date,received_date,updated_at,source_delete_flag"
)


def _claim(number, line=1, member="M1", provider="P1", amount="100.0", status="APPROVED",
           service="2025-01-10", updated="2025-02-01T08:00:00", gone="N"):
    return (f"C{number},L{line},{member},{provider},PAY1,D1,PROC1,{amount},80.0,{status},{service},"
            f"2025-01-15,{updated},{gone}")


@pytest.fixture
def landing(spark, tmp_path):
    root = tmp_path / "landing"
    first = [
        _claim(1), _claim(1), _claim(2, member=""), _claim(3, amount="-500.0"),
        _claim(4, service="2025-99-99"), _claim(5, status="UNKNOWN"), _claim(6, provider=""),
        _claim(7), _claim(8, status="DENIED"), _claim(9, status="PENDING"),
    ]
    second = [
        _claim(3, amount="750.0", updated="2025-03-01T08:00:00") + ",PORTAL",
        _claim(7, updated="2025-03-02T08:00:00", gone="Y") + ",EMAIL",
        _claim(10, member="M404", updated="2025-03-02T08:00:00") + ",API",
    ]
    write_text(root / "claims/batch_001/claims.csv", "\n".join([CLAIM_HEADER, *first, ""]))
    write_text(root / "claims/batch_002/claims.csv", "\n".join([f"{CLAIM_HEADER},submission_channel", *second, ""]))
    member = '{"member_id": %s, "full_name": "Asha Rao", "gender": "F", "dob": "1990-01-01", "city": "%s", "state": "MH", "plan_id": "P", "updated_at": "%s"}\n'
    write_text(root / "members/batch_001/members.json",
               member % ('"M1"', "Pune", "2025-12-01T10:00:00") + member % ("null", "Goa", "2025-12-01T10:00:00"))
    write_text(root / "members/batch_002/members.json", member % ('"M1"', "Delhi", "2025-12-15T11:00:00"))
    header = "provider_id,provider_name,specialty,network_flag,address,city,state,updated_at\n"
    write_text(root / "providers/batch_001/providers.csv",
               header + 'P1,Care,Cardiology,Y,"1 Road, East",Pune,MH,2025-12-01T09:00:00\n'
               + "P2,Cure,,N,2 Road,Goa,GA,2025-12-01T09:00:00\n")
    write_text(root / "providers/batch_002/providers.csv",
               header + "P1,Care,Neurology,N,3 Road,Pune,MH,2025-12-20T09:30:00\n")
    for batch, values in (("batch_001", "('T1', 'C1', 80.0D), ('T2', 'C8', -100.0D)"), ("batch_002", "('T3', 'C10', 5.0D)")):
        spark.sql(f"select col1 payment_id, col2 claim_id, col3 paid_amount, '2025-02-02' payment_date, 'PAID' payment_status from values {values}").coalesce(1).write.parquet(str(root / "payments" / batch))
    return str(root)


def test_pipeline_counts_and_content(spark, store, landing):
    counts = pipeline.run_all(store, landing)
    assert counts == {
        "bronze_claims_rows": 13, "bronze_members_rows": 3, "bronze_providers_rows": 3, "bronze_payments_rows": 3,
        "silver_claims_rows": 5, "silver_claims_reject_rows": 4,
        "silver_members_rows": 1, "silver_members_reject_rows": 1,
        "silver_providers_rows": 2, "silver_providers_reject_rows": 0,
        "silver_payments_rows": 2, "silver_payments_reject_rows": 1,
        "dim_member_current_rows": 1, "dim_provider_current_rows": 2,
        "fact_claim_rows": 5, "fact_payment_rows": 2,
        "dim_provider_scd2_rows": 2, "dim_provider_scd2_current_rows": 1,
        "gold_claim_cost_by_month_rows": 1, "gold_denial_analysis_rows": 1,
        "gold_provider_performance_rows": 1, "gold_member_utilization_rows": 2,
        "gold_claim_turnaround_time_rows": 3,
    }
    channels = {r.claim_id: r.submission_channel for r in store.read("silver_claims").collect()}
    assert channels == {"C1": None, "C3": "PORTAL", "C8": None, "C9": None, "C10": "API"}
    fact = {r.claim_id: r for r in store.read("fact_claim").collect()}
    assert (fact["C10"].member_sk, fact["C1"].member_sk) == (None, 1)
    assert sorted(r.claim_sk for r in fact.values()) == [1, 2, 3, 4, 5]
    assert store.read("dim_member_current").first().city == "Delhi"
    assert store.read("dim_provider_current").where("provider_id = 'P2'").first().specialty is None
    closed, opened = store.read("dim_provider_scd2").orderBy("effective_from").collect()
    assert closed.effective_to == opened.effective_from and closed.address_line1 == "1 Road, East"
    score = store.read("gold_provider_performance").first()
    assert (score.total_claims, score.specialty, score.total_payments) == (5, "Neurology", 0)
    cost = store.read("gold_claim_cost_by_month").first()
    assert (cost.total_claims, cost.total_claim_amount, cost.avg_claim_amount) == (5, 1150.0, 230.0)


def test_batches_can_be_appended(spark, store, landing):
    assert pipeline.ingest(store, landing, "claims", batches=["batch_001"]) == 10
    assert pipeline.ingest(store, landing, "claims", "append", batches=["batch_002"]) == 3
    stepwise = store.read("bronze_claims").drop("ingestion_timestamp")
    whole = read_csv_batches(spark, f"{landing}/claims", "claims").drop("ingestion_timestamp")
    assert stepwise.select(*whole.columns).exceptAll(whole).count() == 0
    assert stepwise.count() == whole.count()


def test_silver_option_keeps_rows_without_key(spark, store, landing):
    pipeline.run_bronze(store, landing)
    again = pipeline.run_bronze(store, landing, mode="append")
    assert again["bronze_members_rows"] == 3
    assert pipeline.run_silver(store, keep_null_keys=True)["silver_members_reject_rows"] == 2
    assert pipeline.run_silver(store)["silver_members_reject_rows"] == 1
