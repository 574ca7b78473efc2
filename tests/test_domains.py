"""Domain plans on literal rows with known defects."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.conform import MissingColumnError
from lakestrata.plans import core, marts
from lakestrata.plans.provider_history import current_providers, provider_versions
from lakestrata.plans.silver import (
    refine_claims,
    refine_members,
    refine_payments,
    refine_providers,
)
from tests.conftest import plan_of

CLAIM = {
    "claim_id": "C1", "claim_line_id": "L1", "member_id": "M1", "provider_id": "P1",
    "payer_id": "PAY1", "diagnosis_code": "D1", "procedure_code": "PROC1",
    "claim_amount": "100.0", "approved_amount": "80.0", "claim_status": "APPROVED",
    "service_date": "2025-01-10", "received_date": "2025-01-15",
    "updated_at": "2025-02-01 08:00:00", "source_delete_flag": "N", "record_hash": "h",
}
MEMBER = {
    "member_id": "M1", "full_name": "Asha Rao Iyer", "gender": "F", "dob": "1990-05-05",
    "city": "Pune", "state": "MH", "plan_id": "PLN", "updated_at": "2025-12-01T10:00:00",
    "record_hash": "h",
}
PROVIDER = {
    "provider_id": "P1", "provider_name": "Care", "specialty": "Cardiology", "network_flag": "Y",
    "address": "1 Road", "city": "Pune", "state": "MH", "updated_at": "2025-12-01 09:00:00",
    "record_hash": "h", "bronze_batch_id": "batch_001",
}
PAYMENT = {
    "payment_id": "T1", "claim_id": "C1", "paid_amount": 80.0, "payment_date": "2025-02-03",
    "payment_status": "paid", "ingestion_timestamp": datetime(2025, 12, 1), "record_hash": "h",
}


def rows(spark, template, *changes):
    """Rows like the template; each change is a dict of replaced values."""
    kinds = {float: "double", datetime: "timestamp"}
    schema = ", ".join(f"{name} {kinds.get(type(value), 'string')}" for name, value in template.items())
    data = [tuple({**template, **change}.values()) for change in changes]
    return spark.createDataFrame(data, schema)


def reasons(checked, key):
    return {row[key]: row.reject_reason for row in checked.rejects.collect()}


def test_claim_defects_and_their_reasons(spark):
    bronze = rows(
        spark, CLAIM,
        {"claim_id": "ok"},
        {"claim_id": "member", "member_id": None},
        {"claim_id": "provider", "provider_id": None},
        {"claim_id": "negative", "claim_amount": "-500.0"},
        {"claim_id": "no amount", "claim_amount": None},
        {"claim_id": "text amount", "claim_amount": "abc"},
        {"claim_id": "date", "service_date": "2025-99-99"},
        {"claim_id": "status", "claim_status": "UNKNOWN"},
        {"claim_id": "null status", "claim_status": None},
        {"claim_id": None},
        {"claim_id": "deleted", "source_delete_flag": " y "},
        {"claim_id": "deleted bad", "source_delete_flag": "Y", "claim_line_id": None},
        {"claim_id": "padded", "claim_status": " denied ", "source_delete_flag": None},
    )
    checked = refine_claims(bronze)
    both = "claim_amount is null | claim_amount is negative"
    assert reasons(checked, "claim_id") == {
        "member": "member_id is null",
        "provider": "provider_id is null",
        "negative": "claim_amount is negative",
        "no amount": both,
        "text amount": both,
        "date": "service_date is invalid",
        "status": "claim_status is invalid",
        "null status": "claim_status is invalid",
        None: "claim_id is null",
        "deleted bad": "claim_line_id is null",
    }
    assert {row.claim_id: row.claim_status for row in checked.valid.collect()} == {
        "ok": "APPROVED", "padded": "DENIED",
    }


def test_valid_rejects_and_deletes_add_up_to_the_latest_rows(spark):
    bronze = rows(spark, CLAIM, *[
        {"claim_id": f"C{i % 20}", "record_hash": str(i), "updated_at": f"2025-02-{1 + i % 9:02d} 00:00:00",
         "claim_amount": "-1" if i % 4 == 0 else "1", "source_delete_flag": "Y" if i % 5 == 0 else "N"}
        for i in range(100)
    ])
    checked = refine_claims(bronze)
    deleted = checked.having("deleted").count()
    assert deleted and checked.valid.count() + checked.rejects.count() + deleted == 20


def test_a_bad_latest_version_hides_a_good_older_one(spark):
    bronze = rows(spark, CLAIM, {}, {"claim_amount": "-1", "updated_at": "2025-03-01 00:00:00"})
    checked = refine_claims(bronze)
    assert (checked.valid.count(), checked.rejects.count()) == (0, 1)


def test_a_later_version_repairs_a_bad_one(spark):
    bronze = rows(spark, CLAIM, {"claim_amount": "-1"}, {"updated_at": "2025-03-01 00:00:00"})
    checked = refine_claims(bronze)
    assert (checked.valid.count(), checked.rejects.count()) == (1, 0)


def test_silver_claim_columns_for_absent_input(spark):
    valid = refine_claims(rows(spark, CLAIM, {})).valid
    kinds = dict(valid.dtypes)
    for name in ("paid_amount", "copay_amount", "coinsurance_amount", "deductible_amount"):
        assert kinds[name] == "double"
    for name in ("service_from_date", "service_to_date", "processed_date", "admit_date", "discharge_date"):
        assert kinds[name] == "date"
    row = valid.first()
    assert (row.network_flag, row.is_emergency, row.claim_version, row.paid_amount) == ("N", "N", 1, None)


def test_member_defaults(spark):
    checked = refine_members(rows(spark, MEMBER, {}, {"member_id": None}, {"member_id": "M2", "plan_id": None}))
    assert checked.rejects.first().reject_reason == "member_id is null"
    row = checked.valid.where("member_id = 'M2'").first()
    assert (row.payer_id, row.plan_id, row.member_status) == ("PAYER_UNKNOWN", None, "ACTIVE")
    assert row.effective_date == date(2025, 12, 1)


def test_provider_defaults(spark):
    bronze = rows(spark, PROVIDER, {"specialty": None}).drop("specialty")
    row = refine_providers(bronze).valid.first()
    assert (row.specialty, row.provider_status) == ("GENERAL", "ACTIVE")
    assert row.contract_start_date == date(2025, 12, 1)
    kept = refine_providers(rows(spark, PROVIDER, {"specialty": None})).valid.first()
    assert kept.specialty is None


def test_payment_rules_and_rename(spark):
    checked = refine_payments(rows(
        spark, PAYMENT, {}, {"payment_id": "T2", "paid_amount": -100.0},
        {"payment_id": "T3", "claim_id": None}, {"payment_id": "T4", "paid_amount": None}))
    assert reasons(checked, "payment_id") == {
        "T2": "payment_amount is negative",
        "T3": "claim_id is null",
        "T4": "payment_amount is null | payment_amount is negative",
    }
    row = checked.valid.first()
    assert (row.payment_amount, row.payment_status, row.source_delete_flag) == (80.0, "PAID", "N")


def _core(spark, claims=({},), payments=({},), **options):
    members = core.member_dimension(refine_members(rows(spark, MEMBER, {})).valid)
    providers = core.provider_dimension(refine_providers(rows(spark, PROVIDER, {})).valid)
    facts = core.claim_fact(
        refine_claims(rows(spark, CLAIM, *claims)).valid, members, providers, **options)
    return members, providers, facts


def test_dimension_columns_and_defaults(spark):
    members, providers, _ = _core(spark)
    row = members.first()
    assert len(members.columns) == 23 and members.columns[-1] == "member_sk"
    assert (row.first_name, row.last_name, row.enterprise_member_id, row.country, row.member_sk) == (
        "Asha", "Rao", "M1", "INDIA", 1)
    row = providers.first()
    assert len(providers.columns) == 22 and providers.columns[-1] == "provider_current_sk"
    assert (row.provider_type, row.address_line1, row.enterprise_provider_id) == ("HOSPITAL", "1 Road", "P1")


def test_a_dimension_names_the_column_it_misses(spark):
    silver = refine_members(rows(spark, MEMBER, {}).drop("gender")).valid
    with pytest.raises(MissingColumnError, match="'gender'"):
        core.member_dimension(silver)


def test_claim_fact(spark):
    _, _, facts = _core(spark, claims=({}, {"claim_line_id": "L2", "member_id": "M9", "claim_status": "Denied"}))
    assert len(facts.columns) == 24
    assert facts.columns[:5] == ["claim_id", "claim_line_id", "member_sk", "provider_current_sk", "member_id"]
    assert facts.columns[-2:] == ["dw_created_at", "claim_sk"]
    one, two = facts.orderBy("claim_sk").collect()
    assert (one.member_sk, one.provider_current_sk, one.claim_year_month) == (1, 1, "2025-01")
    assert (two.member_sk, two.provider_current_sk, two.claim_sk) == (None, 1, 2)
    assert (two.approved_flag, two.denied_flag, two.pending_flag) == (0, 1, 0)


def test_payment_fact_without_and_with_ids(spark):
    members, providers, facts = _core(spark)
    plain = core.payment_fact(refine_payments(rows(spark, PAYMENT, {})).valid, members, providers, facts)
    assert len(plain.columns) == 29 and plain.columns[1:4] == ["claim_sk", "member_sk", "provider_current_sk"]
    row = plain.first()
    assert (row.claim_sk, row.member_sk, row.provider_current_sk, row.currency_code) == (None, None, None, "INR")
    assert (row.payment_year_month, row.paid_flag, row.partial_flag, row.on_hold_flag) == ("2025-02", 1, 0, 0)

    linked = {**PAYMENT, "claim_line_id": "L1", "member_id": "M1", "provider_id": "P1"}
    full = core.payment_fact(refine_payments(rows(spark, linked, {})).valid, members, providers, facts)
    row = full.first()
    assert (row.claim_sk, row.member_sk, row.provider_current_sk, row.payment_sk) == (1, 1, 1, 1)


def test_payments_resolve_through_claims_of_one_line(spark):
    """C1 has one line, C2 has two; an id that the payment gives itself stays."""
    members, providers, facts = _core(
        spark, claims=({}, {"claim_id": "C2"}, {"claim_id": "C2", "claim_line_id": "L2"})
    )
    bronze = rows(
        spark, {**PAYMENT, "claim_line_id": None, "member_id": None},
        {}, {"payment_id": "Y2", "claim_id": "C2"}, {"payment_id": "Y3", "claim_id": "none"},
        {"payment_id": "Y4", "member_id": "M9"}, {"payment_id": "Y5", "claim_line_id": "L7"},
    )
    silver = refine_payments(bronze).valid
    resolved = core.payment_fact(silver, members, providers, facts, resolve_by_claim=True)
    unresolved = core.payment_fact(silver, members, providers, facts)
    assert resolved.columns == unresolved.columns
    found = {r.payment_id: (r.claim_line_id, r.member_id, r.claim_sk, r.member_sk) for r in resolved.collect()}
    first = found.pop(PAYMENT["payment_id"])
    assert first == ("L1", "M1", 1, 1)
    assert found == {
        "Y2": (None, None, None, None), "Y3": (None, None, None, None),
        "Y4": ("L1", "M9", 1, None), "Y5": ("L7", None, None, None)}
    assert unresolved.where("claim_sk is not null").count() == 0


def test_measures_are_the_facts_without_keys(spark):
    members, providers, facts = _core(spark, claims=({}, {"claim_line_id": "L2"}))
    silver = refine_claims(rows(spark, CLAIM, {}, {"claim_line_id": "L2"})).valid
    measures = core.claim_measures(silver)
    keys = {"member_sk", "provider_current_sk", "claim_sk", "dw_created_at"}
    assert set(measures.columns) == set(facts.columns) - keys
    assert measures.exceptAll(facts.select(*measures.columns)).count() == 0
    plan = plan_of(measures)
    assert "Join" not in plan and "rangepartitioning" not in plan


def test_provider_versions(spark):
    later = {"updated_at": "2025-12-20 09:30:00", "bronze_batch_id": "batch_002"}
    bronze = rows(
        spark, PROVIDER, {}, {**later, "network_flag": "n"}, {**later, "updated_at": "zzz"},
        {"provider_id": "P2"}, {"provider_id": "P2", **later, "city": "Goa"},
        {"provider_id": "P3", "specialty": None}, {"provider_id": None},
        {"provider_id": "P4", "network_flag": "maybe"},
    )
    versions = provider_versions(bronze)
    assert len(versions.columns) == 28
    found = [
        (r.provider_scd2_sk, r.provider_id, r.network_flag, r.city, r.is_current, r.effective_to)
        for r in versions.orderBy("provider_scd2_sk").collect()
    ]
    moment = datetime(2025, 12, 20, 9, 30)
    assert found == [
        (1, "P1", "Y", "Pune", "N", moment),
        (2, "P1", "N", "Pune", "Y", None),
        (3, "P2", "Y", "Pune", "N", moment),
        (4, "P2", "Y", "Goa", "Y", None),
    ]
    assert sorted(row.provider_id for row in current_providers(versions).collect()) == ["P1", "P2"]


def test_untracked_changes_make_no_version(spark):
    later = {"updated_at": "2025-12-20 09:30:00", "provider_name": "Renamed"}
    assert provider_versions(rows(spark, PROVIDER, {}, later)).count() == 1
    assert provider_versions(rows(spark, PROVIDER, {}, later), tracked=["provider_name"]).count() == 2


def test_delete_and_return(spark):
    template = {**PROVIDER, "source_delete_flag": "N"}
    bronze = rows(
        spark, template, {}, {"updated_at": "2025-12-02 00:00:00", "source_delete_flag": "y"},
        {"updated_at": "2025-12-03 00:00:00"})
    versions = provider_versions(bronze)
    assert [r.is_deleted for r in versions.orderBy("effective_from").collect()] == ["N", "Y", "N"]
    gone = provider_versions(bronze.where("updated_at < '2025-12-03'"))
    assert current_providers(gone).count() == 0


def test_rates_may_pass_100_when_claims_have_several_lines(spark):
    denied = {"claim_status": "DENIED"}
    _, _, facts = _core(spark, claims=(denied, {**denied, "claim_line_id": "L2", "procedure_code": None}))
    current = current_providers(provider_versions(rows(spark, PROVIDER, {})))
    mart = marts.denial_analysis(facts, current)
    assert mart.columns == [
        "provider_id", "claim_year_month", "denial_reason_code", "denial_reason_claims", "total_claims",
        "denied_claims", "provider_name", "provider_type", "specialty", "network_flag", "provider_status",
        "quality_score", "city", "state", "denial_rate_pct", "dw_created_at"]
    found = sorted(
        (r.denial_reason_code, r.denial_reason_claims, r.total_claims, r.denied_claims, r.denial_rate_pct)
        for r in mart.collect())
    assert found == [("PROC1", 1, 1, 2, 200.0), ("UNKNOWN", 1, 1, 2, 200.0)]


def test_mart_columns(spark):
    members, providers, facts = _core(spark)
    payments = core.payment_fact(refine_payments(rows(spark, PAYMENT, {})).valid, members, providers, facts)
    current = current_providers(provider_versions(rows(spark, PROVIDER, {})))

    cost = marts.claim_cost_by_month(facts)
    assert cost.columns == [
        "claim_year_month", "payer_id", "total_claims", "total_claim_amount", "total_approved_amount",
        "total_paid_amount", "avg_claim_amount"]
    assert tuple(cost.first()) == ("2025-01", "PAY1", 1, 100.0, 80.0, None, 100.0)

    performance = marts.provider_performance(facts, payments, current)
    assert performance.columns == [
        "provider_id", "total_claims", "approved_claims", "denied_claims", "pending_claims",
        "emergency_claims", "total_claim_amount", "total_approved_amount", "avg_turnaround_days",
        "total_payment_amount", "total_payments", "provider_name", "provider_type", "specialty",
        "network_flag", "provider_status", "quality_score", "city", "state", "approval_rate_pct",
        "denial_rate_pct", "dw_created_at"]
    row = performance.first()
    assert (row.total_payment_amount, row.total_payments, row.avg_turnaround_days) == (0.0, 0, 5.0)

    use = marts.member_utilization(facts, payments, members)
    assert use.columns == [
        "member_id", "payer_id", "total_claims", "approved_claims", "denied_claims", "emergency_claims",
        "total_claim_amount", "total_approved_amount", "avg_turnaround_days", "total_payment_amount",
        "total_payments", "member_sk", "enterprise_member_id", "first_name", "last_name", "gender", "dob",
        "city", "state", "member_status", "dw_created_at"]

    pace = marts.claim_turnaround(facts)
    assert pace.columns == [
        "claim_year_month", "claim_status", "total_claims", "avg_turnaround_days", "min_turnaround_days",
        "max_turnaround_days", "dw_created_at"]
    given = facts.withColumn("claim_turnaround_days", F.lit(9))
    assert marts.claim_turnaround(given).first().max_turnaround_days == 9


def test_emergency_counts_only_when_carried(spark):
    template_claims = {**CLAIM, "is_emergency": "y"}
    members, providers, _ = _core(spark)
    silver = refine_claims(rows(spark, template_claims, {})).valid
    for carry, expected in ((False, 0), (True, 1)):
        facts = core.claim_fact(silver, members, providers, carry_emergency=carry)
        assert marts.member_utilization(
            facts, core.payment_fact(refine_payments(rows(spark, PAYMENT, {})).valid, members, providers, facts),
            members).first().emergency_claims == expected


def _exchanges(node) -> list[str]:
    """The output columns of every shuffle below a physical plan's node, before execution."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return _exchanges(node.initialPlan())
    below = node.children()
    found = [text for i in range(below.size()) for text in _exchanges(below.apply(i))]
    return [*found, node.output().toString()] if node.nodeName() == "Exchange" else found


def test_a_fact_moves_its_wide_columns_once(spark, sf_dir):
    """Ordering and lookups shuffle ids; the digest shuffles once, as bytes, whatever the size of the dimensions."""
    from checks.registry import Lake

    lake = Lake(spark, sf_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = _exchanges(lake.claims()._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(moved) >= 4
    assert len([columns for columns in moved if "record_hash" in columns]) == 1


def test_packed_digests_come_back_as_they_were(spark):
    from lakestrata.operators.ranges import packed, unpacked

    values = ["00ff", "ab" * 32, "AB", "abc", "", None, "00ff\n", "zz", "0"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, digest string")
    small = packed(df, "digest")
    assert unpacked(small, "digest").orderBy("i").collect() == df.orderBy("i").collect()
    assert small.where("i = 1 and digest is null and length(_digest_bytes) = 32").count() == 1


def test_facts_keep_repeated_and_null_keys(spark, sf_dir):
    """Rows that agree on every id keep their own columns and get different keys."""
    from lakestrata.plans import core
    from checks.registry import Lake

    lake = Lake(spark, sf_dir)
    some = lake.checked("claims").valid.where("claim_id < 50")
    claims = some.union(some).union(some.limit(1).withColumn("claim_id", F.lit(None).cast("bigint")))
    fact = core.claim_fact(claims, lake.members(), lake.providers())
    rows = claims.count()
    assert sorted(r.claim_sk for r in fact.select("claim_sk").collect()) == list(range(1, rows + 1))
    kept = ["claim_id", "claim_line_id", "member_id", "record_hash"]
    assert fact.select(*kept).exceptAll(claims.select(*kept)).count() == 0
