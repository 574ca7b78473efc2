"""The registered queries: each operator of the library over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracles as sql
from checks.views import BATCH, VIEWS, row_count, spread_table, table
from lakestrata.operators.conform import Field, conform, day, flag, moment, number
from lakestrata.operators.history import HASH, build_versions
from lakestrata.operators.latest import keep_latest
from lakestrata.operators.quality import OUTCOME, REASON, Checked, outcome_summary, reject_profile
from lakestrata.operators.surrogate import add_surrogate_key
from lakestrata.plans import core, marts, pipeline
from lakestrata.plans import provider_history as history
from lakestrata.plans.domains import (
    CLAIMS,
    DEFAULT_COUNTRY,
    DOMAINS,
    PROVIDER_TRACKED,
    UNKNOWN_PLAN,
)
from lakestrata.plans.silver import refine
from lakestrata.sources.landing import LINEAGE, add_lineage
from lakestrata.sources.scratch import shared_folder
from lakestrata.sources.store import LayerStore

Query = Callable[[SparkSession, str], DataFrame]

# Few enough rows per range that the given tables are cut into many ranges.
SMALL_RANGE = 5_000


def comparable(df: DataFrame) -> DataFrame:
    """Leave out clock columns and show timestamps as text, free of time zones."""
    clocks = ("ingestion_timestamp", "dw_created_at")
    shown = [
        F.col(name).cast("string").alias(name) if kind.startswith("timestamp") else F.col(name)
        for name, kind in df.dtypes
        if name not in clocks
    ]
    return df.select(*shown)


class Lake:
    """Layers over the given tables; each frame is built once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        for name in ("view", "checked", "members", "providers", "claims"):
            setattr(self, name, cache(getattr(self, name)))

    def view(self, name: str) -> DataFrame:
        return VIEWS[name].frame(self.spark, self.sf_dir)

    def checked(self, view: str) -> Checked:
        return refine(self.view(view), DOMAINS[view.removeprefix("linked_")])

    def members(self) -> DataFrame:
        return core.member_dimension(self.checked("members").valid)

    def providers(self) -> DataFrame:
        return core.provider_dimension(self.checked("providers").valid)

    def claims(self) -> DataFrame:
        return core.claim_fact(self.checked("claims").valid, self.members(), self.providers())

    def claim_measures(self) -> DataFrame:
        return core.claim_measures(self.checked("claims").valid)

    def payments(self, view: str = "linked_payments", **options) -> DataFrame:
        dims = self.members(), self.providers(), self.claims()
        return core.payment_fact(self.checked(view).valid, *dims, **options)

    def payment_measures(self) -> DataFrame:
        return core.payment_measures(self.checked("linked_payments").valid)

    def versions(self, view: str = "provider_history", ranges: int | None = None) -> DataFrame:
        return history.provider_versions(self.view(view), ranges=ranges)

    def current_providers(self) -> DataFrame:
        return history.current_providers(self.versions("providers"))

    def ranges(self, name: str) -> int:
        """Enough ranges that each holds few rows of the table."""
        return max(2, -(-row_count(self.spark, self.sf_dir, name) // SMALL_RANGE))


def _on_lake(build: Callable[[Lake], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(Lake(spark, sf_dir)))


def _source_columns(view: str) -> list[str]:
    return [*VIEWS[view].columns, BATCH, "record_hash"]


def _file_lineage(lake: Lake) -> DataFrame:
    events = add_lineage(table(lake.spark, lake.sf_dir, "events"), "events")
    return events.select(
        "event_id", "source_file_name", "bronze_batch_id", "bronze_dataset", "record_hash"
    )


def _file_path(lake: Lake) -> DataFrame:
    """The whole path of each row's file, up to the root that the query was given."""
    events = add_lineage(table(lake.spark, lake.sf_dir, "events"), "events")
    inside = F.endswith("source_file_path", F.lit(f"{lake.sf_dir.rstrip('/')}/events.parquet"))
    return events.select("event_id", (inside | F.contains("source_file_path", F.lit("/events.parquet/"))).alias("in_table"))


def _reject_reasons(lake: Lake) -> DataFrame:
    return lake.checked("claims").rows.select(
        "claim_id", "claim_line_id", "record_hash", REASON, OUTCOME
    )


def _reject_profile(lake: Lake) -> DataFrame:
    profiles = [
        reject_profile(lake.checked(name).rejects).select(
            F.lit(name).alias("dataset"), REASON, "count"
        )
        for name in DOMAINS
    ]
    return reduce(DataFrame.unionByName, profiles)


def _drift(lake: Lake) -> DataFrame:
    """Conform suppliers that lack, rename, mistype and half-fill columns."""
    raw = lake.view("providers").select(
        "provider_id", "address", "quality_score", "network_flag", "specialty", "updated_at"
    )
    bad_text = F.when(F.col("provider_id") % 4 == 0, "abc").otherwise(F.col("quality_score"))
    bad_time = F.when(F.col("provider_id") % 7 == 0, "zzz").otherwise(F.col("updated_at"))
    fields = [
        number("quality_score"),
        number("risk_score"),
        Field("claim_version", "int", absent=1),
        moment("updated_at"),
        day("effective_date", fallbacks=("updated_at",)),
        day("termination_date"),
        Field("provider_id"),
        flag("network_flag"),
        flag("is_emergency"),
        Field("plan_id", absent=UNKNOWN_PLAN),
        Field("specialty", normal=True, null_as="none"),
        Field("address_line1", fallbacks=("street", "address")),
        Field("country", absent=DEFAULT_COUNTRY),
    ]
    return conform(raw.withColumns({"quality_score": bad_text, "updated_at": bad_time}), fields)


_DRIFT_SQL = f"""SELECT CAST(provider_id AS STRING) AS provider_id, address,
  TRY_CAST(quality_score AS DOUBLE) AS quality_score,
  upper(trim(COALESCE(network_flag, 'N'))) AS network_flag,
  upper(COALESCE(specialty, 'none')) AS specialty,
  CAST(TRY_CAST(updated_at AS TIMESTAMP) AS STRING) AS updated_at,
  CAST(NULL AS DOUBLE) AS risk_score, 1 AS claim_version,
  CAST(TRY_CAST(updated_at AS TIMESTAMP) AS DATE) AS effective_date,
  CAST(NULL AS DATE) AS termination_date, 'N' AS is_emergency, 'PLAN_UNKNOWN' AS plan_id,
  address AS address_line1, 'INDIA' AS country
FROM (SELECT provider_id, address, network_flag, specialty,
    CASE WHEN provider_id % 4 = 0 THEN 'abc' ELSE quality_score END AS quality_score,
    CASE WHEN provider_id % 7 = 0 THEN 'zzz' ELSE updated_at END AS updated_at
  FROM ({VIEWS["providers"].oracle_sql}) AS b) AS v"""


def _names(lake: Lake) -> DataFrame:
    columns = ("member_id", "full_name", "first_name", "last_name", BATCH)
    return core.split_names(lake.view("members")).select(*columns)


_LINE_ORDER = ("l_shipdate", "l_suppkey")
_LINE_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")


def _line_keys(lake: Lake) -> DataFrame:
    lines = spread_table(lake.spark, lake.sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 10 > 0, F.col("l_suppkey")).alias("l_suppkey"),
        *[name for name in (*_LINE_ORDER, *_LINE_TIES) if name != "l_suppkey"],
    )
    return add_surrogate_key(
        lines, _LINE_ORDER, "line_sk", ties=_LINE_TIES, ranges=lake.ranges("lineitem")
    )


def _repeated_keys(lake: Lake) -> DataFrame:
    """Every second line has the same key; the ties tell the lines apart."""
    lines = spread_table(lake.spark, lake.sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 2 == 0, F.col("l_suppkey")).otherwise(0).alias("shared_key"), *_LINE_TIES
    )
    return add_surrogate_key(
        lines, ["shared_key"], "line_sk", ties=_LINE_TIES, ranges=lake.ranges("lineitem")
    )


_REPEATED_KEYS_SQL = f"""SELECT *, row_number() OVER (ORDER BY shared_key, {", ".join(_LINE_TIES)}) AS line_sk
FROM (SELECT CASE WHEN l_partkey % 2 = 0 THEN l_suppkey ELSE 0 END AS shared_key, {", ".join(_LINE_TIES)}
  FROM lineitem) AS s"""

_LINE_KEYS_SQL = f"""SELECT * EXCLUDE (shipped), CAST(shipped AS STRING) AS l_shipdate FROM (
  SELECT * EXCLUDE (l_shipdate), l_shipdate AS shipped, row_number() OVER (ORDER BY
    {", ".join(f"{c} ASC NULLS LAST" for c in (*_LINE_ORDER, *_LINE_TIES))}) AS line_sk
  FROM (SELECT CASE WHEN l_suppkey % 10 > 0 THEN l_suppkey END AS l_suppkey, l_shipdate,
    {", ".join(_LINE_TIES)} FROM lineitem) AS s) AS k"""


def _text_keys(lake: Lake) -> DataFrame:
    """Claims whose member ids are text, some of it no number, against dimensions keyed by number."""
    member = F.when(F.col("member_id") % 3 == 0, "abc").otherwise(F.col("member_id").cast("string"))
    claims = lake.checked("claims").valid.withColumn("member_id", member)
    provider = F.col("provider_id").cast("string")
    return core.claim_fact(claims.withColumn("provider_id", provider), lake.members(), lake.providers())


def _change_rows(lake: Lake) -> DataFrame:
    rows = build_versions(
        history.provider_history(lake.view("provider_history")),
        key="provider_id",
        at="updated_at",
        tracked=PROVIDER_TRACKED,
        ties=[BATCH, "record_hash"],
        version_key="sk",
        ranges=lake.ranges("events"),
    )
    return rows.select("provider_id", "updated_at", "record_hash", HASH)


def _distinct_history(lake: Lake) -> DataFrame:
    rows = history.distinct_history(history.provider_history(lake.view("provider_history")))
    return rows.select("provider_id", "updated_at", *PROVIDER_TRACKED, "record_hash")


_HISTORY_COLUMNS = (
    "provider_id, CAST(updated_at AS STRING) AS updated_at, specialty, network_flag,"
    " address_line1, city, state, provider_status, source_delete_flag, record_hash"
)

# Landing files and the stored layers.

_DRIFT_COLUMN = "submission_channel"
_DRIFT_BATCH = "batch_002"


def write_landing(
    spark: SparkSession, sf_dir: str, root: str, datasets: Sequence[str], drift: bool = True
) -> None:
    """Write views as landing batches; with ``drift`` the second claims batch has one more column."""
    for dataset in datasets:
        rows = VIEWS[dataset].frame(spark, sf_dir)
        kind = pipeline.LANDING_FORMATS[dataset]
        options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        for batch in VIEWS[dataset].batch_names:
            columns = [F.col(name) for name in VIEWS[dataset].columns]
            if drift and dataset == "claims" and batch == _DRIFT_BATCH:
                columns.append(F.lit("PORTAL").alias(_DRIFT_COLUMN))
            part = rows.where(F.col(BATCH) == batch).select(*columns)
            writer = part.write.format(kind)
            if kind == "csv":
                writer = writer.option("header", "true").option("compression", "gzip").options(**options)
            writer.save(f"{root}/{dataset}/{batch}")


def _round_trip(dataset: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark)
        write_landing(spark, sf_dir, f"{root}/landing", [dataset])
        store = LayerStore(spark, f"{root}/lake")
        pipeline.ingest(store, f"{root}/landing", dataset)
        bronze = store.read(f"bronze_{dataset}")
        path_columns = ("source_file_path", "source_file_name")
        return comparable(bronze.drop(*path_columns))

    return run


def _bronze_sql(dataset: str, drift: bool = True) -> str:
    """Bronze as SQL: text formats hold text, and each batch hashes its own columns."""
    view = VIEWS[dataset]
    kind = pipeline.LANDING_FORMATS[dataset]
    # JSON keys are united over all files, in alphabetical order.
    columns = sorted(view.columns) if kind == "json" else list(view.columns)
    shown = [f"CAST({c} AS STRING) AS {c}" if kind == "csv" else c for c in columns]
    digest = [f"COALESCE(CAST({c} AS STRING), 'NULL')" for c in columns]
    if dataset != "claims" or not drift:
        hashed = f"sha256(concat_ws('||', {', '.join(digest)}))"
    else:
        shown.append(f"CASE WHEN {BATCH} = '{_DRIFT_BATCH}' THEN 'PORTAL' END AS {_DRIFT_COLUMN}")
        own, more = ", ".join(digest), ", ".join([*digest, "'PORTAL'"])
        hashed = (
            f"CASE WHEN {BATCH} = '{_DRIFT_BATCH}' THEN sha256(concat_ws('||', {more}))"
            f" ELSE sha256(concat_ws('||', {own})) END"
        )
    return (
        f"SELECT {', '.join(shown)}, {BATCH}, '{dataset}' AS bronze_dataset,"
        f" {hashed} AS record_hash FROM ({view.oracle_sql}) AS b"
    )


def _typed_batches(kind: str, dataset: str) -> Query:
    """A number that is whole in the first batch and has a fraction in the second, by append or in one load."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark)
        rows = VIEWS["members"].frame(spark, sf_dir)
        points = F.col("member_id") % 7
        for batch, value in zip(VIEWS["members"].batch_names, (points, points + 0.5)):
            part = rows.where(F.col(BATCH) == batch).where(points.isNotNull())
            part = part.select("city", "member_id", value.alias("points"))
            part.write.format(kind).save(f"{root}/landing/{dataset}/{batch}")
        store = LayerStore(spark, f"{root}/lake")
        if kind == "json":
            for batch, mode in zip(VIEWS["members"].batch_names, ("overwrite", "append")):
                pipeline.ingest(store, f"{root}/landing", dataset, mode, batches=[batch])
        else:
            pipeline.ingest(store, f"{root}/landing", dataset)
        return comparable(store.read(f"bronze_{dataset}").drop("source_file_path", "source_file_name"))

    return run


def _typed_batches_sql(dataset: str) -> str:
    late = f"{BATCH} = '{_DRIFT_BATCH}'"
    text = f"CASE WHEN {late} THEN CAST(points + 0.5::DOUBLE AS STRING) ELSE CAST(points AS STRING) END"
    return f"""SELECT city, member_id, CASE WHEN {late} THEN points + 0.5::DOUBLE ELSE points END AS points,
  {BATCH}, '{dataset}' AS bronze_dataset,
  sha256(concat_ws('||', city, CAST(member_id AS STRING), {text})) AS record_hash
FROM (SELECT city, member_id, member_id % 7 AS points, {BATCH}
  FROM ({VIEWS["members"].oracle_sql}) AS b WHERE member_id IS NOT NULL) AS m"""


# What the SQL side does not know: paths, and keys that number text ids in another order.
_UNKNOWN = (
    "source_file_path", "source_file_name", "member_sk", "provider_current_sk", "claim_sk", "payment_sk",
    "provider_scd2_sk",
)


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run every layer on landing files and hold each stored table against the counts of the run."""
    root = shared_folder(spark)
    write_landing(spark, sf_dir, f"{root}/landing", list(pipeline.LANDING_FORMATS), drift=False)
    store = LayerStore(spark, f"{root}/lake")
    counts = pipeline.run_all(store, f"{root}/landing")
    return pipeline.reconcile(store, counts, leave_out=_UNKNOWN)


def _totals_sql(name: str, query: str, clock: bool) -> str:
    """Control totals of a table as SQL; columns are listed by DuckDB, in alphabetical order."""
    skipped = ", ".join(f"'{column}'" for column in (*_UNKNOWN, "ingestion_timestamp"))
    values = f"list_sort(list_filter(json_keys(j), lambda k: NOT list_contains([{skipped}], k)))"
    # Fractions enter with six decimals on both sides.
    value = (
        "CASE WHEN json_type(j, '$.' || k) = 'DOUBLE' THEN CAST(CAST(CAST(j->>k AS DOUBLE) AS DECIMAL(38, 6)) AS STRING)"
        " ELSE coalesce(j->>k, 'NULL') END"
    )
    text = f"array_to_string(list_transform({values}, lambda k: {value}), '||')"
    number = f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"
    clocks = "CAST(count(*) > 0 AS BIGINT)" if clock else "CAST(0 AS BIGINT)"
    return (
        f"SELECT '{name}' AS name, count(*) AS rows, count(*) AS reported_rows, true AS agrees,"
        f" CAST(CAST(coalesce(sum({number}), 0) AS HUGEINT) AS STRING) AS content_digest, {clocks} AS clock_values"
        f" FROM (SELECT to_json(t) AS j FROM ({query}) AS t) AS r"
    )


def _emergencies(lake: Lake) -> DataFrame:
    """Emergency counts per member and payer, with the flag carried and varied."""
    urgent = F.when((F.col("claim_id") + F.col("claim_line_id")) % 3 == 0, "Y").otherwise("N")
    claims = lake.checked("claims").valid.withColumn("is_emergency", urgent)
    facts = core.claim_measures(claims, carry_emergency=True)
    mart = marts.member_utilization(facts, lake.payment_measures(), lake.members())
    return mart.select("member_id", "payer_id", "total_claims", "emergency_claims")


def _stored_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run every layer on landing files and count the rows of each stored table."""
    root = shared_folder(spark)
    write_landing(spark, sf_dir, f"{root}/landing", list(pipeline.LANDING_FORMATS))
    store = LayerStore(spark, f"{root}/lake")
    pipeline.run_all(store, f"{root}/landing")
    names = [*_STORED_SQL]
    counts = [
        store.read(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


_STORED_SQL = {
    **{f"bronze_{name}": VIEWS[name].oracle_sql for name in DOMAINS},
    "silver_claims": sql.having(sql.CLAIMS_CHECKED, "valid"),
    "silver_claims_rejects": sql.having(sql.CLAIMS_CHECKED, "reject"),
    "silver_members": sql.having(sql.MEMBERS_CHECKED, "valid"),
    "silver_members_rejects": sql.having(sql.MEMBERS_CHECKED, "reject"),
    "silver_providers": sql.having(sql.PROVIDERS_CHECKED, "valid"),
    "silver_payments": sql.having(sql.PAYMENTS_CHECKED, "valid"),
    "dim_member_current": sql.DIM_MEMBER,
    "dim_provider_current": sql.DIM_PROVIDER,
    "dim_provider_scd2": sql.versions("providers"),
    "fact_claim": sql.FACT_CLAIM,
    "gold_claim_cost_by_month": sql.COST_BY_MONTH,
    "gold_denial_analysis": sql.DENIALS,
    "gold_provider_performance": sql.PROVIDER_PERFORMANCE,
    "gold_member_utilization": sql.MEMBER_UTILIZATION,
    "gold_claim_turnaround_time": sql.TURNAROUND,
}

def _silver_sql(name: str, outcome: str) -> str:
    rows = sql.having(sql.CHECKED[name], outcome)
    if pipeline.LANDING_FORMATS[name] == "json":
        # The digest of a JSON row takes its keys in alphabetical order.
        digest = [f"COALESCE(CAST({c} AS STRING), 'NULL')" for c in VIEWS[name].columns]
        rows = rows.replace(", ".join(digest), ", ".join(sorted(digest)))
    return f"SELECT *, '{name}' AS bronze_dataset FROM ({rows}) AS s"


def _unlinked(mart: str) -> str:
    """The mart over payments as they come, without line, member and provider."""
    return mart.replace(sql.FACT_LINKED_PAYMENT, sql.FACT_PAYMENT)


# Table: its SQL, and whether it has a load clock.
_TABLES_SQL = {
    **{f"bronze_{name}": (_bronze_sql(name, drift=False), True) for name in DOMAINS},
    **{f"silver_{name}": (_silver_sql(name, "valid"), True) for name in DOMAINS},
    **{f"silver_{name}_rejects": (_silver_sql(name, "reject"), True) for name in DOMAINS},
    "dim_member_current": (sql.DIM_MEMBER, False),
    "dim_provider_current": (sql.DIM_PROVIDER, False),
    "dim_provider_scd2": (sql.versions("providers"), True),
    "fact_claim": (sql.FACT_CLAIM, True),
    "fact_payment": (sql.FACT_PAYMENT, True),
    "gold_claim_cost_by_month": (sql.COST_BY_MONTH, False),
    "gold_denial_analysis": (sql.DENIALS, True),
    "gold_provider_performance": (_unlinked(sql.PROVIDER_PERFORMANCE), True),
    "gold_member_utilization": (_unlinked(sql.MEMBER_UTILIZATION), True),
    "gold_claim_turnaround_time": (sql.TURNAROUND, True),
}

QUERIES: dict[str, Query] = {
    "bronze_record_hash": _on_lake(
        lambda lake: lake.view("claims").select("claim_id", "claim_line_id", BATCH, "record_hash")
    ),
    "bronze_file_lineage": _on_lake(_file_lineage),
    "bronze_file_path": _on_lake(_file_path),
    "bronze_claims_csv": _round_trip("claims"),
    "bronze_providers_csv": _round_trip("providers"),
    "bronze_members_json": _round_trip("members"),
    "bronze_payments_parquet": _round_trip("payments"),
    "bronze_members_drift": _typed_batches("json", "members"),
    "bronze_payments_drift": _typed_batches("parquet", "payments"),
    "latest_claims": _on_lake(
        lambda lake: keep_latest(lake.view("claims"), CLAIMS.keys).select(*_source_columns("claims"))
    ),
    "claim_reject_reason": _on_lake(_reject_reasons),
    "silver_claims_valid": _on_lake(lambda lake: lake.checked("claims").valid),
    "silver_claims_rejects": _on_lake(lambda lake: lake.checked("claims").rejects),
    "silver_claims_rejects_null_keys": _on_lake(
        lambda lake: refine(lake.view("claims"), CLAIMS, keep_null_keys=True).rejects
    ),
    "silver_members": _on_lake(lambda lake: lake.checked("members").valid),
    "silver_members_rejects": _on_lake(lambda lake: lake.checked("members").rejects),
    "silver_providers": _on_lake(lambda lake: lake.checked("providers").valid),
    "silver_providers_rejects": _on_lake(lambda lake: lake.checked("providers").rejects),
    "silver_payments_valid": _on_lake(lambda lake: lake.checked("payments").valid),
    "silver_payments_rejects": _on_lake(lambda lake: lake.checked("payments").rejects),
    "reject_profile": _on_lake(_reject_profile),
    "dq_summary": _on_lake(
        lambda lake: outcome_summary({name: lake.checked(name) for name in DOMAINS})
    ),
    "conform_drift": _on_lake(_drift),
    "name_split": _on_lake(_names),
    "dim_member_current": _on_lake(Lake.members),
    "dim_provider_current": _on_lake(Lake.providers),
    "fact_claim": _on_lake(Lake.claims),
    "fact_payment": _on_lake(lambda lake: lake.payments("payments")),
    "fact_payment_linked": _on_lake(Lake.payments),
    "fact_payment_by_claim": _on_lake(lambda lake: lake.payments("payments", resolve_by_claim=True)),
    "fact_claim_text_keys": _on_lake(_text_keys),
    "surrogate_key_distributed": _on_lake(_line_keys),
    "surrogate_key_repeated_keys": _on_lake(_repeated_keys),
    "scd2_dedup_history": _on_lake(_distinct_history),
    "scd2_change_rows": _on_lake(_change_rows),
    "scd2_history": _on_lake(Lake.versions),
    "scd2_history_in_ranges": _on_lake(lambda lake: lake.versions(ranges=lake.ranges("events"))),
    "scd2_current": _on_lake(lambda lake: history.current_providers(lake.versions())),
    "mart_claim_cost_by_month": _on_lake(lambda lake: marts.claim_cost_by_month(lake.claim_measures())),
    "mart_denial_analysis": _on_lake(
        lambda lake: marts.denial_analysis(lake.claim_measures(), lake.current_providers())
    ),
    "mart_provider_performance": _on_lake(
        lambda lake: marts.provider_performance(
            lake.claim_measures(), lake.payment_measures(), lake.current_providers()
        )
    ),
    "mart_member_utilization": _on_lake(
        lambda lake: marts.member_utilization(
            lake.claim_measures(), lake.payment_measures(), lake.members()
        )
    ),
    "mart_claim_turnaround": _on_lake(lambda lake: marts.claim_turnaround(lake.claim_measures())),
    "mart_emergency_claims": _on_lake(_emergencies),
    "stored_layer_counts": _stored_layers,
    "stored_layer_reconciliation": _reconciled,
}

ORACLES: dict[str, str] = {
    "bronze_record_hash": (
        f"SELECT claim_id, claim_line_id, {BATCH}, record_hash"
        f" FROM ({VIEWS['claims'].oracle_sql}) AS b"
    ),
    "bronze_file_lineage": (
        "SELECT event_id, 'events.parquet' AS source_file_name, '' AS bronze_batch_id,"
        " 'events' AS bronze_dataset, sha256(concat_ws('||', CAST(event_id AS STRING),"
        " CAST(ts AS STRING), CAST(user_id AS STRING), event_type, CAST(value AS STRING), props))"
        " AS record_hash FROM events"
    ),
    "bronze_file_path": "SELECT event_id, true AS in_table FROM events",
    "bronze_claims_csv": _bronze_sql("claims"),
    "bronze_providers_csv": _bronze_sql("providers"),
    "bronze_members_json": _bronze_sql("members"),
    "bronze_payments_parquet": _bronze_sql("payments"),
    "bronze_members_drift": _typed_batches_sql("members"),
    "bronze_payments_drift": _typed_batches_sql("payments"),
    "latest_claims": (
        f"SELECT {', '.join(_source_columns('claims'))}"
        f" FROM ({sql.latest('claims', 'claim_id, claim_line_id')}) AS k"
    ),
    "claim_reject_reason": (
        "SELECT claim_id, claim_line_id, record_hash, reject_reason, row_outcome"
        f" FROM ({sql.CLAIMS_CHECKED}) AS c"
    ),
    "silver_claims_valid": sql.having(sql.CLAIMS_CHECKED, "valid"),
    "silver_claims_rejects": sql.having(sql.CLAIMS_CHECKED, "reject"),
    "silver_claims_rejects_null_keys": sql.having(sql.CLAIMS_CHECKED_NULL_KEYS, "reject"),
    "silver_members": sql.having(sql.MEMBERS_CHECKED, "valid"),
    "silver_members_rejects": sql.having(sql.MEMBERS_CHECKED, "reject"),
    "silver_providers": sql.having(sql.PROVIDERS_CHECKED, "valid"),
    "silver_providers_rejects": sql.having(sql.PROVIDERS_CHECKED, "reject"),
    "silver_payments_valid": sql.having(sql.PAYMENTS_CHECKED, "valid"),
    "silver_payments_rejects": sql.having(sql.PAYMENTS_CHECKED, "reject"),
    "reject_profile": sql.REJECT_PROFILE,
    "dq_summary": sql.DQ_SUMMARY,
    "conform_drift": _DRIFT_SQL,
    "name_split": (
        f"SELECT member_id, full_name, {sql.names()}, {BATCH}"
        f" FROM ({VIEWS['members'].oracle_sql}) AS b"
    ),
    "dim_member_current": sql.DIM_MEMBER,
    "dim_provider_current": sql.DIM_PROVIDER,
    "fact_claim": sql.FACT_CLAIM,
    "fact_payment": sql.FACT_PAYMENT,
    "fact_payment_linked": sql.FACT_LINKED_PAYMENT,
    "fact_payment_by_claim": sql.FACT_PAYMENT_BY_CLAIM,
    "fact_claim_text_keys": sql.FACT_CLAIM_TEXT_KEYS,
    "surrogate_key_distributed": _LINE_KEYS_SQL,
    "surrogate_key_repeated_keys": _REPEATED_KEYS_SQL,
    "scd2_dedup_history": (
        f"SELECT {_HISTORY_COLUMNS} FROM ({sql.distinct_history('provider_history')}) AS d"
    ),
    "scd2_change_rows": (
        "SELECT provider_id, CAST(updated_at AS STRING) AS updated_at, record_hash, change_hash"
        f" FROM ({sql.change_rows('provider_history')}) AS c"
    ),
    "scd2_history": sql.versions("provider_history"),
    "scd2_history_in_ranges": sql.versions("provider_history"),
    "scd2_current": sql.current("provider_history"),
    "mart_claim_cost_by_month": sql.COST_BY_MONTH,
    "mart_denial_analysis": sql.DENIALS,
    "mart_provider_performance": sql.PROVIDER_PERFORMANCE,
    "mart_member_utilization": sql.MEMBER_UTILIZATION,
    "mart_claim_turnaround": sql.TURNAROUND,
    "mart_emergency_claims": (
        "SELECT member_id, payer_id, count(DISTINCT claim_id) AS total_claims,"
        " count(*) FILTER (WHERE (claim_id + claim_line_id) % 3 = 0) AS emergency_claims"
        f" FROM ({sql.FACT_CLAIM}) AS f GROUP BY member_id, payer_id"
    ),
    "stored_layer_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows FROM ({query}) AS t"
        for name, query in _STORED_SQL.items()
    ),
    "stored_layer_reconciliation": " UNION ALL ".join(
        _totals_sql(name, query, clock) for name, (query, clock) in _TABLES_SQL.items()
    ),
}
