"""The four domains as views over the given tables.

Each view is a list of SQL columns that Spark and DuckDB read alike.  Bad
values, nulls, deletes, repeated rows and later versions are derived from the
keys, so they grow with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from lakestrata.functions.columns import row_digest

BATCH = "bronze_batch_id"


@dataclass(frozen=True)
class View:
    """Columns and their SQL, with a source clause per landing batch.

    ``changed`` replaces columns in the second batch.  ``lineage`` adds columns
    that are not source data; one source may hold several batches by giving
    its batch id there.
    """

    tables: tuple[str, ...]
    columns: dict[str, str]
    batches: tuple[str, ...]
    changed: dict[str, str] = field(default_factory=dict)
    lineage: dict[str, str] = field(default_factory=dict)

    @property
    def sql(self) -> str:
        parts = []
        for number, source in enumerate(self.batches, start=1):
            values = {**self.columns, **(self.changed if number > 1 else {})}
            values = {**values, BATCH: f"'batch_{number:03d}'", **self.lineage}
            items = ",\n  ".join(f"{sql} AS {name}" for name, sql in values.items())
            parts.append(f"SELECT {items}\nFROM {source}")
        return "\nUNION ALL\n".join(parts)

    @property
    def batch_names(self) -> list[str]:
        count = 2 if BATCH in self.lineage else len(self.batches)
        return [f"batch_{number:03d}" for number in range(1, count + 1)]

    @property
    def oracle_sql(self) -> str:
        """The view with its record hash, for the SQL side."""
        texts = ", ".join(f"COALESCE(CAST({c} AS STRING), 'NULL')" for c in self.columns)
        plain = self.sql.format(**{name: name for name in self.tables})
        return f"SELECT *, sha256(concat_ws('||', {texts})) AS record_hash FROM ({plain}) AS v"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The view with its record hash, for the Spark side."""
        main, *joined = self.tables
        inputs = {name: table(spark, sf_dir, name) for name in joined}
        inputs[main] = spread_table(spark, sf_dir, main)
        rows = spark.sql(self.sql, **inputs)
        return rows.withColumn("record_hash", row_digest(list(self.columns)))


@lru_cache(maxsize=32)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its files are listed once per session."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@lru_cache(maxsize=32)
def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    return table(spark, sf_dir, name).count()


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, spread over the cores when its file gives fewer tasks than that.

    The given files hold one row group each.  Data in many splits is left as it is.
    """
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    few = name in LARGE and rows.rdd.getNumPartitions() < cores
    return rows.repartition(cores, rows.columns[0]) if few else rows


LARGE = ("lineitem", "orders", "customer", "events")


CLAIMS = View(
    tables=("lineitem", "orders"),
    columns={
        "claim_id": "l.l_orderkey",
        "claim_line_id": "CASE WHEN l.l_orderkey % 113 = 0 THEN NULL ELSE l.l_linenumber END",
        "member_id": "CASE WHEN o.o_custkey % 101 = 0 THEN NULL ELSE o.o_custkey END",
        "provider_id": "CASE WHEN l.l_suppkey % 37 = 0 THEN NULL ELSE l.l_suppkey END",
        "payer_id": "'PAY' || lpad(CAST(1 + o.o_custkey % 3 AS STRING), 3, '0')",
        "diagnosis_code": "'D' || lpad(CAST(1 + l.l_partkey % 5 AS STRING), 3, '0')",
        "procedure_code": (
            "CASE WHEN l.l_partkey % 41 = 0 THEN NULL"
            " ELSE 'PROC' || CAST(100 + 100 * (l.l_partkey % 5) AS STRING) END"
        ),
        "claim_amount": (
            "CASE WHEN l.l_orderkey % 97 = 0 THEN NULL WHEN l.l_orderkey % 89 = 0 THEN 'abc'"
            " WHEN l.l_orderkey % 83 = 0 THEN '-' || CAST(l.l_extendedprice AS STRING)"
            " ELSE CAST(l.l_extendedprice AS STRING) END"
        ),
        "approved_amount": (
            "CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))"
            " * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(14,2)) AS STRING)"
        ),
        "paid_amount": (
            "CASE WHEN l.l_returnflag = 'A' THEN CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))"
            " * CAST(0.75 AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS STRING) END"
        ),
        "claim_status": (
            "CASE WHEN l.l_orderkey % 79 = 0 THEN 'UNKNOWN' WHEN l.l_orderkey % 73 = 0 THEN NULL"
            " WHEN l.l_returnflag = 'A' THEN ' approved' WHEN l.l_returnflag = 'R' THEN 'Denied'"
            " ELSE 'PENDING' END"
        ),
        "service_date": (
            "CASE WHEN l.l_orderkey % 71 = 0 THEN '2025-99-99'"
            " ELSE CAST(CAST(l.l_shipdate AS DATE) AS STRING) END"
        ),
        "received_date": (
            "CAST(CAST(l.l_shipdate AS DATE) + CAST(l.l_partkey % 11 AS INT) AS STRING)"
        ),
        "updated_at": "CAST(l.l_shipdate AS STRING)",
        "source_delete_flag": (
            "CASE WHEN l.l_partkey % 53 = 0 THEN 'y' WHEN l.l_partkey % 59 = 0 THEN ' Y '"
            " WHEN l.l_partkey % 7 = 0 THEN NULL ELSE 'N' END"
        ),
    },
    lineage={BATCH: "CASE WHEN l.l_partkey % 4 = 0 THEN 'batch_002' ELSE 'batch_001' END"},
    batches=("{lineitem} AS l LEFT JOIN {orders} AS o ON l.l_orderkey = o.o_orderkey",),
)

_MEMBER_SOURCE = "{customer} AS c LEFT JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey"

MEMBERS = View(
    tables=("customer", "nation"),
    columns={
        "member_id": "CASE WHEN c.c_custkey % 211 = 0 THEN NULL ELSE c.c_custkey END",
        "full_name": (
            "CASE c.c_custkey % 4 WHEN 0 THEN c.c_name WHEN 1 THEN '  Ann ' || c.c_name || ' Third '"
            " WHEN 2 THEN 'Ravi  ' || c.c_name ELSE NULL END"
        ),
        "gender": "CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
        "dob": (
            "CASE WHEN c.c_custkey % 29 = 0 THEN 'unknown' ELSE"
            " CAST(DATE '1950-01-01' + CAST(c.c_custkey % 20000 AS INT) AS STRING) END"
        ),
        "city": "'City ' || CAST(c.c_custkey % 50 AS STRING)",
        "state": "n.n_name",
        "plan_id": "CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE 'PLN_' || c.c_mktsegment END",
        "risk_score": (
            "CASE WHEN c.c_custkey % 13 = 0 THEN 'n/a' ELSE CAST(c.c_acctbal AS STRING) END"
        ),
        "member_status": (
            "CASE c.c_custkey % 3 WHEN 0 THEN ' active ' WHEN 1 THEN NULL ELSE 'Suspended' END"
        ),
        "updated_at": "'2025-12-01 10:00:00'",
        "source_delete_flag": "CASE WHEN c.c_custkey % 31 = 0 THEN 'Y' ELSE NULL END",
    },
    changed={
        "city": "'New City ' || CAST(c.c_custkey % 50 AS STRING)",
        "updated_at": "'2025-12-15 11:00:00'",
    },
    batches=(_MEMBER_SOURCE, f"{_MEMBER_SOURCE} WHERE c.c_custkey % 5 = 0"),
)

_PROVIDER_SOURCE = "{supplier} AS s LEFT JOIN {nation} AS n ON s.s_nationkey = n.n_nationkey"

PROVIDERS = View(
    tables=("supplier", "nation"),
    columns={
        "provider_id": "CASE WHEN s.s_suppkey % 61 = 0 THEN NULL ELSE s.s_suppkey END",
        "provider_name": "s.s_name",
        "specialty": (
            "CASE s.s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Cardiology' ELSE 'Neurology' END"
        ),
        "network_flag": "CASE s.s_suppkey % 3 WHEN 0 THEN ' y' WHEN 1 THEN 'N' ELSE NULL END",
        "address": "'Street ' || CAST(s.s_suppkey % 90 AS STRING)",
        "city": "'City ' || CAST(s.s_suppkey % 50 AS STRING)",
        "state": "n.n_name",
        "quality_score": "CAST(s.s_acctbal AS STRING)",
        "updated_at": "'2025-12-01 09:00:00'",
        "source_delete_flag": "CASE WHEN s.s_suppkey % 43 = 0 THEN 'Y' ELSE 'N' END",
    },
    changed={
        "specialty": "'General Medicine'",
        "updated_at": "'2025-12-20 09:30:00'",
    },
    batches=(_PROVIDER_SOURCE, f"{_PROVIDER_SOURCE} WHERE s.s_suppkey % 6 = 0"),
)

_PAYMENT_COLUMNS = {
    "payment_id": "CASE WHEN o.o_orderkey % 223 = 0 THEN NULL ELSE o.o_orderkey END",
    "claim_id": "CASE WHEN o.o_orderkey % 109 = 0 THEN NULL ELSE o.o_orderkey END",
    "paid_amount": (
        "CASE WHEN o.o_orderkey % 67 = 0 THEN '-' || CAST(o.o_totalprice AS STRING)"
        " WHEN o.o_orderkey % 61 = 0 THEN NULL ELSE CAST(o.o_totalprice AS STRING) END"
    ),
    "payment_date": (
        "CASE WHEN o.o_orderkey % 47 = 0 THEN 'soon'"
        " ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END"
    ),
    "payment_status": (
        "CASE o.o_orderstatus WHEN 'P' THEN 'partial' WHEN 'F' THEN ' PAID' ELSE 'ON_HOLD' END"
    ),
}
# Payments carry no update time; only the load time and the batch order them.
_LOADED = {"ingestion_timestamp": "CAST('2025-12-21 00:00:00' AS TIMESTAMP)"}

PAYMENTS = View(
    tables=("orders",),
    columns=_PAYMENT_COLUMNS,
    changed={"payment_status": "'paid'"},
    lineage=_LOADED,
    batches=("{orders} AS o", "{orders} AS o WHERE o.o_orderkey % 10 = 0"),
)

# Payments that do name their claim line, member and provider.
LINKED_PAYMENTS = View(
    tables=("orders",),
    columns={
        **_PAYMENT_COLUMNS,
        "claim_line_id": (
            "CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE CAST(1 + o.o_orderkey % 7 AS INT) END"
        ),
        "member_id": "CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE o.o_custkey END",
        "provider_id": "CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE o.o_custkey % 120 END",
    },
    lineage=_LOADED,
    batches=("{orders} AS o",),
)

PROVIDER_HISTORY = View(
    tables=("events",),
    columns={
        "provider_id": "CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE e.user_id END",
        "provider_name": "'Provider ' || CAST(e.user_id AS STRING)",
        "specialty": "CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE e.event_type END",
        "network_flag": (
            "CASE WHEN e.event_id % 83 = 0 THEN 'X' WHEN e.event_id % 2 = 0 THEN 'y' ELSE 'N' END"
        ),
        "address": "'Street ' || CAST(e.user_id % 90 AS STRING)",
        "city": "'City ' || CAST(e.user_id % 50 AS STRING)",
        "state": "CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE 'State' END",
        "quality_score": "CAST(e.value AS STRING)",
        "updated_at": "CAST(date_trunc('hour', e.ts) AS STRING)",
        "source_delete_flag": "CASE WHEN e.event_id % 29 = 0 THEN 'Y' ELSE 'N' END",
    },
    batches=("{events} AS e", "{events} AS e WHERE e.event_id % 10 = 0"),
)

VIEWS = {
    "claims": CLAIMS,
    "members": MEMBERS,
    "providers": PROVIDERS,
    "payments": PAYMENTS,
    "linked_payments": LINKED_PAYMENTS,
    "provider_history": PROVIDER_HISTORY,
}
