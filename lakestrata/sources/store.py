"""Layer tables addressed by name."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.types import common_types, disagree, widened
from lakestrata.operators.quality import OUTCOME, REJECT, VALID, Checked
from lakestrata.sources.files import Files
from lakestrata.sources.scratch import COMPRESSED, written

# Where each table lives under the root.
TABLES = {
    "bronze_claims": "bronze/claims",
    "bronze_members": "bronze/members",
    "bronze_providers": "bronze/providers",
    "bronze_payments": "bronze/payments",
    "silver_claims": "silver/claims",
    "silver_members": "silver/members",
    "silver_providers": "silver/providers",
    "silver_payments": "silver/payments",
    "silver_claims_rejects": "silver/claims_rejects",
    "silver_members_rejects": "silver/members_rejects",
    "silver_providers_rejects": "silver/providers_rejects",
    "silver_payments_rejects": "silver/payments_rejects",
    "dim_member_current": "gold/dim_member_current",
    "dim_provider_current": "gold/dim_provider_current",
    "dim_provider_scd2": "gold/dim_provider_scd2",
    "fact_claim": "gold/fact_claim",
    "fact_payment": "gold/fact_payment",
    "gold_claim_cost_by_month": "gold/marts/claim_cost_by_month",
    "gold_denial_analysis": "gold/marts/denial_analysis",
    "gold_provider_performance": "gold/marts/provider_performance",
    "gold_member_utilization": "gold/marts/member_utilization",
    "gold_claim_turnaround_time": "gold/marts/claim_turnaround_time",
}

REJECTS_SUFFIX = "_rejects"

# Formats that are plain files in a folder, so that a table can be replaced by a rename.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


class LayerStore:
    """Reads and writes the tables of one lake.

    ``fmt`` is any Spark file format; "delta" works where the session has it.
    Parquet and ORC are compressed with zstd unless ``write_options`` say otherwise.
    ``tables`` moves tables: a name and its path, under the root or absolute.

    A plain-file table is replaced by writing the new rows next to it and then
    renaming, so a job that fails leaves the old rows, and a table may be
    written from a frame that reads it.  If a run dies between the two renames,
    the next use of the table puts the old rows back.  Frames read before a
    replacement list files that are gone; read the table again.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fmt: str = "parquet",
        write_options: Mapping[str, str] | None = None,
        read_options: Mapping[str, str] | None = None,
        tables: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        packing = COMPRESSED if fmt in ("parquet", "orc") else {}
        self.write_options = {**packing, **(write_options or {})}
        self.read_options = dict(read_options or {})
        unknown = set(tables or {}) - set(TABLES)
        if unknown:
            raise KeyError(f"no such tables: {sorted(unknown)}")
        self.tables = {**TABLES, **(tables or {})}
        self.files = Files(spark)

    def path(self, name: str) -> str:
        place = self.tables[name]
        absolute = place.startswith("/") or "://" in place
        return place.rstrip("/") if absolute else f"{self.root}/{place}"

    def read(self, name: str) -> DataFrame:
        self._restore(name)
        options = dict(self.read_options)
        if name.startswith("bronze_"):
            # Appended batches may have brought columns that older files lack.
            options.setdefault("mergeSchema", "true")
        return self.spark.read.format(self.fmt).options(**options).load(self.path(name))

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
    ) -> int:
        """Store a table and return the count of the rows written, taken while writing.

        Appended rows whose columns have other types than the stored ones
        rewrite the table once, with a type that holds both.
        """
        counted = Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        if mode == "append" and self._types_differ(name, df):
            stored = self.read(name)
            kinds = common_types([stored.schema, df.schema])
            rows = widened(stored, kinds).unionByName(widened(rows, kinds), allowMissingColumns=True)
            mode = "overwrite"
        self._save(rows, name, mode, partition_by)
        return counted.get["rows"]

    def write_checked(self, checked: Checked, name: str) -> tuple[int, int]:
        """Store valid rows and rejects as two tables; return the two counts.

        Both come from one pass over the annotated rows.  Deleted rows are not
        stored.
        """
        counted = Observation()
        rows = checked.rows.where(F.col(OUTCOME).isin(VALID, REJECT))
        observed = rows.observe(
            counted,
            F.count_if(F.col(OUTCOME) == VALID).alias("valid"),
            F.count_if(F.col(OUTCOME) == REJECT).alias("rejects"),
        )
        targets = {VALID: name, REJECT: f"{name}{REJECTS_SUFFIX}"}
        if self.fmt in FILE_FORMATS:
            self._split(observed, targets)
        else:
            annotated = written(observed, "annotated")
            for outcome, target in targets.items():
                part = annotated.where(F.col(OUTCOME) == outcome).drop(OUTCOME)
                self._save(part, target, "overwrite", ())
        return counted.get["valid"], counted.get["rejects"]

    def _split(self, rows: DataFrame, targets: Mapping[str, str]) -> None:
        """Write rows once, parted by outcome, and rename each part into its table."""
        both = self._beside(targets[VALID], f"next-{uuid.uuid4().hex}")
        try:
            writer = rows.write.format(self.fmt).options(**self.write_options)
            writer.partitionBy(OUTCOME).save(both)
            for outcome, target in targets.items():
                part = f"{both}/{OUTCOME}={outcome}"
                if not self.files.exists(part):
                    # No row has this outcome, so there is no file to take the columns from.
                    empty = self.spark.createDataFrame([], rows.drop(OUTCOME).schema)
                    empty.write.format(self.fmt).options(**self.write_options).save(part)
                self._replace(target, part)
        finally:
            self.files.delete(both)

    def _types_differ(self, name: str, df: DataFrame) -> bool:
        plain = self.fmt in FILE_FORMATS and self.files.exists(self.path(name))
        return plain and disagree([self.read(name).schema, df.schema])

    def _save(self, df: DataFrame, name: str, mode: str, partition_by: Sequence[str]) -> None:
        def save(path: str, mode: str) -> None:
            writer = df.write.format(self.fmt).mode(mode).options(**self.write_options)
            if mode == "overwrite":
                # A session set to dynamic overwrites would keep the partition that gets no rows this time.
                writer = writer.option("partitionOverwriteMode", "static")
            (writer.partitionBy(*partition_by) if partition_by else writer).save(path)

        if mode != "overwrite" or self.fmt not in FILE_FORMATS:
            self._restore(name)
            return save(self.path(name), mode)
        following = self._beside(name, f"next-{uuid.uuid4().hex}")
        try:
            save(following, "error")
            self._replace(name, following)
        finally:
            self.files.delete(following)

    def _beside(self, name: str, what: str) -> str:
        """A hidden path next to the table, in the same file system."""
        folder, _, last = self.path(name).rpartition("/")
        return f"{folder}/.{last}.{what}"

    def _replace(self, name: str, following: str) -> None:
        path, previous = self.path(name), self._beside(name, "previous")
        self._restore(name)
        if self.files.exists(path):
            self.files.delete(previous)
            self.files.rename(path, previous)
        self.files.rename(following, path)
        self.files.delete(previous)

    def _restore(self, name: str) -> None:
        """Undo half a replacement that a lost run left behind."""
        path, previous = self.path(name), self._beside(name, "previous")
        if self.fmt in FILE_FORMATS and not self.files.exists(path) and self.files.exists(previous):
            self.files.rename(previous, path)
