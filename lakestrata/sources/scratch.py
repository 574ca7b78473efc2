"""Frames written to the folder that all executors share, for steps that need their input to stay as it is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str = "lakestrata") -> str:
    """A new path under ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="lakestrata-")
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


# Files that are written once and read back soon: digests and texts take about half the space.
COMPRESSED = {"compression": "zstd"}


def written(df: DataFrame, what: str) -> DataFrame:
    """The rows of ``df`` as a written table: later passes see the same rows, whatever executors are lost."""
    path = shared_folder(df.sparkSession, what)
    df.write.options(**COMPRESSED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
