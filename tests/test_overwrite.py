"""Overwrites replace the whole table, whatever the session's overwrite mode."""

from lakestrata.operators.quality import OUTCOME
from lakestrata.sources.store import REJECT, VALID, LayerStore


class Rows:
    def __init__(self, rows):
        self.rows = rows


def test_no_reject_survives_a_dynamic_overwrite(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    schema = f"id int, reject_reason string, {OUTCOME} string"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        both = spark.createDataFrame([(1, None, VALID), (2, "bad", REJECT)], schema)
        assert store.write_checked(Rows(both), "silver_claims") == (1, 1)
        one = spark.createDataFrame([(1, None, VALID)], schema)
        assert store.write_checked(Rows(one), "silver_claims") == (1, 0)
        assert store.read("silver_claims").count() == 1
        assert store.read("silver_claims_rejects").count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
