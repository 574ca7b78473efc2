"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect("/root/testdata/sf0.001")


def test_contract_names_match():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship(spark, sf_dir):
    result = contract.entry(spark)
    assert result.columns[:2] == ["claim_year_month", "payer_id"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    assert differences(spark, connection, QUERIES[name], ORACLES[name], sf_dir) == []
