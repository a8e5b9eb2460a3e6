"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
import check
from terraquilt.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["gas", "slope", "intercept", "r2", "n_years"]
    assert df.count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    verdict, _ = check.compare(spark, connection, SF_DIR, name, contract.queries(), contract.oracle_sql())
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict
