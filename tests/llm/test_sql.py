"""The text queries that SQL can express, against it."""

import pytest

import check
from terraquilt.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    verdict, _ = check.compare(spark, check.connect(sf_dir), sf_dir, name, queries.QUERIES, queries.SQL)
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
