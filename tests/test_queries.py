"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


def test_entry_has_rows_and_a_stable_schema(spark):
    result = contract.entry(spark)
    assert result.columns == ["filepath", "type", "jurisdiction", "status"]
    assert result.count() > 0
