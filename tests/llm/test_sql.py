"""Queries of the training-data operators against their SQL, over whole tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare
from docenrich.llm.oracle import ORACLE
from docenrich.llm.queries import QUERIES

#: Held against plain versions in the other modules of this folder.
PLAIN = {"op1_packing", "op3_html_text", "op5_quality", "op7_imatch", "op8_langid"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name, QUERIES, ORACLE) == ""


def test_every_query_is_checked():
    assert set(QUERIES) == PLAIN | set(ORACLE)
    assert QUERIES.items() <= contract.queries().items()
