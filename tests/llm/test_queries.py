"""Every registered query of the operators, and the pipeline, against DuckDB on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry
from spanloom.llm.queries import LLM_QUERIES
from tests.compare import assert_same, connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted([*LLM_QUERIES, "pipeline"]))
def test_query(spark, duck, name):
    assert_same(entry.queries()[name](spark, DATA), duck, entry.oracle_sql().get(name))
