"""Every registered query of the core against DuckDB on the smallest test data."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from driver.catalog import CATALOG
from tests.compare import assert_same, connect

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, duck, name):
    assert_same(entry.queries()[name](spark, DATA), duck, entry.oracle_sql().get(name))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


_ALONE = f"""
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", None)
assert entry.queries()["db_totals"](spark, "{DATA}").count() == 1
"""


def test_entry_without_a_staging_folder(tmp_path):
    """A local session whose configuration names no folder, started apart from the one of the tests."""
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": entry.REPO}
    subprocess.run([sys.executable, "-c", _ALONE], env=env, cwd=tmp_path, check=True, timeout=300)
