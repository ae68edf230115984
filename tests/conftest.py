import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
AS_OF = dt.datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="voltgrid-tests-", dir="/tmp")
    s = (SparkSession.builder.master("local[*]").appName("voltgrid-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    """A fresh folder per test (never cleared in place)."""
    return tempfile.mkdtemp(prefix="voltgrid-t-", dir="/tmp")


@pytest.fixture(scope="session")
def tables001(spark):
    from voltgrid.sources.testdata import adapter_tables
    return adapter_tables(spark, SF001)


@pytest.fixture(scope="session")
def tables01(spark):
    from voltgrid.sources.testdata import adapter_tables
    return adapter_tables(spark, SF01)
