"""Plan-shape checks: no nested-loop joins except against
one-row frames, no row-at-a-time Python UDFs, filters and projections pushed
to the parquet scans."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from voltgrid.operators import views
from voltgrid.sources.testdata import adapter_tables

QUERIES = E.queries()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_at_a_time_python(spark, name):
    if name == "a01_isolation_forest_anomalies":
        pytest.skip("fits a model (action) — covered in test_isolation_forest")
    plan = _plan(QUERIES[name](spark, SF001))
    assert "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan


def test_station_filter_reaches_scans(spark):
    t = adapter_tables(spark, SF001)
    df = views.station_statistics(t, station_id="7")
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # the per-station filter is applied below every aggregate (pushed to the scans)
    assert text.count("user_id % 20") >= 3 or "PushedFilters" in _plan(df)


def test_projection_pruned_at_scan(spark):
    t = adapter_tables(spark, SF001)
    plan = _plan(views.geographic_distribution(t))
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line and "events" in line]
    assert scan and all("props" not in s for s in scan)   # props not needed by this view


def test_fanout_free_sums(spark, tables001):
    from pyspark.sql import functions as F
    total = tables001.usage.join(tables001.stations.select(F.col("id").alias("station_id")), "station_id") \
        .agg(F.sum("energy_consumed_kwh")).collect()[0][0]
    for op in (views.station_overview, views.station_performance, views.geographic_distribution):
        s = op(tables001).agg(F.sum("total_energy_kwh")).collect()[0][0]
        assert abs(s - float(total)) < 1e-6


def _op(line: str) -> str:
    return line.lstrip(" :+-").strip()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_window_pulls_everything_into_one_task(spark, name):
    """A window either has a partition key (hash exchange below it) or runs
    on a bounded top-k (TakeOrderedAndProject); an ``Exchange SinglePartition``
    directly below a window would gather a whole table into one task."""
    if name == "a01_isolation_forest_anomalies":
        pytest.skip("fits a model (action) — covered in test_isolation_forest")
    df = QUERIES[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(lines):
        if _op(line).startswith("Window ["):
            below = [_op(x) for x in lines[i + 1:] if not _op(x).startswith("Sort [")]
            assert below and not below[0].startswith("Exchange SinglePartition"), (name, line)
