"""S14/S15 scans of a stored table and D03 lookups: equality filters reach
the parquet scan, projections prune the read schema."""

from conftest import SF001
from voltgrid.operators.derived import lookup
from voltgrid.sinks.tables import append
from voltgrid.sources.tables import read_table
from voltgrid.sources.testdata import adapter_tables


def test_read_table_pushdown_and_pruning(spark, scratch):
    t = adapter_tables(spark, SF001)
    append(t.usage, scratch, "usage_data", partition_by="date")
    df = read_table(spark, scratch, "usage_data", filters={"station_id": "3"},
                    columns=["id", "station_id", "cost"])
    assert df.count() == t.usage.where("station_id = '3'").count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "EqualTo(station_id,3)" in scan
    read_schema = scan.split("ReadSchema: ")[1]
    assert "session_start" not in read_schema and "cost" in read_schema


def test_lookups(spark, tables001):
    assert lookup(tables001.stations, "id", "3").count() == 1
    assert lookup(tables001.weather, "station_id", "3").count() == \
        tables001.weather.where("station_id = '3'").count()
