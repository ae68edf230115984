"""A second mapping of the test tables, for the rules that the plain adapter
never sets off: demand, hours and days are uneven, some stations have no
session, points and prices differ widely. Whole tables, other columns: the
definitions stand in Spark and in SQL, as in ``sources.testdata``.

- a session of user u belongs to station ``(u % 103)² % 103``, so about half of
  the stations have none and the others twice as many;
- it starts in hour ``h² % 24`` (one hour has a third of all) on day 10 of the
  month at the latest (that day has two thirds of all);
- odd users pay a hundredth;
- every even point is a station's only one, the odd ones share seven stations.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voltgrid.schemas import conform
from voltgrid.sources.tables import Tables
from voltgrid.sources.testdata import ADAPTER_SQL, STATION_MODULUS, adapter_tables


def uneven_tables(spark: SparkSession, root: str) -> Tables:
    user, ts = F.col("user_id") % STATION_MODULUS, F.col("ts")
    usage = spark.read.parquet(f"{root}/events.parquet").where(F.col("event_type").isin("click", "purchase")).select(
        F.col("event_id").alias("id"), (user * user % STATION_MODULUS).cast("string").alias("station_id"),
        F.make_timestamp_ntz(F.year(ts), F.month(ts), F.least(F.dayofmonth(ts), F.lit(10)), F.hour(ts) * F.hour(ts) % 24,
                             F.lit(0), F.lit(0)).alias("session_start"),
        F.col("value").cast("decimal(10,3)").alias("energy_consumed_kwh"),
        F.floor("value").cast("int").alias("duration_minutes"),
        F.when(user % 2 == 1, F.floor("value") / 100).otherwise(F.floor("value")).cast("decimal(10,2)").alias("cost"),
        F.col("event_type").alias("user_type"))
    part = F.col("p_partkey")
    points = spark.read.parquet(f"{root}/part.parquet").select(
        part.cast("string").alias("id"), F.when(part % 2 == 0, part).otherwise(part % 7).cast("string").alias("station_id"),
        F.col("p_type").alias("connector_type"), (F.col("p_size") * 3.6).cast("decimal(8,2)").alias("power_kw"))
    return replace(adapter_tables(spark, root), usage=conform(usage, "usage_data"),
                   points=conform(points, "charging_points"))


_USER = f"(user_id % {STATION_MODULUS})"
UNEVEN_SQL = ADAPTER_SQL | {
    "usage_data": f"""
        SELECT event_id AS id, CAST({_USER} * {_USER} % {STATION_MODULUS} AS VARCHAR) AS station_id,
               make_timestamp(year(ts), month(ts), least(day(ts), 10), hour(ts) * hour(ts) % 24, 0, 0.0) AS session_start,
               CAST(value AS DECIMAL(10,3)) AS energy_consumed_kwh, CAST(floor(value) AS INTEGER) AS duration_minutes,
               CAST(CASE WHEN {_USER} % 2 = 1 THEN floor(value) / 100 ELSE floor(value) END AS DECIMAL(10,2)) AS cost,
               event_type AS user_type
        FROM events WHERE event_type IN ('click', 'purchase')""",
    "charging_points": """
        SELECT CAST(p_partkey AS VARCHAR) AS id,
               CAST(CASE WHEN p_partkey % 2 = 0 THEN p_partkey ELSE p_partkey % 7 END AS VARCHAR) AS station_id,
               p_type AS connector_type, CAST(p_size * 3.6 AS DECIMAL(8,2)) AS power_kw
        FROM part""",
}
