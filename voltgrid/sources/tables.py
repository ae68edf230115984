"""Scans of the canonical tables (S14, S15) and the ``Tables`` bundle.

A table lives at ``<root>/<name>`` as parquet (time series partitioned by
``date``). Reads use the fixed schema — no inference pass over 100 TB — and
filters/projections are plain DataFrame ops, which Catalyst pushes into the
parquet scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.schemas import DDL, conform, schema


def read_table(spark: SparkSession, root: str, name: str, filters: dict | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """Full scan with conjunctive equality filters and optional
    projection. ``filters={'station_id': '42'}`` reaches the scan as a
    pushed ``EqualTo`` predicate."""
    df = spark.read.schema(schema(name)).parquet(f"{root}/{name}")
    if filters:
        df = df.where(reduce(lambda a, b: a & b,
                             [F.col(k).eqNullSafe(F.lit(v)) if v is None else F.col(k) == F.lit(v)
                              for k, v in filters.items()]))
    if columns:
        df = df.select(*columns)
    return df


@dataclass(frozen=True)
class Tables:
    """The canonical tables as lazy DataFrames. Derived tables
    (energy_consumption, engineered_features) are computed on demand."""

    stations: DataFrame
    points: DataFrame
    usage: DataFrame
    weather: DataFrame
    traffic: DataFrame
    anomalies: DataFrame
    log: DataFrame
    energy: DataFrame | None = None

    def with_energy(self) -> "Tables":
        if self.energy is not None:
            return self
        from voltgrid.operators.derived import energy_consumption_daily
        return replace(self, energy=energy_consumption_daily(self.usage))

    def where_station(self, station_id: str) -> "Tables":
        """Restrict every per-station table to one station (the reference's
        optional ``station_id`` argument); pushed into each scan."""
        def f(df, col):
            return df.where(F.col(col) == F.lit(station_id))
        return Tables(stations=f(self.stations, "id"), points=f(self.points, "station_id"),
                      usage=f(self.usage, "station_id"), weather=f(self.weather, "station_id"),
                      traffic=f(self.traffic, "station_id"), anomalies=f(self.anomalies, "station_id"),
                      log=self.log,
                      energy=None if self.energy is None else f(self.energy, "station_id"))


UPSERTED = ("charging_stations", "charging_points")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds files under ``path`` (any store it reads)."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_if_there(spark: SparkSession, ddl: str, path: str) -> DataFrame:
    """The parquet table at ``path`` with its partition columns; empty if
    there is none."""
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", path).parquet(path)


def load_tables(spark: SparkSession, root: str) -> Tables:
    """Canonical tables stored under ``root`` as the sinks write them: the
    upserted tables (stations, points; all ``bucket=`` directories), and the
    appended time series (all ``load=`` / ``date=`` directories; date
    filters prune partitions). A table that does not exist yet is empty."""
    def r(n):
        parts = "" if n in UPSERTED else ", load string" + ("" if "date" in schema(n).names else ", date date")
        return conform(read_if_there(spark, DDL[n] + parts, f"{root}/{n}"), n)
    return Tables(stations=r("charging_stations"), points=r("charging_points"),
                  usage=r("usage_data"), weather=r("weather_data"), traffic=r("traffic_data"),
                  anomalies=r("anomaly_detection"), log=r("data_collection_log"))
