"""CSV export of the reporting views and raw tables, and
the typed reader for exported files.

Export is orchestration on the driver (one distributed CSV write per view);
no data passes through the driver. An empty result writes no file (K11).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from voltgrid.operators import views
from voltgrid.operators.features import engineer_features
from voltgrid.schemas import schema
from voltgrid.sinks.tables import export_csv
from voltgrid.sources.tables import Tables

# Exported view names (file stem) and raw tables, in export order.
VIEW_NAMES = ["station_overview", "usage_patterns", "weather_correlation", "traffic_correlation",
              "energy_trends", "anomaly_summary", "station_performance", "hourly_usage_heatmap",
              "geographic_distribution", "data_collection_status"]
RAW_TABLES = ["charging_stations", "charging_points", "usage_data", "weather_data", "traffic_data",
              "energy_consumption", "anomaly_detection", "engineered_features", "data_collection_log"]
FILE_PREFIX = "tableau_"


def view_builders(as_of: _dt.datetime) -> dict[str, Callable[[Tables], DataFrame]]:
    return {
        "station_overview": views.station_overview,
        "usage_patterns": views.usage_patterns,
        "weather_correlation": views.weather_correlation,
        "traffic_correlation": views.traffic_correlation,
        "energy_trends": views.energy_trends,
        "anomaly_summary": lambda t: views.anomaly_summary(t, as_of),
        "station_performance": views.station_performance,
        "hourly_usage_heatmap": views.hourly_heatmap,
        "geographic_distribution": views.geographic_distribution,
        "data_collection_status": views.collection_status,
    }


def empty_tables(spark: SparkSession) -> Tables:
    e = lambda n: spark.createDataFrame([], schema(n))
    return Tables(stations=e("charging_stations"), points=e("charging_points"), usage=e("usage_data"),
                  weather=e("weather_data"), traffic=e("traffic_data"), anomalies=e("anomaly_detection"),
                  log=e("data_collection_log"), energy=e("energy_consumption"))


def view_schema(spark: SparkSession, name: str) -> StructType:
    """Output schema of an exported view, from analysis only (no job runs)."""
    return view_builders(_dt.datetime(1970, 1, 1))[name](empty_tables(spark)).schema


def export_view(t: Tables, name: str, directory: str, as_of: _dt.datetime, prefix: str = FILE_PREFIX) -> bool:
    """One view as CSV (our overview is already the scalable
    pre-aggregated form, so it needs no fallback)."""
    return export_csv(view_builders(as_of)[name](t), directory, f"{prefix}{name}")


def export_table(df: DataFrame, name: str, directory: str) -> bool:
    """A raw table as CSV."""
    return export_csv(df, directory, name)


def export_all(t: Tables, out_root: str, as_of: _dt.datetime, raw: dict[str, DataFrame] | None = None,
               stamp: str | None = None) -> dict[str, bool]:
    """``out_root/<yyyymmdd_HHMMSS>/`` with every non-empty view, then the
    raw tables (``raw`` maps table name → frame; defaults to the bundle's and
    the features computed from it)."""
    stamp = stamp or as_of.strftime("%Y%m%d_%H%M%S")
    directory = f"{out_root}/{stamp}"
    t = t.with_energy()
    written = {f"{FILE_PREFIX}{n}": export_view(t, n, directory, as_of) for n in VIEW_NAMES}
    raw = raw if raw is not None else {
        "charging_stations": t.stations, "charging_points": t.points, "usage_data": t.usage,
        "weather_data": t.weather, "traffic_data": t.traffic, "energy_consumption": t.energy,
        "anomaly_detection": t.anomalies, "data_collection_log": t.log,
        "engineered_features": engineer_features(t.stations, t.weather, t.traffic, as_of)}
    for name in RAW_TABLES:
        if name in raw:
            written[name] = export_table(raw[name], name, directory)
    return written


def read_export_csv(spark: SparkSession, path: str, view: str) -> DataFrame:
    """An exported view read back with its exact schema (header line,
    ``"``-escaped quotes, empty field = NULL). The schema is explicit because
    wholly empty columns would otherwise be inferred as strings."""
    return (spark.read.schema(view_schema(spark, view)).option("header", True).option("escape", '"')
            .option("nullValue", "").csv(path))
