"""Cleaning and validation rules (stateless, row-local: they run
inside the scan's codegen stage, batch or streaming alike).

Deliberate difference (SURVEY §1.4.9): a NULL text field becomes ``''`` (or its
documented default), never the string ``'None'``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from voltgrid.functions.columns import clean_numeric, clean_text, ntz_literal
from voltgrid.schemas import conform

# Fixed values of the cleaning rules: text widths of the reporting database
# (``WIDTHS``, for callers that load into such columns; texts are kept whole by
# default), defaults and numeric ranges.
WIDTHS = {"name": 500, "address": 1000, "city": 255, "state": 255, "country": 255, "operator": 255,
          "network": 255, "access_type": 100, "pricing_info": 1000, "amenities": 1000, "status": 50,
          "weather_condition": 100, "congestion_level": 50, "road_type": 100}
STATION_TEXT = ["name", "address", "city", "state", "country", "operator", "network", "access_type",
                "pricing_info", "amenities"]
STATUS_DEFAULT = "Unknown"
WEATHER_RANGES = {"temperature_celsius": (-50, 60), "humidity_percent": (0, 100), "pressure_hpa": (800, 1100),
                  "wind_speed_ms": (0, 100), "wind_direction_degrees": (0, 360), "precipitation_mm": (0, 1000),
                  "visibility_km": (0, 50), "uv_index": (0, 15)}
TRAFFIC_RANGES = {"traffic_density": (0, 1000), "average_speed_kmh": (0, 200), "distance_to_station_km": (0, 100)}
CONGESTION_DEFAULT = "unknown"
ROAD_DEFAULT = "highway"


def _truthy(df: DataFrame, c: str):
    """Python truthiness of a scalar field: text is truthy unless NULL or
    empty (``'0'`` is truthy), a number unless NULL or 0."""
    v = F.col(c)
    if isinstance(df.schema[c].dataType, StringType):
        return v.isNotNull() & (v != "")
    return v.isNotNull() & (v.cast("double") != 0)


def _col_or_null(df: DataFrame, c: str, typ: str = "string"):
    return F.col(c) if c in df.columns else F.lit(None).cast(typ)


def _coordinates() -> tuple[Column, Column]:
    return (F.col("latitude").try_cast("double").try_cast("decimal(10,8)"),
            F.col("longitude").try_cast("double").try_cast("decimal(11,8)"))


def _located(df: DataFrame) -> Column:
    """The rows that C01 keeps."""
    lat, lon = _coordinates()
    return (_truthy(df, "id") & lat.isNotNull() & (lat != 0) & lon.isNotNull() & (lon != 0)
            & lat.between(-90, 90) & lon.between(-180, 180))


def _observed(df: DataFrame) -> Column:
    """The rows that C02 and C03 keep."""
    return F.col("timestamp").isNotNull() & _truthy(df, "station_id")


KEPT = {"stations": _located, "weather": _observed, "traffic": _observed}


def clean_stations(df: DataFrame, as_of: _dt.datetime, widths: dict | None = None) -> DataFrame:
    """Keep stations with a truthy id, latitude and longitude inside
    [-90, 90] × [-180, 180]; trim the text fields (and cut them to ``widths``); stamp
    ``as_of``.
    Coordinates are judged at their stored precision (decimal(10,8) /
    decimal(11,8)), so a value that would be stored as 0 counts as missing
    and cleaning stays idempotent."""
    lat, lon = _coordinates()
    widths = widths or {}
    now = ntz_literal(as_of)
    out = df.where(_located(df)).select(
        F.trim(F.col("id").cast("string")).alias("id"),
        lat.alias("latitude"), lon.alias("longitude"),
        *[clean_text(_col_or_null(df, c), widths.get(c)).alias(c) for c in STATION_TEXT],
        clean_text(_col_or_null(df, "status"), widths.get("status"), STATUS_DEFAULT).alias("status"),
        now.alias("created_at"), now.alias("updated_at"))
    return conform(out, "charging_stations")


def clean_weather(df: DataFrame, as_of: _dt.datetime, widths: dict | None = None) -> DataFrame:
    """Require timestamp and station; NULL every measure outside its
    physical range; trim the condition text."""
    widths = widths or {}
    out = df.where(_observed(df)).select(
        _col_or_null(df, "id", "bigint").alias("id"),
        F.trim(F.col("station_id").cast("string")).alias("station_id"), "timestamp",
        *[clean_numeric(_col_or_null(df, c, "double"), lo, hi).alias(c) for c, (lo, hi) in WEATHER_RANGES.items()],
        clean_text(_col_or_null(df, "weather_condition"), widths.get("weather_condition")).alias("weather_condition"),
        ntz_literal(as_of).alias("created_at"))
    return conform(out, "weather_data")


def clean_traffic(df: DataFrame, as_of: _dt.datetime, widths: dict | None = None) -> DataFrame:
    """Require timestamp and station; range rules; congestion and road
    defaults. Incident rows pass with NULL measures."""
    widths = widths or {}
    out = df.where(_observed(df)).select(
        _col_or_null(df, "id", "bigint").alias("id"),
        F.trim(F.col("station_id").cast("string")).alias("station_id"), "timestamp",
        *[clean_numeric(_col_or_null(df, c, "double"), lo, hi).alias(c) for c, (lo, hi) in TRAFFIC_RANGES.items()],
        clean_text(_col_or_null(df, "congestion_level"), widths.get("congestion_level"), CONGESTION_DEFAULT)
        .alias("congestion_level"),
        clean_text(_col_or_null(df, "road_type"), widths.get("road_type"), ROAD_DEFAULT).alias("road_type"),
        ntz_literal(as_of).alias("created_at"))
    return conform(out, "traffic_data")


def limit_stations(df: DataFrame, n: int | None = None) -> DataFrame:
    """The first ``n`` stations of a collection cycle, all of them
    without ``n``. Input order is not a Spark notion, so the first n by id — a
    top-k, not a sort of the whole table."""
    if n is None:
        return df
    return df.orderBy("id").limit(n)


def reject_report(raw: DataFrame, what: str) -> DataFrame:
    """C06: "cleaned n out of m" as one row, from one scan: the rows that the
    cleaning rule of ``what`` (stations, weather or traffic) keeps are counted
    beside all rows."""
    n = raw.agg(F.count(F.lit(1)).alias("raw_records"), F.count_if(KEPT[what](raw)).alias("clean_records"))
    return n.select(
        F.lit(what).alias("dataset"), "raw_records", "clean_records",
        (F.col("raw_records") - F.col("clean_records")).alias("rejected_records"),
        F.format_string(f"Cleaned %d out of %d {what} records", "clean_records", "raw_records").alias("message"))
