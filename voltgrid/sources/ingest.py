"""Landing-zone JSON readers (re-aimed from the HTTP collectors).

Every reader uses a fixed schema (no inference pass), PERMISSIVE mode with a
corrupt-record column (broken lines are counted, not fatal), and row-local
expressions only: nested documents are flattened with ``explode`` where a row
per element is the result (stations → connections, incidents), and with
higher-order array functions (``transform``/``filter``/``aggregate``) where a
document reduces to one row (traffic flow) — no shuffle either way.

Documents may carry ``station_id`` (and for traffic ``observed_at``) fields
set by the landing process; otherwise the station is attached by S08.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.functions.columns import (congestion_of_speed, first_nonzero, haversine_km,  # noqa: F401
                                        instant_to_ntz, ntz_literal)

CORRUPT = "_corrupt_record"

# ---------------------------------------------------------------- schemas

STATION_DOC = (
    "ID bigint, "
    "AddressInfo struct<Title: string, Latitude: double, Longitude: double, AddressLine1: string, "
    "Town: string, StateOrProvince: string, Country: struct<Title: string, ISOCode: string>>, "
    "OperatorInfo struct<Title: string>, Network struct<Title: string>, StatusType struct<Title: string>, "
    "AccessComments string, UsageCost string, "
    "UsageType struct<IsAccessKeyRequired: boolean, IsMembershipRequired: boolean, IsPayAtLocation: boolean>, "
    "Connections array<struct<ID: bigint, ConnectionType: struct<ID: bigint, Title: string>, PowerKW: double, "
    "Voltage: double, Amperage: double, StatusType: struct<Title: string>>>, "
    f"{CORRUPT} string")

_WEATHER_ITEM = (
    "dt bigint, main struct<temp: double, humidity: double, pressure: double>, "
    "temp double, humidity double, pressure double, "
    "weather array<struct<main: string, description: string>>, wind struct<speed: double, deg: double>, "
    "clouds struct<all: double>, rain struct<`1h`: double, `3h`: double>, "
    "snow struct<`1h`: double, `3h`: double>, visibility double, uvi double")
WEATHER_DOC = (f"station_id string, {_WEATHER_ITEM}, list array<struct<{_WEATHER_ITEM}>>, "
               f"data array<struct<{_WEATHER_ITEM}>>, {CORRUPT} string")
TRAFFIC_FLOW_DOC = (
    "station_id string, observed_at timestamp_ntz, latitude double, longitude double, "
    "RWS array<struct<RW: array<struct<FIS: array<struct<FI: array<struct<"
    "CF: array<struct<SP: double, JF: double>>>>>>>>>>, "
    f"{CORRUPT} string")
INCIDENT_DOC = (
    "station_id string, observed_at timestamp_ntz, latitude double, longitude double, "
    "TRAFFIC_ITEMS struct<TRAFFIC_ITEM: array<struct<TRAFFIC_ITEM_TYPE_DESC: string, "
    "TRAFFIC_ITEM_DESCRIPTION: array<struct<value: string>>, CRITICALITY: struct<ID: string>, "
    "LOCATION: struct<GEOLOC: struct<ORIGIN: struct<LATITUDE: double, LONGITUDE: double>>>>>>, "
    f"{CORRUPT} string")


def _opt(df: DataFrame, name: str, typ: str) -> Column:
    """An optional landing field: the column, or a typed NULL when absent."""
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def read_json(spark: SparkSession, path: str, ddl: str, multi_line: bool = False) -> DataFrame:
    """Schema-on-read JSON scan; malformed documents land in ``_corrupt_record``."""
    return (spark.read.schema(ddl).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).json(path))


def valid(docs: DataFrame) -> DataFrame:
    """Documents that parsed (the corrupt-record column is NULL)."""
    return docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in docs.columns else docs


def corrupt_count(docs: DataFrame) -> DataFrame:
    """Broken and total documents in one pass. (Spark refuses a query over
    raw JSON that references only the corrupt-record column, so the
    predicate also names a parsed column; it does not change the result.)"""
    other = F.col([c for c in docs.columns if c != CORRUPT][0])
    broken = F.col(CORRUPT).isNotNull() & (other.isNull() | other.isNotNull())
    return docs.agg(F.count_if(broken).alias("corrupt_records"), F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------- S01–S04 stations

def station_status(status_type: Column) -> Column:
    """``StatusType.Title`` with default ``Unknown``."""
    return F.coalesce(status_type.getField("Title"), F.lit("Unknown"))


# Amenity labels by usage-type flag, in output order.
AMENITIES = [("IsAccessKeyRequired", "Access Key Required"), ("IsMembershipRequired", "Membership Required"),
             ("IsPayAtLocation", "Pay at Location")]


def station_amenities(usage_type: Column) -> Column:
    """The labels of the set flags joined with ', ' (``concat_ws`` skips NULLs)."""
    return F.concat_ws(", ", *[F.when(usage_type.getField(flag), F.lit(label)) for flag, label in AMENITIES])


def parse_stations(docs: DataFrame, country: str | None = None, max_results: int | None = None,
                   center: tuple[float, float] | None = None, distance_km: float | None = None) -> DataFrame:
    """Station documents → flat station rows, with the collector's
    source-side filters (country code, radius around a point, result cap)."""
    d = valid(docs)
    a = F.col("AddressInfo")
    if country is not None:
        d = d.where(a.getField("Country").getField("ISOCode") == F.lit(country))
    if center is not None and distance_km:
        lat, lon = F.coalesce(a.getField("Latitude"), F.lit(0.0)), F.coalesce(a.getField("Longitude"), F.lit(0.0))
        d = d.where(haversine_km(F.lit(center[0]), F.lit(center[1]), lat, lon) <= distance_km)
    out = d.select(
        F.coalesce(F.col("ID").cast("string"), F.lit("")).alias("id"),
        F.coalesce(a.getField("Title"), F.lit("")).alias("name"),
        F.coalesce(a.getField("Latitude"), F.lit(0.0)).alias("latitude"),
        F.coalesce(a.getField("Longitude"), F.lit(0.0)).alias("longitude"),
        F.coalesce(a.getField("AddressLine1"), F.lit("")).alias("address"),
        F.coalesce(a.getField("Town"), F.lit("")).alias("city"),
        F.coalesce(a.getField("StateOrProvince"), F.lit("")).alias("state"),
        F.coalesce(a.getField("Country").getField("Title"), F.lit("")).alias("country"),
        F.coalesce(F.col("OperatorInfo.Title"), F.lit("")).alias("operator"),
        F.coalesce(F.col("Network.Title"), F.lit("")).alias("network"),
        station_status(F.col("StatusType")).alias("status"),
        F.coalesce(F.col("AccessComments"), F.lit("")).alias("access_type"),
        F.coalesce(F.col("UsageCost"), F.lit("")).alias("pricing_info"),
        station_amenities(F.col("UsageType")).alias("amenities"))
    if max_results is not None:
        out = out.orderBy("id").limit(max_results)
    return out


def read_stations_json(spark: SparkSession, path: str, multi_line: bool = False, **filters) -> DataFrame:
    """S01 from a landing path."""
    return parse_stations(read_json(spark, path, STATION_DOC, multi_line), **filters)


def explode_charging_points(docs: DataFrame, as_of: _dt.datetime | None = None) -> DataFrame:
    """One row per connection; id ``"{ID}_{ConnectionType.ID}"`` (an
    absent part stays empty but keeps the ``_``), parent station attached."""
    c = F.col("c")
    d = valid(docs).select(F.col("ID").cast("string").alias("station_id"),
                           F.explode(F.coalesce(F.col("Connections"), F.array())).alias("c"))
    return d.select(
        F.concat_ws("_", F.coalesce(c.getField("ID").cast("string"), F.lit("")),
                    F.coalesce(c.getField("ConnectionType").getField("ID").cast("string"), F.lit(""))).alias("id"),
        "station_id",
        F.coalesce(c.getField("ConnectionType").getField("Title"), F.lit("")).alias("connector_type"),
        F.coalesce(c.getField("PowerKW"), F.lit(0.0)).alias("power_kw"),
        F.coalesce(c.getField("Voltage"), F.lit(0.0)).alias("voltage"),
        F.coalesce(c.getField("Amperage"), F.lit(0.0)).alias("amperage"),
        station_status(c.getField("StatusType")).alias("status"),
        ntz_literal(as_of).alias("last_updated"))


# ---------------------------------------------------------------- S05–S08 weather

def _weather_fields(doc: Column | None = None) -> list[Column]:
    """S05 over a weather item (top-level document or series element)."""
    g = (lambda name: F.col(name)) if doc is None else (lambda name: doc.getField(name))
    nested = g("main").isNotNull()
    pick = lambda f: F.when(nested, g("main").getField(f)).otherwise(g(f))
    first = F.get(g("weather"), 0)
    vis = g("visibility")
    return [
        instant_to_ntz(F.timestamp_seconds(F.coalesce(g("dt"), F.lit(0)))).alias("timestamp"),
        F.coalesce(pick("temp"), F.lit(0.0)).alias("temperature_celsius"),
        F.coalesce(pick("humidity"), F.lit(0.0)).alias("humidity_percent"),
        F.coalesce(pick("pressure"), F.lit(0.0)).alias("pressure_hpa"),
        F.coalesce(g("wind").getField("speed"), F.lit(0.0)).alias("wind_speed_ms"),
        F.coalesce(g("wind").getField("deg"), F.lit(0.0)).alias("wind_direction_degrees"),
        first_nonzero(g("rain").getField("1h"), g("rain").getField("3h"),
                      g("snow").getField("1h"), g("snow").getField("3h")).alias("precipitation_mm"),
        F.coalesce(first.getField("main"), F.lit("")).alias("weather_condition"),
        F.coalesce(first.getField("description"), F.lit("")).alias("weather_description"),
        F.when(F.coalesce(vis, F.lit(0.0)) != 0, vis / 1000.0).alias("visibility_km"),
        F.coalesce(g("uvi"), F.lit(0.0)).alias("uv_index"),
        F.coalesce(g("clouds").getField("all"), F.lit(0.0)).alias("cloudiness_percent"),
    ]


def parse_weather(docs: DataFrame) -> DataFrame:
    """Current-weather documents of either shape (``main`` nested or flat)."""
    v = valid(docs)
    return v.select(_opt(v, "station_id", "string").alias("station_id"), *_weather_fields())


def read_weather_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return parse_weather(read_json(spark, path, WEATHER_DOC, multi_line))


FORECAST_PER_DAY = 8


def explode_weather_series(docs: DataFrame, field: str = "list", days: int | None = None) -> DataFrame:
    """Forecast (``list``) or history (``data``) documents → one row per
    point; forecasts keep the first ``days × 8`` points if ``days`` is given."""
    d = valid(docs).select("station_id", F.posexplode(F.coalesce(F.col(field), F.array())).alias("pos", "item"))
    if field == "list" and days is not None:
        d = d.where(F.col("pos") < days * FORECAST_PER_DAY)
    return d.select("station_id", *_weather_fields(F.col("item")))


def attach_station(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Tag observations with their station; stations whose latitude or
    longitude is missing or 0 are skipped (equi-join on the station id)."""
    ok = stations.where(F.coalesce(F.col("latitude").cast("double"), F.lit(0.0)) != 0) \
        .where(F.coalesce(F.col("longitude").cast("double"), F.lit(0.0)) != 0) \
        .select(F.col("id").alias("station_id"))
    return observations.join(ok, "station_id")


# ---------------------------------------------------------------- S09–S12 traffic

def parse_traffic_flow(docs: DataFrame, as_of: _dt.datetime | None = None) -> DataFrame:
    """RWS[0].RW[].FIS[0].FI[].CF[] items with SP > 0 and JF > 0 →
    average speed, average jam factor (density) and the congestion vote
    (severe share > 0.5 → severe, else moderate share > 0.3 → moderate, else
    light). A document without a valid item gives no row; an ``RW`` whose
    ``FIS`` list is empty invalidates the document (the collector fails on it)."""
    d = valid(docs)
    rw = F.coalesce(F.get(F.col("RWS"), 0).getField("RW"), F.array())
    items = F.flatten(F.transform(rw, lambda r: F.flatten(F.transform(
        F.coalesce(F.get(r.getField("FIS"), 0).getField("FI"), F.array()),
        lambda fi: F.coalesce(fi.getField("CF"), F.array())))))
    ok = F.filter(items, lambda x: (x.getField("SP") > 0) & (x.getField("JF") > 0))
    broken = F.exists(rw, lambda r: F.size(F.coalesce(r.getField("FIS"), F.array(F.lit(None)))) == 0)
    d = d.select("*", ok.alias("_ok"), broken.alias("_broken"))
    n = F.size("_ok")
    ssum = F.aggregate("_ok", F.lit(0.0), lambda acc, x: acc + x.getField("SP"))
    jsum = F.aggregate("_ok", F.lit(0.0), lambda acc, x: acc + x.getField("JF"))
    severe = F.size(F.filter("_ok", lambda x: x.getField("SP") < 20))
    moderate = F.size(F.filter("_ok", lambda x: (x.getField("SP") >= 20) & (x.getField("SP") < 40)))
    obs = _opt(d, "observed_at", "timestamp_ntz")
    ts = obs if as_of is None else F.coalesce(obs, ntz_literal(as_of))
    return d.where((n > 0) & ~F.col("_broken")).select(
        _opt(d, "station_id", "string").alias("station_id"), ts.alias("timestamp"),
        _opt(d, "latitude", "double").alias("latitude"), _opt(d, "longitude", "double").alias("longitude"),
        (jsum / n).alias("traffic_density"), (ssum / n).alias("average_speed_kmh"),
        F.when(severe > n * 0.5, F.lit("severe")).when(moderate > n * 0.3, F.lit("moderate"))
        .otherwise(F.lit("light")).alias("congestion_level"),
        F.lit("highway").alias("road_type"), F.lit(0.0).alias("distance_to_station_km"),
        F.lit(0).alias("incident_count"))


def read_traffic_flow_json(spark: SparkSession, path: str, as_of=None, multi_line: bool = False) -> DataFrame:
    return parse_traffic_flow(read_json(spark, path, TRAFFIC_FLOW_DOC, multi_line), as_of)


def parse_incidents(docs: DataFrame, as_of: _dt.datetime | None = None) -> DataFrame:
    """One row per incident — type, first description value,
    criticality, origin (JSON text)."""
    v = valid(docs)
    obs = _opt(v, "observed_at", "timestamp_ntz")
    ts = obs if as_of is None else F.coalesce(obs, ntz_literal(as_of))
    d = v.select(_opt(v, "station_id", "string").alias("station_id"), ts.alias("timestamp"),
                 _opt(v, "latitude", "double").alias("latitude"), _opt(v, "longitude", "double").alias("longitude"),
                 F.explode(F.coalesce(F.col("TRAFFIC_ITEMS.TRAFFIC_ITEM"), F.array())).alias("i"))
    i = F.col("i")
    return d.select(
        "station_id", "timestamp", "latitude", "longitude",
        F.coalesce(i.getField("TRAFFIC_ITEM_TYPE_DESC"), F.lit("")).alias("incident_type"),
        F.coalesce(F.get(i.getField("TRAFFIC_ITEM_DESCRIPTION"), 0).getField("value"), F.lit("")).alias("description"),
        F.coalesce(i.getField("CRITICALITY").getField("ID"), F.lit("")).alias("severity"),
        F.to_json(i.getField("LOCATION").getField("GEOLOC").getField("ORIGIN")).alias("location"))


def read_incidents_json(spark: SparkSession, path: str, as_of=None, multi_line: bool = False) -> DataFrame:
    return parse_incidents(read_json(spark, path, INCIDENT_DOC, multi_line), as_of)


def union_flow_incidents(flow: DataFrame, incidents: DataFrame) -> DataFrame:
    """One mixed traffic table of both record kinds."""
    return flow.withColumn("record_kind", F.lit("flow")).unionByName(
        incidents.withColumn("record_kind", F.lit("incident")), allowMissingColumns=True)
