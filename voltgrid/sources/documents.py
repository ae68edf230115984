"""Landing-zone documents derived from canonical rows (the inverse of the
S01/S02/S05/S09 readers). Used to exercise the readers end to end on data
Spark derives from the given tables, and to land test data for the streaming
jobs. One document per input row — no grouping, so no unbounded collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.functions.columns import ntz_to_instant

# keep microseconds (the default text form stops at milliseconds)
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def station_documents(stations: DataFrame) -> DataFrame:
    """One station document (JSON text in ``value``) per station row. The
    usage-type flags follow the station key (fixed rule of this fixture:
    access key when id % 2 = 0, membership when % 3 = 0, pay at location
    when % 5 = 0)."""
    k = F.col("id").try_cast("bigint")
    doc = F.struct(
        k.alias("ID"),
        F.struct(F.col("name").alias("Title"), F.col("latitude").cast("double").alias("Latitude"),
                 F.col("longitude").cast("double").alias("Longitude"), F.col("address").alias("AddressLine1"),
                 F.col("city").alias("Town"), F.col("state").alias("StateOrProvince"),
                 F.struct(F.col("country").alias("Title")).alias("Country")).alias("AddressInfo"),
        F.struct(F.col("operator").alias("Title")).alias("OperatorInfo"),
        F.struct((k % 2 == 0).alias("IsAccessKeyRequired"), (k % 3 == 0).alias("IsMembershipRequired"),
                 (k % 5 == 0).alias("IsPayAtLocation")).alias("UsageType"))
    return stations.select(F.to_json(doc, JSON_OPTIONS).alias("value"))


def point_documents(points: DataFrame) -> DataFrame:
    """One single-connection station document per charging point;
    ``ConnectionType.ID`` is the length of the connector title (fixture rule)."""
    conn = F.struct(F.col("id").try_cast("bigint").alias("ID"),
                    F.struct(F.length("connector_type").cast("bigint").alias("ID"),
                             F.col("connector_type").alias("Title")).alias("ConnectionType"),
                    F.col("power_kw").cast("double").alias("PowerKW"))
    doc = F.struct(F.col("station_id").try_cast("bigint").alias("ID"), F.array(conn).alias("Connections"))
    return points.select(F.to_json(doc, JSON_OPTIONS).alias("value"))


def weather_documents(weather: DataFrame) -> DataFrame:
    """One current-weather document per observation: the nested shape
    (``main``) for even ids, the flat shape for odd ids (fixture rule)."""
    nested = F.col("id") % 2 == 0
    t = F.col("temperature_celsius").cast("double")
    doc = F.struct(
        F.col("station_id"), F.unix_seconds(ntz_to_instant("timestamp")).alias("dt"),
        F.when(nested, F.struct(t.alias("temp"))).alias("main"),
        F.when(~nested, t).alias("temp"),
        F.array(F.struct(F.col("weather_condition").alias("main"))).alias("weather"),
        F.struct(F.col("precipitation_mm").cast("double").alias("1h")).alias("rain"))
    return weather.select(F.to_json(doc, JSON_OPTIONS).alias("value"))


def traffic_flow_documents(traffic: DataFrame) -> DataFrame:
    """One flow document per traffic row with two flow items:
    (speed, density) and (speed + 25, density / 2) (fixture rule)."""
    sp, jf = F.col("average_speed_kmh").cast("double"), F.col("traffic_density").cast("double")
    cf = F.array(F.struct(sp.alias("SP"), jf.alias("JF")), F.struct((sp + 25).alias("SP"), (jf / 2).alias("JF")))
    rws = F.array(F.struct(F.array(F.struct(F.array(F.struct(F.array(F.struct(cf.alias("CF"))).alias("FI")))
                                            .alias("FIS"))).alias("RW")))
    doc = F.struct(F.col("station_id"), F.col("timestamp").alias("observed_at"), rws.alias("RWS"))
    return traffic.select(F.to_json(doc, JSON_OPTIONS).alias("value"))


def parse_documents(docs: DataFrame, ddl: str) -> DataFrame:
    """JSON text column → document columns (``from_json`` with the reader's
    schema; the same row-local parse the file reader performs)."""
    ddl = ", ".join(p for p in ddl.split(", ") if not p.startswith("_corrupt_record"))
    return docs.select(F.from_json("value", ddl).alias("d")).select("d.*")


# ------------------------------------------------ documents that reach every branch of the readers

def connection_documents(points: DataFrame) -> DataFrame:
    """One station document per charging point with one to four connections
    (fixture rule: 1 + id % 4; connection j is ten times the id plus j, has
    ``power + j`` kW, a voltage if j is even, and a status if j is 1)."""
    k = F.col("id").try_cast("bigint")
    conns = F.transform(F.sequence(F.lit(0).cast("bigint"), k % 4), lambda j: F.struct(
        (k * 10 + j).alias("ID"),
        F.struct((F.length("connector_type") + j).alias("ID"), F.col("connector_type").alias("Title")).alias("ConnectionType"),
        (F.col("power_kw").cast("double") + j).alias("PowerKW"),
        F.when(j % 2 == 0, F.lit(230.0)).alias("Voltage"),
        F.when(j == 1, F.struct(F.lit("Operational").alias("Title"))).alias("StatusType")))
    doc = F.struct(F.col("station_id").try_cast("bigint").alias("ID"), conns.alias("Connections"))
    return points.select(F.to_json(doc, JSON_OPTIONS).alias("value"))


def _weather_item(shift):
    """A full weather item ``shift`` hours later; precipitation stands, by id,
    in the rain of one or three hours or in the snow of one or three hours,
    with zeros ahead of it."""
    k, p = F.col("id"), F.col("precipitation_mm").cast("double")
    at = lambda i: F.when(k % 4 == i, p).otherwise(0.0)
    t = F.col("temperature_celsius").cast("double") + shift
    humidity, pressure = (k % 100).cast("double"), (k % 50 + 1000).cast("double")
    nested = k % 2 == 0
    return [(F.unix_seconds(ntz_to_instant("timestamp")) + shift * 3600).alias("dt"),
            F.when(nested, F.struct(t.alias("temp"), humidity.alias("humidity"), pressure.alias("pressure"))).alias("main"),
            *[F.when(~nested, v).alias(n) for n, v in (("temp", t), ("humidity", humidity), ("pressure", pressure))],
            F.array(F.struct(F.col("weather_condition").alias("main"),
                             F.lower("weather_condition").alias("description"))).alias("weather"),
            F.struct((k % 30).cast("double").alias("speed"), (k % 360).cast("double").alias("deg")).alias("wind"),
            F.struct((k % 101).cast("double").alias("all")).alias("clouds"),
            F.struct(at(0).alias("1h"), at(1).alias("3h")).alias("rain"),
            F.struct(at(2).alias("1h"), at(3).alias("3h")).alias("snow"),
            ((k % 20) * 500).cast("double").alias("visibility"), (k % 12).cast("double").alias("uvi")]


def full_weather_documents(weather: DataFrame) -> DataFrame:
    """One current-weather document per observation with every field."""
    return weather.select(F.to_json(F.struct("station_id", *_weather_item(F.lit(0))), JSON_OPTIONS).alias("value"))


SERIES_POINTS = 10


def forecast_documents(weather: DataFrame) -> DataFrame:
    """One forecast document per observation with ten hourly points."""
    points = F.array(*[F.struct(*_weather_item(F.lit(j))) for j in range(SERIES_POINTS)])
    return weather.select(F.to_json(F.struct("station_id", points.alias("list")), JSON_OPTIONS).alias("value"))


def congested_flow_documents(traffic: DataFrame) -> DataFrame:
    """One flow document per traffic row with three flow items: the speed,
    half of it, and 25 more (fixture rule), so that every vote occurs."""
    sp, jf = F.col("average_speed_kmh").cast("double"), F.col("traffic_density").cast("double")
    item = lambda s, j: F.struct(F.array(F.struct(s.alias("SP"), j.alias("JF"))).alias("CF"))
    fi = F.array(item(sp, jf), item(sp / 2, jf / 2), item(sp + 25, jf))
    rws = F.array(F.struct(F.array(F.struct(F.array(F.struct(fi.alias("FI"))).alias("FIS"))).alias("RW")))
    return traffic.select(F.to_json(F.struct("station_id", F.col("timestamp").alias("observed_at"), rws.alias("RWS")),
                                    JSON_OPTIONS).alias("value"))


def incident_documents(traffic: DataFrame) -> DataFrame:
    """One incident document per traffic row with id % 3 incidents (fixture
    rule: the second has no description, the first no criticality)."""
    k = F.col("id")
    items = F.transform(F.sequence(F.lit(0).cast("bigint"), k % 3), lambda j: F.struct(
        F.col("congestion_level").alias("TRAFFIC_ITEM_TYPE_DESC"),
        F.when(j != 1, F.array(F.struct(F.concat(F.lit("incident "), k.cast("string"), F.lit("-"), j.cast("string"))
                                        .alias("value")))).alias("TRAFFIC_ITEM_DESCRIPTION"),
        F.when(j != 0, F.struct(j.cast("string").alias("ID"))).alias("CRITICALITY"),
        F.struct(F.struct(F.struct((k % 90 + F.lit(0.5)).alias("LATITUDE"), (j + F.lit(0.25)).alias("LONGITUDE"))
                          .alias("ORIGIN")).alias("GEOLOC")).alias("LOCATION")))
    some = F.filter(items, lambda _, i: i < k % 3)
    doc = F.struct(F.col("station_id"), F.col("timestamp").alias("observed_at"),
                   F.struct(some.alias("TRAFFIC_ITEM")).alias("TRAFFIC_ITEMS"))
    return traffic.select(F.to_json(doc, JSON_OPTIONS).alias("value"))
