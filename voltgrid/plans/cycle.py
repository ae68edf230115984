"""The collection cycle (the reference's only running application) as a
batch Spark job over a landing zone:

    landing/stations/*.json  → S01/S02 → C01 → C05 → K01/K02 (upsert)
    landing/weather/*.json   → S05 → S08 → C02 → K03 (append)
    landing/traffic/*.json   → S09 + S11 → S12 → C03 → K04 (append)
    stored tables            → F01 → A01 → K05/K06 (append)
    every load               → K07 audit row (real start and end, counts
                                observed during the write — no second pass)

Each load is one distributed write; the driver only sequences them. Every
write is keyed by the cycle stamp (kept in upserted rows, ``load=<stamp>``
directories), so re-running a failed cycle with the same stamp replaces its
own output — no duplicates. Incremental (streaming) variants of the same steps
are in ``voltgrid.streaming.jobs``.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from voltgrid.operators import cleaning, features, isolation_forest
from voltgrid.schemas import conform, schema
from voltgrid.sinks import tables as sinks
from voltgrid.sources import ingest
from voltgrid.sources.tables import exists

# Fixed values of the cycle: the audit labels of each load.
STATIONS_SOURCE = ("OpenChargeMap", "charging_stations")
WEATHER_SOURCE = ("OpenWeatherMap", "weather_data")
TRAFFIC_SOURCE = ("HERE_Maps", "traffic_data")
POINTS_SOURCE = ("OpenChargeMap", "charging_points")
FEATURES_SOURCE = ("FeatureEngineering", "engineered_features")
ANOMALY_SOURCE = ("AnomalyDetection", "anomaly_detection")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _load(spark: SparkSession, df: DataFrame, source: tuple[str, str], write) -> DataFrame:
    """Run one load (``write(observed_df)``) and return its audit row
    (status ``success`` or ``failed`` with the error text)."""
    obs = Observation(f"{source[0]}_{source[1]}")
    started = _now()
    try:
        write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
        n, status, err = int(obs.get.get("rows", 0)), "success", None
    except Exception as e:  # noqa: BLE001 — the audit row records the failure
        n, status, err = 0, "failed", str(e)
    return sinks.collection_log_row(spark, source[0], source[1], n, status, started, _now(), err)


def run_collection_cycle(spark: SparkSession, landing: str, store: str, as_of: _dt.datetime,
                         stamp: str | None = None, max_stations: int | None = None,
                         max_weather_stations: int | None = None,
                         max_traffic_stations: int | None = None) -> DataFrame:
    """One full cycle over all that has landed; returns the audit rows it
    appended. The limits (C05) are for callers with a quota; by default there
    are none."""
    stamp = stamp or as_of.strftime("%Y%m%d%H%M%S")
    audit = []

    # stations and their charging points
    docs = ingest.read_json(spark, os.path.join(landing, "stations"), ingest.STATION_DOC)
    stations = cleaning.limit_stations(cleaning.clean_stations(ingest.parse_stations(docs), as_of), max_stations)
    audit.append(_load(spark, stations, STATIONS_SOURCE, lambda d: sinks.upsert(
        spark, store, "charging_stations", d, ["id"], ["updated_at"], version=stamp)))
    kept = sinks.read_upserted(spark, store, "charging_stations")
    cycle_ids = stations.select(F.col("id").alias("station_id"))
    points = ingest.explode_charging_points(docs, as_of).join(cycle_ids, "station_id", "left_semi")
    audit.append(_load(spark, conform(points, "charging_points"), POINTS_SOURCE, lambda d: sinks.upsert(
        spark, store, "charging_points", d, ["id"], ["last_updated"], version=stamp)))

    # weather of this cycle's stations
    weather = spark.createDataFrame([], schema("weather_data"))
    wpath = os.path.join(landing, "weather")
    if exists(spark, wpath):
        ws = cleaning.limit_stations(stations, max_weather_stations)
        w = ingest.attach_station(ingest.read_weather_json(spark, wpath), ws)
        weather = sinks.prepare_weather_rows(cleaning.clean_weather(w, as_of))
        audit.append(_load(spark, weather, WEATHER_SOURCE,
                           lambda d: sinks.append(d, store, "weather_data", "date", load_id=stamp)))

    # traffic flow and incidents of this cycle's stations
    traffic = spark.createDataFrame([], schema("traffic_data"))
    tpath, ipath = os.path.join(landing, "traffic"), os.path.join(landing, "incidents")
    parts = []
    if exists(spark, tpath):
        parts.append(ingest.read_traffic_flow_json(spark, tpath, as_of))
    if exists(spark, ipath):
        parts.append(ingest.read_incidents_json(spark, ipath, as_of))
    if parts:
        ts = cleaning.limit_stations(stations, max_traffic_stations)
        tr = parts[0] if len(parts) == 1 else ingest.union_flow_incidents(*parts)
        traffic = cleaning.clean_traffic(ingest.attach_station(tr, ts), as_of)
        audit.append(_load(spark, traffic, TRAFFIC_SOURCE,
                           lambda d: sinks.append(d, store, "traffic_data", "date", load_id=stamp)))

    # features of this cycle's data, then anomalies; the feature table is
    # written first (the forest reads it twice, and the write cuts the lineage)
    feats = features.engineer_features(stations, weather, traffic, as_of)
    feats_path = os.path.join(store, "engineered_features", f"load={stamp}")
    audit.append(_load(spark, feats, FEATURES_SOURCE, lambda d: d.write.mode("overwrite").parquet(feats_path)))
    if exists(spark, feats_path):
        feats = spark.read.schema(feats.schema).parquet(feats_path)
        anomalies = sinks.prepare_anomaly_rows(isolation_forest.detect_anomalies(feats, as_of))
        audit.append(_load(spark, anomalies, ANOMALY_SOURCE,
                           lambda d: sinks.append(d, store, "anomaly_detection", "date", load_id=stamp)))

    log = audit[0]
    for row in audit[1:]:
        log = log.unionByName(row)
    sinks.append(log, store, "data_collection_log", load_id=stamp)
    return log
