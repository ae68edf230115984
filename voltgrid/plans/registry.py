"""Named queries: each takes ``(spark, sf_dir)``, builds the canonical tables
from the test data (adapters) and returns the operator's lazy DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.operators import correlations as corr
from voltgrid.operators import anomalies, cleaning, derived, features
from voltgrid.operators import isolation_forest
from voltgrid.operators import insights as bi
from voltgrid.operators import patterns, views
from voltgrid.functions.columns import day_name
from voltgrid.functions.output import finish
from voltgrid.sinks.tables import (cascade_delete, latest_by_key, merge_batch, orphans, prepare_anomaly_rows,
                                   prepare_weather_rows, upsert_frame)
from voltgrid.sources import documents as docs
from voltgrid.sources import ingest
from voltgrid.sources.testdata import adapter_tables
from voltgrid.sources.uneven import uneven_tables

AS_OF = dt.datetime(2024, 2, 1)

Query = Callable[[SparkSession, str], DataFrame]


def _u(op, **kw) -> Query:
    """Operator over the usage table alone."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(op(adapter_tables(spark, sf_dir).usage, **kw))
    run.__name__ = getattr(op, "__name__", "query")
    run.__doc__ = op.__doc__
    return run


def _us(op, **kw) -> Query:
    """Operator over (usage, stations)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = adapter_tables(spark, sf_dir)
        return finish(op(t.usage, t.stations, **kw))
    run.__name__ = getattr(op, "__name__", "query")
    run.__doc__ = op.__doc__
    return run


def _wtu(op, *sides: str, **kw) -> Query:
    """Operator over named canonical tables, e.g. ('weather', 'usage')."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = adapter_tables(spark, sf_dir)
        return finish(op(*[getattr(t, s) for s in sides], **kw))
    run.__name__ = getattr(op, "__name__", "query")
    run.__doc__ = op.__doc__
    return run


def _q(build) -> Query:
    """Query from a function of the canonical tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(build(adapter_tables(spark, sf_dir)))
    run.__name__ = getattr(build, "__name__", "query")
    run.__doc__ = build.__doc__
    return run


def _t(op, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(op(adapter_tables(spark, sf_dir), **kw))
    run.__name__ = getattr(op, "__name__", "query")
    run.__doc__ = op.__doc__
    return run


QUERIES: dict[str, Query] = {
    "v01_station_overview": _t(views.station_overview),
    "v02_usage_patterns": _t(views.usage_patterns),
    "v03_weather_correlation": _t(views.weather_correlation),
    "v04_traffic_correlation": _t(views.traffic_correlation),
    "v06_anomaly_summary": _t(views.anomaly_summary, as_of=AS_OF),
    "v07_station_performance": _t(views.station_performance),
    "v08_hourly_heatmap": _t(views.hourly_heatmap),
    "v09_geographic_distribution": _t(views.geographic_distribution),
    "v10_collection_status": _t(views.collection_status),
    "v11_station_statistics": _t(views.station_statistics),
    "v12_station_overview_filled": _t(views.station_overview_filled),
    "v13_usage_patterns_weekday": _t(views.usage_patterns_weekday),
    "p01_peak_hours": _u(patterns.peak_hours, by=["station_id"]),
    "p01_peak_hours_network": _u(patterns.peak_hours, by=[]),
    "p02_weekday_weekend": _u(patterns.weekday_weekend, by=["station_id"]),
    "p03_usage_spikes": _u(patterns.usage_spikes, by=["station_id"]),
    "p04_low_usage_periods": _u(patterns.low_usage_periods, by=["station_id"]),
    "p05_session_duration_stats": _u(patterns.session_duration_stats, by=["station_id"]),
    "p05_session_duration_stats_network": _u(patterns.session_duration_stats, by=[]),
    "p06_seasonal_trends": _u(patterns.seasonal_trends, by=["station_id"]),
    "p07_usage_pattern_summary": _u(patterns.usage_pattern_summary, by=["station_id"], with_details=False),
    "p09_location_patterns_state": _us(patterns.location_patterns, level="state"),
    "p09_location_patterns_city": _us(patterns.location_patterns, level="city"),
    "r01_hourly_usage": _wtu(corr.hourly_usage, "usage"),
    "r02_weather_usage_correlation": _wtu(corr.weather_usage_correlation, "weather", "usage"),
    "r02_weather_usage_correlation_by_station": _wtu(corr.weather_usage_correlation, "weather", "usage",
                                                     by=["station_id"]),
    "r03_condition_impact": _wtu(corr.condition_impact, "weather", "usage"),
    "r03_condition_impact_by_station": _wtu(corr.condition_impact, "weather", "usage", by=["station_id"]),
    "r04_traffic_usage_correlation": _wtu(corr.traffic_usage_correlation, "traffic", "usage"),
    "r04_traffic_usage_correlation_by_station": _wtu(corr.traffic_usage_correlation, "traffic", "usage",
                                                     by=["station_id"]),
    "r05_congestion_impact": _wtu(corr.congestion_impact, "traffic", "usage"),
    "r06_combined_correlation": _wtu(corr.combined_correlation, "weather", "traffic", "usage"),
    "r06_combined_correlation_by_station": _wtu(corr.combined_correlation, "weather", "traffic", "usage",
                                                by=["station_id"]),
    "r07_correlation_insights": _wtu(corr.correlation_insights, "weather", "traffic", "usage"),
    "r07_correlation_insights_by_station": _wtu(corr.correlation_insights, "weather", "traffic", "usage",
                                                by=["station_id"]),
    "r08_correlation_report": _wtu(corr.correlation_report, "weather", "traffic", "usage"),
    "b01_network_overview": _wtu(bi.network_overview, "stations", "usage", "points"),
    "b02_stations_by_state": _wtu(bi.stations_by, "stations", dim="state"),
    "b02_stations_by_city": _wtu(bi.stations_by, "stations", dim="city"),
    "b02_stations_by_operator": _wtu(bi.stations_by, "stations", dim="operator"),
    "b03_performance_metrics": _wtu(bi.performance_metrics, "stations", "usage"),
    "b04_underutilized_stations": _wtu(bi.underutilized_stations, "usage"),
    "b05_capacity_expansion": _wtu(bi.capacity_expansion, "usage", "points"),
    "b06_pricing_optimization": _wtu(bi.pricing_optimization, "usage"),
    "b07_geographic_gaps": _wtu(bi.geographic_gaps, "stations"),
    "b08_network_recommendations": _wtu(bi.network_recommendations, "stations", "usage", "points"),
    "b09_revenue_summary": _wtu(bi.revenue_summary, "usage"),
    "b10_top_revenue_stations": _wtu(bi.top_revenue_stations, "usage"),
    "b11_daily_revenue": _wtu(bi.daily_revenue, "usage"),
    "b11_revenue_trend": _wtu(bi.revenue_trend, "usage"),
    "b12_capacity_summary": _wtu(bi.capacity_summary, "points"),
    "b13_station_utilization": _wtu(bi.station_utilization, "points", "usage"),
    "b15_station_usage_stats": _wtu(bi.station_usage_stats, "usage"),
    "b16_station_capacity": _wtu(bi.station_capacity, "points"),
    "b17_station_recommendations": _wtu(bi.station_recommendations, "stations", "usage", "points"),
    "b18_station_insights": _wtu(bi.station_insights, "stations", "usage", "points"),
    "c01_clean_stations": _q(lambda t: cleaning.clean_stations(t.stations, AS_OF)),
    "c02_clean_weather": _q(lambda t: cleaning.clean_weather(t.weather, AS_OF).select(
        "id", "station_id", "timestamp", "temperature_celsius", "precipitation_mm", "weather_condition",
        "created_at")),
    "c03_clean_traffic": _q(lambda t: cleaning.clean_traffic(t.traffic, AS_OF).select(
        "id", "station_id", "timestamp", "traffic_density", "average_speed_kmh", "congestion_level",
        "road_type", "created_at")),
    "c05_limit_stations": _q(lambda t: cleaning.limit_stations(t.stations, 50).select("id", "name")),
    "c06_reject_report": _q(lambda t: cleaning.reject_report(t.weather, "weather")),
    "k01_latest_session_per_station": _q(lambda t: latest_by_key(
        t.usage, ["station_id"], ["session_start", "id"]).select(
        "id", "station_id", "session_start", "energy_consumed_kwh", "duration_minutes", "cost", "user_type")),
    "k12_orphan_points": _q(lambda t: orphans(t.points, t.stations).select(
        "id", "station_id", "connector_type", "power_kw")),
    "k12_orphan_sessions": _q(lambda t: orphans(t.usage, t.stations).select("id", "station_id", "session_start")),
    "d01_energy_consumption": _q(lambda t: derived.energy_consumption_daily(t.usage).drop("id", "created_at")),
    "v05_energy_trends": _t(views.energy_trends),
    "d02_quota_usage": _q(lambda t: derived.quota_usage(t.log, {"1-URGENT": ("month", 1000)})),
    "d04_collection_success_rate": _q(lambda t: derived.collection_success_rate(t.log)),
    "d05_stations_within": _q(lambda t: derived.stations_within(t.stations, 0.0, 0.0, 5000.0).select(
        "id", "name", "latitude", "longitude", "distance_km")),
    "f01_engineer_features": _q(lambda t: features.engineer_features(
        t.stations, t.weather, t.traffic, AS_OF).drop("id")),
    "f02_usage_features": _q(lambda t: features.usage_features(
        t.stations, t.usage, t.weather, t.traffic, AS_OF).drop("id")),
    "a02_zscore_anomalies": _q(lambda t: anomalies.zscore_anomalies(
        features.usage_features(t.stations, t.usage, t.weather, t.traffic, AS_OF), AS_OF).drop("id", "resolved_at")),
    # isolation forest: no SQL oracle (randomised model) — rows-only check here,
    # invariants in tests/test_isolation_forest.py
    "a01_isolation_forest_anomalies": _q(lambda t: isolation_forest.detect_anomalies(
        features.usage_features(t.stations, t.usage, t.weather, t.traffic, AS_OF), AS_OF).drop("id", "resolved_at")),
    "a01_forest_summary": _q(lambda t: isolation_forest.forest_summary(
        features.usage_features(t.stations, t.usage, t.weather, t.traffic, AS_OF))),
    "s01_parse_station_documents": _q(lambda t: ingest.parse_stations(
        docs.parse_documents(docs.station_documents(t.stations), ingest.STATION_DOC))),
    "s02_explode_point_documents": _q(lambda t: ingest.explode_charging_points(
        docs.parse_documents(docs.point_documents(t.points), ingest.STATION_DOC)).drop("last_updated")),
    "s05_parse_weather_documents": _q(lambda t: ingest.parse_weather(
        docs.parse_documents(docs.weather_documents(t.weather), ingest.WEATHER_DOC))),
    "s09_parse_traffic_flow_documents": _q(lambda t: ingest.parse_traffic_flow(
        docs.parse_documents(docs.traffic_flow_documents(t.traffic), ingest.TRAFFIC_FLOW_DOC))
        .drop("latitude", "longitude")),
    "s08_attach_station": _q(lambda t: ingest.attach_station(
        t.weather.select("id", "station_id", "timestamp", "temperature_celsius"), t.stations)),
    "s13_stations_in_bbox": _q(lambda t: derived.points_in_bbox(t.stations, 45.0, 10.0, 2000.0).select(
        "id", "name", "latitude", "longitude")),
    "p02_weekday_weekend_network": _u(patterns.weekday_weekend, by=[]),
    "p04_low_usage_periods_network": _u(patterns.low_usage_periods, by=[]),
    "p06_seasonal_trends_network": _u(patterns.seasonal_trends, by=[]),
    "r08_correlation_report_by_station": _wtu(corr.correlation_report, "weather", "traffic", "usage",
                                              by=["station_id"]),
    "r05_congestion_impact_by_station": _wtu(corr.congestion_impact, "traffic", "usage", by=["station_id"]),
    # row rules of the sinks and the forms for one station
    "k01_upsert_stations": _q(lambda t: upsert_frame(t.stations, t.stations.where(F.col("id").cast("bigint") % 3 == 0)
                                                     .withColumns({"name": F.concat("name", F.lit("*")),
                                                                   "updated_at": F.lit("2024-01-01").cast("timestamp_ntz")}),
                                                     ["id"], ["updated_at"]).select("id", "name", "city")),
    "k03_weather_row_rules": _q(lambda t: prepare_weather_rows(t.weather.withColumn(
        "humidity_percent", F.col("precipitation_mm").cast("decimal(5,2)"))).select("id", "humidity_percent")),
    "k06_anomaly_row_rules": _q(lambda t: prepare_anomaly_rows(t.anomalies.withColumn(
        "is_resolved", F.when(F.col("is_resolved"), True))).select("id", "is_resolved")),
    "k12_cascade_sessions": _q(lambda t: cascade_delete(t, t.stations.where(F.col("id").cast("bigint") % 7 == 0))
                               .usage.select("id", "station_id")),
    "p03_usage_spikes_network": _u(patterns.usage_spikes, by=[]),
    "p07_usage_pattern_summary_network": _u(patterns.usage_pattern_summary, by=[], with_details=False),
    "p08_sessions_by_day_name": _q(lambda t: t.usage.groupBy(day_name("session_start").alias("day")).agg(
        F.count(F.lit(1)).alias("session_count"))),
    "v11_station_statistics_one": _t(views.station_statistics, station_id="3"),
    "s12_union_flow_incidents": _q(lambda t: ingest.union_flow_incidents(
        t.traffic.where("congestion_level <> 'severe'"),
        t.traffic.where("congestion_level = 'severe'").drop("average_speed_kmh")).select(
        "station_id", "timestamp", "average_speed_kmh", "congestion_level", "record_kind")),
}


def _uneven(build) -> Query:
    """Query from a function of the canonical tables, on the uneven mapping."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(build(uneven_tables(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _updated_points(t) -> DataFrame:
    """Every point stored and sent once more with a kW added: newer, older or
    of the same time, by id."""
    third = F.col("id").cast("bigint") % 3
    at = lambda c: c.cast("timestamp_ntz")
    row = lambda df, q: df.withColumns({"_query": F.lit(q), "_batch": F.lit(0).cast("bigint")})
    stored = row(t.points.withColumn("last_updated", at(F.lit("2024-01-01"))), "first")
    sent = row(t.points.withColumns({
        "power_kw": (F.col("power_kw") + 1).cast("decimal(8,2)"),
        "last_updated": at(F.when(third == 0, "2024-01-02").when(third == 1, "2023-12-31").otherwise("2024-01-01"))}), "second")
    return merge_batch(stored, sent, ["id"], ["last_updated"]).select(
        "id", "station_id", "connector_type", "power_kw", "last_updated", "_query")


# The services of the quota monitor, by the priorities of the test tables.
SERVICES = {"1-URGENT": "openchargemap", "2-HIGH": "openweather", "3-MEDIUM": "here_maps"}


def _service_log(t) -> DataFrame:
    name = F.col("data_source")
    for k, v in SERVICES.items():
        name = F.when(F.col("data_source") == k, F.lit(v)).otherwise(name)
    return t.log.withColumn("data_source", name)


LOOKED_UP = "7"

QUERIES.update({
    # rules that the plain tables never set off
    "b04_underutilized_stations_uneven": _uneven(lambda t: bi.underutilized_stations(t.usage)),
    "b05_capacity_expansion_uneven": _uneven(lambda t: bi.capacity_expansion(t.usage, t.points)),
    "b08_network_recommendations_uneven": _uneven(lambda t: bi.network_recommendations(t.stations, t.usage, t.points)),
    "b17_station_recommendations_uneven": _uneven(lambda t: bi.station_recommendations(t.stations, t.usage, t.points)),
    "b18_station_insights_uneven": _uneven(lambda t: bi.station_insights(t.stations, t.usage, t.points)),
    "p01_peak_hours_network_uneven": _uneven(lambda t: patterns.peak_hours(t.usage)),
    "p03_usage_spikes_network_uneven": _uneven(lambda t: patterns.usage_spikes(t.usage)),
    "p07_usage_pattern_details": _q(lambda t: patterns.usage_pattern_summary(t.usage)),
    "p07_usage_pattern_details_uneven": _uneven(lambda t: patterns.usage_pattern_summary(t.usage)),
    "p07_usage_pattern_details_network_uneven": _uneven(lambda t: patterns.usage_pattern_summary(t.usage, by=[])),
    "d01_energy_consumption_uneven": _uneven(lambda t: derived.energy_consumption_daily(t.usage).drop("id", "created_at")),
    "f02_usage_features_uneven": _uneven(lambda t: features.usage_features(
        t.stations, t.usage, t.weather, t.traffic, AS_OF).drop("id")),
    # readers on documents with every field
    "s02_explode_connections": _q(lambda t: ingest.explode_charging_points(
        docs.parse_documents(docs.connection_documents(t.points), ingest.STATION_DOC), AS_OF)),
    "s05_parse_full_weather_documents": _q(lambda t: ingest.parse_weather(
        docs.parse_documents(docs.full_weather_documents(t.weather), ingest.WEATHER_DOC))),
    "s07_explode_forecasts": _q(lambda t: ingest.explode_weather_series(
        docs.parse_documents(docs.forecast_documents(t.weather), ingest.WEATHER_DOC), days=1)),
    "s09_parse_congested_flow": _q(lambda t: ingest.parse_traffic_flow(
        docs.parse_documents(docs.congested_flow_documents(t.traffic), ingest.TRAFFIC_FLOW_DOC))
        .drop("latitude", "longitude")),
    "s11_parse_incidents": _q(lambda t: ingest.parse_incidents(
        docs.parse_documents(docs.incident_documents(t.traffic), ingest.INCIDENT_DOC)).drop("latitude", "longitude")),
    "k02_upsert_points": _q(_updated_points),
    "d02_quota_usage_services": _q(lambda t: derived.quota_usage(_service_log(t))),
    # the promised lookups of one station
    "d03_lookup_weather": _q(lambda t: derived.lookup(t.weather, "station_id", LOOKED_UP).select(
        "id", "station_id", "timestamp", "temperature_celsius", "precipitation_mm", "weather_condition")),
    "d03_lookup_traffic": _q(lambda t: derived.lookup(t.traffic, "station_id", LOOKED_UP).select(
        "id", "station_id", "timestamp", "traffic_density", "average_speed_kmh", "congestion_level")),
    "d03_lookup_anomalies": _q(lambda t: derived.lookup(t.anomalies, "station_id", LOOKED_UP).select(
        "id", "station_id", "anomaly_type", "severity_score", "detected_at", "is_resolved")),
    "d03_lookup_station": _q(lambda t: derived.lookup(t.stations, "id", LOOKED_UP).select(
        "id", "name", "latitude", "longitude", "city", "state", "country", "operator")),
})
