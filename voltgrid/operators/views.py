"""The reporting views.

Design (SURVEY §1.4.1, §4): every multi-child view aggregates each child
table per station *first* and then left-joins the one-row-per-station
aggregates to the station dimension. This is the intended, fan-out-free
result (the literal SQL multiplies SUMs by the other children's row counts)
and it is the scalable plan: the heavy tables are reduced map-side
(partial aggregation) before any shuffle, so a station holding a third of all
sessions costs one partial row per task, never a cross product.

Distinct counts over primary keys (``COUNT(DISTINCT ud.id)``) are computed as
plain ``count(id)``: ``id`` is the table key (serial or upserted by K01), and
a non-distinct count combines map-side instead of shuffling every id.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.functions.columns import (dow_sunday0, dsum, hour_floor, is_weekend_monday0, ntz_literal,
                                        mean, weekday_monday0)
from voltgrid.functions.groupstats import attach_one_row
from voltgrid.functions.output import finish
from voltgrid.sources.tables import Tables


def _zero(*names):
    return {n: 0 for n in names}


def _stations(t: Tables, *cols: str) -> DataFrame:
    ren = {"id": "station_id", "name": "station_name"}
    return t.stations.select(*[F.col(c).alias(ren.get(c, c)) for c in cols])


# ---------------------------------------------------------------- per-child aggregates

def points_by_station(points: DataFrame) -> DataFrame:
    return points.groupBy("station_id").agg(
        F.count("id").alias("n_points"),
        mean("power_kw").alias("avg_power_kw"),
        F.max("power_kw").cast("double").alias("max_power_kw"),
        dsum("power_kw").alias("total_power_kw"))


def usage_by_station(usage: DataFrame) -> DataFrame:
    return usage.groupBy("station_id").agg(
        F.count("id").alias("n_sessions"),
        dsum("energy_consumed_kwh").alias("total_energy_kwh"),
        mean("duration_minutes").alias("avg_duration_minutes"),
        mean("cost").alias("avg_cost"),
        dsum("cost").alias("total_revenue"),
        F.count_distinct(F.to_date("session_start")).alias("active_days"),
        F.max("session_start").alias("last_session"),
        F.min("session_start").alias("first_session"))


def count_by_station(df: DataFrame, name: str, where=None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return df.groupBy("station_id").agg(F.count("id").alias(name))


# ---------------------------------------------------------------- V01 / V12

def station_overview(t: Tables) -> DataFrame:
    """One row per station with point, session, weather, traffic and
    unresolved-anomaly summaries. Counts are 0 when a child is empty,
    measures stay NULL."""
    s = _stations(t, "id", "name", "latitude", "longitude", "city", "state", "country", "operator",
                  "network", "status", "access_type", "created_at", "updated_at")
    p = points_by_station(t.points)
    u = usage_by_station(t.usage)
    w = count_by_station(t.weather, "weather_records_count")
    tr = count_by_station(t.traffic, "traffic_records_count")
    a = count_by_station(t.anomalies, "anomaly_count", F.col("is_resolved") == F.lit(False))
    j = (s.join(p, "station_id", "left").join(u, "station_id", "left").join(w, "station_id", "left")
         .join(tr, "station_id", "left").join(a, "station_id", "left"))
    return finish(j.select(
        "station_id", "station_name", "latitude", "longitude", "city", "state", "country", "operator",
        "network", "status", "access_type",
        F.coalesce("n_points", F.lit(0)).alias("total_charging_points"),
        "avg_power_kw", "max_power_kw",
        F.coalesce("n_sessions", F.lit(0)).alias("total_sessions"),
        "total_energy_kwh",
        F.col("avg_duration_minutes").alias("avg_session_duration_minutes"),
        F.col("avg_cost").alias("avg_session_cost"),
        F.coalesce("weather_records_count", F.lit(0)).alias("weather_records_count"),
        F.coalesce("traffic_records_count", F.lit(0)).alias("traffic_records_count"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
        F.col("last_session").alias("last_session_date"),
        "created_at", "updated_at"))


OVERVIEW_FILLED = ("total_charging_points", "avg_power_kw", "max_power_kw", "total_sessions",
                   "total_energy_kwh", "avg_session_duration_minutes", "avg_session_cost",
                   "weather_records_count", "traffic_records_count", "anomaly_count")


def station_overview_filled(t: Tables) -> DataFrame:
    """V01 with every count and measure filled with 0 (export fallback)."""
    return station_overview(t).fillna(_zero(*OVERVIEW_FILLED))


# ---------------------------------------------------------------- V02 / V13 / V08

def usage_patterns(t: Tables) -> DataFrame:
    """Station × date × hour × day-of-week (0 = Sunday), inner join."""
    u = t.usage.select(
        "station_id", F.to_date("session_start").alias("session_date"),
        F.hour("session_start").cast("bigint").alias("hour_of_day"),
        dow_sunday0("session_start").alias("day_of_week"),
        "energy_consumed_kwh", "duration_minutes", "cost")
    agg = u.groupBy("station_id", "session_date", "hour_of_day", "day_of_week").agg(
        F.count(F.lit(1)).alias("session_count"),
        dsum("energy_consumed_kwh").alias("total_energy_kwh"),
        mean("energy_consumed_kwh").alias("avg_energy_kwh"),
        mean("duration_minutes").alias("avg_duration_minutes"),
        dsum("cost").alias("total_cost"),
        mean("cost").alias("avg_cost"))
    s = _stations(t, "id", "name", "city", "state")
    return finish(agg.join(s, "station_id").select(
        "station_id", "station_name", "city", "state", "session_date", "hour_of_day", "day_of_week",
        F.col("day_of_week").isin(0, 6).alias("is_weekend"),
        "session_count", "total_energy_kwh", "avg_energy_kwh", "avg_duration_minutes", "total_cost",
        "avg_cost"))


def usage_patterns_weekday(t: Tables) -> DataFrame:
    """Monday-first variant of V02 (export fallback); sessions of unknown
    stations are kept (left join); NULL group keys dropped as pandas does."""
    u = t.usage.where(F.col("station_id").isNotNull() & F.col("session_start").isNotNull())
    agg = u.groupBy(
        "station_id", F.to_date("session_start").alias("session_date"),
        F.hour("session_start").cast("bigint").alias("hour_of_day"),
        weekday_monday0("session_start").alias("day_of_week"),
        is_weekend_monday0("session_start").alias("is_weekend"),
    ).agg(
        F.count("id").alias("session_count"),
        dsum("energy_consumed_kwh").alias("total_energy"),
        mean("energy_consumed_kwh").alias("avg_energy"),
        mean("duration_minutes").alias("avg_duration"),
        dsum("cost").alias("total_cost"),
        mean("cost").alias("avg_cost"))
    s = t.stations.select(F.col("id").alias("station_id"), "name", "city", "state")
    return finish(agg.join(s, "station_id", "left"))


DAY_NAMES_SUNDAY0 = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def _day_name_of_dow(dow):
    expr = None
    for i, n in enumerate(DAY_NAMES_SUNDAY0):
        expr = F.when(dow == i, F.lit(n)) if expr is None else expr.when(dow == i, F.lit(n))
    return expr


def hourly_heatmap(t: Tables) -> DataFrame:
    """Station × hour × day-of-week with the day's name."""
    agg = t.usage.groupBy(
        "station_id", F.hour("session_start").cast("bigint").alias("hour_of_day"),
        dow_sunday0("session_start").alias("day_of_week"),
    ).agg(
        F.count(F.lit(1)).alias("session_count"),
        dsum("energy_consumed_kwh").alias("total_energy_kwh"),
        mean("duration_minutes").alias("avg_duration_minutes"))
    s = _stations(t, "id", "name", "city", "state")
    return finish(agg.join(s, "station_id").select(
        "station_id", "station_name", "city", "state", "hour_of_day", "day_of_week",
        _day_name_of_dow(F.col("day_of_week")).alias("day_name"),
        "session_count", "total_energy_kwh", "avg_duration_minutes"))


# ---------------------------------------------------------------- V03 / V04

def hourly_usage_sums(usage: DataFrame) -> DataFrame:
    """Usage reduced to (station, hour) with additive parts (count, sums,
    non-null count of minutes) so that later merges can add them up."""
    return usage.groupBy("station_id", hour_floor("session_start").alias("hour")).agg(
        F.count("id").alias("u_n"),
        F.sum("energy_consumed_kwh").alias("u_energy"),
        F.sum("duration_minutes").alias("u_minutes"),
        F.count("duration_minutes").alias("u_minutes_n"))


HOT_SHARE = 0.001         # a station-hour with this share of all observations is hot: 1,000 at most
SALTS = 32


def _salted(o: DataFrame, hourly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the lookup with a salt: the observations of a hot
    station-hour are spread over ``SALTS`` keys, and its usage row is repeated
    for each of them; all others have salt 0. Hot keys are counted in ``o``
    itself (sums per key, combined before the shuffle); by their share there
    are at most 1 / HOT_SHARE of them, which bounds the broadcast."""
    cells = o.groupBy("station_id", "hour").agg(F.sum("_times").alias("n"))
    hot = attach_one_row(cells, cells.agg(F.sum("n").alias("_all"))) \
        .where(F.col("n") >= F.col("_all") * HOT_SHARE) \
        .select(F.col("station_id").alias("_s"), F.col("hour").alias("_h"), F.lit(True).alias("_hot"))
    # null-safe, or Spark would filter NULL hours out of the observations that
    # are counted, but not out of those that are kept, and compute them twice
    mark = lambda df: df.join(F.broadcast(hot), df["station_id"].eqNullSafe(hot["_s"])
                              & df["hour"].eqNullSafe(hot["_h"]), "left").drop("_s", "_h")
    spread = F.pmod(F.xxhash64(*[c for c in o.columns if c not in ("station_id", "hour")]), F.lit(SALTS))
    left = mark(o).withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0).cast("bigint"))).drop("_hot")
    copies = F.sequence(F.lit(0).cast("bigint"), F.when(F.col("_hot"), F.lit(SALTS - 1)).otherwise(F.lit(0)).cast("bigint"))
    return left, mark(hourly).withColumn("_salt", F.explode(copies)).drop("_hot")


def _observation_correlation(obs: DataFrame, t: Tables, measures: list[str], prefix: str,
                             date_name: str) -> DataFrame:
    """Shared body of V03/V04: equal observations are merged into one row
    with their number first (the view groups by the observation's columns, not
    its id; the count combines map-side), then each is left-joined to the
    same-hour usage of its station, whose sums count once per observation.
    Station-hours with very many different observations are salted."""
    hourly = hourly_usage_sums(t.usage)
    s = _stations(t, "id", "name")
    o = obs.where(F.col("station_id").isNotNull()).groupBy("station_id", "timestamp", *measures).agg(
        F.count(F.lit(1)).alias("_times")).withColumn("hour", hour_floor("timestamp"))
    o, hourly = _salted(o, hourly)
    j = o.join(s, "station_id").join(hourly, ["station_id", "hour", "_salt"], "left")
    return finish(j.select(
        "station_id", "station_name", "timestamp",
        F.to_date("timestamp").alias(date_name),
        F.hour("timestamp").cast("bigint").alias("hour_of_day"),
        *measures,
        F.coalesce(F.col("u_n") * F.col("_times"), F.lit(0)).alias(f"sessions_during_{prefix}"),
        (F.col("u_energy") * F.col("_times")).cast("double").alias(f"energy_during_{prefix}"),
        F.round(F.try_divide(F.col("u_minutes").cast("double"), F.col("u_minutes_n").cast("double")), 6)
        .alias(f"avg_duration_during_{prefix}")))


WEATHER_MEASURES = ["temperature_celsius", "humidity_percent", "pressure_hpa", "wind_speed_ms",
                    "precipitation_mm", "weather_condition", "uv_index"]
TRAFFIC_MEASURES = ["traffic_density", "average_speed_kmh", "congestion_level", "road_type",
                    "distance_to_station_km"]


def weather_correlation(t: Tables) -> DataFrame:
    """V03."""
    return _observation_correlation(t.weather, t, WEATHER_MEASURES, "weather", "weather_date")


def traffic_correlation(t: Tables) -> DataFrame:
    """V04."""
    return _observation_correlation(t.traffic, t, TRAFFIC_MEASURES, "traffic", "traffic_date")


# ---------------------------------------------------------------- V05 / V06

def energy_trends(t: Tables) -> DataFrame:
    """Daily energy rows with station attributes and energy per session."""
    e = t.with_energy().energy
    s = _stations(t, "id", "name", "city", "state")
    return finish(e.join(s, "station_id").select(
        "station_id", "station_name", "city", "state", "date",
        dow_sunday0("date").alias("day_of_week"),
        dow_sunday0("date").isin(0, 6).alias("is_weekend"),
        "total_energy_kwh", "peak_hour_energy", "off_peak_energy", "session_count",
        "avg_session_duration",
        F.round(F.try_divide(F.col("total_energy_kwh").cast("double"),
                             F.nullif(F.col("session_count"), F.lit(0)).cast("double")), 6)
        .alias("energy_per_session")))


def anomaly_summary(t: Tables, as_of: _dt.datetime) -> DataFrame:
    """Anomalies with station attributes and ``days_open`` measured to
    ``resolved_at`` or, when open, to the explicit ``as_of`` instant."""
    s = _stations(t, "id", "name", "city", "state")
    now = ntz_literal(as_of)
    end = F.coalesce(F.col("resolved_at"), now)
    return finish(t.anomalies.join(s, "station_id").select(
        "station_id", "station_name", "city", "state", "anomaly_type", "severity_score",
        "detected_at", F.to_date("detected_at").alias("anomaly_date"), "description", "is_resolved",
        "resolved_at",
        F.round(F.timestamp_diff("MICROSECOND", F.col("detected_at"), end).cast("double") / 8.64e10, 6)
        .alias("days_open")))


# ---------------------------------------------------------------- V07 / V09 / V11

def station_performance(t: Tables) -> DataFrame:
    """V07 — the flagship query."""
    s = _stations(t, "id", "name", "city", "state", "operator")
    u = usage_by_station(t.usage)
    p = points_by_station(t.points)
    a = t.anomalies.groupBy("station_id").agg(
        F.count(F.when(F.col("is_resolved") == F.lit(False), F.col("id"))).alias("open_anomalies"))
    j = s.join(u, "station_id", "left").join(p, "station_id", "left").join(a, "station_id", "left")
    return finish(j.select(
        "station_id", "station_name", "city", "state", "operator",
        F.coalesce("n_sessions", F.lit(0)).alias("total_sessions"),
        "total_energy_kwh", "avg_duration_minutes", "avg_cost", "total_revenue",
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        "last_session", "first_session",
        F.coalesce("n_points", F.lit(0)).alias("charging_points_count"),
        "avg_power_kw",
        F.coalesce("open_anomalies", F.lit(0)).alias("open_anomalies")))


def geographic_distribution(t: Tables) -> DataFrame:
    """V09."""
    s = _stations(t, "id", "name", "latitude", "longitude", "city", "state", "country", "operator",
                  "status")
    u = t.usage.groupBy("station_id").agg(
        F.count("id").alias("n_sessions"), dsum("energy_consumed_kwh").alias("total_energy_kwh"),
        mean("cost").alias("avg_cost"))
    p = t.points.groupBy("station_id").agg(F.count("id").alias("n_points"))
    j = s.join(u, "station_id", "left").join(p, "station_id", "left")
    return finish(j.select(
        "station_id", "station_name", "latitude", "longitude", "city", "state", "country", "operator",
        "status", F.coalesce("n_sessions", F.lit(0)).alias("total_sessions"), "total_energy_kwh",
        "avg_cost", F.coalesce("n_points", F.lit(0)).alias("charging_points_count")))


def station_statistics(t: Tables, station_id: str | None = None) -> DataFrame:
    """weather/traffic/anomaly counts and two averages per station,
    optionally for one station (the filter reaches every scan)."""
    if station_id is not None:
        t = t.where_station(station_id)
    w = t.weather.groupBy("station_id").agg(F.count("id").alias("weather_records"),
                                            mean("temperature_celsius").alias("avg_temperature"))
    tr = t.traffic.groupBy("station_id").agg(F.count("id").alias("traffic_records"),
                                             mean("traffic_density").alias("avg_traffic_density"))
    a = count_by_station(t.anomalies, "anomaly_count")
    s = t.stations.select(F.col("id").alias("station_id"), "name", "city", "state")
    j = s.join(w, "station_id", "left").join(tr, "station_id", "left").join(a, "station_id", "left")
    # The reference turns a 0 average into None (``float(x) if x else None``).
    return finish(j.select(
        "station_id", "name", "city", "state",
        F.coalesce("weather_records", F.lit(0)).alias("weather_records"),
        F.coalesce("traffic_records", F.lit(0)).alias("traffic_records"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
        F.nullif(F.col("avg_temperature"), F.lit(0.0)).alias("avg_temperature"),
        F.nullif(F.col("avg_traffic_density"), F.lit(0.0)).alias("avg_traffic_density")))


# ---------------------------------------------------------------- V10

def collection_status(t: Tables) -> DataFrame:
    """Audit rows with date, duration in seconds and success flag."""
    return finish(t.log.select(
        "id", "data_source", "collection_type", "records_collected", "status", "error_message",
        "started_at", "completed_at", F.to_date("started_at").alias("collection_date"),
        (F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at")).cast("double") / 1e6)
        .alias("duration_seconds"),
        F.coalesce(F.col("status") == F.lit("success"), F.lit(False)).alias("is_successful")))

