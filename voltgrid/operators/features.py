"""Engineered features per station.

F01 reproduces the collection cycle's feature rules literally (they read the
weather and traffic tables; "sessions" are weather rows and "energy" is 0.1 ×
the temperature sum). F02 is the re-aimed form computed from real usage.

The reference filters the whole weather/traffic frames once per station
(O(stations × rows)); here each side is aggregated once per station with
partial aggregation and left-joined to the station list.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltgrid.functions.columns import hour_floor, ntz_literal
from voltgrid.schemas import conform

# Fixed values of the feature rules.
HOLIDAYS = [(1, 1), (7, 4), (12, 25)]          # (month, day)
STORM_RAIN_SNOW = "(?i)storm|rain|snow"        # 30 minutes of downtime per matching observation
STORM_THUNDER = "(?i)storm|thunder"
DOWNTIME_PER_STORM = 30.0
WAIT_SEVERE, WAIT_MODERATE, WAIT_LIGHT = 45.0, 20.0, 5.0
ENERGY_PER_DEGREE = 0.1


def _calendar(as_of: _dt.datetime) -> list:
    wd = as_of.weekday()
    return [F.lit(as_of.date()).alias("date"), F.lit(as_of.hour).alias("hour_of_day"),
            F.lit(wd).alias("day_of_week"), F.lit(wd >= 5).alias("is_weekend"),
            F.lit((as_of.month, as_of.day) in HOLIDAYS).alias("is_holiday")]


def _weather_side(weather: DataFrame) -> DataFrame:
    c = F.col("weather_condition")
    return weather.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("w_rows"),
        F.count_if(F.coalesce(c.rlike(STORM_RAIN_SNOW), F.lit(False))).alias("w_storm_rain_snow"),
        F.bool_or(F.coalesce(c.rlike(STORM_THUNDER), F.lit(False))).alias("w_storm"),
        F.sum(F.col("temperature_celsius").cast("double")).alias("w_temp_sum"),
        F.count("temperature_celsius").alias("w_temp_n"),
        F.sum("temperature_celsius").alias("w_temp_sum_exact"))


def _traffic_side(traffic: DataFrame) -> DataFrame:
    c = F.col("congestion_level")
    return traffic.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("t_rows"),
        F.sum(F.col("traffic_density").cast("double")).alias("t_density_sum"),
        F.count("traffic_density").alias("t_density_n"),
        F.bool_or(F.coalesce(c == "severe", F.lit(False))).alias("t_severe"),
        F.bool_or(F.coalesce(c == "moderate", F.lit(False))).alias("t_moderate"))


def _wait_time():
    return (F.when(F.coalesce(F.col("t_rows"), F.lit(0)) == 0, F.lit(0.0))
            .when(F.col("t_severe"), F.lit(WAIT_SEVERE))
            .when(F.col("t_moderate"), F.lit(WAIT_MODERATE))
            .otherwise(F.lit(WAIT_LIGHT)))


def engineer_features(stations: DataFrame, weather: DataFrame, traffic: DataFrame,
                      as_of: _dt.datetime) -> DataFrame:
    """one row per station with the 13 feature fields of the reference."""
    s = stations.where(F.col("id").isNotNull() & (F.col("id") != "")).select(F.col("id").alias("station_id"))
    j = s.join(_weather_side(weather), "station_id", "left").join(_traffic_side(traffic), "station_id", "left")
    has_w = F.coalesce(F.col("w_rows"), F.lit(0)) > 0
    has_t = F.coalesce(F.col("t_rows"), F.lit(0)) > 0
    avg_temp = F.try_divide(F.col("w_temp_sum"), F.col("w_temp_n").cast("double"))
    avg_dens = F.try_divide(F.col("t_density_sum"), F.col("t_density_n").cast("double"))
    out = j.select(
        "station_id", *_calendar(as_of),
        F.when(has_w, F.col("w_storm_rain_snow") * DOWNTIME_PER_STORM).otherwise(F.lit(0.0))
        .alias("avg_downtime_minutes"),
        F.when(has_w & has_t, F.try_divide(avg_temp, F.greatest(avg_dens, F.lit(1.0)))).otherwise(F.lit(0.0))
        .alias("energy_consumption_per_traffic"),
        F.coalesce(F.col("w_storm"), F.lit(False)).alias("usage_spike_during_storm"),
        F.coalesce(F.col("w_rows"), F.lit(0)).alias("peak_usage_hours"),
        _wait_time().alias("avg_wait_time_minutes"),
        F.coalesce(F.col("w_rows"), F.lit(0)).alias("total_sessions"),
        F.coalesce(F.col("w_temp_sum_exact") * F.lit(ENERGY_PER_DEGREE).cast("decimal(2,1)"),
                   F.lit(0).cast("decimal(2,1)")).alias("total_energy_kwh"),
        ntz_literal(as_of).alias("created_at"))
    return conform(out, "engineered_features", computed=True)


def _usage_and_weather(usage: DataFrame, weather: DataFrame) -> DataFrame:
    """Per station the usage and weather figures of F02. Both tables become
    (station, hour) cells, stacked and added up per cell, then per hour of day,
    then per station: one scan of each, and only cells are shuffled."""
    u = usage.where(F.col("station_id").isNotNull() & F.col("session_start").isNotNull()).select(
        "station_id", hour_floor("session_start").alias("hour"), F.lit(1).alias("session"),
        F.col("energy_consumed_kwh").alias("e"), F.lit(None).cast("string").alias("c"), F.lit(0).alias("observation"))
    w = weather.where(F.col("station_id").isNotNull()).select(
        "station_id", hour_floor("timestamp").alias("hour"), F.lit(0), F.lit(None).cast("decimal(10,3)"),
        F.col("weather_condition"), F.lit(1))
    match = lambda pattern: F.coalesce(F.col("c").rlike(pattern), F.lit(False))
    cells = u.union(w).groupBy("station_id", "hour").agg(
        F.sum("session").alias("n"), F.sum("e").alias("e"), F.count("e").alias("e_n"),
        F.sum("observation").alias("w_rows"), F.count_if(match(STORM_RAIN_SNOW)).alias("w_storm_rain_snow"),
        F.bool_or(match(STORM_THUNDER)).alias("storm"))
    active, storm = F.col("n") > 0, (F.col("n") > 0) & F.col("storm") & F.col("hour").isNotNull()
    of_day = cells.groupBy("station_id", F.hour("hour").alias("h")).agg(
        F.sum("n").alias("n"), F.sum("e").alias("e"), F.sum("e_n").alias("e_n"), F.sum("w_rows").alias("w_rows"),
        F.sum("w_storm_rain_snow").alias("w_storm_rain_snow"), F.count_if(active).alias("hours"),
        F.sum(F.when(storm, F.col("n"))).alias("storm_n"), F.count_if(storm).alias("storm_hours"))
    # busiest hour of day: max of (n, -h) picks the earliest hour among ties
    busiest = F.max(F.when(F.col("n") > 0, F.struct("n", (-F.col("h")).alias("neg_h"))))
    total = lambda c: F.sum(c).cast("double")
    return of_day.groupBy("station_id").agg(
        F.sum("n").alias("u_sessions"), F.sum("e").alias("u_energy"),
        F.try_divide(total("e"), total("e_n")).alias("u_energy_avg"), (-busiest["neg_h"]).alias("busiest_hour"),
        F.try_divide(total("n"), total("hours")).alias("mean_hour"),
        F.try_divide(total("storm_n"), total("storm_hours")).alias("mean_storm_hour"),
        F.sum("w_rows").alias("w_rows"), F.sum("w_storm_rain_snow").alias("w_storm_rain_snow"))


def usage_features(stations: DataFrame, usage: DataFrame, weather: DataFrame, traffic: DataFrame,
                   as_of: _dt.datetime) -> DataFrame:
    """the feature schema computed from real sessions — sessions and
    energy, the busiest hour of day, mean session energy per unit of traffic
    density, whether storm hours see more sessions than the station's average
    active hour, plus F01's downtime and wait rules."""
    s = stations.where(F.col("id").isNotNull()).select(F.col("id").alias("station_id"))
    j = (s.join(_usage_and_weather(usage, weather), "station_id", "left")
         .join(_traffic_side(traffic), "station_id", "left"))
    has_w = F.coalesce(F.col("w_rows"), F.lit(0)) > 0
    has_t = F.coalesce(F.col("t_rows"), F.lit(0)) > 0
    avg_dens = F.try_divide(F.col("t_density_sum"), F.col("t_density_n").cast("double"))
    out = j.select(
        "station_id", *_calendar(as_of),
        F.when(has_w, F.col("w_storm_rain_snow") * DOWNTIME_PER_STORM).otherwise(F.lit(0.0))
        .alias("avg_downtime_minutes"),
        F.when(has_t, F.coalesce(F.try_divide(F.col("u_energy_avg"), F.greatest(avg_dens, F.lit(1.0))),
                                 F.lit(0.0))).otherwise(F.lit(0.0))
        .alias("energy_consumption_per_traffic"),
        F.coalesce(F.col("mean_storm_hour") > F.col("mean_hour"), F.lit(False)).alias("usage_spike_during_storm"),
        F.coalesce(F.col("busiest_hour"), F.lit(0)).alias("peak_usage_hours"),
        _wait_time().alias("avg_wait_time_minutes"),
        F.coalesce(F.col("u_sessions"), F.lit(0)).alias("total_sessions"),
        F.coalesce(F.col("u_energy"), F.lit(0).cast("decimal(38,3)")).alias("total_energy_kwh"),
        ntz_literal(as_of).alias("created_at"))
    return conform(out, "engineered_features", computed=True)
