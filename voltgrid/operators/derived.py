"""Derived tables the reference promises but fills with random
numbers or leaves out (re-aimed as real Spark jobs)."""

from __future__ import annotations

import math
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltgrid.functions.columns import EARTH_RADIUS_KM, bbox, day_floor, haversine_km, month_floor
from voltgrid.operators.patterns import PEAK_FACTOR
from voltgrid.schemas import conform

# Fixed values of the quota monitor: three services, 1000 calls per period.
QUOTA_LIMIT = 1000
DEFAULT_QUOTAS = {"openchargemap": ("day", 1000), "openweather": ("day", 1000), "here_maps": ("month", 1000)}


def energy_consumption_daily(usage: DataFrame, peak: DataFrame | None = None) -> DataFrame:
    """Per station × day — total energy, energy of sessions that start in
    the station's peak hours (P01 unless ``peak`` (station_id, hour) is given),
    off-peak energy (total − peak), sessions and mean minutes (rounded).

    Usage is reduced to (station, day, hour) cells in one scan; a station's
    hours of day are added up from its cells (as many as it has hours with a
    session), so its peak hours need no second look at the sessions."""
    u = usage.where(F.col("station_id").isNotNull() & F.col("session_start").isNotNull())
    cells = u.groupBy("station_id", F.to_date("session_start").alias("date"),
                      F.hour("session_start").cast("bigint").alias("hour")).agg(
        F.sum("energy_consumed_kwh").alias("e"), F.count(F.lit(1)).alias("n"),
        F.sum("duration_minutes").alias("d"), F.count("duration_minutes").alias("dn"))
    if peak is None:
        station = Window.partitionBy("station_id")
        mean_hourly = F.sum("n").over(station).cast("double") / F.size(F.collect_set("hour").over(station))
        j = cells.select("*", F.sum("n").over(Window.partitionBy("station_id", "hour")).alias("of_hour"),
                         mean_hourly.alias("mean_hourly")) \
            .withColumn("is_peak", F.col("of_hour") >= F.col("mean_hourly") * PEAK_FACTOR)
    else:
        flags = peak.select("station_id", "hour", F.lit(True).alias("is_peak"))
        j = cells.join(flags, ["station_id", "hour"], "left")
    zero = F.lit(0).cast("decimal(38,3)")
    daily = j.groupBy("station_id", "date").agg(
        F.coalesce(F.sum("e"), zero).alias("total_energy_kwh"),
        F.coalesce(F.sum(F.when(F.col("is_peak"), F.col("e"))), zero).alias("peak_hour_energy"),
        F.sum("n").alias("session_count"),
        F.round(F.try_divide(F.sum("d").cast("double"), F.sum("dn").cast("double")), 0).alias("avg_session_duration"))
    out = daily.withColumn("off_peak_energy", F.col("total_energy_kwh") - F.col("peak_hour_energy"))
    return conform(out, "energy_consumption", computed=True)


def quota_periods(log: DataFrame, quotas: dict | None = None, default=("day", QUOTA_LIMIT)) -> DataFrame:
    """Each call with its service's kind of period, the start of the period it
    falls into, and the limit."""
    quotas = quotas or DEFAULT_QUOTAS
    svc = F.col("data_source")
    period, limit = F.lit(default[0]), F.lit(default[1])
    for name, (p, lim) in quotas.items():
        period = F.when(svc == name, F.lit(p)).otherwise(period)
        limit = F.when(svc == name, F.lit(lim)).otherwise(limit)
    ts = F.col("started_at")
    start = F.when(period == "month", month_floor(ts)).otherwise(day_floor(ts))
    return log.where(svc.isNotNull() & ts.isNotNull()).select(
        svc.alias("service"), period.alias("period"), start.alias("period_start"),
        limit.cast("bigint").alias("quota_limit"))


def quota_columns(counted: DataFrame) -> DataFrame:
    return counted.select("service", "period", "period_start", "calls", "quota_limit",
                          (F.col("quota_limit") - F.col("calls")).alias("remaining"),
                          (F.col("calls") < F.col("quota_limit")).alias("can_use"))


def quota_usage(log: DataFrame, quotas: dict | None = None, default=("day", QUOTA_LIMIT)) -> DataFrame:
    """Calls per service per quota period (calendar day or month; the
    counter restarts with each period), limit, remaining calls and
    ``can_use = calls < limit``. One log row is one call of its data source."""
    g = quota_periods(log, quotas, default).groupBy("service", "period", "period_start", "quota_limit")
    return quota_columns(g.agg(F.count(F.lit(1)).alias("calls")))


def collection_success_rate(log: DataFrame) -> DataFrame:
    """Per data source — runs, successful runs, success share, records
    collected and the latest run."""
    ok = F.col("status") == "success"
    return log.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("successful_runs"),
        F.round(F.count_if(ok) / F.count(F.lit(1)), 6).alias("success_rate"),
        F.coalesce(F.sum("records_collected").cast("bigint"), F.lit(0).cast("bigint")).alias("records_collected"),
        F.max("started_at").alias("last_run"))


def _degrees(value: float, up: bool) -> Decimal:
    """A bound at the stored precision, rounded outwards: a decimal literal of
    the column's own type, so that the range reaches the parquet scan."""
    return Decimal(value).quantize(Decimal("1e-8"), rounding=ROUND_CEILING if up else ROUND_FLOOR)


def _range(c: str, lo: float, hi: float):
    return F.col(c).between(F.lit(_degrees(lo, False)), F.lit(_degrees(hi, True)))


def _longitudes(west: float, east: float):
    """Between two longitudes, across the antimeridian if they pass it; all
    if the range is a whole circle."""
    if east - west >= 360:
        return F.lit(True)
    if west < -180:
        return _range("longitude", west + 360, 180) | _range("longitude", -180, east)
    if east > 180:
        return _range("longitude", west, 180) | _range("longitude", -180, east - 360)
    return _range("longitude", west, east)


def stations_within(stations: DataFrame, lat: float, lon: float, radius_km: float) -> DataFrame:
    """Stations within ``radius_km`` of a point — latitude and longitude
    ranges first (decimal comparisons that are pushed to the parquet scan and
    its row-group statistics), the exact haversine distance second. A circle
    that holds a pole takes all longitudes."""
    angle = radius_km / EARTH_RADIUS_KM
    dlat = math.degrees(angle) + 1e-6
    box = _range("latitude", max(-90.0, lat - dlat), min(90.0, lat + dlat))
    if angle < math.pi / 2 and abs(lat) + dlat < 90:
        dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + 1e-6
        box = box & _longitudes(lon - dlon, lon + dlon)
    la, lo = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    dist = haversine_km(F.lit(lat), F.lit(lon), la, lo)
    return stations.where(box).withColumn("distance_km", F.round(dist, 6)) \
        .where(F.col("distance_km") <= radius_km)


def points_in_bbox(df: DataFrame, lat: float, lon: float, radius_km: float) -> DataFrame:
    """Rows whose coordinates fall inside the traffic service's bounding
    box around a point (S13 approximation; at latitude 0 it takes all
    longitudes). The ranges reach the scan; the box itself decides."""
    b = bbox(F.lit(lat), F.lit(lon), radius_km)
    dlat = radius_km / 111.0
    dlon = min(360.0, radius_km / (111.0 * abs(lat) / 90.0)) if lat else 360.0
    la, lo = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    pushed = _range("latitude", max(-90.0, lat - dlat), min(90.0, lat + dlat)) \
        & _range("longitude", max(-180.0, lon - dlon), min(180.0, lon + dlon))
    return df.where(pushed).where(la.between(b["south"], b["north"]) & lo.between(b["west"], b["east"]))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The promised per-station lookups (stations, weather, traffic,
    anomalies) as scans with a pushed equality filter."""
    return df.where(F.col(key) == F.lit(value))

