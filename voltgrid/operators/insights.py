"""Network and station insights with rule-based recommendations.

Each section of the reference's nested result document is its own lazy
DataFrame; ``voltgrid.plans.bundles`` assembles them. Thresholds against an
aggregate (quartiles of per-station counts) are one-row aggregates broadcast
back (J09); the quartiles are exact (``functions.quantiles``). Lists are rows,
one for each station or state concerned; limits are optional and default to
none.

B04–B08 read one table of units: a row for each station, with its sessions,
revenue and points from a single aggregate, and for B07 and B08 a row for each
state. The thresholds of all rules are attached to it once, and each unit gives
an array of the rules that it meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltgrid.functions.columns import dsum, mean
from voltgrid.functions.groupstats import attach_one_row
from voltgrid.functions.quantiles import exact_quantiles

# Fixed values of the recommendation rules.
LOW_QUANTILE = 0.25
HIGH_QUANTILE = 0.75
MIN_POINTS = 4             # fewer points than this on a high-demand station → expansion
HIGH_UTILIZATION = 50      # sessions per point above this → capacity
LOW_AVG_REVENUE = 10       # mean cost per session below this → pricing
# The sentences.
NO_DATA_TEXT = "Collect more usage data to generate insights"
LOW_USAGE_TEXT = "%d stations have low usage. Consider marketing or relocation."
EXPANSION_TEXT = "Station %s has high demand but only %d charging points. Consider expansion."
LOW_REVENUE_TEXT = "%d stations have low revenue. Review pricing strategy."
GAP_TEXT = "Consider expanding to states with low coverage: "


def half_up_text(num: Column, den: Column, places: int) -> Column:
    """Decimal text of num/den rounded half-up to ``places`` digits, from
    exact integer arithmetic (no float formatting differences between
    engines). Intended for non-negative values."""
    scale = 10 ** places
    q = F.floor((2 * num * scale + den) / (2 * den)).cast("bigint")
    if places == 0:
        return q.cast("string")
    return F.concat(F.floor(q / scale).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((q % scale).cast("string"), places, "0"))


def _nonempty(df: DataFrame) -> DataFrame:
    """A one-row frame when ``df`` has rows, else empty (a guard to attach)."""
    return df.agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 0)


def _sessions_by_station(usage: DataFrame) -> DataFrame:
    return usage.where(F.col("station_id").isNotNull()).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.coalesce(F.sum("cost"), F.lit(0)).alias("revenue"))


def _points_by_station(points: DataFrame) -> DataFrame:
    return points.where(F.col("station_id").isNotNull()).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("points"))


# ---------------------------------------------------------------- B01–B03

def network_overview(stations: DataFrame, usage: DataFrame, points: DataFrame) -> DataFrame:
    """Totals of stations, points and sessions; points per station."""
    s = stations.agg(F.count(F.lit(1)).alias("total_stations"))
    p = points.agg(F.count(F.lit(1)).alias("total_charging_points"))
    u = usage.agg(F.count(F.lit(1)).alias("total_sessions"))
    return attach_one_row(attach_one_row(s, p), u).select(
        "total_stations", "total_charging_points", "total_sessions",
        F.coalesce(F.round(F.try_divide(F.col("total_charging_points").cast("double"),
                                        F.col("total_stations").cast("double")), 6), F.lit(0.0))
        .alias("avg_points_per_station"))


def stations_by(stations: DataFrame, dim: str) -> DataFrame:
    """Station counts per value of ``dim`` (state, city, operator),
    NULLs dropped, largest first."""
    return (stations.where(F.col(dim).isNotNull()).groupBy(dim)
            .agg(F.count(F.lit(1)).alias("station_count"))
            .orderBy(F.col("station_count").desc(), F.col(dim)))


def performance_metrics(stations: DataFrame, usage: DataFrame) -> DataFrame:
    """Session, energy, duration, revenue and utilisation figures
    (no row when there is no usage)."""
    u = usage.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.coalesce(dsum("energy_consumed_kwh"), F.lit(0.0)).alias("total_energy_kwh"),
        mean("duration_minutes").alias("avg_duration_minutes"),
        F.coalesce(dsum("cost"), F.lit(0.0)).alias("total_revenue"),
        F.count_distinct("station_id").alias("active_stations"))
    s = stations.agg(F.count(F.lit(1)).alias("n_stations"))
    per = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b).cast("double")), 6)
    return attach_one_row(u.where(F.col("total_sessions") > 0), s).select(
        "total_sessions", "total_energy_kwh",
        per("total_energy_kwh", "total_sessions").alias("avg_energy_per_session_kwh"),
        "avg_duration_minutes", "total_revenue",
        per("total_revenue", "total_sessions").alias("avg_cost_per_session"),
        "active_stations",
        F.coalesce(F.round(F.try_divide(F.col("active_stations") * 100.0, F.col("n_stations").cast("double")), 6),
                   F.lit(0.0)).alias("utilization_rate_percent"))


# ---------------------------------------------------------------- B04–B08

UNIT = "station_id string, state string, sessions bigint, revenue decimal(38,2), points bigint, station_count bigint"


def _units(usage: DataFrame | None = None, points: DataFrame | None = None,
           stations: DataFrame | None = None) -> DataFrame:
    """The units that the rules speak of: stations that are known by a session
    or a point (NULL, too, for the totals), and states. One aggregate over one
    scan of each table given."""
    none = lambda kind: F.lit(None).cast(kind)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    row = lambda df, **c: df.select(*[c.get(f.split()[0], none(f.split()[1])).cast(f.split()[1]).alias(f.split()[0])
                                      for f in UNIT.split(", ")])
    sid = F.col("station_id")
    parts = []
    if usage is not None:
        parts.append(row(usage, station_id=sid, sessions=one, revenue=F.col("cost"), points=zero))
    if points is not None:
        parts.append(row(points, station_id=sid, sessions=zero, points=one))
    if stations is not None:
        parts.append(row(stations.where(F.col("state").isNotNull()), state=F.col("state"), station_count=one))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    units = rows.groupBy("station_id", "state").agg(
        F.sum("sessions").alias("sessions"), F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"),
        F.sum("points").alias("points"), F.sum("station_count").alias("station_count"))
    # true of every unit; it reads all measures, so that every use of the units
    # asks for the same columns and their shuffle is written once
    return units.where((F.col("sessions") >= 0) | (F.col("points") >= 0) | (F.col("station_count") > 0)
                       | (F.col("revenue") > 0))


def _flagged(units: DataFrame) -> DataFrame:
    """The units with the flags of B04–B07. A station without sessions has no
    part in the thresholds and no flag."""
    active = F.col("station_id").isNotNull() & (F.col("sessions") > 0)
    thr = exact_quantiles(
        units.select(
            F.when(active, F.col("sessions")).alias("sessions"), F.when(active, F.col("revenue")).alias("revenue"),
            "station_count"),
        [("sessions", LOW_QUANTILE, "low_sessions"), ("sessions", HIGH_QUANTILE, "high_sessions"),
         ("revenue", LOW_QUANTILE, "low_revenue"), ("station_count", LOW_QUANTILE, "few_stations")])
    return attach_one_row(units, thr).select(
        *units.columns, "low_sessions_below", "low_revenue_below", (active & (F.col("sessions") < F.col("low_sessions"))).alias("low"),
        (active & (F.col("sessions") > F.col("high_sessions"))).alias("high"),
        (active & (F.col("revenue").cast("double") < F.col("low_revenue"))).alias("poor"),
        (F.col("station_count") < F.col("few_stations")).alias("few"))


REC = "type string, priority string, recommendation string, station_id string, state string, n_stations bigint, points bigint"


def _recommendations(units: DataFrame, with_points: bool = False) -> DataFrame:
    """One row (``REC``) for each rule that a unit meets; the sentences of B04
    and B06 name the number of stations flagged, which is the number of values
    below the threshold."""
    any_point = units.agg(F.sum("points").alias("all_points"))
    one_each = attach_one_row(_flagged(units), any_point) if with_points else _flagged(units).withColumn(
        "all_points", F.lit(0))
    points, n_low, n_poor = F.coalesce("points", F.lit(0)), F.col("low_sessions_below"), F.col("low_revenue_below")

    def rule(when: Column, **c) -> Column:
        return F.when(when, F.struct(*[c.get(f.split()[0], F.lit(None)).cast(f.split()[1]).alias(f.split()[0])
                                       for f in REC.split(", ")]))

    sid, state = F.col("station_id"), F.col("state")
    rules = F.array(
        rule(F.col("low"), type=F.lit("underutilized_stations"), priority=F.lit("medium"), station_id=sid,
             recommendation=F.format_string(LOW_USAGE_TEXT, n_low), n_stations=n_low),
        rule(F.col("high") & (points < MIN_POINTS) & (F.col("all_points") > 0), type=F.lit("capacity_expansion"),
             priority=F.lit("high"), station_id=sid, points=points,
             recommendation=F.format_string(EXPANSION_TEXT, "station_id", points)),
        rule(F.col("poor"), type=F.lit("pricing_optimization"), priority=F.lit("medium"), station_id=sid,
             recommendation=F.format_string(LOW_REVENUE_TEXT, n_poor), n_stations=n_poor),
        rule(F.col("few"), type=F.lit("geographic_expansion"), priority=F.lit("low"), state=state,
             recommendation=F.concat(F.lit(GAP_TEXT), F.lit("['"), state, F.lit("']"))))
    return one_each.select(F.inline(F.array_compact(rules)))


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy("station_id").limit(limit)


def underutilized_stations(usage: DataFrame, limit: int | None = None) -> DataFrame:
    """Stations with fewer sessions than the 25th percentile (the first
    ``limit`` by id, if given); the sentence names the number of all."""
    recs = _recommendations(_units(usage)).where(F.col("type") == "underutilized_stations")
    return _first(recs, limit).select("type", "priority", "recommendation", "n_stations", "station_id")


def capacity_expansion(usage: DataFrame, points: DataFrame, limit: int | None = None) -> DataFrame:
    """The stations above the 75th percentile of sessions (the first
    ``limit`` by id, if given) with fewer than four points. Skipped when no
    point is known at all."""
    units = _units(usage, points)
    if limit is not None:
        high = _flagged(units).where("high").orderBy("station_id").limit(limit).select("station_id")
        return capacity_expansion(usage, points).join(F.broadcast(high), "station_id", "left_semi").select(
            "type", "priority", "recommendation", "station_id", "points")
    return _recommendations(units, True).where(F.col("type") == "capacity_expansion").select(
        "type", "priority", "recommendation", "station_id", "points")


def pricing_optimization(usage: DataFrame, limit: int | None = None) -> DataFrame:
    """Stations whose revenue is below the 25th percentile (the first
    ``limit`` by id, if given); the sentence names the number of all."""
    recs = _recommendations(_units(usage)).where(F.col("type") == "pricing_optimization")
    return _first(recs, limit).select("type", "priority", "recommendation", "n_stations", "station_id")


def geographic_gaps(stations: DataFrame) -> DataFrame:
    """States whose station count is below the 25th percentile."""
    return _flagged(_units(stations=stations)).where("few").select("state", "station_count")


def network_recommendations(stations: DataFrame, usage: DataFrame, points: DataFrame) -> DataFrame:
    """B04–B07 as one table (type, priority, recommendation, station_id,
    state), one row for each station or state concerned; without any usage,
    the single data-collection row instead of the stations' rows."""
    none = F.lit(None).cast("string")
    units = _units(usage, points, stations)
    recs = _recommendations(units, True).select("type", "priority", "recommendation", "station_id", "state")
    no_usage = usage.agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") == 0)
    return recs.unionByName(no_usage.select(
        F.lit("data_collection").alias("type"), F.lit("high").alias("priority"),
        F.lit(NO_DATA_TEXT).alias("recommendation"), none.alias("station_id"), none.alias("state")))


# ---------------------------------------------------------------- B09–B13

def revenue_summary(usage: DataFrame) -> DataFrame:
    """Total revenue and mean revenue per session."""
    return usage.agg(F.count(F.lit(1)).alias("_rows"),
                     F.coalesce(dsum("cost"), F.lit(0.0)).alias("total_revenue"),
                     mean("cost").alias("avg_revenue_per_session")) \
        .where(F.col("_rows") > 0).drop("_rows")


def top_revenue_stations(usage: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` stations with the highest revenue (ties by id)."""
    rev = usage.where(F.col("station_id").isNotNull()).groupBy("station_id") \
        .agg(F.coalesce(dsum("cost"), F.lit(0.0)).alias("revenue"))
    order = [F.col("revenue").desc(), F.col("station_id")]
    top = rev.orderBy(*order).limit(n)
    # rank over the n kept rows only
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def daily_revenue(usage: DataFrame) -> DataFrame:
    """Revenue per calendar day."""
    return usage.where(F.col("session_start").isNotNull()).groupBy(
        F.to_date("session_start").alias("date")).agg(F.coalesce(dsum("cost"), F.lit(0.0)).alias("revenue"))


def revenue_trend(usage: DataFrame) -> DataFrame:
    """``increasing`` when there is more than one day and the last day's
    revenue exceeds the first day's, else ``stable``."""
    d = daily_revenue(usage)
    return d.agg(F.count(F.lit(1)).alias("days"),
                 F.max_by("revenue", "date").alias("last_revenue"),
                 F.min_by("revenue", "date").alias("first_revenue")).where(F.col("days") > 0).select(
        "days", "first_revenue", "last_revenue",
        F.when((F.col("days") > 1) & (F.col("last_revenue") > F.col("first_revenue")), F.lit("increasing"))
        .otherwise(F.lit("stable")).alias("trend"))


def capacity_summary(points: DataFrame) -> DataFrame:
    """Points, mean points per station that has points, total and mean
    power (no row without points)."""
    per = _points_by_station(points)
    a = points.agg(F.count(F.lit(1)).alias("total_charging_points"),
                   F.coalesce(dsum("power_kw"), F.lit(0.0)).alias("total_power_capacity_kw"),
                   mean("power_kw").alias("avg_power_per_point_kw"))
    b = per.agg(F.round(F.avg("points"), 6).alias("avg_points_per_station"))
    return attach_one_row(a.where(F.col("total_charging_points") > 0), b).select(
        "total_charging_points", "avg_points_per_station", "total_power_capacity_kw", "avg_power_per_point_kw")


def station_utilization(points: DataFrame, usage: DataFrame) -> DataFrame:
    """Per station with points — sessions (0 if none), points, ratio;
    nothing at all when there is no usage."""
    j = _points_by_station(points).join(_sessions_by_station(usage).select("station_id", "sessions"),
                                        "station_id", "left")
    j = attach_one_row(j, _nonempty(usage)).drop("_rows")
    return j.select("station_id", F.coalesce("sessions", F.lit(0)).alias("sessions"), "points",
                    F.round(F.coalesce("sessions", F.lit(0)) / F.col("points"), 6).alias("utilization_ratio"))


# ---------------------------------------------------------------- B15–B18

def station_usage_stats(usage: DataFrame) -> DataFrame:
    """Per station sessions, energy, mean duration, revenue."""
    return usage.where(F.col("station_id").isNotNull()).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.coalesce(dsum("energy_consumed_kwh"), F.lit(0.0)).alias("total_energy_kwh"),
        mean("duration_minutes").alias("avg_duration_minutes"),
        F.coalesce(dsum("cost"), F.lit(0.0)).alias("total_revenue"))


def station_capacity(points: DataFrame) -> DataFrame:
    """Per station points, total and mean power."""
    return points.where(F.col("station_id").isNotNull()).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("total_points"),
        F.coalesce(dsum("power_kw"), F.lit(0.0)).alias("total_power_kw"),
        mean("power_kw").alias("avg_power_kw"))


def station_recommendations(stations: DataFrame, usage: DataFrame, points: DataFrame) -> DataFrame:
    """Per station — no usage → data collection (high); more than 50
    sessions per point → capacity (high); mean cost under 10 → pricing
    (medium). One row per recommendation."""
    u = usage.groupBy("station_id").agg(F.count(F.lit(1)).alias("sessions"),
                                        F.sum("cost").alias("cost_sum"), F.count("cost").alias("cost_n"))
    s = stations.select(F.col("id").alias("station_id")) \
        .join(u, "station_id", "left").join(_points_by_station(points), "station_id", "left")
    sessions, pts = F.coalesce("sessions", F.lit(0)), F.col("points")
    cents = (F.col("cost_sum") * 100).cast("bigint")
    recs = F.array(
        F.when(sessions == 0, F.struct(F.lit("data_collection").alias("type"), F.lit("high").alias("priority"),
                                       F.lit(NO_DATA_TEXT).alias("recommendation"))),
        F.when((sessions > 0) & (pts > 0) & (sessions > HIGH_UTILIZATION * pts), F.struct(
            F.lit("capacity").alias("type"), F.lit("high").alias("priority"),
            F.concat(F.lit("High utilization ("), half_up_text(sessions, pts, 1),
                     F.lit(" sessions/point). Consider adding more charging points.")).alias("recommendation"))),
        F.when((sessions > 0) & (F.col("cost_n") > 0) & (F.col("cost_sum") < LOW_AVG_REVENUE * F.col("cost_n")),
               F.struct(F.lit("pricing").alias("type"), F.lit("medium").alias("priority"),
                        F.concat(F.lit("Low average revenue per session ($"),
                                 half_up_text(cents, F.col("cost_n") * 100, 2),
                                 F.lit("). Review pricing strategy.")).alias("recommendation"))))
    return s.select("station_id", F.explode(F.array_compact(recs)).alias("r")).select("station_id", "r.*")


def station_insights(stations: DataFrame, usage: DataFrame, points: DataFrame,
                     station_id: str | None = None) -> DataFrame:
    """Station row + usage stats + capacity + its recommendation types,
    for one station or all (the filter reaches every scan)."""
    if station_id is not None:
        stations = stations.where(F.col("id") == station_id)
        usage = usage.where(F.col("station_id") == station_id)
        points = points.where(F.col("station_id") == station_id)
    recs = station_recommendations(stations, usage, points).groupBy("station_id").agg(
        F.array_join(F.array_sort(F.collect_list("type")), ",").alias("recommendation_types"))
    s = stations.select(F.col("id").alias("station_id"), "name", "city", "state", "operator")
    j = (s.join(station_usage_stats(usage), "station_id", "left")
         .join(station_capacity(points), "station_id", "left")
         .join(recs, "station_id", "left"))
    return j.fillna({"total_sessions": 0, "total_points": 0})
