"""Usage patterns.

Every operator takes the usage table and ``by``: ``[]`` for the whole network
or ``["station_id"]`` for every station in one job (the reference analyses one
station per call; here all stations run in the same shuffle). Rows with a NULL
group key or timestamp are dropped, as pandas ``groupby`` does (SURVEY §1.4.6).

Plan shape: the raw table is reduced by a hash aggregate with map-side
partial aggregation to (group, hour) / (group, day) cells first; the statistics
(mean, sample std) are then computed over those small cells — by a window per
station or a broadcast one-row aggregate network-wide. The summary (P07) adds
up the three grains that it needs (hour of day, day, whole minutes) in one
aggregate over one scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltgrid.functions.columns import dsum, mean, season_of_month
from voltgrid.functions.groupstats import attach_one_row, group_stats, with_group_stats
from voltgrid.functions.quantiles import count_values, counted_quantiles

# Fixed values of the pattern rules.
PEAK_FACTOR = 1.5          # hour is a peak when its count >= 1.5 x mean hourly count
SPIKE_Z = 2.0              # usage spike: z > 2
LOW_Z = -1.5               # low-usage period: z < -1.5
CONFIDENCE = {"peak_hours": 0.85, "day_of_week": 0.80, "usage_spikes": 0.75,
              "low_usage_periods": 0.70, "session_duration": 0.75}


def _keys_present(df: DataFrame, by, *cols) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, *cols)], F.lit(True))
    return df.where(cond)


def hourly_counts(usage: DataFrame, by=()) -> DataFrame:
    by = list(by)
    u = _keys_present(usage, by, "session_start")
    return u.groupBy(*by, F.hour("session_start").cast("bigint").alias("hour")).agg(
        F.count(F.lit(1)).alias("session_count"))


def peak_hours(usage: DataFrame, by=()) -> DataFrame:
    """Hours whose session count is at least 1.5 × the mean count over
    the hours that occur."""
    by = list(by)
    h = with_group_stats(hourly_counts(usage, by), by, mean_hourly=F.avg("session_count"))
    return (h.where(F.col("session_count") >= F.col("mean_hourly") * PEAK_FACTOR)
            .select(*by, "hour", "session_count"))


def weekday_weekend(usage: DataFrame, by=()) -> DataFrame:
    """Sessions and energy split by weekend (Saturday/Sunday)."""
    by = list(by)
    u = _keys_present(usage, by)
    wk = F.coalesce(F.weekday("session_start") >= 5, F.lit(False))
    g = group_stats(u, by,
                    weekday_sessions=F.count_if(~wk),
                    weekend_sessions=F.count_if(wk),
                    weekday_energy_kwh=F.coalesce(dsum(F.when(~wk, F.col("energy_consumed_kwh"))), F.lit(0.0)),
                    weekend_energy_kwh=F.coalesce(dsum(F.when(wk, F.col("energy_consumed_kwh"))), F.lit(0.0)))
    return g.withColumn("pattern", F.when(F.col("weekend_sessions") > F.col("weekday_sessions"),
                                          F.lit("weekend_heavy")).otherwise(F.lit("weekday_heavy")))


def daily_zscores(usage: DataFrame, by=()) -> DataFrame:
    """Daily session counts with the z-score against the group's days
    (sample standard deviation; days without sessions are not counted)."""
    by = list(by)
    u = _keys_present(usage, by, "session_start")
    d = u.groupBy(*by, F.to_date("session_start").alias("date")).agg(
        F.count(F.lit(1)).alias("session_count"))
    d = with_group_stats(d, by, mean_daily=F.avg("session_count"),
                         std_daily=F.stddev_samp("session_count"))
    z = F.when(F.col("std_daily") > 0,
               (F.col("session_count") - F.col("mean_daily")) / F.col("std_daily"))
    return d.select(*by, "date", "session_count", z.alias("z_score"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("z_score", F.round("z_score", 6))


def usage_spikes(usage: DataFrame, by=()) -> DataFrame:
    """Days with z > 2."""
    return _rounded(daily_zscores(usage, by).where(F.col("z_score") > SPIKE_Z))


def low_usage_periods(usage: DataFrame, by=()) -> DataFrame:
    """Days with z < −1.5."""
    return _rounded(daily_zscores(usage, by).where(F.col("z_score") < LOW_Z))


NO_DURATION_TEXT = "No valid duration data"
DURATION_TEXT = "Average session duration: %.1f minutes"


def _duration_text(n: Column, avg: Column) -> Column:
    return F.when(n > 0, F.format_string(DURATION_TEXT, F.round(avg, 1))).otherwise(F.lit(NO_DURATION_TEXT))


def _half(x: Column, upto: Column, n: Column, some: Column) -> Column:
    """The median from the running counts of values in order, as an aggregate."""
    return (F.min(F.when(some & (upto >= n / 2), x)) + F.min(F.when(some & (upto > n / 2), x))) / 2


def session_duration_stats(usage: DataFrame, by=()) -> DataFrame:
    """Mean, median, min, max and sample std of the non-null durations,
    all from the counts of the distinct values (whole minutes): one scan, and
    no task gathers the sessions of a group."""
    by = list(by)
    x, c, some = F.col("x"), F.col("c"), F.col("x").isNotNull()
    counts = _keys_present(usage, by).groupBy(*by, F.col("duration_minutes").cast("double").alias("x")).agg(
        F.count(F.lit(1)).alias("c")) if by else count_values(usage, ["duration_minutes"])
    d = with_group_stats(counts, by, n=F.sum(F.when(some, c)), total=F.sum(x * c))
    mean_ = F.col("total") / F.col("n")
    aggs = dict(n=F.max("n"), total=F.max("total"), lo=F.min("x"), hi=F.max("x"),
                square=F.sum(c * (x - mean_) * (x - mean_)))
    if by:
        order = Window.partitionBy(*by).orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn("upto", F.sum(F.when(some, c)).over(order))
        g = group_stats(d, by, **aggs, median=_half(x, F.col("upto"), F.col("n"), some))
    else:
        g = attach_one_row(group_stats(d, by, **aggs), counted_quantiles(counts, [(0.5, "median")]).select("median"))
    n = F.coalesce("n", F.lit(0))
    return g.select(
        *by, F.round(F.try_divide("total", n.cast("double")), 6).alias("avg_duration_minutes"),
        F.round("median", 6).alias("median_duration_minutes"), F.col("lo").alias("min_duration_minutes"),
        F.col("hi").alias("max_duration_minutes"),
        F.round(F.sqrt(F.try_divide("square", F.nullif(n - 1, F.lit(0)).cast("double"))), 6).alias("std_duration_minutes"),
        _duration_text(n, F.round(F.try_divide("total", n.cast("double")), 6)).alias("description"))


def seasonal_trends(usage: DataFrame, by=()) -> DataFrame:
    """Sessions and energy per meteorological season."""
    by = list(by)
    u = _keys_present(usage, by, "session_start")
    return u.groupBy(*by, season_of_month(F.month("session_start")).alias("season")).agg(
        F.count("id").alias("session_count"),
        F.coalesce(dsum("energy_consumed_kwh"), F.lit(0.0)).alias("total_energy_kwh"))


def location_patterns(usage: DataFrame, stations: DataFrame, level: str = "state") -> DataFrame:
    """Sessions and energy per state (or city); sessions of unknown
    stations and NULL locations are dropped."""
    # reduce sessions per station first (map-side partial aggregation), so the
    # join with the station dimension handles one row per station, not every
    # session of a hot station
    per_station = usage.groupBy("station_id").agg(F.count("id").alias("n"),
                                                  F.sum("energy_consumed_kwh").alias("e"))
    s = stations.select(F.col("id").alias("station_id"), F.col(level).alias("location"))
    j = per_station.join(s, "station_id").where(F.col("location").isNotNull())
    return j.groupBy("location").agg(
        F.sum("n").alias("session_count"),
        F.coalesce(F.sum("e").cast("double"), F.lit(0.0)).alias("total_energy_kwh"),
    ).select(F.lit(level).alias("location_type"), "location", "session_count", "total_energy_kwh")


def _py_list(values_sorted) -> F.Column:
    return F.concat(F.lit("["), F.array_join(values_sorted, ", "), F.lit("]"))


def _summary_cells(usage: DataFrame, by: list[str]) -> DataFrame:
    """Sessions (c) and energy of each hour of day, day (as a day number) and
    duration of a group, from one scan: every session counts in three cells,
    which are added up before the shuffle. With the statistics of its grain
    that each cell is held against."""
    start = F.col("session_start")
    cell = lambda grain, key, e: F.struct(F.lit(grain).alias("grain"), key.cast("bigint").alias("key"), e.alias("e"))
    none = F.lit(None).cast("decimal(10,3)")
    rows = _keys_present(usage, by).select(*by, F.inline(F.array(
        cell("hour", F.hour(start), none), cell("day", F.unix_date(F.to_date(start)), F.col("energy_consumed_kwh")),
        cell("minutes", F.col("duration_minutes"), none))))
    cells = rows.groupBy(*by, "grain", "key").agg(F.count(F.lit(1)).alias("c"), F.sum("e").alias("e"))
    # hours, days and whole minutes: the calendar bounds the cells of a grain
    grain = Window.partitionBy(*by, "grain")
    upto = grain.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.when(F.col("key").isNotNull(), F.col("c"))
    return cells.select(
        "*", F.avg(known).over(grain).alias("mean"), F.stddev_samp(known).over(grain).alias("std"),
        F.sum(known).over(grain).alias("n"), F.sum(F.col("key").cast("double") * F.col("c")).over(grain).alias("total"),
        F.sum(known).over(upto).alias("upto"))


def usage_pattern_summary(usage: DataFrame, by=("station_id",), with_details: bool = True) -> DataFrame:
    """The long pattern table — one row per (group, pattern type) with
    description, details (JSON) and the fixed confidence. Spike and low-usage
    rows appear only for groups that have at least one such day; a group (or,
    network-wide, the network) without sessions yields no rows."""
    by = list(by)
    key, c, known = F.col("key"), F.col("c"), F.col("key").isNotNull()
    of = lambda grain, x: F.when(F.col("grain") == grain, x)
    date = F.date_from_unix_date(key.cast("int"))
    weekend = F.coalesce(F.weekday(date) >= 5, F.lit(False))
    z = F.when(F.col("std") > 0, (c - F.col("mean")) / F.col("std"))
    day = F.struct(date.cast("string").alias("date"), c.alias("session_count"), F.round(z, 6).alias("z_score"))
    minutes, mean_ = key.cast("double"), F.col("total") / F.col("n")
    energy = lambda when: F.coalesce(F.sum(of("day", F.when(when, F.col("e")))).cast("double"), F.lit(0.0))
    is_minutes = (F.col("grain") == "minutes") & known
    g = group_stats(
        _summary_cells(usage, by), by, rows=F.sum(of("day", c)),
        hours=F.array_sort(F.collect_list(of("hour", F.when(known & (c >= F.col("mean") * PEAK_FACTOR), key)))),
        weekday_sessions=F.sum(of("day", F.when(~weekend, c).otherwise(0))),
        weekend_sessions=F.sum(of("day", F.when(weekend, c).otherwise(0))),
        weekday_energy_kwh=energy(~weekend), weekend_energy_kwh=energy(weekend),
        spikes=F.sort_array(F.collect_list(of("day", F.when(known & (z > SPIKE_Z), day)))),
        low_periods=F.sort_array(F.collect_list(of("day", F.when(known & (z < LOW_Z), day)))),
        n=F.coalesce(F.max(of("minutes", F.col("n"))), F.lit(0)), total=F.max(of("minutes", F.col("total"))),
        lo=F.min(F.when(is_minutes, minutes)), hi=F.max(F.when(is_minutes, minutes)),
        square=F.sum(of("minutes", c * (minutes - mean_) * (minutes - mean_))),
        median=_half(minutes, F.col("upto"), F.col("n"), is_minutes))
    n = F.col("n")
    avg = F.round(F.try_divide("total", n.cast("double")), 6)
    pattern = F.when(F.col("weekend_sessions") > F.col("weekday_sessions"), F.lit("weekend_heavy")) \
        .otherwise(F.lit("weekday_heavy")).alias("pattern")
    split = ["weekday_sessions", "weekend_sessions", "weekday_energy_kwh", "weekend_energy_kwh"]
    as_dict = F.format_string(
        "{'weekday_sessions': %d, 'weekend_sessions': %d, 'weekday_energy_kwh': %s, "
        "'weekend_energy_kwh': %s, 'pattern': '%s'}", *split[:2], *[F.col(k).cast("string") for k in split[2:]], pattern)

    def entry(type_, description, details):
        return F.struct(F.lit(type_).alias("pattern_type"), description.alias("description"),
                        F.to_json(F.struct(*details)).alias("details"),
                        F.lit(CONFIDENCE[type_]).alias("confidence"))

    def days(type_, name, text):
        return F.when(F.size(name) > 0, entry(type_, F.format_string(text, F.size(name)), [name]))

    items = F.array_compact(F.array(
        entry("peak_hours", F.concat(F.lit("Peak usage occurs during hours: "), _py_list(F.col("hours"))),
              [F.col("hours").alias("peak_hours")]),
        entry("day_of_week", F.concat(F.lit("Weekday vs Weekend pattern: "), as_dict), [*split, pattern]),
        days("usage_spikes", "spikes", "Detected %d usage spikes"),
        days("low_usage_periods", "low_periods", "Identified %d low usage periods"),
        entry("session_duration", _duration_text(n, avg), [
            avg.alias("avg_duration_minutes"), F.round("median", 6).alias("median_duration_minutes"),
            F.col("lo").alias("min_duration_minutes"), F.col("hi").alias("max_duration_minutes"),
            F.round(F.sqrt(F.try_divide("square", F.nullif(n - 1, F.lit(0)).cast("double"))), 6)
            .alias("std_duration_minutes")])))
    sid = (F.col("station_id") if "station_id" in by else F.lit(None).cast("string")).alias("station_id")
    out = g.where(F.col("rows") > 0).select(sid, F.inline(items))
    return out if with_details else out.drop("details")
