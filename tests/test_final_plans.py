"""Scans, shuffles and joins of final adaptive plans, and keys that hold a
large share of the rows."""

import re

import numpy as np
from pyspark.sql import functions as F

from conftest import AS_OF, SF01, SF001
from voltgrid.operators import correlations, derived, features, insights, patterns, views
from voltgrid.sources.testdata import adapter_tables
from voltgrid.sources.uneven import uneven_tables


def final_plan(df) -> str:
    """The plan as executed; a reused exchange is printed once only."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", plan))


def test_recommendations_read_usage_twice_at_most(spark):
    t = adapter_tables(spark, SF001)
    plan = final_plan(insights.network_recommendations(t.stations, t.usage, t.points))
    assert scans(plan, "events") <= 2 and scans(plan, "part") <= 1, plan
    assert plan.count("BroadcastNestedLoopJoin") <= 3
    for df in (insights.underutilized_stations(t.usage), insights.pricing_optimization(t.usage),
               insights.capacity_expansion(t.usage, t.points)):
        assert scans(final_plan(df), "events") == 1


def test_roll_ups_read_usage_once(spark):
    t = adapter_tables(spark, SF001)
    for df in (patterns.usage_pattern_summary(t.usage), patterns.usage_pattern_summary(t.usage, by=[]),
               patterns.session_duration_stats(t.usage, by=["station_id"]), patterns.session_duration_stats(t.usage),
               derived.energy_consumption_daily(t.usage)):
        assert scans(final_plan(df), "events") == 1
    # usage, weather and traffic are all in this file
    assert scans(final_plan(features.usage_features(t.stations, t.usage, t.weather, t.traffic, AS_OF)), "events") == 3


def test_correlations_read_each_source_once(spark):
    t = adapter_tables(spark, SF01)
    for op in (correlations.combined_correlation, correlations.correlation_insights, correlations.correlation_report):
        assert scans(final_plan(op(t.weather, t.traffic, t.usage)), "events") == 3
    assert scans(final_plan(views.weather_correlation(t)), "events") <= 2


def test_rules_fire_on_uneven_tables(spark):
    t = uneven_tables(spark, SF01)
    kinds = {r.type for r in insights.network_recommendations(t.stations, t.usage, t.points).collect()}
    assert {"underutilized_stations", "capacity_expansion", "pricing_optimization"} <= kinds
    assert {r.type for r in insights.station_recommendations(t.stations, t.usage, t.points).collect()} == {
        "data_collection", "capacity", "pricing"}
    assert patterns.peak_hours(t.usage).count() and patterns.usage_spikes(t.usage).count()


def test_recommendations_without_usage_or_points(spark):
    t = uneven_tables(spark, SF001)
    none = t.usage.where("1 = 0")
    rows = insights.network_recommendations(t.stations, none, t.points).collect()
    assert [r.type for r in rows if r.station_id is None and r.state is None] == ["data_collection"]
    assert not [r for r in rows if r.station_id is not None]
    assert insights.capacity_expansion(t.usage, t.points.where("1 = 0")).count() == 0
    assert insights.underutilized_stations(none).count() == 0
    some = insights.underutilized_stations(t.usage, limit=2).collect()
    assert len(some) == 2 and some[0].n_stations == insights.underutilized_stations(t.usage).count()


def test_a_hot_station_hour_is_spread(spark, tables001):
    """A third of the observations, all different, in one station-hour: the
    salted key spreads them, and the view equals the plain join."""
    hot = spark.range(4000).select(
        F.lit("3").alias("station_id"), F.timestamp_add("MICROSECOND", F.col("id"), F.lit("2024-01-05 10:00:00").cast(
            "timestamp_ntz")).alias("timestamp"), (F.col("id") / 100).cast("decimal(10,2)").alias("temperature_celsius"))
    from voltgrid.schemas import conform
    spread = spark.range(8000).select(
        (F.col("id") % 20).cast("string").alias("station_id"), F.timestamp_add("MINUTE", F.col("id"), F.lit(
            "2024-01-01 00:00:00").cast("timestamp_ntz")).alias("timestamp"), F.lit(1.5).alias("temperature_celsius"))
    weather = conform(hot, "weather_data").unionByName(conform(spread, "weather_data"))
    usage = conform(spark.range(2000).select(
        "id", (F.col("id") % 20).cast("string").alias("station_id"), F.timestamp_add("MINUTE", F.col("id") * 7, F.lit(
            "2024-01-01 00:00:00").cast("timestamp_ntz")).alias("session_start"), F.lit(2).alias("energy_consumed_kwh")), "usage_data")
    o = weather.groupBy("station_id", "timestamp", "temperature_celsius").agg(F.count("*").alias("_times")) \
        .withColumn("hour", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    hourly = views.hourly_usage_sums(usage)
    left, right = views._salted(o, hourly)
    sizes = [r["count"] for r in left.groupBy("station_id", "hour", "_salt").count().collect()]
    assert max(sizes) < 4000 / views.SALTS * 1.6 and sum(sizes) == 12000
    keys = [tuple(r) for r in right.select("station_id", "hour", "_salt").collect()]
    assert len(keys) == len(set(keys)) and len({k[2] for k in keys}) in (1, views.SALTS)
    got = views.weather_correlation(type(tables001)(**{**tables001.__dict__, "weather": weather, "usage": usage}))
    plain = o.join(hourly, ["station_id", "hour"], "left").join(tables001.stations.select(F.col("id").alias("station_id")), "station_id")
    want = plain.agg(F.count("*"), F.sum(F.coalesce("u_n", F.lit(0)))).first()
    assert tuple(got.agg(F.count("*"), F.sum("sessions_during_weather")).first()) == tuple(want)


def test_flags_with_a_given_model_start_no_job(spark, tables001):
    """With a fitted forest the frame is lazy and each row is scored once."""
    from voltgrid.operators import isolation_forest as forest
    feats = features.usage_features(tables001.stations, tables001.usage, tables001.weather, tables001.traffic, AS_OF)
    model = forest.fit(feats, n_trees=10)
    spark.sparkContext.setJobGroup("lazy", "lazy")
    flagged = forest.detect_anomalies(feats, AS_OF, model=model)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    plan = final_plan(flagged)
    assert plan.count("MapInPandas") == 1, plan
    scores = np.array([r.score for r in forest.decision_values(feats, model).collect()])
    assert flagged.count() == int((-scores < np.quantile(-scores, forest.CONTAMINATION)).sum())
