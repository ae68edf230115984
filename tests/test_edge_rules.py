"""Hand-made fixtures for the edge rules of SURVEY §5.2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from voltgrid.functions.columns import clean_numeric, pearson
from voltgrid.operators import cleaning, correlations, insights, patterns, views
from voltgrid.schemas import conform
from voltgrid.sinks.tables import orphans
from voltgrid.sources.tables import Tables


def _tables(spark, stations=(), points=(), usage=(), weather=(), traffic=(), anomalies=()):
    def mk(rows, name, cols):
        df = spark.createDataFrame(list(rows), cols) if rows else None
        if df is None:
            from voltgrid.schemas import schema
            return spark.createDataFrame([], schema(name))
        return conform(df, name)
    return Tables(
        stations=mk(stations, "charging_stations", "id string, name string, state string, city string"),
        points=mk(points, "charging_points", "id string, station_id string, power_kw double"),
        usage=mk(usage, "usage_data",
                 "id long, station_id string, session_start timestamp_ntz, energy_consumed_kwh double, "
                 "duration_minutes int, cost double"),
        weather=mk(weather, "weather_data",
                   "id long, station_id string, timestamp timestamp_ntz, temperature_celsius double, "
                   "precipitation_mm double, weather_condition string"),
        traffic=mk(traffic, "traffic_data",
                   "id long, station_id string, timestamp timestamp_ntz, traffic_density double, "
                   "average_speed_kmh double, congestion_level string"),
        anomalies=mk(anomalies, "anomaly_detection", "id long, station_id string, is_resolved boolean"),
        log=mk((), "data_collection_log", ""),
    )


T0 = dt.datetime(2024, 1, 6, 10, 15)   # a Saturday


def test_latitude_zero_and_out_of_range_dropped(spark):
    df = spark.createDataFrame(
        [("1", 0.0, 10.0), ("2", 10.0, 10.0), ("3", 91.0, 10.0), ("", 10.0, 10.0), ("0", 5.0, 5.0)],
        "id string, latitude double, longitude double")
    out = {r.id for r in cleaning.clean_stations(df, AS_OF).collect()}
    assert out == {"2", "0"}          # '0' is a truthy string id


def test_clean_numeric_nan_unparsable_and_range(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), ("NaN",), ("-60",), (None,)], "v string")
    got = [r.x for r in df.select(clean_numeric("v", -50, 60).alias("x")).collect()]
    assert got == [12.5, None, None, None, None]


def test_text_cut_and_defaults(spark):
    df = spark.createDataFrame([("7", 1.0, 1.0, "  " + "x" * 600 + " ", None)],
                               "id string, latitude double, longitude double, name string, status string")
    r = cleaning.clean_stations(df, AS_OF).collect()[0]
    assert len(r.name) == 600 and r.status == "Unknown" and r.city == ""
    r = cleaning.clean_stations(df, AS_OF, cleaning.WIDTHS).collect()[0]
    assert len(r.name) == 500


def test_weekend_conventions(spark):
    t = _tables(spark, stations=[("1", "a", "S", "C")],
                usage=[(1, "1", T0, 1.0, 10, 1.0), (2, "1", T0 + dt.timedelta(days=1), 1.0, 10, 1.0),
                       (3, "1", T0 + dt.timedelta(days=2), 1.0, 10, 1.0)])
    v = {r.day_of_week: r.is_weekend for r in views.usage_patterns(t).collect()}
    assert v == {6: True, 0: True, 1: False}            # Sunday = 0
    w = patterns.weekday_weekend(t.usage).collect()[0]
    assert (w.weekday_sessions, w.weekend_sessions, w.pattern) == (1, 2, "weekend_heavy")


def test_single_day_has_no_spikes(spark):
    t = _tables(spark, usage=[(i, "1", T0, 1.0, 10, 1.0) for i in range(5)])
    assert patterns.usage_spikes(t.usage, ["station_id"]).count() == 0
    assert patterns.low_usage_periods(t.usage, ["station_id"]).count() == 0


def test_constant_correlation_is_zero_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert df.agg(pearson("x", "y").alias("r")).collect()[0].r == 0.0
    one = spark.createDataFrame([(1.0, 5.0)], "x double, y double")
    assert one.agg(pearson("x", "y").alias("r")).collect()[0].r == 0.0


def test_correlation_drops_null_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (None, 100.0), (3.0, 3.0)], "x double, y double")
    assert df.agg(pearson("x", "y").alias("r")).collect()[0].r == 1.0


def test_station_without_children_and_fanout(spark):
    t = _tables(spark, stations=[("1", "a", "S", "C"), ("2", "b", "S", "C")],
                points=[("p1", "1", 7.2), ("p2", "1", 3.6)],
                usage=[(1, "1", T0, 10.0, 30, 5.0), (2, "1", T0, 20.0, 60, 7.0)],
                weather=[(1, "1", T0, 10.0, 0.0, "Rain")] * 1 + [(2, "1", T0, 11.0, 0.0, "Rain")],
                anomalies=[(1, "1", False), (2, "1", True), (3, "1", False)])
    o = {r.station_id: r for r in views.station_overview(t).collect()}
    # no fan-out: 2 points x 2 weather x 2 open anomalies would multiply the sum by 8
    assert o["1"].total_energy_kwh == 30.0 and o["1"].total_sessions == 2
    assert o["1"].anomaly_count == 2 and o["1"].total_charging_points == 2
    assert o["2"].total_sessions == 0 and o["2"].total_energy_kwh is None
    p = {r.station_id: r for r in views.station_performance(t).collect()}
    assert p["1"].total_revenue == 12.0 and p["1"].open_anomalies == 2


def test_orphans(spark):
    t = _tables(spark, stations=[("1", "a", "S", "C")],
                usage=[(1, "1", T0, 1.0, 1, 1.0), (2, "9", T0, 1.0, 1, 1.0), (3, None, T0, 1.0, 1, 1.0)])
    assert sorted(r.id for r in orphans(t.usage, t.stations).collect()) == [2, 3]


def test_equal_revenues_top_n_tie_break(spark):
    t = _tables(spark, usage=[(i, str(i), T0, 1.0, 1, 5.0) for i in range(1, 13)])
    top = insights.top_revenue_stations(t.usage, 10).orderBy("rank").collect()
    assert [r.station_id for r in top] == sorted(str(i) for i in range(1, 13))[:10]


def test_empty_usage_recommends_data_collection(spark):
    t = _tables(spark, stations=[("1", "a", "S", "C")])
    rec = insights.network_recommendations(t.stations, t.usage, t.points).collect()
    assert [(r.type, r.priority) for r in rec] == [("data_collection", "high")]
    assert insights.performance_metrics(t.stations, t.usage).count() == 0
    assert patterns.usage_pattern_summary(t.usage, by=[]).count() == 0


def test_severe_share_exactly_half_is_not_severe(spark):
    from voltgrid.sources.ingest import parse_traffic_flow
    doc = {"station_id": "1", "RWS": [{"RW": [{"FIS": [{"FI": [{"CF": [
        {"SP": 10.0, "JF": 1.0}, {"SP": 50.0, "JF": 1.0}]}]}]}]}]}
    import json
    df = spark.read.schema("station_id string, RWS array<struct<RW: array<struct<FIS: array<struct<FI: "
                           "array<struct<CF: array<struct<SP: double, JF: double>>>>>>>>>>").json(
        spark.sparkContext.parallelize([json.dumps(doc)]))
    r = parse_traffic_flow(df, AS_OF).collect()[0]
    # severe share 0.5 is not > 0.5; moderate share 0 → light
    assert r.congestion_level == "light" and r.average_speed_kmh == 30.0


def test_null_group_key_dropped_for_pandas_operators(spark):
    t = _tables(spark, usage=[(1, None, T0, 1.0, 1, 1.0), (2, "1", T0, 1.0, 1, 1.0)])
    assert [r.station_id for r in patterns.seasonal_trends(t.usage, ["station_id"]).collect()] == ["1"]
    assert correlations.hourly_usage(t.usage).count() == 1


def test_bbox_and_radius(spark):
    from voltgrid.operators import derived
    st = spark.createDataFrame([("a", 45.0, 10.0), ("b", 46.0, 11.0), ("c", 60.0, 10.0), ("d", 0.0, 0.0)],
                               "id string, latitude double, longitude double")
    assert sorted(r.id for r in derived.points_in_bbox(st, 45.0, 10.0, 150.0).collect()) == ["a", "b"]
    assert sorted(r.id for r in derived.stations_within(st, 45.0, 10.0, 150.0).collect()) == ["a", "b"]
    assert sorted(r.id for r in derived.stations_within(st, 45.0, 10.0, 100.0).collect()) == ["a"]
    # equator: the service's longitude delta grows without bound → all longitudes
    assert [r.id for r in derived.points_in_bbox(st, 0.0, 0.0, 10.0).collect()] == ["d"]


def test_utilization_needs_usage(spark):
    t = _tables(spark, stations=[("1", "a", "S", "C")], points=[("p1", "1", 7.2)])
    assert insights.station_utilization(t.points, t.usage).count() == 0
    t2 = _tables(spark, stations=[("1", "a", "S", "C")], points=[("p1", "1", 7.2)],
                 usage=[(1, "2", T0, 1.0, 1, 1.0)])
    assert [(r.station_id, r.sessions) for r in insights.station_utilization(t2.points, t2.usage).collect()] == [("1", 0)]


def test_hot_station_hour(spark):
    """A third of all rows in one station-hour: the views and correlations
    merge them before any join, and the figures are those of the pairs."""
    from voltgrid.operators import correlations as corr
    rng = __import__("random").Random(4)
    usage, weather, traffic = [], [], []
    for k in range(600):
        hot = k % 3 == 0
        at = T0 + dt.timedelta(hours=0 if hot else rng.randrange(40), minutes=rng.randrange(60))
        sid = "1" if hot else str(rng.randrange(1, 6))
        usage.append((k, sid, at, 1.5, 10, 1.0))
        weather.append((k, sid, at, float(rng.randrange(30)), 0.0, "Rain" if k % 2 else "Clear"))
        traffic.append((k, sid, at, float(rng.randrange(50)), float(rng.randrange(90)), "severe" if k % 5 else "light"))
    w = spark.createDataFrame(weather, "id long, station_id string, timestamp timestamp_ntz, temperature_celsius double, "
                                       "precipitation_mm double, weather_condition string")
    t = spark.createDataFrame(traffic, "id long, station_id string, timestamp timestamp_ntz, traffic_density double, "
                                       "average_speed_kmh double, congestion_level string")
    u = spark.createDataFrame(usage, "id long, station_id string, session_start timestamp_ntz, "
                                     "energy_consumed_kwh double, duration_minutes int, cost double")
    hour = lambda x: x.replace(minute=0)
    count = {}
    for _, sid, at, *_ in usage:
        count[sid, hour(at)] = count.get((sid, hour(at)), 0) + 1
    pairs = [(a[3], b[3], count[a[1], hour(a[2])]) for a in weather for b in traffic
             if a[1] == b[1] and hour(a[2]) == hour(b[2])]
    r = corr.combined_correlation(w, t, u).collect()[0]
    import numpy as np
    x = np.array(pairs)
    assert r.data_points == len(pairs) > 20_000
    assert abs(r.temperature - np.corrcoef(x[:, 0], x[:, 2])[0, 1]) < 1e-5
    assert abs(r.traffic_density - np.corrcoef(x[:, 1], x[:, 2])[0, 1]) < 1e-5
    report = {(a.section, a.metric): a.value for a in corr.correlation_report(w, t, u).collect()}
    assert report["combined_correlation", "temperature"] == r.temperature
    plan = corr.correlation_report(w, t, u)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 3            # one scan of each table
