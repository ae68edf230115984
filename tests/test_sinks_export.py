"""Sinks (K01, K03, K06, K07, K11, K12) and export."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import AS_OF, SF001
from voltgrid.operators import views
from voltgrid.plans import export
from voltgrid.schemas import conform
from voltgrid.sinks import tables as sinks
from voltgrid.sources.testdata import adapter_tables


def test_upsert_last_write_wins_and_idempotent(spark, scratch):
    root = scratch + "/store"
    b1 = conform(spark.createDataFrame([("1", "a", dt.datetime(2024, 1, 1)), ("2", "b", dt.datetime(2024, 1, 1))],
                                       "id string, name string, updated_at timestamp_ntz"), "charging_stations")
    b2 = conform(spark.createDataFrame([("2", "B", dt.datetime(2024, 1, 2)), ("3", "c", dt.datetime(2024, 1, 2))],
                                       "id string, name string, updated_at timestamp_ntz"), "charging_stations")
    sinks.upsert(spark, root, "charging_stations", b1, ["id"], ["updated_at"], version="0")
    sinks.upsert(spark, root, "charging_stations", b2, ["id"], ["updated_at"], version="1")
    got = {r.id: r.name for r in sinks.read_upserted(spark, root, "charging_stations").collect()}
    assert got == {"1": "a", "2": "B", "3": "c"}
    # applying the same batch again (as a new version) changes nothing
    sinks.upsert(spark, root, "charging_stations", b2, ["id"], ["updated_at"], version="2")
    again = {r.id: r.name for r in sinks.read_upserted(spark, root, "charging_stations").collect()}
    assert again == got


def test_upsert_frame_matches_row_number_dedupe(spark, tables001):
    u = tables001.usage
    a = sinks.latest_by_key(u, ["station_id"], ["session_start", "id"])
    from pyspark.sql import Window
    w = Window.partitionBy("station_id").orderBy(F.col("session_start").desc(), F.col("id").desc())
    b = u.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(a.collect()) == sorted(b.collect())


def test_weather_and_anomaly_row_rules(spark):
    w = spark.createDataFrame([(55.9, 7.8)], "humidity_percent double, uv_index double")
    r = sinks.prepare_weather_rows(w).collect()[0]
    assert float(r.humidity_percent) == 55.0 and float(r.uv_index) == 7.0
    a = sinks.prepare_anomaly_rows(spark.createDataFrame([("1",)], "station_id string")).collect()[0]
    assert a.is_resolved is False


def test_append_and_audit_row(spark, scratch):
    root = scratch + "/store"
    t = adapter_tables(spark, SF001)
    sinks.append(t.weather, root, "weather_data", partition_by="date")
    back = spark.read.parquet(root + "/weather_data")
    assert back.count() == t.weather.count() and "date" in back.columns
    row = sinks.collection_log_row(spark, "weather", "batch", 188, "success",
                                   dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 1))
    sinks.append(row, root, "data_collection_log")
    v = views.collection_status(adapter_tables(spark, SF001).__class__(
        stations=t.stations, points=t.points, usage=t.usage, weather=t.weather, traffic=t.traffic,
        anomalies=t.anomalies, log=conform(spark.read.parquet(root + "/data_collection_log"),
                                           "data_collection_log"))).collect()[0]
    assert v.duration_seconds == 60.0 and v.is_successful


def test_export_csv_roundtrip_and_empty(spark, scratch, tables001):
    out = scratch + "/export"
    assert export.export_view(tables001, "station_performance", out, AS_OF)
    back = export.read_export_csv(spark, f"{out}/tableau_station_performance", "station_performance")
    orig = views.station_performance(tables001)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in orig.schema]
    assert sorted(back.collect()) == sorted(orig.collect())
    empty = tables001.stations.where("1 = 0")
    assert sinks.export_csv(empty, out, "nothing") is False
    assert not os.path.exists(f"{out}/nothing")


def test_export_all_writes_views_and_tables(spark, scratch, tables001):
    res = export.export_all(tables001, scratch + "/exp", AS_OF)
    assert res["tableau_station_overview"] and res["usage_data"]
    assert os.path.isdir(scratch + "/exp/20240201_000000/tableau_hourly_usage_heatmap")


def test_quoting_with_commas_and_quotes(spark, scratch):
    df = spark.createDataFrame([("Smith, \"Jr\"", None)], "name string, note string")
    sinks.export_csv(df, scratch, "q")
    text = "".join(open(os.path.join(scratch, "q", f)).read()
                   for f in sorted(os.listdir(os.path.join(scratch, "q"))) if f.endswith(".csv"))
    assert '"Smith, ""Jr"""' in text and text.strip().endswith(",")


def test_cascade_delete(spark, tables001):
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    t = sinks.cascade_delete(tables001, ids)
    assert t.usage.where(F.col("station_id").isin("1", "2")).count() == 0
    assert t.stations.where(F.col("id").isin("1", "2")).count() == 0
    assert t.usage.count() == tables001.usage.where(~F.col("station_id").isin("1", "2")).count()


def test_ties_have_one_winner(spark, scratch):
    """Two rows with one id and one time: the same one wins in either order."""
    one = [("1", "x", dt.datetime(2024, 1, 1)), ("1", "y", dt.datetime(2024, 1, 1))]
    got = set()
    for k, rows in enumerate((one, one[::-1])):
        df = conform(spark.createDataFrame(rows, "id string, name string, updated_at timestamp_ntz"), "charging_stations")
        sinks.upsert(spark, f"{scratch}/{k}", "charging_stations", df.coalesce(1), ["id"], ["updated_at"], version="0")
        got |= {r.name for r in sinks.read_upserted(spark, f"{scratch}/{k}", "charging_stations").collect()}
    assert len(got) == 1


def _stations(spark, *rows):
    return conform(spark.createDataFrame([(i, n, dt.datetime(2024, 1, d)) for i, n, d in rows],
                                         "id string, name string, updated_at timestamp_ntz"), "charging_stations")


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_upsert_rewrites_only_its_buckets(spark, scratch):
    """The files of buckets without a key of the batch stay as they are."""
    put = lambda df, v: sinks.upsert(spark, scratch, "charging_stations", df, ["id"], ["updated_at"], version=v)
    put(_stations(spark, *[(str(i), "a", 1) for i in range(500)]), "0")
    before = _files(scratch)
    batch = _stations(spark, ("7", "b", 2), ("11", "b", 2))
    touched = {f"/bucket={r[0]}/" for r in batch.select(sinks.bucket_of(["id"])).collect()}
    put(batch, "1")
    after = _files(scratch)
    gone, new = before.keys() - after.keys(), after.keys() - before.keys()
    assert gone and new and all(any(t in f for t in touched) for f in gone | new)
    kept = {f for f in before if not any(t in f for t in touched)}
    assert len({f.split("/bucket=")[1].split("/")[0] for f in kept}) == sinks.BUCKETS - len(touched)
    assert all(after[f] == before[f] for f in kept)
    names = {r.id: r.name for r in sinks.read_upserted(spark, scratch, "charging_stations").collect()}
    assert len(names) == 500 and {i for i, n in names.items() if n == "b"} == {"7", "11"}


def test_failed_upsert_leaves_the_table(spark, scratch):
    """A batch whose rows raise changes nothing, and the next one is merged."""
    import pytest
    put = lambda df, v: sinks.upsert(spark, scratch, "charging_stations", df, ["id"], ["updated_at"], version=v)
    put(_stations(spark, ("1", "a", 1)), "0")
    before = _files(scratch)
    bad = _stations(spark, ("1", "b", 2)).withColumn("name", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        put(bad, "1")
    assert _files(scratch) == before
    put(_stations(spark, ("2", "c", 2)), "1")
    assert {r.id: r.name for r in sinks.read_upserted(spark, scratch, "charging_stations").collect()} == {"1": "a", "2": "c"}


def test_merge_orders_by_query_and_batch(spark):
    """The rows say which batch wrote them: older times, batches that come
    again, NULL times and NULL keys."""
    schema = "id string, name string, at int, _query string, _batch long"
    stored = spark.createDataFrame([("1", "a", 5, "q", 3), ("2", "b", 5, "q", 3), ("3", "c", 5, "p", 9),
                                    ("4", "d", None, "q", 0), (None, "e", 1, "q", 0)], schema)
    incoming = spark.createDataFrame([("1", "late", 9, "q", 3), ("2", "old", 4, "q", 4), ("3", "same", 5, "q", 2),
                                      ("4", "timed", 1, "q", 1), (None, "f", 2, "q", 1), ("5", "new", None, "q", 4)], schema)
    got = {r.id: r.name for r in sinks.merge_batch(stored, incoming, ["id"], ["at"]).collect()}
    assert got == {"1": "a", "2": "b", "3": "same", "4": "timed", None: "f", "5": "new"}


def test_sums_keep_their_digits(spark):
    """A station-day of 20,000,000 kWh and 40,000 rain rows come out whole."""
    from voltgrid.operators import anomalies, derived, features
    usage = spark.range(20_000).selectExpr("id", "'1' AS station_id", "CAST('2024-01-01 10:00:00' AS timestamp_ntz) AS session_start",
                                           "CAST(1000 AS decimal(10,3)) AS energy_consumed_kwh", "60 AS duration_minutes")
    day = derived.energy_consumption_daily(conform(usage, "usage_data")).collect()
    assert [float(r.total_energy_kwh) for r in day] == [20_000_000.0] and day[0].session_count == 20_000
    weather = conform(spark.range(40_000).selectExpr("id", "'1' AS station_id", "'Rain' AS weather_condition",
                                                     "CAST('2024-01-01 10:00:00' AS timestamp_ntz) AS timestamp"), "weather_data")
    stations = conform(spark.createDataFrame([("1",), ("2",)], "id string"), "charging_stations")
    traffic = conform(spark.createDataFrame([("1", 5.0)], "station_id string, traffic_density double"), "traffic_data")
    feats = features.engineer_features(stations, weather, traffic, AS_OF)
    rows = {r.station_id: r for r in anomalies.feature_matrix(feats).collect()}
    assert rows["1"].avg_downtime_minutes == 1_200_000.0 and rows["2"].avg_downtime_minutes == 0.0


def test_range_reaches_the_scan(spark, scratch):
    """Latitude and longitude ranges are pushed; the equator, the poles
    and the antimeridian are complete."""
    from voltgrid.operators import derived
    rows = [(str(i), lat, lon) for i, (lat, lon) in enumerate(
        [(0.0001, 10.0), (0.5, 10.2), (0.0001, 12.0), (89.9, 50.0), (89.9, -130.0), (10.0, 179.9), (10.0, -179.9)])]
    conform(spark.createDataFrame(rows, "id string, latitude double, longitude double"),
            "charging_stations").write.parquet(scratch + "/s")
    s = spark.read.parquet(scratch + "/s")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    near = derived.stations_within(s, 0.0, 10.0, 100.0)
    plan = near._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert all(f"{op}({c}" in pushed for c in ("latitude", "longitude")
               for op in ("GreaterThanOrEqual", "LessThanOrEqual")), pushed
    ids = lambda df: {r.id for r in df.collect()}
    assert ids(near) == {"0", "1"}
    assert ids(derived.stations_within(s, 89.95, 50.0, 50.0)) == {"3", "4"}
    assert ids(derived.stations_within(s, 10.0, 179.95, 50.0)) == {"5", "6"}
    assert ids(derived.points_in_bbox(s, 0.0, 10.0, 100.0)) == {"0", "1", "2"}


def test_default_export_lists_every_table(spark, scratch):
    t = adapter_tables(spark, SF001)
    assert "engineered_features" in export.export_all(t, scratch, AS_OF)
