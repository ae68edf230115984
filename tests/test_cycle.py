"""The batch collection cycle end to end on landing documents derived from
the sf0.001 tables."""

from conftest import AS_OF, SF001
from voltgrid.plans import bundles
from voltgrid.plans.cycle import run_collection_cycle
from voltgrid.sinks.tables import read_upserted
from voltgrid.sources import documents
from voltgrid.sources.testdata import adapter_tables


def test_collection_cycle(spark, scratch):
    t = adapter_tables(spark, SF001)
    land, store = scratch + "/landing", scratch + "/store"
    documents.station_documents(t.stations).write.text(land + "/stations")
    documents.weather_documents(t.weather).write.text(land + "/weather")
    documents.traffic_flow_documents(t.traffic).write.text(land + "/traffic")
    log = {r.collection_type: r for r in run_collection_cycle(spark, land, store, AS_OF).collect()}
    assert set(log) == {"charging_stations", "charging_points", "weather_data", "traffic_data",
                        "engineered_features", "anomaly_detection"}
    assert all(r.status == "success" for r in log.values()), {k: r.error_message for k, r in log.items()}
    assert log["charging_stations"].data_source == "OpenChargeMap"
    assert log["charging_stations"].records_collected == t.stations.count()
    kept = read_upserted(spark, store, "charging_stations")
    assert kept.count() == log["charging_stations"].records_collected
    assert spark.read.parquet(store + "/weather_data").count() == log["weather_data"].records_collected > 0
    assert spark.read.parquet(store + "/data_collection_log").count() == len(log)
    # the stored tables feed the analytics directly
    from voltgrid.operators import views
    from voltgrid.sources.tables import load_tables
    stored = load_tables(spark, store)
    assert stored.stations.count() == kept.count()
    assert stored.weather.count() == log["weather_data"].records_collected
    assert views.station_statistics(stored).agg({"weather_records": "sum"}).collect()[0][0] == \
        log["weather_data"].records_collected
    feats = spark.read.parquet(store + "/engineered_features")
    assert feats.count() == kept.count() and "load" in feats.columns
    n_anom = spark.read.parquet(store + "/anomaly_detection").count()
    assert n_anom >= 1
    # re-running the same cycle (same stamp) replaces its own output: no duplicates
    run_collection_cycle(spark, land, store, AS_OF)
    assert spark.read.parquet(store + "/weather_data").count() == log["weather_data"].records_collected
    assert spark.read.parquet(store + "/anomaly_detection").count() == n_anom
    assert spark.read.parquet(store + "/data_collection_log").count() == len(log)


def test_cycle_stores_every_station(spark, scratch):
    """1,000 landed stations: all are stored, and a limit is the caller's."""
    docs = spark.range(1000).selectExpr(
        "to_json(named_struct('ID', id, 'AddressInfo', named_struct('Title', concat('s', id), "
        "'Latitude', 1.0 + id / 50, 'Longitude', 2.0 + id / 50))) AS value")
    docs.write.text(scratch + "/landing/stations")
    run_collection_cycle(spark, scratch + "/landing", scratch + "/store", AS_OF)
    assert read_upserted(spark, scratch + "/store", "charging_stations").count() == 1000
    assert spark.read.parquet(scratch + "/store/engineered_features").count() == 1000
    run_collection_cycle(spark, scratch + "/landing", scratch + "/few", AS_OF, max_stations=10)
    assert read_upserted(spark, scratch + "/few", "charging_stations").count() == 10


def test_bundles_are_lazy_frames(spark, tables001):
    b = bundles.network_insights(tables001)
    assert b["network_overview"].count() == 1
    s = bundles.station_insights(tables001, "3")
    assert s["station_info"].count() == 1
    assert set(bundles.correlation_report(tables001)) >= {"report", "insights"}
    assert bundles.usage_patterns(tables001, by=[])["summary"].count() >= 3
