"""Landing-zone readers S01–S12 on small files: one valid document, one
with the optional structs absent, one with them explicitly null, and one
broken line (FIXTURES §2)."""

import json
import os

from conftest import AS_OF
from voltgrid.sources import ingest


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    return folder


STATION_FULL = {
    "ID": 42, "AddressInfo": {"Title": "Depot", "Latitude": 40.5, "Longitude": -74.2, "AddressLine1": "1 Main",
                              "Town": "Springfield", "StateOrProvince": "NJ",
                              "Country": {"Title": "United States", "ISOCode": "US"}},
    "OperatorInfo": {"Title": "OpCo"}, "Network": {"Title": "Net"}, "StatusType": {"Title": "Operational"},
    "AccessComments": "24/7", "UsageCost": "$0.30/kWh",
    "UsageType": {"IsAccessKeyRequired": True, "IsMembershipRequired": False, "IsPayAtLocation": True},
    "Connections": [{"ID": 7, "ConnectionType": {"ID": 25, "Title": "Type 2"}, "PowerKW": 22.0,
                     "Voltage": 400.0, "Amperage": 32.0, "StatusType": {"Title": "Available"}},
                    {"ID": 8, "PowerKW": 50.0}]}
STATION_ABSENT = {"ID": 43, "AddressInfo": {"Title": "Bare", "Latitude": 41.0, "Longitude": -73.0}}
STATION_NULLS = {"ID": 44, "AddressInfo": None, "OperatorInfo": None, "StatusType": None, "UsageType": None,
                 "Connections": None}


def test_stations_and_points(spark, scratch):
    path = _write(scratch + "/stations", "a.json",
                  [json.dumps(STATION_FULL), json.dumps(STATION_ABSENT), json.dumps(STATION_NULLS), "{broken"])
    docs = ingest.read_json(spark, path, ingest.STATION_DOC)
    assert docs.transform(ingest.corrupt_count).collect()[0].corrupt_records == 1
    rows = {r.id: r for r in ingest.parse_stations(docs).collect()}
    assert set(rows) == {"42", "43", "44"}
    full = rows["42"]
    assert (full.name, full.city, full.state, full.country, full.status) == (
        "Depot", "Springfield", "NJ", "United States", "Operational")
    assert full.amenities == "Access Key Required, Pay at Location"
    assert rows["43"].status == "Unknown" and rows["43"].amenities == "" and rows["43"].operator == ""
    assert rows["44"].latitude == 0.0 and rows["44"].name == ""
    pts = {r.id: r for r in ingest.explode_charging_points(docs, AS_OF).collect()}
    assert set(pts) == {"7_25", "8_"}
    assert pts["7_25"].connector_type == "Type 2" and pts["8_"].status == "Unknown"
    assert pts["8_"].station_id == "42" and pts["8_"].voltage == 0.0


def test_station_source_filters(spark, scratch):
    path = _write(scratch + "/stations", "a.json", [json.dumps(STATION_FULL), json.dumps(STATION_ABSENT)])
    assert [r.id for r in ingest.read_stations_json(spark, path, country="US").collect()] == ["42"]
    near = ingest.read_stations_json(spark, path, center=(40.5, -74.2), distance_km=10)
    assert [r.id for r in near.collect()] == ["42"]
    assert ingest.read_stations_json(spark, path, max_results=1).count() == 1


def test_weather_shapes_and_series(spark, scratch):
    nested = {"station_id": "1", "dt": 1704067200, "main": {"temp": 21.5, "humidity": 40, "pressure": 1012},
              "weather": [{"main": "Rain", "description": "light rain"}], "wind": {"speed": 3.0, "deg": 90},
              "rain": {"1h": 0, "3h": 2.5}, "visibility": 10000, "uvi": 3.1}
    flat = {"station_id": "2", "dt": 1704070800, "temp": -3.0, "humidity": 80, "weather": [],
            "snow": {"1h": 1.2}, "visibility": 0}
    nulls = {"station_id": "3", "dt": None, "main": None, "weather": None, "wind": None}
    path = _write(scratch + "/weather", "w.json",
                  [json.dumps(nested), json.dumps(flat), json.dumps(nulls), "not json"])
    rows = {r.station_id: r for r in ingest.read_weather_json(spark, path).collect()}
    assert set(rows) == {"1", "2", "3"}
    a = rows["1"]
    assert (a.temperature_celsius, a.humidity_percent, a.precipitation_mm, a.weather_condition,
            a.visibility_km) == (21.5, 40.0, 2.5, "Rain", 10.0)
    b = rows["2"]
    assert (b.temperature_celsius, b.precipitation_mm, b.weather_condition, b.visibility_km) == (
        -3.0, 1.2, "", None)
    assert str(a.timestamp) == "2024-01-01 00:00:00"
    forecast = {"station_id": "9", "list": [dict(nested, dt=1704067200 + 10800 * i) for i in range(50)]}
    fpath = _write(scratch + "/forecast", "f.json", [json.dumps(forecast)])
    docs = ingest.read_json(spark, fpath, ingest.WEATHER_DOC)
    assert ingest.explode_weather_series(docs, "list").count() == 50
    assert ingest.explode_weather_series(docs, "list", days=5).count() == 40
    assert ingest.explode_weather_series(docs, "list", days=2).count() == 16


def test_traffic_flow_incidents_and_union(spark, scratch):
    flow = {"station_id": "1", "RWS": [{"RW": [{"FIS": [{"FI": [
        {"CF": [{"SP": 15.0, "JF": 4.0}, {"SP": 10.0, "JF": 6.0}, {"SP": 0.0, "JF": 5.0}]},
        {"CF": [{"SP": 55.0, "JF": 2.0}]}]}]}]}]}
    empty = {"station_id": "2", "RWS": [{"RW": [{"FIS": [{"FI": [{"CF": [{"SP": 0.0, "JF": 0.0}]}]}]}]}]}
    broken_fis = {"station_id": "3", "RWS": [{"RW": [{"FIS": []}, {"FIS": [{"FI": [{"CF": [{"SP": 30.0, "JF": 1.0}]}]}]}]}]}
    path = _write(scratch + "/flow", "t.json", [json.dumps(flow), json.dumps(empty), json.dumps(broken_fis), "{"])
    rows = ingest.read_traffic_flow_json(spark, path, AS_OF).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.average_speed_kmh == (15 + 10 + 55) / 3 and r.traffic_density == 4.0
    assert r.congestion_level == "severe"      # 2 of 3 valid items below 20 km/h
    inc = {"station_id": "1", "TRAFFIC_ITEMS": {"TRAFFIC_ITEM": [
        {"TRAFFIC_ITEM_TYPE_DESC": "ACCIDENT", "TRAFFIC_ITEM_DESCRIPTION": [{"value": "Crash"}],
         "CRITICALITY": {"ID": "1"}, "LOCATION": {"GEOLOC": {"ORIGIN": {"LATITUDE": 1.0, "LONGITUDE": 2.0}}}},
        {"TRAFFIC_ITEM_TYPE_DESC": "ROADWORK"}]}}
    ipath = _write(scratch + "/inc", "i.json", [json.dumps(inc), json.dumps({"station_id": "2"})])
    incidents = ingest.read_incidents_json(spark, ipath, AS_OF)
    got = sorted((r.incident_type, r.description, r.severity) for r in incidents.collect())
    assert got == [("ACCIDENT", "Crash", "1"), ("ROADWORK", "", "")]
    mixed = ingest.union_flow_incidents(ingest.read_traffic_flow_json(spark, path, AS_OF), incidents)
    assert sorted(r.record_kind for r in mixed.collect()) == ["flow", "incident", "incident"]


def test_attach_station_skips_zero_coordinates(spark):
    obs = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "station_id string, v double")
    st = spark.createDataFrame([("1", 10.0, 5.0), ("2", 0.0, 5.0)], "id string, latitude double, longitude double")
    assert [r.station_id for r in ingest.attach_station(obs, st).collect()] == ["1"]
