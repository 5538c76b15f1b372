"""Payload shapes, one record each."""

import json
from datetime import datetime

import pytest

from airlattice.constants import AIR_FORECAST_MAPPING
from airlattice.sources import payloads as P
from airlattice.tables import default_cities


def records(spark, *items):
    lines = [i if isinstance(i, str) else json.dumps(i) for i in items]
    return P.as_records(spark.createDataFrame([(x,) for x in lines], "value STRING"))


NOON = "2024-01-01T12:00:00Z"


@pytest.mark.parametrize("record,expected", [
    ({"parameter": "PM25", "value": 1, "unit": "µg/m³", "date": {"utc": NOON}}, ("pm25", 1.0, 1.0)),
    ({"parameter": {"id": 2, "name": "O3"}, "value": {"value": 2.5}, "unit": {"name": "ppm"}, "datetime": {"utc": NOON}}, ("o3", 2.5, 2500.0)),
    ({"parameter": {"id": 2}, "value": "3.5", "unit": {"symbol": "PPM"}, "datetime": NOON}, ("2", 3.5, 3500.0)),
    ({"parameter": "no2", "dateUTC": NOON}, ("no2", 0.0, 0.0)),
    ({"parameter": "no2", "value": {}, "date": NOON}, ("no2", 0.0, 0.0)),
])
def test_field_shapes(spark, record, expected):
    row = P.parse_observations(records(spark, record)).first()
    assert (row["parameter"], row["value"], row["value_ug_m3"]) == expected
    assert row["timestamp"] == datetime(2024, 1, 1, 12)


@pytest.mark.parametrize("record,problem", [
    ({"value": 1}, "no time"), ({"value": 1, "date": "soon"}, "unreadable time"),
    ({"value": None, "date": NOON}, "unreadable value"), ({"value": "much", "date": NOON}, "unreadable value"),
    ("{broken", "unreadable record"),
])
def test_rejects(spark, record, problem):
    rows = records(spark, record)
    assert P.parse_observations(rows).count() == 0
    assert [(r["problem"], r["records"]) for r in P.rejected(rows).collect()] == [(problem, 1)]


@pytest.mark.parametrize("place,expected", [
    ({"location": {"id": 7, "name": "x", "coordinates": {"latitude": 1.5, "longitude": 2.5}}}, (1.5, 2.5, "7", "x")),
    ({"location": {"locationId": 8, "latitude": 0, "longitude": 0}}, (0.0, 0.0, "8", None)),
    ({"id": 9, "geometry": {"type": "Point", "coordinates": [3.5, 4.5]}}, (4.5, 3.5, "9", None)),
    ({"geometry": {"type": "Line", "coordinates": [3.5, 4.5]}}, (51.5074, -0.1278, None, None)),
    ({"latitude": "6.5", "longitude": 7}, (6.5, 7.0, None, None)),
])
def test_coordinates(spark, place, expected):
    from pyspark.sql import functions as F
    rows = records(spark, {**place, "parameter": "o3", "value": 1, "date": NOON}).withColumn("city", F.lit("london"))
    row = P.parse_observations(rows, default_cities(spark)).first()
    assert (row["latitude"], row["longitude"], row["location_id"], row["location_name"]) == expected
    assert row["country"] == "GB"


def test_times_and_clock_changes(spark):
    from pyspark.sql import functions as F
    texts = ["2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z", "2024-11-03T05:30:00", "2024-11-03T07:30:00+02:00"]
    rows = records(spark, *[{"parameter": "o3", "value": 1, "date": t} for t in texts]).withColumn("city", F.lit("New York"))
    got = P.parse_observations(rows, default_cities(spark)).select("timestamp", "local_time").collect()
    assert [r["timestamp"].hour for r in got] == [5, 6, 5, 5]
    assert {r["local_time"].hour for r in got} == {1}


def test_envelopes(spark):
    lines = ['{"results": [{"a": 1}, {"a": 2}]}', '{"data": [{"a": 3}]}', '[{"a": 4}]', '{"error": 1}', "[]"]
    got = P.unwrap(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    assert sorted(json.loads(r["record"])["a"] for r in got.collect()) == [1, 2, 3, 4]


def test_read_files_by_city(spark, tmp_path):
    folder = tmp_path / "city=Paris"
    folder.mkdir()
    (folder / "part.json").write_text(json.dumps({"results": [{"parameter": "o3", "value": 4, "date": NOON}]}) + "\n\n")
    row = P.read_observations(spark, str(tmp_path), default_cities(spark), envelope=True).first()
    assert (row["city"], row["value"], row["latitude"]) == ("Paris", 4.0, 48.8566)


def test_weather_arrays(spark, tmp_path):
    (tmp_path / "w.json").write_text("\n".join(json.dumps(p) for p in [
        {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0, None], "precipitation": [0.5]}},
        {"hourly": {"time": []}}, {"daily": {}}, {"hourly": {"time": ["later"], "temperature_2m": [9.0]}}]))
    rows = sorted(P.read_weather(spark, str(tmp_path)).collect())
    assert [(r["timestamp"].hour, r["temperature_c"], r["precipitation_mm"], r["humidity_percent"]) for r in rows] == [
        (0, 1.0, 0.5, None), (1, None, None, None)]
    tokyo = P.read_weather(spark, str(tmp_path), source_zone="Asia/Tokyo").agg({"timestamp": "min"}).first()[0]
    assert tokyo == datetime(2023, 12, 31, 15)


def test_forecast_mapping(spark):
    line = json.dumps({"hourly": {"time": ["2024-01-01T00:00"], "pm2_5": [1.0], "ozone": [2.0]}})
    row = P.parse_weather(spark.createDataFrame([(line,)], "value STRING"), AIR_FORECAST_MAPPING).first()
    assert (row["pm25"], row["o3"], row["pm10"], row["no2"]) == (1.0, 2.0, None, None)


def test_stations_and_sensors(spark):
    station = {"id": 5, "name": "n", "coordinates": {"latitude": 1.0, "longitude": 2.0},
               "sensors": [{"id": 51, "parameter": {"id": 1, "name": "PM10", "units": "u"}}, {"id": 52, "parameter": {"id": 2}}]}
    sensors = P.parse_stations(records(spark, station, {"name": "no id"}))
    assert sorted((r["sensor_id"], r["parameter"]) for r in sensors.collect()) == [(51, "pm10"), (52, "")]
    values = spark.createDataFrame([("5", 51, 1.0, None), ("5", 52, 2.0, 9.0), ("5", 99, 3.0, None)],
                                   "location_id STRING, sensor_id BIGINT, value DOUBLE, latitude DOUBLE").selectExpr("*", "latitude AS longitude")
    got = P.attach_sensor_metadata(values, sensors, "PM10").collect()
    assert [(r["value"], r["latitude"], r["longitude"], r["unit"]) for r in got] == [(1.0, 1.0, 2.0, "u")]


def test_city_names(spark):
    got = P.list_cities(records(spark, {"name": "A"}, {"city": "B"}, {"name": "", "city": "B"}, {"name": ""}, {}))
    assert sorted(r[0] for r in got.collect()) == ["A", "B"]
