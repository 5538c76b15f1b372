"""Payload readers. The payload texts are written by Spark from the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.sources import eventlog, payloads
from queries.base import query

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def record_lines(spark, folder):
    """One record per event, its shape chosen by the event id: old, new, point, no time, bad value, broken."""
    e = eventlog.events(spark, folder)
    user, kind, at = F.col("user_id"), F.col("event_type"), F.date_format("ts", STAMP)
    lat, lon = (user % 90).cast("double"), (user % 180).cast("double")
    name = F.concat(F.lit("Station "), user.cast("string"))
    old = F.to_json(F.struct(
        F.struct(user.alias("id"), name.alias("name"),
                 F.struct(lat.alias("latitude"), lon.alias("longitude")).alias("coordinates")).alias("location"),
        F.upper(kind).alias("parameter"), F.col("value"), F.lit("µg/m³").alias("unit"),
        F.struct(F.concat(at, F.lit("Z")).alias("utc")).alias("date")))
    new = F.to_json(F.struct(
        user.alias("locationId"), name.alias("locationName"), lat.alias("latitude"), lon.alias("longitude"),
        F.struct(F.lit(2).alias("id"), kind.alias("name")).alias("parameter"),
        F.struct(F.col("value")).alias("value"), F.struct(F.lit("ppm").alias("name")).alias("unit"),
        F.struct(F.concat(at, F.lit("+02:00")).alias("utc")).alias("datetime")))
    point = F.to_json(F.struct(
        user.alias("id"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        kind.alias("parameter"), F.col("value").cast("string").alias("value"), F.lit("ppb").alias("unit"),
        at.alias("datetime")))
    timeless = F.to_json(F.struct(user.alias("id"), kind.alias("parameter"), F.col("value")))
    worded = F.to_json(F.struct(user.alias("id"), kind.alias("parameter"), F.lit("n/a").alias("value"), at.alias("dateUTC")))
    broken = F.concat(F.lit("{"), kind)
    shape = F.col("event_id") % 6
    line = (F.when(shape == 0, old).when(shape == 1, new).when(shape == 2, point).when(shape == 3, timeless)
            .when(shape == 4, worded).otherwise(broken))
    return e.select("event_id", line.alias("value"))


@query("S1_observation_payloads", f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS location_id,
       CASE WHEN event_id % 6 < 2 THEN 'Station ' || user_id END AS location_name, event_type AS parameter,
       value, CASE event_id % 6 WHEN 0 THEN 'µg/m³' WHEN 1 THEN 'ppm' ELSE 'ppb' END AS unit,
       CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id % 180 AS DOUBLE) AS longitude,
       CASE WHEN event_id % 6 = 1 THEN ts - INTERVAL 2 HOUR ELSE ts END AS timestamp,
       ROUND(CASE WHEN event_id % 6 = 1 THEN value * 1000 ELSE value END, 9) AS value_ug_m3,
       event_id % 6 < 2 AS unit_known
FROM events WHERE event_id % 6 < 3""")
def observations(spark, folder):
    return payloads.parse_observations(payloads.as_records(record_lines(spark, folder)))


@query("S1_rejected_records", """
SELECT CASE event_id % 6 WHEN 3 THEN 'no time' WHEN 4 THEN 'unreadable value' ELSE 'unreadable record' END AS problem,
       COUNT(*) AS records FROM events WHERE event_id % 6 >= 3 GROUP BY 1""")
def rejects(spark, folder):
    return payloads.rejected(payloads.as_records(record_lines(spark, folder)))


@query("S1_observations_of_cities", """
SELECT event_id, c_mktsegment AS city, 'XX' AS country, -1.5::DOUBLE AS latitude,
       CAST(user_id AS DOUBLE) AS longitude, ts AS timestamp, ts + INTERVAL 9 HOUR AS local_time
FROM events JOIN customer ON c_custkey = user_id""")
def observations_of_cities(spark, folder):
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    segments = customer.select(F.col("c_mktsegment").alias("city_name")).distinct().select(
        F.upper("city_name").alias("city_name"), F.lit("XX").alias("country"), F.lit("Asia/Tokyo").alias("timezone"),
        F.lit(-1.5).alias("latitude"), F.lit(99.0).alias("longitude"))
    e = eventlog.events(spark, folder).join(customer, F.col("user_id") == F.col("c_custkey"))
    line = F.to_json(F.struct(F.col("user_id").alias("longitude"), F.col("event_type").alias("parameter"),
                              F.col("value"), F.date_format("ts", STAMP).alias("date")))
    records = payloads.as_records(e.select("event_id", F.col("c_mktsegment").alias("city"), line.alias("value")))
    return payloads.parse_observations(records, segments).select(
        "event_id", "city", "country", "latitude", "longitude", "timestamp", "local_time")


def hourly_lines(spark, folder, names):
    """One payload of parallel arrays per event: two hours, the last parameter ragged, one absent."""
    e = eventlog.events(spark, folder)
    v, hour = F.col("value"), F.date_trunc("hour", "ts")
    first, second = [F.date_format(h, "yyyy-MM-dd'T'HH:mm") for h in (hour, hour + F.expr("INTERVAL 1 HOUR"))]
    arrays = [F.array(first, second).alias("time")]
    arrays += [F.array(v + i, v - i).alias(n) for i, n in enumerate(names[:-2])]
    arrays.append(F.array(v).alias(names[-2]))
    return e.select("event_id", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("value"))


def hourly_sql(columns, shift: str = "") -> str:
    def pick(sign, ragged):
        cells = [f"ROUND(value {sign} {i}, 9) AS {c}" for i, c in enumerate(columns[:-2])]
        return ", ".join([*cells, f"{ragged} AS {columns[-2]}", f"NULL::DOUBLE AS {columns[-1]}"])
    return f"""
SELECT event_id, date_trunc('hour', ts)::TIMESTAMP {shift} AS timestamp, {pick('+', 'value')} FROM events
UNION ALL SELECT event_id, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR {shift}, {pick('-', 'NULL::DOUBLE')} FROM events"""


query("S2_weather_payloads", hourly_sql(list(C.WEATHER_MAPPING.values())))(
    lambda spark, folder: payloads.parse_weather(hourly_lines(spark, folder, list(C.WEATHER_MAPPING))))

query("S2_weather_in_local_time", hourly_sql(list(C.WEATHER_MAPPING.values()), "- INTERVAL 9 HOUR"))(
    lambda spark, folder: payloads.parse_weather(
        hourly_lines(spark, folder, list(C.WEATHER_MAPPING)), source_zone="Asia/Tokyo"))

query("S3_pollutant_forecasts", hourly_sql(list(C.AIR_FORECAST_MAPPING.values())))(
    lambda spark, folder: payloads.parse_weather(
        hourly_lines(spark, folder, list(C.AIR_FORECAST_MAPPING)), C.AIR_FORECAST_MAPPING))


@query("S4_envelopes", """
SELECT event_id, n AS item, value FROM events, generate_series(1, 2) g(n) WHERE event_id % 4 < 3""")
def envelopes(spark, folder):
    e = eventlog.events(spark, folder)
    items = F.array(*[F.struct(F.lit(n).cast("bigint").alias("item"), F.col("value")) for n in (1, 2)])
    listed = F.to_json(items)
    shape = F.col("event_id") % 4
    line = (F.when(shape == 0, F.concat(F.lit('{"results": '), listed, F.lit("}")))
            .when(shape == 1, F.concat(F.lit('{"meta": 1, "data": '), listed, F.lit("}")))
            .when(shape == 2, listed).otherwise(F.lit('{"error": "none"}')))
    records = payloads.unwrap(e.select("event_id", line.alias("value")))
    return records.select("event_id", F.get_json_object("record", "$.item").cast("bigint").alias("item"),
                          F.get_json_object("record", "$.value").cast("double").alias("value"))


def station_lines(spark, folder):
    """Metadata of one station per customer: two sensors, every seventh without an id."""
    key = F.col("c_custkey")
    sensors = F.array(*[F.struct((key * 10 + i).alias("id"), F.struct(
        F.lit(i).cast("bigint").alias("id"), F.lit(name).alias("name"), F.lit("µg/m³").alias("units")).alias("parameter"))
        for i, name in enumerate(("PM25", "O3"))])
    station = F.struct(F.when(key % 7 > 0, key).alias("id"), F.col("c_name").alias("name"),
                       F.struct((key % 90).cast("double").alias("latitude"),
                                (key % 180).cast("double").alias("longitude")).alias("coordinates"),
                       sensors.alias("sensors"))
    return spark.read.parquet(f"{folder}/customer.parquet").select(F.to_json(station).alias("value"))


@query("S5_station_metadata", """
SELECT CAST(c_custkey AS VARCHAR) AS location_id, c_name AS location_name, CAST(c_custkey % 90 AS DOUBLE) AS latitude,
       CAST(c_custkey % 180 AS DOUBLE) AS longitude, c_custkey * 10 + i AS sensor_id,
       CASE i WHEN 0 THEN 'pm25' ELSE 'o3' END AS parameter, 'µg/m³' AS unit
FROM customer, generate_series(0, 1) g(i) WHERE c_custkey % 7 > 0""")
def stations(spark, folder):
    return payloads.parse_stations(payloads.as_records(station_lines(spark, folder)))


@query("S6_attach_sensor_metadata", """
SELECT event_id, CAST(user_id AS VARCHAR) AS location_id, value, ts AS timestamp,
       CASE event_id % 3 WHEN 0 THEN 'pm25' ELSE 'o3' END AS parameter, 'µg/m³' AS unit, c_name AS location_name,
       CASE WHEN event_id % 2 = 0 THEN 1.5::DOUBLE ELSE CAST(user_id % 90 AS DOUBLE) END AS latitude,
       CAST(user_id % 180 AS DOUBLE) AS longitude
FROM events JOIN customer ON c_custkey = user_id WHERE event_id % 3 < 2 AND user_id % 7 > 0""")
def attached(spark, folder):
    known = payloads.parse_stations(payloads.as_records(station_lines(spark, folder)))
    none = F.lit(None).cast("double")
    latest = eventlog.events(spark, folder).select(
        "event_id", F.col("user_id").cast("string").alias("location_id"), "value", F.col("ts").alias("timestamp"),
        (F.col("user_id") * 10 + F.col("event_id") % 3).alias("sensor_id"),
        F.when(F.col("event_id") % 2 == 0, 1.5).otherwise(none).alias("latitude"), none.alias("longitude"))
    return payloads.attach_sensor_metadata(latest, known).drop("sensor_id")


@query("S8_list_cities", """
SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN c_mktsegment ELSE 'City ' || c_nationkey END AS city_name
FROM customer WHERE c_custkey % 3 < 2""")
def cities(spark, folder):
    key = F.col("c_custkey")
    line = (F.when(key % 3 == 0, F.to_json(F.struct(F.col("c_mktsegment").alias("name"))))
            .when(key % 3 == 1, F.to_json(F.struct(F.lit("").alias("name"),
                                                   F.concat(F.lit("City "), "c_nationkey").alias("city"))))
            .otherwise(F.lit('{"name": ""}')))
    lines = spark.read.parquet(f"{folder}/customer.parquet").select(line.alias("value"))
    return payloads.list_cities(payloads.as_records(lines))
