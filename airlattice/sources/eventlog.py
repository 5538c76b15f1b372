"""Star schema read out of an event log with its users.

Each user is a station, a user's region its city, and the event type the metric.
Events are reduced per user and hour before they meet the user table, so neither a
busy user nor a busy region puts raw events on one task.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import hour_floor
from airlattice.operators.reshape import merge_station_hours, station_hours
from airlattice.session import use_utc
from airlattice.tables import Warehouse, default_metrics

EVENT_METRIC = {"click": "pm25", "view": "pm10", "purchase": "no2", "error": "o3"}
WEATHER_EVENT = "signup"


# Declared, so that no job has to read file footers first.
LAYOUTS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(LAYOUTS[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")


def mapped(column, values: dict, other):
    """A small lookup as one CASE expression that is never NULL."""
    out = F
    for key, value in values.items():
        out = out.when(column == key, value)
    return out.otherwise(other)


def events(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def user_cities(spark: SparkSession, root: str) -> DataFrame:
    """(location_id, city_id) for every user."""
    return (_read(spark, root, "customer")
            .join(_read(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("location_id"), F.col("n_regionkey").alias("city_id")))


def dim_city(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("r_regionkey")
    return _read(spark, root, "region").select(
        key.alias("city_id"), F.col("r_name").alias("city_name"),
        F.substring("r_name", 1, 2).alias("country"),
        (key * 10.0).alias("latitude"), (key * 20.0 - 40.0).alias("longitude"),
        F.lit("UTC").alias("timezone"))


def station_observations(spark: SparkSession, root: str) -> DataFrame:
    """The long frame of the log. Values carry two decimals and are kept exact."""
    kind = F.col("event_type")
    code = mapped(kind, EVENT_METRIC, "")
    user = F.col("user_id")
    return (events(spark, root).filter(kind.isin(list(EVENT_METRIC)))
            .select("event_id", user.alias("location_id"),
                    F.concat(F.lit("Station "), user.cast("string")).alias("location_name"),
                    code.alias("parameter"), F.col("ts").alias("timestamp"),
                    F.col("value").cast("decimal(18,2)").alias("value_ug_m3"),
                    (user % 90).cast("double").alias("latitude"),
                    (user % 180).cast("double").alias("longitude")))


def fact_observation(spark: SparkSession, root: str) -> DataFrame:
    totals = station_hours(station_observations(spark, root)).join(user_cities(spark, root), "location_id")
    hourly = merge_station_hours(totals, "city_id")
    ids = mapped(F.col("parameter"), {m[1]: m[0] for m in C.METRICS}, -1)
    return hourly.select(F.col("timestamp_hour").alias("timestamp"), "city_id", ids.alias("metric_id"),
                         F.col("value_ug_m3").alias("value"), "value_ug_m3", "station_count",
                         "latitude", "longitude", F.col("location_id").cast("string").alias("location_id"),
                         "location_name")


def fact_weather(spark: SparkSession, root: str) -> DataFrame:
    v = F.col("value").cast("decimal(18,2)")
    k = F.get_json_object("props", "$.k").cast("bigint")
    hours = (events(spark, root).filter(F.col("event_type") == WEATHER_EVENT)
             .groupBy(F.col("user_id").alias("location_id"), hour_floor("ts").alias("timestamp"))
             .agg(F.sum(v).alias("v"), F.sum(k).alias("k"), F.count(F.lit(1)).alias("n"), F.count(k).alias("kn"))
             .join(user_cities(spark, root), "location_id")
             .groupBy("city_id", "timestamp")
             .agg(F.sum("v").cast("double").alias("v"), F.sum("k").alias("k"),
                  F.sum("n").alias("n"), F.sum("kn").alias("kn")))
    mean = F.col("v") / F.col("n")
    return hours.select("timestamp", "city_id", mean.alias("temperature_c"),
                        F.try_divide(F.col("k"), F.col("kn")).alias("humidity_percent"),
                        (F.col("v") / 100).alias("precipitation_mm"), (mean / 10).alias("wind_speed_ms"),
                        (mean % 360).alias("wind_direction_deg"),
                        (F.col("city_id") * 10.0).alias("latitude"),
                        (F.col("city_id") * 20.0 - 40.0).alias("longitude"))


class EventWarehouse(Warehouse):
    """The star schema of an event log; a table's plan is built when first asked for."""

    def __init__(self, spark: SparkSession, root: str):
        object.__setattr__(self, "source", (spark, root))

    dim_city = cached_property(lambda self: dim_city(*self.source))
    dim_metric = cached_property(lambda self: default_metrics(self.source[0]))
    fact_observation = cached_property(lambda self: fact_observation(*self.source))
    fact_weather = cached_property(lambda self: fact_weather(*self.source))


def event_warehouse(spark: SparkSession, root: str) -> Warehouse:
    return EventWarehouse(spark, root)
