"""Joins of observations with dimensions, weather and other metrics.

Dimension sides carry no forced broadcast: Catalyst and adaptive execution decide from
their sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import hour_floor
from airlattice.operators.scope import last


def star(fact: DataFrame, city: DataFrame, metric: DataFrame | None = None) -> DataFrame:
    """Fact rows with the attributes of their city and metric."""
    extra = [c for c in ("city_name", "country", "timezone") if c in city.columns]
    out = fact.join(city.select("city_id", *extra), "city_id")
    if metric is not None:
        named = metric.select("metric_id", "metric_code", "metric_name", "unit")
        out = out.join(named, "metric_id")
    return out


def day_weather(weather: DataFrame, key: str = "city_id") -> DataFrame:
    """Weather of one calendar day per city: row count, sums and non-null counts."""
    sums = []
    for name in C.WEATHER_COLUMNS:
        sums += [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n")]
    return (weather.groupBy(key, F.to_date("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("weather_rows"), *sums))


def join_same_day(air: DataFrame, weather: DataFrame, key: str = "city_id") -> DataFrame:
    """Each observation with the weather of its city and day.

    The day's weather is one row of counts and sums, so the join never multiplies the
    observations. ``weather_rows`` is how many rows a row-level join would have made.
    """
    return air.withColumn("date", F.to_date("timestamp")).join(day_weather(weather, key), [key, "date"], "left")


def join_same_hour(air: DataFrame, weather: DataFrame, key: str = "city_id") -> DataFrame:
    """Each observation with the weather rows of its city, day and hour."""
    hourly = weather.select(key, hour_floor("timestamp").alias("_hour"), *C.WEATHER_COLUMNS)
    return (air.withColumn("_hour", hour_floor("timestamp"))
            .join(hourly, [key, "_hour"], "left").drop("_hour"))


def with_metric(air: DataFrame, fact: DataFrame, metric_id, name: str) -> DataFrame:
    """Add another metric's value at the same city and time as column ``name``."""
    other = (fact.filter(F.col("metric_id") == metric_id)
             .select("city_id", "timestamp", F.col("value_ug_m3").alias(name)))
    return air.join(other, ["city_id", "timestamp"], "left")


def merge_observations_and_weather(air: DataFrame, weather: DataFrame,
                                  keys=("city", "timestamp_hour")) -> DataFrame:
    """Full outer merge of hourly frames; keys present on either side are kept."""
    return (air.join(weather, list(keys), "full")
            .withColumn("timestamp", F.col(keys[1])))


def records_by_city(city: DataFrame, air: DataFrame, weather: DataFrame, as_of,
                    interval: str = "7 days", mode: str = "fanout") -> DataFrame:
    """Recent rows per city and table.

    Joining two facts to one city multiplies their rows; ``fanout`` reports those
    products, computed from the two counts, and ``dedup`` reports the plain counts.
    """
    def recent(df, name):
        return (last(df, interval, as_of)
                .groupBy("city_id").agg(F.count(F.lit(1)).alias(name)))

    out = (city.select("city_id", "city_name")
           .join(recent(air, "aq"), "city_id", "left").join(recent(weather, "wx"), "city_id", "left")
           .na.fill(0, ["aq", "wx"]))
    if mode == "fanout":
        aq = F.col("aq") * F.greatest(F.col("wx"), F.lit(1))
        wx = F.col("wx") * F.greatest(F.col("aq"), F.lit(1))
    else:
        aq, wx = F.col("aq"), F.col("wx")
    return out.select("city_name", aq.alias("aq_count"), wx.alias("weather_count")).orderBy("city_name")
