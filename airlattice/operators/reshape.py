"""Station to city-hour aggregation and long/wide conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import hour_floor

PLACE = ["latitude", "longitude", "location_id", "location_name"]


def _first_known(columns, order):
    """Per column, its value in the earliest row where it is not NULL; ties go to the least value."""
    def first(c):
        seen = F.struct(*order, F.col(c).alias("_v"))
        return F.min(F.when(F.col(c).isNotNull(), seen)).getField("_v").alias(c)
    return [first(c) for c in columns]


def _mean(total, number):
    return F.try_divide(F.col(total).cast("double"), F.col(number))


def station_hours(obs: DataFrame, value: str = "value_ug_m3", by=("location_id",), extra=()) -> DataFrame:
    """Mergeable totals per station, hour and parameter: a far smaller frame to join with."""
    keys = [*by, "parameter"]
    place = [c for c in PLACE if c in obs.columns and c not in keys] + list(extra)
    return (obs.groupBy(*keys, hour_floor("timestamp").alias("timestamp_hour"))
            .agg(F.sum(value).alias("v_sum"), F.count(value).alias("v_n"),
                 F.min("timestamp").alias("first_seen"), *_first_known(place, ["timestamp"])))


def merge_station_hours(totals: DataFrame, city: str = "city") -> DataFrame:
    """City-hour rows from station totals that carry a city column."""
    place = [c for c in PLACE if c in totals.columns]
    return (totals.groupBy(city, "timestamp_hour", "parameter")
            .agg(F.sum("v_sum").alias("v_sum"), F.sum("v_n").cast("int").alias("station_count"),
                 F.count_distinct("location_id").cast("int").alias("distinct_stations"),
                 *_first_known(place, ["first_seen", "location_id"]))
            .withColumn("value_ug_m3", _mean("v_sum", "station_count"))
            .drop("v_sum"))


def hourly_by_city(obs: DataFrame, city: str = "city", value: str = "value_ug_m3") -> DataFrame:
    """Mean, count and first-seen place per city, hour and parameter.

    ``station_count`` counts measurements, ``distinct_stations`` the stations behind them.
    A busy station is reduced on its own key first, then stations merge into their city.
    """
    return merge_station_hours(station_hours(obs, value, by=(city, "location_id")), city)


def pivot_metrics(hourly: DataFrame, keys=("city", "timestamp_hour"), metrics=None,
                  column: str = "parameter", value: str = "value_ug_m3") -> DataFrame:
    """One column per metric. The metric list is fixed, so the plan needs no extra pass."""
    return hourly.groupBy(*keys).pivot(column, list(metrics or C.METRIC_CODES)).agg(F.avg(value))


def unpivot_metrics(wide: DataFrame, keys=None, metrics=None, column: str = "parameter",
                    value: str = "value_ug_m3") -> DataFrame:
    """One row per metric with a value; empty cells vanish."""
    present = [m for m in (metrics or C.METRIC_CODES) if m in wide.columns]
    ids = list(keys) if keys else [c for c in wide.columns if c not in present]
    return wide.unpivot(ids, present, column, value).filter(F.col(value).isNotNull())


def hourly_wide(wide: DataFrame, city: str = "city", metrics=None) -> DataFrame:
    """Wide rows merged per city and hour: mean of metrics, first-seen metadata."""
    present = [m for m in (metrics or C.METRIC_CODES) if m in wide.columns]
    meta = [c for c in [*PLACE, "station_count"] if c in wide.columns]
    hour = F.col("timestamp_hour") if "timestamp_hour" in wide.columns else hour_floor("timestamp")
    order = [c for c in ("timestamp", "location_id", "station_count") if c in wide.columns]
    return (wide.groupBy(city, hour.alias("timestamp_hour"))
            .agg(*[F.avg(m).alias(m) for m in present], *_first_known(meta, order)))


def hourly_weather(weather: DataFrame, city: str = "city", circular: bool = False) -> DataFrame:
    """Hourly weather per city; direction is averaged arithmetically or on the circle."""
    if circular:
        angle = F.radians("wind_direction_deg")
        turn = F.degrees(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle))))
        direction = F.pmod(turn, F.lit(360.0))
    else:
        direction = F.avg("wind_direction_deg")
    return (weather.groupBy(city, hour_floor("timestamp").alias("timestamp_hour"))
            .agg(F.avg("temperature_c").alias("temperature_c"),
                 F.avg("humidity_percent").alias("humidity_percent"),
                 F.sum("precipitation_mm").alias("precipitation_mm"),
                 F.avg("wind_speed_ms").alias("wind_speed_ms"),
                 direction.alias("wind_direction_deg")))


def latest_per_series(df: DataFrame, keys, ts: str = "timestamp", ties=()) -> DataFrame:
    """The newest row of each series, by aggregation so that only winners are shuffled."""
    rest = [c for c in df.columns if c not in keys]
    order = [ts, *ties, *[c for c in rest if c not in (ts, *ties)]]
    newest = F.max(F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[f"_row.{c}" for c in rest])


def duplicate_free(df: DataFrame, keys) -> DataFrame:
    """One row per key, always the same one: the least in column order."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
            .select(*keys, *[f"_row.{c}" for c in rest]).select(*df.columns))


def top_per_group(df: DataFrame, keys, order, k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark prunes to k per task before the shuffle."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(spec)).filter(F.col("rank") <= k)


