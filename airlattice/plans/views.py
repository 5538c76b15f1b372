"""The nine named views over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.values import exceeds_limit, percent, risk_level
from airlattice.operators.joins import day_weather, star
from airlattice.operators.windows import fill_hours, lag_of, trailing_days_mean, trailing_mean, with_history
from airlattice.tables import Warehouse

SERIES = ["city_name", "metric_code"]


def observations(t: Warehouse) -> DataFrame:
    """Fact rows with names of city and metric."""
    return star(t.fact_observation, t.dim_city, t.dim_metric)


def v_observations(t: Warehouse) -> DataFrame:
    return observations(t).select(
        "timestamp", "city_name", "country", "metric_code", "metric_name", "unit",
        "value", "value_ug_m3", "station_count", "latitude", "longitude")


def v_weather(t: Warehouse) -> DataFrame:
    return star(t.fact_weather, t.dim_city).select(
        "timestamp", "city_name", "country", *C.WEATHER_COLUMNS, "latitude", "longitude")


def v_observations_weather(t: Warehouse) -> DataFrame:
    """Observations and weather at the same time and city name, unmatched rows of both kept."""
    air = v_observations(t).select(
        "timestamp", "city_name", "country", "metric_code", "metric_name", "value_ug_m3")
    weather = v_weather(t).select(
        "timestamp", "city_name", F.col("country").alias("w_country"), *C.WEATHER_COLUMNS)
    return air.join(weather, ["timestamp", "city_name"], "full_outer").select(
        "timestamp", "city_name", F.coalesce("country", "w_country").alias("country"),
        "metric_code", "metric_name", "value_ug_m3", *C.WEATHER_COLUMNS)


def day_totals(fact: DataFrame, by: list[str]) -> DataFrame:
    """Mergeable totals of the observed value per city, metric and day."""
    v = "value_ug_m3"
    return (fact.groupBy("city_id", *by, F.to_date("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("v_n"), F.sum(v).alias("v_sum"),
                 F.min(v).alias("v_min"), F.max(v).alias("v_max")))


def value_totals(t: Warehouse) -> DataFrame:
    """``day_totals`` by metric, from the stored profile where there is one."""
    if t.daily is None:
        return day_totals(t.fact_observation, ["metric_id"])
    return t.daily.select("city_id", "metric_id", "date", F.col("rows").alias("n"), F.col("n").alias("v_n"), F.col("sum").alias("v_sum"),
                          F.col("min").alias("v_min"), F.col("max").alias("v_max"))


def profiles(t: Warehouse) -> DataFrame:
    """Stored profile rows with names of city and metric."""
    return star(t.daily, t.dim_city, t.dim_metric)


def weighted_summary(totals: DataFrame, weather: DataFrame, by: list, mode: str, *extra) -> DataFrame:
    """Value and weather statistics of day totals joined with the day's weather.

    ``fanout`` gives what a row-level join would: each observation counts once per
    weather row of its day and each weather row once per observation. Both weights are
    known per day, so no pair of rows is ever formed. ``daily`` counts each row once.
    """
    if mode not in ("fanout", "daily"):
        raise ValueError(f"unknown mode {mode!r}")
    joined = totals.join(day_weather(weather), ["city_id", "date"], "left")
    times = F.greatest(F.coalesce("weather_rows", F.lit(0)), F.lit(1)) if mode == "fanout" else F.lit(1)
    each = F.col("n") if mode == "fanout" else F.lit(1)

    def mean(name):
        return F.try_divide(F.sum(F.col(f"{name}_sum") * each), F.sum(F.col(f"{name}_n") * each))

    measures = {
        "avg_value": F.try_divide(F.sum(F.col("v_sum") * times), F.sum(F.col("v_n") * times)),
        "min_value": F.min("v_min"),
        "max_value": F.max("v_max"),
        "data_points": F.sum(F.col("n") * times),
        "avg_temperature": mean("temperature_c"),
        "avg_humidity": mean("humidity_percent"),
        "total_precipitation": F.sum(F.when(F.col("precipitation_mm_n") > 0,
                                            F.col("precipitation_mm_sum") * each)),
        "avg_wind_speed": mean("wind_speed_ms"),
    }
    return joined.groupBy(*by).agg(*[m.alias(k) for k, m in measures.items()], *extra)


def v_daily_aggregates(t: Warehouse, weather: str = "fanout") -> DataFrame:
    totals = star(value_totals(t), t.dim_city, t.dim_metric)
    return weighted_summary(totals, t.fact_weather,
                            ["date", "city_name", "country", "metric_code"], weather)


def v_moving_averages(t: Warehouse, rows: int = 7, **layout) -> DataFrame:
    """Mean of each row and the ``rows - 1`` rows before it in its series."""
    base = observations(t).select("timestamp", *SERIES, "value_ug_m3")
    return with_history(base, SERIES, "timestamp", rows - 1,
                        {"moving_avg_7d": trailing_mean("value_ug_m3", rows)}, **layout)


def moving_average_days(t: Warehouse, days: int = 7) -> DataFrame:
    """Mean over true calendar time instead of a number of rows."""
    base = observations(t).select("timestamp", *SERIES, "value_ug_m3")
    name = f"moving_avg_{days}d"
    exact = base.withColumn("_exact", F.col("value_ug_m3").cast("decimal(28,12)"))
    return trailing_days_mean(exact, "_exact", days, SERIES, name=name).drop("_exact")


def v_risk_map(t: Warehouse) -> DataFrame:
    weather = t.fact_weather.select("city_id", "timestamp", "temperature_c", "wind_speed_ms", "precipitation_mm")
    return (observations(t).join(weather, ["city_id", "timestamp"], "left")
            .select(F.to_date("timestamp").alias("date"), F.hour("timestamp").alias("hour"),
                    *SERIES, "value_ug_m3",
                    risk_level("metric_code", "value_ug_m3").alias("risk_level"),
                    "temperature_c", "wind_speed_ms", "precipitation_mm"))


def v_lags(t: Warehouse, grid: bool = False, **layout) -> DataFrame:
    """Values one, two and three rows back; with ``grid`` that many hours back."""
    base = observations(t).select("timestamp", *SERIES, "value_ug_m3", "station_count")
    if grid:
        base = fill_hours(base.withColumn("_seen", F.lit(True)), SERIES)
    out = with_history(base, SERIES, "timestamp", 3,
                       {f"value_lag_{k}h": lag_of("value_ug_m3", k) for k in (1, 2, 3)}, **layout)
    if grid:
        out = out.filter("_seen").drop("_seen")
    return out.select("timestamp", *SERIES, "value_ug_m3",
                      "value_lag_1h", "value_lag_2h", "value_lag_3h", "station_count")


def exceedance_summary(named: DataFrame) -> DataFrame:
    hours = F.count_if(exceeds_limit("metric_code", "value_ug_m3"))
    return (named.groupBy(F.to_date("timestamp").alias("date"), *SERIES)
            .agg(hours.alias("exceedance_hours"), F.max("value_ug_m3").alias("max_value"),
                 F.avg("value_ug_m3").alias("avg_value"), (hours > 0).alias("has_exceedance")))


def v_days_with_exceedances(t: Warehouse) -> DataFrame:
    if t.daily is None:
        return exceedance_summary(observations(t))
    return (profiles(t).groupBy("date", *SERIES)
            .agg(F.sum("over").alias("exceedance_hours"), F.max("max").alias("max_value"),
                 F.try_divide(F.sum("sum"), F.sum("n")).alias("avg_value"), (F.sum("over") > 0).alias("has_exceedance")))


def v_data_completeness(t: Warehouse) -> DataFrame:
    share = percent("actual_data_points", F.lit(C.POINTS_PER_DAY))
    counted = (observations(t).groupBy(*SERIES, F.to_date("timestamp").alias("date")).agg(F.count(F.lit(1)).alias("actual_data_points"))
               if t.daily is None else profiles(t).groupBy(*SERIES, "date").agg(F.sum("rows").alias("actual_data_points")))
    return (counted.select(*SERIES, "date", "actual_data_points",
                    F.lit(C.POINTS_PER_DAY).alias("expected_data_points_per_day"),
                    share.alias("completeness_percent"),
                    (F.lit(100).cast("decimal(5,2)") - share).alias("missing_percent")))


VIEWS = {
    "v_observations": v_observations,
    "v_weather": v_weather,
    "v_observations_weather": v_observations_weather,
    "v_daily_aggregates": v_daily_aggregates,
    "v_moving_averages": v_moving_averages,
    "v_risk_map": v_risk_map,
    "v_lags": v_lags,
    "v_days_with_exceedances": v_days_with_exceedances,
    "v_data_completeness": v_data_completeness,
}


def register_views(spark: SparkSession, t: Warehouse) -> list[str]:
    """Make the tables and all views visible to ``spark.sql``; safe to repeat."""
    for name in ("dim_city", "dim_metric", "fact_observation", "fact_weather"):
        getattr(t, name).createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(t).createOrReplaceTempView(name)
    return list(VIEWS)
