"""One load run over all cities: payload files to appended facts, quality rows and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice.operators.joins import merge_observations_and_weather, star
from airlattice.operators.quality import daily_quality_metrics, in_order_of_loads, quality_gate, quality_report
from airlattice.operators.reshape import hourly_by_city, hourly_weather, hourly_wide, pivot_metrics
from airlattice.operators.scope import keep_metrics, last
from airlattice.plans.daily import refresh_profiles
from airlattice.sources import payloads, sinks
from airlattice.session import stored
from airlattice.tables import Warehouse, create_tables, load_warehouse, read_table


def run_summary(cities: DataFrame, air: DataFrame, weather: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """One row: cities processed and failed, rows per table, cities with quality issues.

    A city fails when it brought neither observations nor weather.
    """
    def count(df, name):
        return df.groupBy("city").agg(F.count(F.lit(1)).alias(name))

    per_city = (cities.select(F.col("city_name").alias("city")).distinct()
                .join(count(air, "aq"), "city", "left").join(count(weather, "wx"), "city", "left"))
    if issues is not None:
        per_city = per_city.join(count(issues, "bad"), "city", "left")
    else:
        per_city = per_city.withColumn("bad", F.lit(0))
    per_city = per_city.na.fill(0)
    some = (F.col("aq") + F.col("wx")) > 0
    return per_city.agg(F.count_if(some).alias("cities_processed"), F.count_if(~some).alias("cities_failed"),
                        F.coalesce(F.sum("aq"), F.lit(0)).alias("total_aq_records"),
                        F.coalesce(F.sum("wx"), F.lit(0)).alias("total_weather_records"),
                        F.count_if(F.col("bad") > 0).alias("cities_with_issues"))


def hourly_observations(obs: DataFrame, metrics=None) -> DataFrame:
    """Long city-hour rows, of the named metrics or all, ready for the sink."""
    kept = obs if metrics is None else keep_metrics(obs, allow=metrics, metric="parameter")
    return hourly_by_city(kept).withColumn("timestamp", F.col("timestamp_hour"))


def merged_hours(obs: DataFrame, weather: DataFrame) -> DataFrame:
    """The wide hourly frame of pollutants next to weather, unmatched hours kept."""
    wide = hourly_wide(pivot_metrics(hourly_by_city(obs)))
    return merge_observations_and_weather(wide, hourly_weather(weather))


def load_cities(spark: SparkSession, root: str, cities: DataFrame) -> int:
    create_tables(spark, root)
    return sinks.append_cities(spark, root, cities)


def refresh_quality(spark: SparkSession, root: str, batch: DataFrame) -> int:
    """Quality rows of the days a batch touches, from all facts of those days, in place of earlier rows.

    Only those folders of the fact are read, and only those of the quality table are written.
    """
    t = load_warehouse(spark, root)
    touched = Warehouse(t.dim_city, t.dim_metric, sinks.stored_days(t.fact_observation, batch), t.fact_weather)
    return sinks.replace_quality(daily_quality_metrics(touched, loaded="created_at"), root)


def recent_report(spark: SparkSession, root: str, as_of, interval: str = "7 days") -> DataFrame:
    """The quality report of the stored facts of the last days, in their order of loading."""
    t = load_warehouse(spark, root)
    recent = last(t.fact_observation, interval, as_of)
    named = star(recent, t.dim_city, t.dim_metric).select("timestamp", "city_name", "metric_code", "value_ug_m3", "created_at")
    series = ["city_name", "metric_code"]
    order = in_order_of_loads(named, series, "created_at").agg(
        F.coalesce(F.bool_and("is_monotonic"), F.lit(True)).alias("ok"))
    row = order.select(F.lit("monotonic").alias("check"), F.lit("all").alias("scope"), F.lit("timestamp").alias("column"),
                       F.col("ok").cast("double").alias("value"), F.lit(1.0).alias("threshold"),
                       F.when(F.col("ok"), "ok").otherwise("warning").alias("status"))
    return quality_report(named.drop("created_at"), as_of).unionByName(row)


def run_load(spark: SparkSession, root: str, observations: str, weather: str, cities: DataFrame,
             as_of, metrics=None, envelope: bool = False, gate: bool = False) -> dict:
    """Load both payload folders for all cities at once.

    Returns the written row counts and, as lazy frames, the quality report of the batch and
    of the stored last seven days, the run summary, what was not loaded (``rejected`` records
    by problem, weather rows of unknown cities) and the merged hourly frame. With ``gate`` a
    warning of the last seven days raises ``QualityError`` after the facts are written.
    """
    load_cities(spark, root, cities)
    known = read_table(spark, root, "dim_city")
    lines = payloads.read_lines(spark, observations)
    records = payloads.unwrap(lines) if envelope else payloads.as_records(lines)
    obs = payloads.parse_observations(records, known)
    hourly = stored(hourly_observations(obs, metrics))
    sky = payloads.read_weather(spark, weather)
    report = quality_report(hourly.select("timestamp", "city", "parameter", "value_ug_m3"), as_of,
                            city="city", metric="parameter")
    written = {"fact_observation": sinks.append_observations(spark, root, hourly),
               "fact_weather": sinks.append_weather(spark, root, sky)}
    written["fact_data_quality_metrics"] = refresh_quality(spark, root, hourly)
    refresh_profiles(spark, root, hourly, sky)
    recent = recent_report(spark, root, as_of)
    if gate:
        quality_gate(recent)
    issues = report.filter("status = 'warning' AND scope <> 'all'").select(F.col("scope").alias("city"))
    lost = payloads.rejected(records, known).unionByName(
        sinks.unknown_cities(sky, known).agg(F.sum("rows").alias("records")).filter("records > 0")
        .select(F.lit("weather of an unknown city").alias("problem"), "records"))
    return {"written": written, "report": report, "recent": recent, "rejected": lost,
            "summary": run_summary(known, hourly, sky, issues), "merged": merged_hours(obs, sky)}
