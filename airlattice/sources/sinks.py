"""Idempotent appends to the star schema, and export.

Plain Parquet has no upsert. A batch is made unique on the natural key, rows already
stored are removed by an anti join, and the rest is appended. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.operators.reshape import duplicate_free, unpivot_metrics
from airlattice.operators.windows import position_in_series
from airlattice.session import stored
from airlattice.tables import read_table, write_table

OBSERVATION_KEY = ["city_id", "metric_id", "timestamp"]
WEATHER_KEY = ["city_id", "timestamp"]
QUALITY_KEY = ["date", "city_id", "metric_id"]


def upsert_dim(existing: DataFrame, incoming: DataFrame, natural_key: str, id_col: str) -> DataFrame:
    """The dimension with unseen names added under fresh ids.

    New rows are numbered through hash slices, so no task holds all of them.
    """
    fresh = (duplicate_free(incoming.drop(id_col), [natural_key])
             .join(existing.select(natural_key), natural_key, "left_anti"))
    digest = F.md5(F.col(natural_key))
    highest = F.coalesce(existing.agg(F.max(id_col)).scalar(), F.lit(0))
    numbered = position_in_series(fresh, [], [digest], F.substring(digest, 1, 3), "_position")
    added = numbered.withColumn(id_col, (highest + F.col("_position") + 1).cast("int")).drop("_position")
    return existing.unionByName(added, allowMissingColumns=True)


def stored_days(existing: DataFrame, batch: DataFrame, day: str = "event_date") -> DataFrame:
    """Stored rows of the days the batch touches.

    The first and last day, as scalar subqueries on the partition column, skip all folders
    outside; a semi join then drops the untouched days between.
    """
    if day not in existing.columns:
        return existing
    days = batch.select((F.col(day) if day in batch.columns else F.to_date("timestamp")).alias(day))
    first, last = days.agg(F.min(day)).scalar(), days.agg(F.max(day)).scalar()
    return (existing.filter((F.col(day) >= first) & (F.col(day) <= last))
            .join(days.distinct(), day, "left_semi"))


def unseen(batch: DataFrame, existing: DataFrame, keys, day: str = "event_date") -> DataFrame:
    """Rows of the batch whose key is not stored yet, one per key."""
    stored = stored_days(existing, batch, day).select(*keys)
    return duplicate_free(batch, keys).join(stored, list(keys), "left_anti")


def city_ids(city: DataFrame) -> DataFrame:
    """(_name, city_id): the smallest id of each city name in any letter case."""
    return city.groupBy(F.lower("city_name").alias("_name")).agg(F.min("city_id").alias("city_id"))


def with_city_id(batch: DataFrame, city: DataFrame) -> DataFrame:
    """The batch with the id of its ``city`` name, unless it carries ids; unknown cities are dropped."""
    if "city_id" in batch.columns:
        return batch
    return batch.withColumn("_name", F.lower("city")).join(city_ids(city), "_name").drop("_name")


def unknown_cities(batch: DataFrame, city: DataFrame) -> DataFrame:
    """(city, rows) of the batch that no stored city matches."""
    missing = batch.withColumn("_name", F.lower("city")).join(city_ids(city).select("_name"), "_name", "left_anti")
    return missing.groupBy("city").agg(F.count(F.lit(1)).alias("rows"))


def observation_rows(batch: DataFrame, city: DataFrame, metric: DataFrame) -> DataFrame:
    """A wide or long batch with a ``city`` name column in the layout of the fact.

    Cities match in any letter case. Unknown cities and metrics and empty values are dropped.
    """
    if "parameter" not in batch.columns:
        batch = unpivot_metrics(batch)
    defaults = {"station_count": F.lit(1), "latitude": F.lit(None), "longitude": F.lit(None),
                "location_id": F.lit(None), "location_name": F.lit(None)}
    for name, default in defaults.items():
        if name not in batch.columns:
            batch = batch.withColumn(name, default)
    codes = metric.select("metric_id", F.col("metric_code").alias("parameter"))
    return (with_city_id(batch.filter(F.col("value_ug_m3").isNotNull()), city).join(codes, "parameter")
            .select("timestamp", "city_id", "metric_id",
                    F.col("value_ug_m3").alias("value"), "value_ug_m3",
                    F.coalesce("station_count", F.lit(1)).cast("int").alias("station_count"),
                    F.col("latitude").cast("double").alias("latitude"),
                    F.col("longitude").cast("double").alias("longitude"),
                    F.col("location_id").cast("string").alias("location_id"),
                    F.col("location_name").cast("string").alias("location_name")))


def new_observations(existing: DataFrame, batch: DataFrame, city: DataFrame, metric: DataFrame) -> DataFrame:
    """Fact rows of a batch that are not stored yet."""
    return unseen(observation_rows(batch, city, metric), existing, OBSERVATION_KEY)


def weather_rows(batch: DataFrame, city: DataFrame) -> DataFrame:
    """A weather batch in the layout of the fact; NULLs are kept, unknown cities dropped."""
    for name in (*C.WEATHER_COLUMNS, "latitude", "longitude"):
        if name not in batch.columns:
            batch = batch.withColumn(name, F.lit(None).cast("double"))
    return with_city_id(batch, city).select(
        "timestamp", "city_id", *C.WEATHER_COLUMNS, "latitude", "longitude")


def new_weather(existing: DataFrame, batch: DataFrame, city: DataFrame) -> DataFrame:
    """Weather rows of a batch that are not stored yet."""
    return unseen(weather_rows(batch, city), existing, WEATHER_KEY)


def new_quality(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Quality rows to append, absent counters as 0 and an absent order flag as true."""
    for name, default in {"value_range_violations": F.lit(0), "sudden_jumps_count": F.lit(0),
                          "is_monotonic": F.lit(True)}.items():
        held = F.col(name) if name in batch.columns else F.lit(None)
        batch = batch.withColumn(name, F.coalesce(held, default))
    return unseen(batch, existing, QUALITY_KEY, day="date")


def _append(rows: DataFrame, root: str, name: str) -> int:
    """Write and return the number of rows."""
    return write_table(rows.withColumn("created_at", F.current_timestamp()), root, name)


def append_observations(spark: SparkSession, root: str, batch: DataFrame) -> int:
    """The batch is stored once: its days, range and rows are separate passes."""
    rows = observation_rows(batch, read_table(spark, root, "dim_city"), read_table(spark, root, "dim_metric"))
    fresh = unseen(stored(rows), read_table(spark, root, "fact_observation"), OBSERVATION_KEY)
    return _append(fresh, root, "fact_observation")


def append_weather(spark: SparkSession, root: str, batch: DataFrame) -> int:
    rows = stored(weather_rows(batch, read_table(spark, root, "dim_city")))
    return _append(unseen(rows, read_table(spark, root, "fact_weather"), WEATHER_KEY), root, "fact_weather")


def append_quality(spark: SparkSession, root: str, batch: DataFrame) -> int:
    rows = new_quality(read_table(spark, root, "fact_data_quality_metrics"), stored(batch))
    return _append(rows, root, "fact_data_quality_metrics")


def replace_quality(rows: DataFrame, root: str) -> int:
    """Write whole days of quality rows; the days' earlier rows are replaced, other days stay."""
    return write_table(rows.withColumn("created_at", F.current_timestamp()), root, "fact_data_quality_metrics", mode="replace")


def append_cities(spark: SparkSession, root: str, incoming: DataFrame) -> int:
    """Add unseen cities under fresh ids. Only the new rows are written."""
    existing = read_table(spark, root, "dim_city")
    merged = upsert_dim(existing, incoming, "city_name", "city_id")
    added = (merged.join(existing.select("city_id"), "city_id", "left_anti")
             .withColumn("updated_at", F.current_timestamp()))
    return _append(added, root, "dim_city")


def export_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """A folder of CSV files with header lines, written by the tasks that hold the rows."""
    df.write.mode(mode).option("header", True).csv(path)
