"""The star schema: table layouts, seed rows and the set of tables a query needs."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice import constants as C


TYPES = {"INT": T.IntegerType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(),
         "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType()}


def _schema(text: str) -> T.StructType:
    """A layout from ``name TYPE`` pairs; needs no running session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


DIM_CITY = _schema(
    "city_id INT, city_name STRING, country STRING, latitude DOUBLE, longitude DOUBLE, "
    "timezone STRING, provider_city_name STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
DIM_METRIC = _schema(
    "metric_id INT, metric_code STRING, metric_name STRING, unit STRING, description STRING, "
    "created_at TIMESTAMP"
)
FACT_OBSERVATION = _schema(
    "timestamp TIMESTAMP, city_id INT, metric_id INT, value DOUBLE, value_ug_m3 DOUBLE, "
    "station_count INT, latitude DOUBLE, longitude DOUBLE, location_id STRING, "
    "location_name STRING, created_at TIMESTAMP, event_date DATE"
)
FACT_WEATHER = _schema(
    "timestamp TIMESTAMP, city_id INT, temperature_c DOUBLE, humidity_percent DOUBLE, "
    "precipitation_mm DOUBLE, wind_speed_ms DOUBLE, wind_direction_deg DOUBLE, "
    "latitude DOUBLE, longitude DOUBLE, created_at TIMESTAMP, event_date DATE"
)
FACT_QUALITY = _schema(
    "date DATE, city_id INT, metric_id INT, completeness_ratio DOUBLE, missing_ratio DOUBLE, "
    "data_points_expected INT, data_points_actual INT, value_range_violations INT, "
    "sudden_jumps_count INT, is_monotonic BOOLEAN, created_at TIMESTAMP"
)
LAYOUTS = {
    "dim_city": DIM_CITY,
    "dim_metric": DIM_METRIC,
    "fact_observation": FACT_OBSERVATION,
    "fact_weather": FACT_WEATHER,
    "fact_data_quality_metrics": FACT_QUALITY,
}
# Facts are stored by calendar day, so a time range prunes folders.
PARTITION_COLUMN = {
    "fact_observation": "event_date",
    "fact_weather": "event_date",
    "fact_data_quality_metrics": "date",
}


# Rows of a file are ordered by series, so a row group of this size holds few series and its minima and maxima tell
# which; a Bloom filter answers for the stations, which have no order.
ROW_GROUP_BYTES = 32 << 20
BLOOM_COLUMN = {"fact_observation": "location_id"}


@dataclass(frozen=True)
class Warehouse:
    """The tables of the star schema, each as a lazy frame, and the day profiles of the facts where there are any."""

    dim_city: DataFrame
    dim_metric: DataFrame
    fact_observation: DataFrame
    fact_weather: DataFrame
    daily: DataFrame | None = None
    joint: DataFrame | None = None

    def but(self, **tables) -> Warehouse:
        """The same tables with some of them replaced."""
        return Warehouse(**{**{f.name: getattr(self, f.name) for f in fields(Warehouse) if f.name not in tables}, **tables})


def default_metrics(spark: SparkSession) -> DataFrame:
    """Seed rows of the metric dimension."""
    rows = spark.createDataFrame(
        C.METRICS,
        "metric_id INT, metric_code STRING, metric_name STRING, unit STRING",
    )
    return conform(rows, DIM_METRIC)


def default_cities(spark: SparkSession) -> DataFrame:
    """Seed rows of the city dimension, without ids."""
    rows = spark.createDataFrame(
        C.CITIES,
        "city_name STRING, country STRING, latitude DOUBLE, longitude DOUBLE, timezone STRING",
    )
    return rows.withColumn("provider_city_name", F.col("city_name"))


def conform(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Columns of ``df`` in the order and types of ``layout``; absent ones become NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in layout.fields
    ])


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One stored table; an absent folder is an error, an empty one an empty frame."""
    return spark.read.schema(LAYOUTS[name]).parquet(table_path(root, name))


def write_table(df: DataFrame, root: str, name: str, mode: str = "append", row_group_bytes: int = ROW_GROUP_BYTES) -> int:
    """Store rows by day, clustered by series inside each file; returns their number.

    A limit on series or stations then reads the row groups that can hold them.

    Mode ``replace`` overwrites just the days that the rows bring.

    The rebalance step lets adaptive execution cut a heavy day into several tasks and
    merge light days, so neither one huge file nor many tiny ones come out. The rows are
    counted by the writing tasks. The counter sits right below the writer: further down,
    adaptive execution may drop it from an empty plan.
    """
    seen = Observation()
    layout = LAYOUTS[name]
    day = PARTITION_COLUMN.get(name)
    if day == "event_date":
        df = df.withColumn("event_date", F.to_date("timestamp"))
    out = conform(df, layout)
    if day:
        order = [c for c in (day, "city_id", "metric_id", "timestamp") if c in out.columns]
        out = out.hint("rebalance", day).sortWithinPartitions(*order)
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("parquet.block.size", row_group_bytes)
    if name in BLOOM_COLUMN:
        writer = writer.option(f"parquet.bloom.filter.enabled#{BLOOM_COLUMN[name]}", "true")
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    (writer.partitionBy(day) if day else writer).parquet(table_path(root, name))
    return seen.get["rows"]


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty fact tables and the seeded metric dimension, where they do not exist yet."""
    for name, layout in LAYOUTS.items():
        if name == "dim_metric":
            default_metrics(spark).write.mode("ignore").parquet(table_path(root, name))
        else:
            spark.createDataFrame([], layout).write.mode("ignore").parquet(table_path(root, name))


def load_warehouse(spark: SparkSession, root: str) -> Warehouse:
    return Warehouse(**{
        name: read_table(spark, root, name)
        for name in ("dim_city", "dim_metric", "fact_observation", "fact_weather")
    })


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality of equally named columns, usable as an equi-join key."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def lookup(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Join on equally named key columns where NULL keys match each other.

    The key columns appear once, from the left side.
    """
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in columns})
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(renamed[f"__r_{name}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in columns])
