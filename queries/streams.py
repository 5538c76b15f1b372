"""Streaming queries. Payload files are first written from the event log, then streamed back."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.plans.load_run import load_cities, run_load
from airlattice.session import use_checkpoint_dir
from airlattice.sources import eventlog
from airlattice.streaming import ingest as ST
from airlattice.tables import read_table
from queries.base import query


def scratch(spark) -> str:
    return f"{use_checkpoint_dir(spark)}/stream-{uuid4().hex}"


def land(spark, folder, root, copies: int = 1, sentinel: bool = False) -> str:
    """Observation records of the log as text files, one folder per city.

    ``sentinel`` adds one record three days after the last: it lets every hour before it finish.
    """
    obs = eventlog.station_observations(spark, folder)
    cities = eventlog.user_cities(spark, folder).join(
        eventlog.dim_city(spark, folder).select("city_id", F.col("city_name").alias("city")), "city_id")
    rows = obs.join(cities, "location_id")
    if sentinel:
        late = (F.max("timestamp") + F.expr("INTERVAL 3 DAYS")).alias("timestamp")
        rows = rows.unionByName(rows.groupBy().agg(late, F.min("city").alias("city"), F.lit("pm25").alias("parameter")),
                                allowMissingColumns=True)
    line = F.to_json(F.struct(
        F.struct(F.col("location_id").alias("id"), F.col("location_name").alias("name")).alias("location"),
        "parameter", F.col("value_ug_m3").cast("double").alias("value"), F.lit("µg/m³").alias("unit"),
        F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("utc")).alias("date")))
    lines = rows.select("city", line.alias("value"))
    repeated = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    path = f"{root}/observations"
    repeated.write.partitionBy("city").text(path)
    return path


def stored_cities(spark, folder):
    return eventlog.dim_city(spark, folder)


@query("ST1_ST2_ingest_without_repeats", """
SELECT CAST(user_id AS VARCHAR) AS location_id, r_name AS city, ts AS timestamp, value AS value_ug_m3,
       CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10' WHEN 'purchase' THEN 'no2' ELSE 'o3' END AS parameter
FROM station_events JOIN region ON r_regionkey = city_id WHERE event_type <> 'signup'""")
def ingest(spark, folder):
    root = scratch(spark)
    path = land(spark, folder, root, copies=2)
    rows = ST.ingest_stream(spark, path, stored_cities(spark, folder)).select(
        "location_id", "city", "timestamp", "value_ug_m3", "parameter")
    ST.stream_to_files(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


FINISHED = """
WITH hours AS (
  SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, r_name AS city, metric_id,
         AVG(value) AS value_ug_m3, CAST(COUNT(*) AS INT) AS station_count
  FROM station_events JOIN region ON r_regionkey = city_id WHERE event_type <> 'signup' GROUP BY 1, 2, 3)
SELECT timestamp, city, metric_id, ROUND(value_ug_m3, 9) AS value_ug_m3, station_count FROM hours"""


@query("ST3_hourly_stream", FINISHED)
def hourly(spark, folder):
    root = scratch(spark)
    path = land(spark, folder, root, sentinel=True)
    rows = ST.hourly_stream(ST.ingest_stream(spark, path, stored_cities(spark, folder)))
    ST.stream_to_files(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    ids = eventlog.default_metrics(spark).select("metric_id", F.col("metric_code").alias("parameter"))
    return spark.read.parquet(f"{root}/out").join(F.broadcast(ids), "parameter").select(
        "timestamp", "city", "metric_id", "value_ug_m3", "station_count")


@query("ST4_stream_to_warehouse_twice", FINISHED)
def to_warehouse(spark, folder):
    root = scratch(spark)
    path = land(spark, folder, root, sentinel=True)
    store = f"{root}/store"
    load_cities(spark, store, eventlog.dim_city(spark, folder).drop("city_id"))
    for attempt in ("first", "second"):
        rows = ST.hourly_stream(ST.ingest_stream(spark, path, read_table(spark, store, "dim_city")))
        ST.stream_to_warehouse(rows, store, f"{root}/{attempt}").awaitTermination()
    names = read_table(spark, store, "dim_city").select("city_id", F.col("city_name").alias("city"))
    return read_table(spark, store, "fact_observation").join(names, "city_id").select(
        "timestamp", "city", "metric_id", "value_ug_m3", "station_count")


@query("ST4_quality_after_two_batches", """
SELECT timestamp::DATE AS date, city_id, metric_id, CAST(COUNT(DISTINCT timestamp) AS INT) AS data_points_actual
FROM fact_observation GROUP BY 1, 2, 3""")
def quality_after_two_batches(spark, folder):
    """Each day arrives in two halves; its quality rows have to count both."""
    root = scratch(spark)
    t = eventlog.event_warehouse(spark, folder)
    names = t.dim_city.select("city_id", F.col("city_name").alias("city"))
    codes = t.dim_metric.select("metric_id", F.col("metric_code").alias("parameter"))
    rows = t.fact_observation.join(names, "city_id").join(codes, "metric_id").drop("metric_id", "city_id")
    load_cities(spark, root, t.dim_city.drop("city_id"))
    for half in ("hour(timestamp) < 12", "hour(timestamp) >= 12"):
        ST.load_batch(spark, root, rows.filter(half))
    stored_names = read_table(spark, root, "dim_city").select(F.col("city_id").alias("stored_id"), F.col("city_name").alias("city"))
    return (read_table(spark, root, "fact_data_quality_metrics").withColumnRenamed("city_id", "stored_id")
            .join(stored_names, "stored_id").join(names, "city").select("date", "city_id", "metric_id", "data_points_actual"))


# Rows from the tenth day on arrive first; those of the first five days come a batch later, far beyond the lateness.
OF_CITIES = "FROM station_events JOIN region ON r_regionkey = city_id WHERE event_type <> 'signup'"
BROKEN, EARLY, LATER = "r_name = 'EUROPE' AND user_id % 10 = 0", "ts < TIMESTAMP '2024-01-06'", "ts >= TIMESTAMP '2024-01-11'"


@query("ST1_ST2_losses_counted", f"""
SELECT 'records' AS problem, COUNT(*) FILTER ({LATER}) * 2 + COUNT(*) FILTER ({EARLY}) AS records {OF_CITIES}
UNION ALL SELECT 'unreadable record', COUNT(*) FILTER ({LATER}) * 2 + COUNT(*) FILTER ({EARLY}) {OF_CITIES} AND {BROKEN}
UNION ALL SELECT 'no time', 0 UNION ALL SELECT 'unreadable time', 0 UNION ALL SELECT 'unreadable value', 0
UNION ALL SELECT 'unknown city', COUNT(*) FILTER ({LATER}) * 2 + COUNT(*) FILTER ({EARLY}) {OF_CITIES} AND r_name = 'ASIA'
UNION ALL SELECT 'late', COUNT(*) FILTER ({EARLY}) {OF_CITIES} AND r_name <> 'ASIA' AND NOT ({BROKEN})
UNION ALL SELECT 'repeats', COUNT(*) FILTER ({LATER}) {OF_CITIES} AND r_name <> 'ASIA' AND NOT ({BROKEN})""")
def losses_counted(spark, folder):
    """Every record twice, one city unknown, some lines broken, then days that are too late."""
    root = scratch(spark)
    path = land(spark, folder, root)
    known = stored_cities(spark, folder).filter("city_name <> 'ASIA'")
    lines = spark.read.text(path)
    broken = (F.col("city") == "EUROPE") & (F.get_json_object("value", "$.location.id") % 10 == 0)
    day = F.get_json_object("value", "$.date.utc")
    mixed = lines.select("city", day.alias("day"), F.when(broken, F.concat(F.lit("{"), "value")).otherwise(F.col("value")).alias("value"))
    for copies, part in ((2, F.col("day") >= "2024-01-11"), (1, F.col("day") < "2024-01-06")):
        some = mixed.filter(part).drop("day").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
        some.write.mode("append").partitionBy("city").text(f"{root}/mixed")
        counter = ST.LossCounter(spark, root)
        spark.streams.addListener(counter)
        rows = ST.ingest_stream(spark, f"{root}/mixed", known)
        ST.stream_to_files(rows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        counter.finish()
    return ST.losses(spark, root)


@query("A20_load_with_losses", """
SELECT 'unknown city' AS problem, COUNT(*) AS records FROM station_events JOIN region ON r_regionkey = city_id
WHERE event_type <> 'signup' AND r_name = 'ASIA'
UNION ALL SELECT 'unreadable record', COUNT(*) FROM station_events JOIN region ON r_regionkey = city_id
WHERE event_type <> 'signup' AND r_name = 'EUROPE' AND user_id % 10 = 0
UNION ALL SELECT 'loaded hours', COUNT(*) FROM (
  SELECT DISTINCT date_trunc('hour', ts), city_id, metric_id FROM station_events JOIN region ON r_regionkey = city_id
  WHERE event_type <> 'signup' AND r_name <> 'ASIA' AND NOT (r_name = 'EUROPE' AND user_id % 10 = 0))""")
def load_with_losses(spark, folder):
    """Folders in lower case, one city that is not stored, and every tenth station of another with broken lines."""
    root = scratch(spark)
    path = land(spark, folder, root)
    broken = (F.col("city") == "EUROPE") & (F.get_json_object("value", "$.location.id") % 10 == 0)
    (spark.read.text(path).withColumn("value", F.when(broken, F.concat(F.lit("{"), "value")).otherwise(F.col("value")))
     .withColumn("city", F.lower("city")).write.partitionBy("city").text(f"{root}/mixed"))
    spark.createDataFrame([], "value string").write.text(f"{root}/weather/city=africa")
    cities = eventlog.dim_city(spark, folder).drop("city_id").filter("city_name <> 'ASIA'")
    done = run_load(spark, f"{root}/store", f"{root}/mixed", f"{root}/weather", cities, "2024-01-31")
    loaded = read_table(spark, f"{root}/store", "fact_observation").agg(F.count("*").alias("records"))
    return done["rejected"].unionByName(loaded.select(F.lit("loaded hours").alias("problem"), "records"))


@query("A20_load_run", """
SELECT 'fact_observation' AS stored, (SELECT COUNT(*) FROM fact_observation) AS rows
UNION ALL SELECT 'fact_weather', COUNT(*) FROM fact_weather
UNION ALL SELECT 'fact_data_quality_metrics', COUNT(*) FROM (SELECT DISTINCT timestamp::DATE, city_id, metric_id FROM fact_observation)""")
def load_run(spark, folder):
    root = scratch(spark)
    path = land(spark, folder, root)
    sky = (eventlog.fact_weather(spark, folder)
           .join(eventlog.dim_city(spark, folder).select("city_id", F.col("city_name").alias("city")), "city_id"))
    hour = F.array(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm"))
    line = F.to_json(F.struct(F.struct(hour.alias("time"), *[
        F.array(name).alias(field) for field, name in C.WEATHER_MAPPING.items()]).alias("hourly")))
    sky.select("city", line.alias("value")).write.partitionBy("city").text(f"{root}/weather")
    cities = eventlog.dim_city(spark, folder).drop("city_id")

    for _ in range(2):  # the second run has nothing to add
        written = run_load(spark, f"{root}/store", path, f"{root}/weather", cities, "2024-01-31")["written"]
    counts = [read_table(spark, f"{root}/store", name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("stored"), "rows")
              for name in written]
    return reduce(DataFrame.unionByName, counts)
