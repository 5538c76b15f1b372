"""Idempotent writes, dimension upserts, gaps and export."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlattice.operators import reshape as R
from airlattice.sources import gaps, sinks
from airlattice.tables import create_tables, default_cities, load_warehouse, read_table

START = datetime(2024, 5, 1)


@pytest.fixture
def store(spark, tmp_path):
    root = str(tmp_path / "store")
    create_tables(spark, root)
    assert sinks.append_cities(spark, root, default_cities(spark)) == 5
    return root


def test_tables_can_be_created_twice(spark, store):
    create_tables(spark, store)
    assert read_table(spark, store, "dim_metric").count() == 6
    assert sinks.append_cities(spark, store, default_cities(spark)) == 0
    assert sorted(r[0] for r in read_table(spark, store, "dim_city").select("city_id").collect()) == [1, 2, 3, 4, 5]


def wide(spark, hours=3):
    rows = [("Paris", START + timedelta(hours=h), 10.0 + h, None, "x" * 300) for h in range(hours)]
    rows += [("Paris", START, 99.0, 5.0, "y"), ("Atlantis", START, 1.0, 1.0, "z")]
    return spark.createDataFrame(rows, "city STRING, timestamp TIMESTAMP, pm25 DOUBLE, o3 DOUBLE, location_name STRING")


def test_observations_once(spark, store):
    assert sinks.append_observations(spark, store, wide(spark)) == 4
    assert sinks.append_observations(spark, store, wide(spark)) == 0
    assert sinks.append_observations(spark, store, wide(spark, 5)) == 2
    rows = read_table(spark, store, "fact_observation")
    assert rows.groupBy("city_id", "metric_id", "timestamp").count().filter("count > 1").count() == 0
    assert rows.agg(F.max(F.length("location_name")), F.min("station_count")).first() == (300, 1)
    assert rows.filter("event_date = DATE '2024-05-01'").count() == 6


def test_weather_keeps_nulls(spark, store):
    rows = spark.createDataFrame([("Paris", START, 1.0), ("Paris", START, None), ("Paris", START + timedelta(hours=1), None)],
                                 "city STRING, timestamp TIMESTAMP, temperature_c DOUBLE")
    assert sinks.append_weather(spark, store, rows) == 2
    assert sinks.append_weather(spark, store, rows) == 0
    assert read_table(spark, store, "fact_weather").filter("temperature_c IS NULL AND humidity_percent IS NULL").count() >= 1


def test_quality_defaults(spark, store):
    rows = spark.createDataFrame([(START.date(), 1, 1, 0.5, 0.5, 24, 12, None)], "date DATE, city_id INT, metric_id INT, "
                                 "completeness_ratio DOUBLE, missing_ratio DOUBLE, data_points_expected INT, "
                                 "data_points_actual INT, sudden_jumps_count INT")
    assert sinks.append_quality(spark, store, rows) == 1 and sinks.append_quality(spark, store, rows) == 0
    row = read_table(spark, store, "fact_data_quality_metrics").first()
    assert (row["value_range_violations"], row["sudden_jumps_count"], row["is_monotonic"]) == (0, 0, True)


def test_stored_days_prune_folders(spark, store):
    sinks.append_observations(spark, store, wide(spark))
    target = read_table(spark, store, "fact_observation")
    later = wide(spark).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 9 DAYS"))
    assert sinks.append_observations(spark, store, later) == 4
    touched = sinks.stored_days(read_table(spark, store, "fact_observation"), target.limit(1).drop("event_date"))
    assert touched.count() == 4
    scan = [p for p in touched._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]]
    assert any("subquery" in p.split("PushedFilters")[0] for p in scan)


def test_export_and_reload(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.export_csv(spark.range(3), path)
    assert sorted(r["id"] for r in spark.read.option("header", True).csv(path).collect()) == ["0", "1", "2"]


def test_gaps_take_the_floor_share(spark, tiny):
    left = gaps.inject_gaps(tiny, "There", "pm25", 50.0, "2024-03-03")
    assert left.count() == tiny.fact_observation.count() - 14
    assert sorted(map(str, left.collect())) == sorted(map(str, gaps.inject_gaps(tiny, "There", "pm25", 50.0, "2024-03-03").repartition(7).collect()))
    assert gaps.inject_gaps(tiny, "Mars", "pm25", 50.0, "2024-03-03").count() == tiny.fact_observation.count()
    assert gaps.inject_gaps(tiny, "There", "pm25", 1.0, "2024-03-03").count() == tiny.fact_observation.count()
    assert gaps.drop_hours(tiny, "There", "pm25", [0, 1], "2024-03-03").count() == tiny.fact_observation.count() - 4


def test_pivot_and_back(spark, tiny):
    long = tiny.fact_observation.filter("value_ug_m3 IS NOT NULL").select(
        F.col("city_id").cast("string").alias("city"), F.col("timestamp").alias("timestamp_hour"),
        F.element_at(F.create_map(*[F.lit(x) for kv in {1: "pm25", 2: "pm10", 3: "no2", 4: "o3", 5: "co"}.items() for x in kv]),
                     F.col("metric_id")).alias("parameter"), "value_ug_m3")
    back = R.unpivot_metrics(R.pivot_metrics(long))
    assert sorted(map(str, back.select(*long.columns).collect())) == sorted(map(str, long.collect()))


def test_hourly_mean_count_and_first(spark):
    rows = [("c", "s2", 40, 4.0, None), ("c", "s1", 10, 1.0, 7.0), ("c", "s1", 20, None, 8.0), ("c", "s1", 70, 9.0, 1.0)]
    df = spark.createDataFrame([(c, s, START + timedelta(minutes=m), v, lat, "pm25") for c, s, m, v, lat in rows],
                               "city STRING, location_id STRING, timestamp TIMESTAMP, value_ug_m3 DOUBLE, latitude DOUBLE, parameter STRING")
    got = {r["timestamp_hour"].hour: r for r in R.hourly_by_city(df).collect()}
    assert (got[0]["value_ug_m3"], got[0]["station_count"], got[0]["distinct_stations"], got[0]["latitude"], got[0]["location_id"]) == (2.5, 2, 2, 7.0, "s1")
    assert got[1]["value_ug_m3"] == 9.0
    newest = R.latest_per_series(df, ["city", "location_id"]).filter("location_id = 's1'").first()
    assert newest["value_ug_m3"] == 9.0


def test_warehouse_round_trip(spark, store):
    sinks.append_observations(spark, store, wide(spark))
    assert load_warehouse(spark, store).fact_observation.count() == 4
