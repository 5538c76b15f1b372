import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airlattice.session import build_session  # noqa: E402
from airlattice.tables import Warehouse, default_metrics  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    """Two cities, one of them twice under different ids, and one without any data."""
    start = datetime(2024, 3, 1)
    cities = spark.createDataFrame(
        [(1, "Here", "AA", 10.0, 20.0, "UTC"), (2, "There", "BB", 0.0, 0.0, "America/New_York"),
         (3, "Here", "AA", 10.0, 20.0, "UTC"), (4, "Empty", "CC", 1.0, 1.0, "UTC")],
        "city_id INT, city_name STRING, country STRING, latitude DOUBLE, longitude DOUBLE, timezone STRING")
    air = []
    limits = {1: (15.0, 25.0), 2: (30.0, 50.0), 3: (100.0, 200.0), 4: (120.0, 180.0)}
    for metric, (low, high) in limits.items():
        for hour, value in enumerate([low, low + 0.01, high, high + 0.01, None]):
            air.append((start + timedelta(hours=hour), 1, metric, value, value, 1, "a"))
    air += [(start + timedelta(hours=h), 2, 1, 10.0 + h, 10.0 + h, 2, "b") for h in range(30) if h != 7]
    air += [(start + timedelta(hours=2), 2, 5, 9999.0, 9999.0, 1, "b"), (start + timedelta(hours=9), 3, 1, 40.0, 40.0, 1, "c")]
    fact = spark.createDataFrame(air, "timestamp TIMESTAMP, city_id INT, metric_id INT, value DOUBLE, "
                                      "value_ug_m3 DOUBLE, station_count INT, location_id STRING")
    weather = spark.createDataFrame(
        [(start + timedelta(hours=h), 2, 1.0 * h, 50.0, 0.5, 2.0, 90.0) for h in (0, 1, 2)],
        "timestamp TIMESTAMP, city_id INT, temperature_c DOUBLE, humidity_percent DOUBLE, precipitation_mm DOUBLE, "
        "wind_speed_ms DOUBLE, wind_direction_deg DOUBLE")
    from pyspark.sql import functions as F
    none = F.lit(None).cast("double")
    fact = fact.select("*", none.alias("latitude"), none.alias("longitude"), F.lit(None).cast("string").alias("location_name"))
    weather = weather.select("*", none.alias("latitude"), none.alias("longitude"))
    return Warehouse(cities, default_metrics(spark), fact, weather)
