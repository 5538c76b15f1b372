"""What a stored fact lets a scan skip inside the files of one day."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airlattice.operators.scope import scope
from airlattice.tables import read_table, write_table

ROWS = 240_000


@pytest.fixture(scope="module")
def day(spark, tmp_path_factory):
    """One day of 40 cities, as they arrive: in no order, stations in no relation to the cities."""
    root = str(tmp_path_factory.mktemp("layout"))
    at = F.lit(datetime(2024, 3, 1)) + F.make_interval(secs=F.floor(F.col("id") / 40) % 86_400)
    rows = spark.range(ROWS).select(at.alias("timestamp"), (F.col("id") % 40).cast("int").alias("city_id"), F.lit(1).alias("metric_id"), F.rand(7).alias("value"),
                                    F.lit(1).alias("station_count"), F.concat(F.lit("station "), F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("location_id"))
    assert write_table(rows.repartition(8), root, "fact_observation", row_group_bytes=256 << 10) == ROWS
    return read_table(spark, root, "fact_observation")


def rows_from_scan(df) -> tuple[int, int]:
    """(rows that left the scan, rows of the result): whole row groups that hold no row are not read."""
    found = len(df.collect())
    node = df._jdf.queryExecution().executedPlan()
    todo = [node.executedPlan() if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else node]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            return node.metrics().apply("numOutputRows").value(), found
        todo += [node.plan()] if node.getClass().getSimpleName().endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    raise AssertionError("no scan")


def test_a_series_reads_few_row_groups(day):
    read, found = rows_from_scan(day.filter("city_id = 7").select("timestamp", "value"))
    assert found == ROWS / 40 and read <= ROWS / 8


def test_a_station_reads_the_groups_that_may_hold_it(day):
    some = day.filter("city_id = 3").select("location_id").first()[0]
    read, found = rows_from_scan(day.filter(F.col("location_id") == some).select("timestamp", "value"))
    assert 0 < found <= 20 and read <= ROWS / 2
    read, found = rows_from_scan(day.filter("location_id = 'station 5x'").select("timestamp", "value"))
    assert (read, found) == (0, 0) or read <= ROWS / 8


def test_scope_is_pushed_to_the_files(day):
    """City and time limits of a report reach the scan as well."""
    limited = scope(day.withColumnRenamed("city_id", "city_name"), cities=[7], start="2024-03-01 01:00:00", end="2024-03-01 01:10:00").select("value")
    read, found = rows_from_scan(limited)
    assert found > 0 and read <= ROWS / 8
