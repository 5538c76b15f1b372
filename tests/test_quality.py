"""Quality checks on hand-made frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.operators import quality as Q
from airlattice.plans import views as V
from airlattice.tables import FACT_WEATHER

START = datetime(2024, 1, 1)


def values(spark, *numbers):
    return spark.createDataFrame([(float(n) if n is not None else None,) for n in numbers], "pm25 DOUBLE")


def test_missing_ratios(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (None, 1.0), (4.0, 1.0), (5.0, 1.0)], "col1 DOUBLE, col2 DOUBLE")
    assert {r["column"]: r["missing_ratio"] for r in Q.missing_ratios(df).collect()} == {"col1": 0.2, "col2": 0.0}
    assert {r["missing_ratio"] for r in Q.missing_ratios(df.limit(0)).collect()} == {1.0}


def test_range_violations(spark):
    df = values(spark, 10, 20, 30, 100, 200, None)
    assert Q.range_violation_count(df, {"pm25": (0, 500)}).first()["violations"] == 0
    got = {r["column"]: r["violations"] for r in Q.range_violation_count(df, {"pm25": (0, 50), "gone": (0, 1)}).collect()}
    assert got == {"pm25": 2, "gone": 0}
    assert Q.range_violation_count(df.limit(0), {"pm25": (0, 50), "gone": (0, 1)}).filter("violations <> 0").count() == 0


@pytest.mark.parametrize("hours,expected", [([0, 1, 2, 3, 4], True), ([4, 3, 2, 1, 0], False), ([0, 1, 1, 2], True), ([0], True)])
def test_monotonicity(spark, hours, expected):
    df = spark.createDataFrame([(START + timedelta(hours=h), i) for i, h in enumerate(hours)], "timestamp TIMESTAMP, arrival BIGINT")
    assert Q.monotonicity(df, "timestamp", "arrival").first()["is_monotonic"] is expected


def test_monotonicity_across_slices(spark):
    df = spark.range(200_000).select((F.lit(START) + F.make_interval(secs=F.when(F.col("id") == 131_072, 5).otherwise(F.col("id")))).alias("ts"), "id")
    assert Q.monotonicity(df, "ts", "id").first()["is_monotonic"] is False
    assert Q.monotonicity(df.filter("id <> 131072"), "ts", "id").first()["is_monotonic"] is True


def test_freshness(spark):
    df = spark.createDataFrame([(START,), (START + timedelta(hours=5),)], "timestamp TIMESTAMP")
    assert Q.freshness(df, "timestamp", "2024-01-02 05:00:00").first()["is_fresh"] is True
    assert Q.freshness(df, "timestamp", "2024-01-02 05:00:01").first()["is_fresh"] is False
    assert Q.freshness(df.limit(0), "timestamp", "2024-01-02").first()["is_fresh"] is False


@pytest.mark.parametrize("numbers,jumps", [((10, 11, 12, 100, 14), 0), ((*([10] * 15), *([11] * 15), 500), 1), ((5, 5, 5), 0), ((5,), 0), ((), 0)])
def test_jumps(spark, numbers, jumps):
    assert Q.zscore_outliers(values(spark, *numbers), "pm25").first()["jumps"] == jumps


def test_completeness_by_group(spark):
    rows = [("a", START + timedelta(hours=h)) for h in range(30)] + [("b", START + timedelta(hours=h)) for h in (0, 1, 9)]
    got = {r["city"]: (r["actual_points"], r["expected_points"], r["completeness_ratio"]) for r in
           Q.completeness_by_group(spark.createDataFrame(rows, "city STRING, timestamp TIMESTAMP")).collect()}
    assert got == {"a": (30, 30, 1.0), "b": (3, 10, 0.3)}


def long_frame(spark, value=lambda h: 10.0 + h % 3, skip=()):
    rows = [(START + timedelta(hours=h), "x", "pm25", value(h)) for h in range(48) if h not in skip]
    return spark.createDataFrame(rows, "timestamp TIMESTAMP, city_name STRING, metric_code STRING, value_ug_m3 DOUBLE")


def test_report_without_warnings_passes_the_gate(spark):
    report = Q.quality_report(long_frame(spark), "2024-01-03")
    assert {r["status"] for r in report.collect()} == {"ok"}
    Q.quality_gate(report)


@pytest.mark.parametrize("frame,as_of,check", [
    (lambda s: long_frame(s), "2024-01-09", "freshness_hours"),
    (lambda s: long_frame(s, lambda h: -1.0 if h == 3 else 10.0 + h), "2024-01-03", "range"),
    (lambda s: long_frame(s, lambda h: 400.0 if h == 3 else 10.0), "2024-01-03", "jumps"),
    (lambda s: long_frame(s, skip=range(5, 30)), "2024-01-03", "completeness"),
    (lambda s: long_frame(s, lambda h: None if h < 20 else 1.0 + h), "2024-01-03", "missing_ratio"),
])
def test_each_warning_fails_the_gate(spark, frame, as_of, check):
    report = Q.quality_report(frame(spark), as_of)
    assert check in {r["check"] for r in report.filter("status = 'warning'").collect()}
    with pytest.raises(Q.QualityError):
        Q.quality_gate(report)


def test_empty_frame_is_an_error(spark):
    report = Q.quality_report(long_frame(spark).limit(0), "2024-01-03")
    assert report.filter("check = 'not_empty' AND status = 'warning'").count() == 1
    assert Q.report_valid(report).first()["valid"] is False


def test_report_along_arrival(spark):
    df = long_frame(spark).withColumn("arrival", F.unix_seconds("timestamp"))
    assert Q.quality_report(df, "2024-01-03", arrival="arrival").filter("check = 'monotonic' AND status = 'ok'").count() == 1
    back = df.withColumn("arrival", -F.col("arrival"))
    assert Q.quality_report(back, "2024-01-03", arrival="arrival").filter("check = 'monotonic' AND status = 'warning'").count() == 1


def test_daily_metrics(tiny):
    rows = Q.daily_quality_metrics(tiny).filter("city_id = 2 AND metric_id = 1").orderBy("date").collect()
    assert [(r["data_points_actual"], r["data_points_expected"], r["is_monotonic"]) for r in rows] == [(23, 24, True), (6, 24, True)]
    assert rows[0]["completeness_ratio"] == pytest.approx(23 / 24)


def test_keys_and_references(spark, tiny):
    assert Q.duplicate_keys(tiny.fact_observation, ["city_id", "metric_id", "timestamp"]).count() == 0
    assert Q.duplicate_keys(tiny.fact_weather.union(tiny.fact_weather), ["city_id", "timestamp"]).count() == 3
    lost = Q.orphans(tiny.fact_observation, {"city_id": tiny.dim_city.filter("city_id <> 3"), "metric_id": tiny.dim_metric})
    assert [tuple(r) for r in lost.collect()] == [("city_id", "3", 1)]
    assert Q.sparse_days(V.observations(tiny), 20).filter("city_name = 'There' AND metric_code = 'pm25'").count() == 1


def test_schema_check(tiny):
    got = {r["column"]: r for r in Q.schema_check(tiny.fact_weather, FACT_WEATHER).collect()}
    assert got["temperature_c"]["present"] and got["temperature_c"]["type_ok"] and got["latitude"]["nulls"] == 3
    assert not got["event_date"]["present"]


def test_weather_ranges(tiny):
    assert Q.range_violation_count(tiny.fact_weather, C.WEATHER_RANGES).filter("violations > 0").count() == 0
