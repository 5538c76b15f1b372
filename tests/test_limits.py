"""No cut, no size switch: what an argument asks for is what comes out; time limits reach the folders."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlattice.operators import joins
from airlattice.operators import windows as W
from airlattice.operators.scope import last
from airlattice.plans import forecast, reports, views
from airlattice.plans.load_run import load_cities, refresh_quality, run_load
from airlattice.sources import gaps, sinks
from airlattice.tables import default_cities, load_warehouse, read_table

START = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("limits") / "store")
    load_cities(spark, root, default_cities(spark))
    rows = [("pArIs", "pm25", START + timedelta(hours=h), float(h % 50)) for h in range(24 * 60)]
    batch = spark.createDataFrame(rows, "city STRING, parameter STRING, timestamp TIMESTAMP, value_ug_m3 DOUBLE")
    assert sinks.append_observations(spark, root, batch.withColumn("location_id", F.repeat(F.lit("x"), 60))) == len(rows)
    return root


def test_long_names_stay_whole(spark, store):
    assert read_table(spark, store, "fact_observation").select(F.length("location_id")).distinct().collect() == [(60,)]


def test_rows_off_the_hour_stay_on_the_grid(spark):
    times = [START, START + timedelta(minutes=90), START + timedelta(hours=4)]
    df = spark.createDataFrame([("a", t, 1.0) for t in times], "k STRING, timestamp TIMESTAMP, v DOUBLE")
    got = W.fill_hours(df, ["k"]).orderBy("timestamp").collect()
    assert [(r["timestamp"], r["v"]) for r in got] == [
        (times[0], 1.0), (times[1], 1.0), (START + timedelta(hours=2), None), (START + timedelta(hours=3), None), (times[2], 1.0)]


def test_windows_of_any_length(spark):
    df = spark.createDataFrame([("a", START + timedelta(days=d), float(d)) for d in range(250)], "k STRING, timestamp TIMESTAMP, v DOUBLE")
    means = {r["timestamp"]: r["mean"] for r in W.trailing_days_mean(df, "v", 100, ["k"]).collect()}
    assert means[START + timedelta(days=249)] == sum(range(150, 250)) / 100
    lagged = W.lag_features(df, "v", [200], ["k"], block_rows=16)
    assert {r["v"] - r["v_lag_200h"] for r in lagged.filter("v_lag_200h IS NOT NULL").collect()} == {200.0}


def test_median_beside_an_outlier(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") < 2, 1e15).otherwise(F.col("id")).cast("double").alias("v"))
    got = {r["g"]: r["median"] for r in W.exact_medians(df, ["v"], ["g"]).collect()}
    values = {g: sorted(1e15 if k < 2 else float(k) for k in range(g, 20_000, 2)) for g in (0, 1)}
    assert got == {g: (v[4999] + v[5000]) / 2 for g, v in values.items()}


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_limits_reach_the_folders(spark, store):
    t, day = load_warehouse(spark, store), "2024-04-20"
    frames = [forecast.training_frame(t, days=5, as_of=day), last(t.fact_observation, "7 days", day),
              joins.records_by_city(t.dim_city, t.fact_observation, t.fact_weather, day), reports.trends(t, start="2024-04-01", end="2024-04-02")]
    profile = spark.createDataFrame([("Paris", "pm25", 10.0)], "city_name STRING, metric_code STRING, pct DOUBLE")
    frames.append(gaps.rows_to_drop(t, profile, day))
    for df in frames:
        # The weather table holds no rows here, so no folders.
        facts = [x for x in plan(df).splitlines() if "FileScan" in x and "event_date" in x and "fact_observation" in x]
        assert facts and not any("PartitionFilters: []" in x for x in facts), df
    status = {r["check"]: r for r in reports.table_status(t, "2024-04-30").collect()}
    assert status["observation_last_7_days"]["number"] == 24 * 7 and status["observation_latest"]["latest"] == START + timedelta(hours=24 * 60 - 1)
    assert reports.browse(t, "v_observations").count() == 24 * 60 == views.v_observations(t).count()


def test_quality_rows_follow_the_data(spark, tmp_path):
    root = str(tmp_path / "store")
    load_cities(spark, root, default_cities(spark))

    def batch(hours):
        return spark.createDataFrame([("London", "pm25", START + timedelta(hours=h), 1.0) for h in hours],
                                     "city STRING, parameter STRING, timestamp TIMESTAMP, value_ug_m3 DOUBLE")
    for hours, order in ((range(3, 4), True), (range(4, 20), True), (range(0, 2), False)):
        sinks.append_observations(spark, root, batch(hours))
        refresh_quality(spark, root, batch(hours))
        row = read_table(spark, root, "fact_data_quality_metrics").collect()
        assert len(row) == 1 and row[0]["is_monotonic"] is order
    assert row[0]["data_points_actual"] == 19


def test_names_in_any_case_and_lost_records(spark, tmp_path):
    line = '{"location": {"id": 1}, "parameter": "co", "value": 2, "unit": "ug/m3", "date": {"utc": "2024-03-01T01:00:00Z"}}'
    for city, text in (("paris", line), ("atlantis", line), ("London", "{broken")):
        (tmp_path / "obs" / f"city={city}").mkdir(parents=True)
        (tmp_path / "obs" / f"city={city}" / "a.json").write_text(text)
    (tmp_path / "sky" / "city=atlantis").mkdir(parents=True)
    (tmp_path / "sky" / "city=atlantis" / "w.json").write_text('{"hourly": {"time": ["2024-03-01T01:00"], "temperature_2m": [1.0]}}')
    twice = default_cities(spark).unionByName(default_cities(spark).filter("city_name = 'Paris'").withColumn("city_name", F.upper("city_name")))
    done = run_load(spark, str(tmp_path / "store"), str(tmp_path / "obs"), str(tmp_path / "sky"), twice, "2024-03-02")
    assert done["written"]["fact_observation"] == 1
    assert {r["problem"]: r["records"] for r in done["rejected"].collect()} == {
        "unknown city": 1, "unreadable record": 1, "weather of an unknown city": 1}
