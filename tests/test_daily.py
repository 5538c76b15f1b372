"""Stored day profiles: refreshed by day, and enough for reports over any range."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlattice.operators import quality as Q
from airlattice.operators.stats import correlation_matrix, linear_trends
from airlattice.plans import daily, reports, views
from airlattice.sources import sinks
from airlattice.tables import create_tables, write_table

XS = ["temperature_c", "wind_speed_ms"]


def rounded(df):
    order = sorted(df.columns)
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in order)]) for r in df.collect())


def emptied(t):
    return t.but(fact_observation=t.fact_observation.filter("false"), fact_weather=t.fact_weather.filter("false"))


@pytest.fixture(scope="module")
def both(tiny):
    """The small warehouse, with a metric that one day repeats as a constant and a row at no time."""
    t = daily.with_profiles(tiny)
    return tiny, t


def test_reports_from_profiles_equal_those_from_facts(both):
    facts, t = both
    for make in (views.v_data_completeness, views.v_days_with_exceedances,
                 lambda w: reports.completeness_range(w, "2024-03-01", "2024-03-02"),
                 lambda w: reports.weather_correlations(w), lambda w: reports.weather_correlations(w, start="2024-03-01", end="2024-03-01")):
        assert rounded(make(emptied(t))) == rounded(make(facts))
    only_air = t.but(fact_observation=t.fact_observation.filter("false"))
    for make in (views.v_daily_aggregates, lambda w: reports.period_statistics(w, start="2024-03-01", end="2024-03-02", cities=["Here", "There"])):
        assert rounded(make(only_air)) == rounded(make(facts))
    named = views.v_observations_weather(facts).filter("metric_code IS NOT NULL")
    assert rounded(daily.trends(t, XS)) == rounded(linear_trends(named, XS))


def test_limits_inside_a_day_go_to_the_facts(both):
    facts, t = both
    limits = {"start": "2024-03-01 02:00:00", "end": "2024-03-01 05:00:00"}
    assert reports.within(t, **limits).daily is None
    assert rounded(reports.weather_correlations(t, **limits)) == rounded(reports.weather_correlations(facts, **limits))


def test_moments_and_constant_columns(both):
    facts, t = both
    by = ["city_id", "metric_id"]
    got = {tuple(r)[:2]: r["_std"] for r in daily.moments(t, by).collect()}
    for r in facts.fact_observation.groupBy(*by).agg(F.stddev_samp("value_ug_m3").alias("s")).collect():
        have = got[(r["city_id"], r["metric_id"])]
        assert (have is None) == (r["s"] is None) and (have is None or have == pytest.approx(r["s"]))
    assert rounded(Q.zscore_outliers(facts.fact_observation, "value_ug_m3", 1.5, by, daily.moments(t, by))) == rounded(
        Q.zscore_outliers(facts.fact_observation, "value_ug_m3", 1.5, by))
    flat = facts.but(fact_weather=facts.fact_weather.withColumn("humidity_percent", F.lit(0.1)))
    named = views.v_observations_weather(flat).filter("metric_code IS NOT NULL")
    assert rounded(daily.correlations(daily.with_profiles(flat))) == rounded(correlation_matrix(named))


def test_sketches_stay_within_their_error(spark, tiny):
    places = spark.range(60_000).select(
        (F.lit(datetime(2024, 3, 1)) + F.make_interval(hours=(F.col("id") % 240).cast("int"))).alias("timestamp"), F.lit(1).alias("city_id"), F.lit(1).alias("metric_id"),
        F.lit(1.0).alias("value"), F.lit(1.0).alias("value_ug_m3"), F.lit(1).alias("station_count"), (F.col("id") % 20_000).cast("string").alias("location_id"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"), F.lit(None).cast("string").alias("location_name"))
    t = daily.with_profiles(tiny.but(fact_observation=places))
    got = reports.station_metadata(emptied(t), approximate=True).first()
    assert got["total_records"] == 60_000 and abs(got["unique_locations"] - 20_000) < 0.05 * 20_000


def test_hours_are_distinct(spark):
    at = datetime(2024, 3, 1)
    rows = [("a", "m", at + timedelta(minutes=m)) for m in (0, 10, 59, 60, 23 * 60 + 59)] + [("a", "m", None), ("b", "m", at)]
    df = spark.createDataFrame(rows, "city_name STRING, metric_code STRING, timestamp TIMESTAMP")
    assert {(r["city_name"], str(r["date"]), r["actual_hours"]) for r in Q.day_hours(df).collect()} == {
        ("a", "2024-03-01", 3), ("a", "None", 0), ("b", "2024-03-01", 1)}
    plan = Q.day_hours(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_daily_quality_reads_the_facts_once(spark, tiny, tmp_path):
    """With an order of loads as well: one scan, its exchange is reused; null keys and a heavy day included."""
    rows = tiny.fact_observation.withColumn("created_at", F.col("timestamp"))
    rows.write.parquet(f"{tmp_path}/facts")
    t = tiny.but(fact_observation=spark.read.parquet(f"{tmp_path}/facts"))
    for loaded in (None, "created_at"):
        frame = Q.daily_quality_metrics(t, loaded=loaded)
        frame.collect()
        final = frame._jdf.queryExecution().executedPlan().executedPlan().toString()
        assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final


def test_only_touched_days_are_replaced(spark, tiny, tmp_path):
    root = str(tmp_path)
    create_tables(spark, root)
    sinks.append_cities(spark, root, tiny.dim_city)
    first = tiny.fact_observation.filter("metric_id < 5")
    write_table(first, root, "fact_observation")
    write_table(tiny.fact_weather, root, "fact_weather")
    daily.refresh_profiles(spark, root, first, tiny.fact_weather)
    of_first = lambda df: {f for f in df.inputFiles() if "date=2024-03-01" in f}
    files = of_first(daily.load_profiled(spark, root).daily)
    more = first.filter("city_id = 2").limit(3).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAYS"))
    more = more.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 10 MINUTES"))
    write_table(more, root, "fact_observation")
    daily.refresh_profiles(spark, root, more)
    t = daily.load_profiled(spark, root)
    assert files and of_first(t.daily) == files
    assert rounded(views.v_data_completeness(emptied(t))) == rounded(views.v_data_completeness(t.but(daily=None)))
    assert rounded(reports.weather_correlations(emptied(t))) == rounded(reports.weather_correlations(t.but(joint=None)))


def test_views_that_look_back_read_only_the_days_they_need(spark, tiny, tmp_path):
    """A dense series, one with a long gap just before the range, one that ended long before, and rows without a time."""
    root, start = str(tmp_path), datetime(2024, 3, 1)
    create_tables(spark, root)
    rows = [(start + timedelta(hours=h), 1, 1, float(h)) for h in range(24 * 20)]
    rows += [(start + timedelta(days=d), 2, 1, float(d)) for d in (0, 1, 2, 3, 5, 7, 9, 18, 19)] + [(start, 1, 2, 5.0), (None, 1, 1, 1.0)]
    fact = spark.createDataFrame(rows, "timestamp TIMESTAMP, city_id INT, metric_id INT, value_ug_m3 DOUBLE").selectExpr(
        "*", "value_ug_m3 AS value", "1 AS station_count", "'a' AS location_id")
    tiny.dim_city.write.mode("append").parquet(f"{root}/dim_city")
    write_table(fact, root, "fact_observation")
    daily.refresh_profiles(spark, root, fact)
    t = daily.load_profiled(spark, root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    for view, first_day, limits in (("v_moving_averages", "2024-03-02", {"start": "2024-03-18", "end": "2024-03-19"}),
                                    ("v_lags", "2024-03-06", {"start": "2024-03-18", "end": "2024-03-19 05:00:00"}),
                                    ("v_lags", "2024-03-17", {"start": "2024-03-18", "cities": ["Here"]}),
                                    ("v_lags", None, {"end": "2024-03-02"}), ("v_lags", "2024-05-01", {"start": "2024-05-01"})):
        got, want = reports.browse(t, view, **limits), reports.browse(t.but(daily=None), view, **limits)
        assert rounded(got) == rounded(want)
        scans = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "fact_observation" in x]
        assert scans and all("PartitionFilters: []" not in x and "event_date" in x for x in scans)
        read = reports.reaching_back(t, reports.LOOKS_BACK[view], **limits).fact_observation
        assert first_day is None or str(read.agg(F.min("event_date")).first()[0]) in (first_day, "None")
