"""Views and reports on a hand-made instance."""

import pytest
from pyspark.sql import functions as F

from airlattice.operators import joins, stats
from airlattice.operators import scope as S
from airlattice.plans import reports as R
from airlattice.plans import views as V


def test_all_views_register(spark, tiny):
    assert len(V.register_views(spark, tiny)) == 9
    assert V.register_views(spark, tiny) == list(V.VIEWS)
    assert spark.sql("SELECT count(*) FROM v_observations").first()[0] == tiny.fact_observation.count()


def test_limits_are_strict(tiny):
    rows = V.v_risk_map(tiny).filter("city_name = 'Here' AND hour < 5").collect()
    by_hour = {}
    for r in rows:
        by_hour.setdefault(r["hour"], set()).add(r["risk_level"])
    assert by_hour == {0: {"LOW"}, 1: {"MODERATE"}, 2: {"MODERATE"}, 3: {"HIGH"}, 4: {"LOW"}}


def test_metrics_without_limit_are_low(tiny):
    assert [r["risk_level"] for r in V.v_risk_map(tiny).filter("metric_code = 'co'").collect()] == ["LOW"]


def test_exceedances_merge_equal_names(tiny):
    row = V.v_days_with_exceedances(tiny).filter("city_name = 'Here' AND metric_code = 'pm25'").first()
    assert row["exceedance_hours"] == 2 and row["has_exceedance"] and row["max_value"] == 40.0


def test_completeness_of_a_day(tiny):
    row = V.v_data_completeness(tiny).filter("city_name = 'There' AND metric_code = 'pm25' AND date = '2024-03-01'").first()
    assert (row["actual_data_points"], float(row["completeness_percent"]), float(row["missing_percent"])) == (23, 95.83, 4.17)


def test_full_outer_keeps_both_sides(tiny):
    both = V.v_observations_weather(tiny)
    assert both.count() == tiny.fact_observation.count()
    alone = V.v_observations_weather(type(tiny)(tiny.dim_city, tiny.dim_metric, tiny.fact_observation.limit(0), tiny.fact_weather))
    assert alone.filter("metric_code IS NULL").count() == 3


def test_daily_modes(tiny):
    pick = "city_name = 'There' AND metric_code = 'pm25' AND date = '2024-03-01'"
    wide, once = [V.v_daily_aggregates(tiny, weather=m).filter(pick).first() for m in ("fanout", "daily")]
    assert (wide["data_points"], once["data_points"]) == (69, 23)
    assert wide["total_precipitation"] == pytest.approx(23 * 1.5) and once["total_precipitation"] == 1.5
    assert wide["avg_value"] == pytest.approx(once["avg_value"]) and wide["avg_temperature"] == 1.0
    dry = V.v_daily_aggregates(tiny).filter("city_name = 'Here' AND metric_code = 'o3'").first()
    assert dry["data_points"] == 5 and dry["total_precipitation"] is None and dry["avg_temperature"] is None
    with pytest.raises(ValueError):
        V.v_daily_aggregates(tiny, weather="other")


def test_lags_skip_gaps_unless_on_grid(tiny):
    pick = "city_name = 'There' AND metric_code = 'pm25' AND hour(timestamp) = 8 AND to_date(timestamp) = '2024-03-01'"
    assert V.v_lags(tiny).filter(pick).first()["value_lag_1h"] == 16.0
    gridded = V.v_lags(tiny, grid=True).filter(pick).first()
    assert gridded["value_lag_1h"] is None and gridded["value_lag_2h"] == 16.0


def test_browse_is_newest_first(tiny):
    rows = R.browse(tiny, "v_observations", n=3, cities=["There"]).collect()
    assert [r["timestamp"].hour for r in rows] == [5, 4, 3]


def test_scope_end_day(tiny):
    named = V.v_observations(tiny)
    assert S.scope(named, ["There"], ["pm25"], end="2024-03-01").count() == 23
    assert S.scope(named, ["There"], ["pm25"], end="2024-03-01", inclusive_midnight=True).count() == 1
    assert S.scope(named, ["There"], ["pm25"], start="2024-03-02 03:00:00").count() == 3


def test_scope_prunes_stored_days(spark, tiny, tmp_path):
    from airlattice.tables import read_table, write_table
    assert write_table(tiny.fact_observation, str(tmp_path), "fact_observation") == tiny.fact_observation.count()
    stored = read_table(spark, str(tmp_path), "fact_observation")
    plan = S.scope(stored, start="2024-03-02", end="2024-03-02")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_records_by_city(tiny):
    counts = {r["city_name"]: (r["aq_count"], r["weather_count"]) for r in joins.records_by_city(
        tiny.dim_city.filter("city_id IN (2, 4)"), tiny.fact_observation, tiny.fact_weather, "2024-03-03").collect()}
    assert counts == {"There": (90, 90), "Empty": (0, 0)}


def test_include_empty_lists_every_series(tiny):
    rows = R.completeness_range(tiny, "2024-03-01", "2024-03-02", include_empty=True)
    assert rows.count() == 3 * 6
    there = rows.filter("city_name = 'There' AND metric_code = 'pm25'").first()
    assert (there["total_points"], there["total_expected"], float(there["avg_completeness"])) == (29, 48, 60.42)
    assert float(rows.filter("city_name = 'Empty'").first()["avg_missing"]) == 100.0


def test_correlation_without_variance_is_null(spark):
    df = spark.createDataFrame([("m", 1.0, 5.0, 2.0), ("m", 2.0, 5.0, 4.1), ("m", 3.0, 5.0, None)], "g STRING, a DOUBLE, b DOUBLE, c DOUBLE")
    r = {(x["x"], x["y"]): x["r"] for x in stats.correlation_matrix(df, ["a", "b", "c"], ["g"]).collect()}
    assert r[("a", "b")] is None and r[("b", "b")] is None
    assert r[("a", "c")] == pytest.approx(1.0) and r[("c", "a")] == r[("a", "c")]


def test_trend_line_points(spark):
    df = spark.createDataFrame([("m", float(i), 2.0 * i + 1) for i in range(5)] + [("one", 1.0, 1.0)], "g STRING, x DOUBLE, y DOUBLE")
    fit = stats.linear_trend(df, "x", "y", ["g"])
    assert [r["g"] for r in fit.collect()] == ["m"]
    line = sorted(stats.trend_line(fit, 5).select("x", F.round("y", 9).alias("y")).collect())
    assert [tuple(r) for r in line] == [(0.0, 1.0), (1.0, 3.0), (2.0, 5.0), (3.0, 7.0), (4.0, 9.0)]


def test_city_lists(spark, tiny):
    from airlattice.tables import default_cities
    assert [r[0] for r in S.list_active_cities(tiny.dim_city, ["There", "Here", "Mars"]).collect()] == ["Here", "There"]
    assert [r["metric_code"] for r in S.list_metrics(tiny.dim_metric).collect()] == ["no2", "o3", "pm10", "pm25"]
    assert default_cities(spark).count() == 5
    assert S.select_cities(default_cities(spark), ["new york", "nowhere"]).first()["city_name"] == "New York"
