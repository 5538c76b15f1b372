"""Report queries, correlations and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.operators import stats
from airlattice.operators.scope import list_metrics
from airlattice.plans import reports, views
from queries.base import AS_OF, SKY, nine, on_warehouse

WHERE = {"cities": ["AFRICA", "ASIA", "EUROPE"], "metrics": ["pm25", "pm10"], "start": "2024-01-08", "end": "2024-01-21"}
NAMES = "city_name IN ('AFRICA','ASIA','EUROPE') AND metric_code IN ('pm25','pm10')"
IN_TIME = f"{NAMES} AND timestamp >= TIMESTAMP '2024-01-08' AND timestamp < TIMESTAMP '2024-01-22'"
IN_DAYS = f"{NAMES} AND date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"

on_warehouse("T1_trends", f"""
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3 FROM air WHERE {IN_TIME}""")(
    lambda t: reports.trends(t, **WHERE))

on_warehouse("T2_browse_observations", f"""
SELECT timestamp, city_name, country, metric_code, metric_name, unit, station_count,
       {nine('value', 'value_ug_m3', 'latitude', 'longitude')}
FROM air WHERE {IN_TIME} ORDER BY timestamp DESC, city_name, metric_code LIMIT 1000""")(
    lambda t: reports.browse(t, "v_observations", n=1000, **WHERE))

on_warehouse("T2_browse_weather", f"""
SELECT timestamp, city_name, country, {nine(*SKY, 'latitude', 'longitude')}
FROM sky""")(lambda t: reports.browse(t, "v_weather"))

on_warehouse("T3_browse_risk_map", f"""
SELECT date, hour, city_name, metric_code, risk_level,
       {nine('value_ug_m3', 'temperature_c', 'wind_speed_ms', 'precipitation_mm')}
FROM risk WHERE {IN_DAYS}""")(
    lambda t: reports.browse(t, "v_risk_map", **WHERE))

on_warehouse("T2_browse_completeness", """
SELECT city_name, metric_code, date, n AS actual_data_points, 24 AS expected_data_points_per_day,
       CAST(ROUND(CAST(n * 100 AS DECIMAL(18,6)) / 24, 2) AS DOUBLE) AS completeness_percent,
       CAST(100.0 - ROUND(CAST(n * 100 AS DECIMAL(18,6)) / 24, 2) AS DOUBLE) AS missing_percent
FROM (SELECT city_name, metric_code, timestamp::DATE AS date, COUNT(*) AS n FROM air GROUP BY 1, 2, 3)
""")(lambda t: reports.browse(t, "v_data_completeness"))

on_warehouse("T2_browse_moving_averages", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3,
       ROUND(AVG(value_ug_m3) OVER (PARTITION BY city_name, metric_code ORDER BY timestamp
                                    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS moving_avg_7d
FROM air""")(lambda t: reports.browse(t, "v_moving_averages"))

on_warehouse("T2_browse_lags", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3, station_count,
       ROUND(LAG(value_ug_m3, 1) OVER s, 9) AS value_lag_1h, ROUND(LAG(value_ug_m3, 2) OVER s, 9) AS value_lag_2h,
       ROUND(LAG(value_ug_m3, 3) OVER s, 9) AS value_lag_3h
FROM air WINDOW s AS (PARTITION BY city_name, metric_code ORDER BY timestamp)""")(lambda t: reports.browse(t, "v_lags"))

on_warehouse("T2_browse_exceedances", f"""
SELECT date, city_name, metric_code, exceedance_hours, {nine('max_value', 'avg_value')}, exceedance_hours > 0 AS has_exceedance
FROM exceeding""")(lambda t: reports.browse(t, "v_days_with_exceedances"))

on_warehouse("T2_browse_observations_weather", f"""
SELECT COALESCE(a.timestamp, w.timestamp) AS timestamp, COALESCE(a.city_name, w.city_name) AS city_name,
       COALESCE(a.country, w.country) AS country, metric_code, metric_name, {nine('value_ug_m3', *SKY)}
FROM air a FULL JOIN sky w ON a.timestamp = w.timestamp AND a.city_name = w.city_name""")(
    lambda t: reports.browse(t, "v_observations_weather"))

on_warehouse("T2_browse_daily_aggregates", f"""
SELECT a.timestamp::DATE AS date, a.city_name, a.country, a.metric_code, COUNT(*) AS data_points,
       ROUND(AVG(a.value_ug_m3), 9) AS avg_value, ROUND(MIN(a.value_ug_m3), 9) AS min_value, ROUND(MAX(a.value_ug_m3), 9) AS max_value,
       ROUND(AVG(w.temperature_c), 9) AS avg_temperature, ROUND(AVG(w.wind_speed_ms), 9) AS avg_wind_speed
FROM air a LEFT JOIN fact_weather w ON w.city_id = a.city_id AND w.timestamp::DATE = a.timestamp::DATE GROUP BY 1, 2, 3, 4""")(
    lambda t: reports.browse(t, "v_daily_aggregates").drop("avg_humidity", "total_precipitation"))

on_warehouse("E2_exceedance_days", f"""
SELECT date, city_name, metric_code, exceedance_hours, {nine('max_value', 'avg_value')}, TRUE AS has_exceedance
FROM exceeding WHERE {IN_DAYS} AND exceedance_hours > 0""")(lambda t: reports.exceedance_days(t, **WHERE))

on_warehouse("E3_risk_counts", """
SELECT date, hour, city_name, metric_code, risk_level, COUNT(*) AS count FROM risk GROUP BY ALL""")(lambda t: reports.risk_counts(t))

on_warehouse("A15_risk_pivot", """
WITH n AS (SELECT date, hour, city_name, risk_level, COUNT(*) AS count FROM risk WHERE metric_code = 'pm25' GROUP BY ALL)
SELECT date, hour, COALESCE(AVG(count) FILTER (risk_level = 'HIGH'), 0.0::DOUBLE) AS "HIGH",
       COALESCE(AVG(count) FILTER (risk_level = 'LOW'), 0.0::DOUBLE) AS "LOW",
       COALESCE(AVG(count) FILTER (risk_level = 'MODERATE'), 0.0::DOUBLE) AS "MODERATE" FROM n GROUP BY 1, 2""")(
    lambda t: stats.risk_pivot(reports.risk_counts(t), "pm25"))


def completeness_sql(condition: str, days: int) -> str:
    share = f"CAST(total_points * 100 AS DECIMAL(18,6)) / {days * 24}"
    return f"""
SELECT city_name, metric_code, days_with_data, total_points, CAST({days * 24} AS BIGINT) AS total_expected,
       CAST(ROUND({share}, 2) AS DOUBLE) AS avg_completeness, CAST(ROUND(100 - {share}, 2) AS DOUBLE) AS avg_missing
FROM (SELECT city_name, metric_code, COUNT(DISTINCT timestamp::DATE) AS days_with_data,
             COUNT(DISTINCT date_trunc('hour', timestamp)) AS total_points FROM air WHERE {condition} GROUP BY 1, 2)"""


on_warehouse("A5_completeness_range", completeness_sql(IN_TIME, 14))(
    lambda t: reports.completeness_range(t, "2024-01-08", "2024-01-21", WHERE["cities"], WHERE["metrics"]))

on_warehouse("A5_completeness_with_empty_series", """
SELECT c.city_name, m.metric_code, COUNT(DISTINCT a.timestamp::DATE) AS days_with_data,
       COUNT(DISTINCT a.timestamp) AS total_points, CAST(72 AS BIGINT) AS total_expected,
       CAST(ROUND(CAST(COUNT(DISTINCT a.timestamp) * 100 AS DECIMAL(18,6)) / 72, 2) AS DOUBLE) AS avg_completeness,
       CAST(ROUND(100 - CAST(COUNT(DISTINCT a.timestamp) * 100 AS DECIMAL(18,6)) / 72, 2) AS DOUBLE) AS avg_missing
FROM dim_city c CROSS JOIN dim_metric m LEFT JOIN air a ON a.city_id = c.city_id AND a.metric_id = m.metric_id
     AND a.timestamp >= TIMESTAMP '2024-01-28' AND a.timestamp < TIMESTAMP '2024-01-31' GROUP BY 1, 2""")(
    lambda t: reports.completeness_range(t, "2024-01-28", "2024-01-30", include_empty=True))

on_warehouse("A16_completeness_heatmap", """
SELECT city_name, ROUND(100.0 * COUNT(*) FILTER (metric_code = 'pm25') / 720, 2) AS pm25,
       ROUND(100.0 * COUNT(*) FILTER (metric_code = 'pm10') / 720, 2) AS pm10,
       ROUND(100.0 * COUNT(*) FILTER (metric_code = 'no2') / 720, 2) AS no2,
       ROUND(100.0 * COUNT(*) FILTER (metric_code = 'o3') / 720, 2) AS o3,
       CAST(NULL AS DOUBLE) AS co, CAST(NULL AS DOUBLE) AS so2 FROM air GROUP BY 1""")(
    lambda t: stats.completeness_heatmap(reports.completeness_range(t, "2024-01-01", "2024-01-30")))

on_warehouse("A6_range_violations", f"""
SELECT city_name, metric_code, total_records, range_violations, {nine('min_value', 'max_value', 'avg_value')},
       round_even(range_violations / total_records * 100, 2) AS violation_rate
FROM (SELECT city_name, metric_code, COUNT(*) AS total_records,
             COUNT(*) FILTER ((metric_code = 'pm25' AND value_ug_m3 NOT BETWEEN 1 AND 60)
                 OR (metric_code = 'o3' AND value_ug_m3 NOT BETWEEN 5 AND 80)) AS range_violations,
             MIN(value_ug_m3) AS min_value, MAX(value_ug_m3) AS max_value, AVG(value_ug_m3) AS avg_value
      FROM air GROUP BY 1, 2)""")(
    lambda t: reports.range_violations(t, {"pm25": (1.0, 60.0), "o3": (5.0, 80.0)}))

on_warehouse("A7_station_metadata", """
SELECT city_name, metric_code, ROUND(AVG(station_count), 9) AS avg_stations,
       COUNT(DISTINCT location_id) AS unique_locations, COUNT(*) AS total_records FROM air GROUP BY 1, 2""")(
    reports.station_metadata)

on_warehouse("A8_period_statistics", f"""
SELECT city_name, metric_code, total_records,
       {nine('avg_value', 'min_value', 'max_value', 'avg_temperature', 'avg_wind_speed')}
FROM (SELECT a.city_name, a.metric_code, COUNT(*) AS total_records, AVG(a.value_ug_m3) AS avg_value,
             MIN(a.value_ug_m3) AS min_value, MAX(a.value_ug_m3) AS max_value,
             AVG(w.temperature_c) AS avg_temperature, AVG(w.wind_speed_ms) AS avg_wind_speed
      FROM (SELECT * FROM air WHERE {IN_TIME}) a
      LEFT JOIN fact_weather w ON w.city_id = a.city_id AND w.timestamp::DATE = a.timestamp::DATE GROUP BY 1, 2)""")(
    lambda t: reports.period_statistics(t, **WHERE))

STATUS = "CAST(NULL AS TIMESTAMP) AS latest"
on_warehouse("A9_table_status", f"""
SELECT 'cities' AS "check", COUNT(*) AS number, {STATUS} FROM dim_city
UNION ALL SELECT 'metrics', COUNT(*), NULL FROM dim_metric
UNION ALL SELECT 'observation_last_7_days', COUNT(*), NULL FROM fact_observation WHERE timestamp >= TIMESTAMP '2024-01-24'
UNION ALL SELECT 'observation_last_24_hours', COUNT(*), NULL FROM fact_observation WHERE timestamp >= TIMESTAMP '2024-01-30'
UNION ALL SELECT 'observation_latest', NULL, MAX(timestamp) FROM fact_observation
UNION ALL SELECT 'weather_last_7_days', COUNT(*), NULL FROM fact_weather WHERE timestamp >= TIMESTAMP '2024-01-24'
UNION ALL SELECT 'weather_last_24_hours', COUNT(*), NULL FROM fact_weather WHERE timestamp >= TIMESTAMP '2024-01-30'
UNION ALL SELECT 'weather_latest', NULL, MAX(timestamp) FROM fact_weather""")(lambda t: reports.table_status(t, AS_OF))


def correlation_sql(where: str) -> str:
    cols = stats.CORRELATED
    parts = []
    for x in cols:
        for y in cols:
            r = f"corr({x}, {y})"
            parts.append(f"SELECT metric_code, '{x}' AS x, '{y}' AS y, ROUND(CASE WHEN "
                         f"COUNT(CASE WHEN {y} IS NOT NULL THEN {x} END) = 0 THEN NULL ELSE {r} END, 9) AS r "
                         f"FROM air_sky WHERE {where} GROUP BY 1")
    return " UNION ALL ".join(parts)


on_warehouse("A17_correlation_matrix", correlation_sql("metric_code IS NOT NULL"))(
    lambda t: reports.weather_correlations(t, metrics=C.REQUESTED_METRICS))

on_warehouse("T4_correlations_in_scope", correlation_sql(IN_TIME))(lambda t: reports.weather_correlations(t, **WHERE))

on_warehouse("A18_ranked_correlations", f"""
SELECT metric_code, y AS parameter, r FROM ({correlation_sql("metric_code IS NOT NULL")})
WHERE x = 'value_ug_m3' AND y <> 'value_ug_m3'""")(
    lambda t: stats.rank_correlations(reports.weather_correlations(t, metrics=C.REQUESTED_METRICS)))

XS = ["temperature_c", "wind_speed_ms", "precipitation_mm", "humidity_percent"]
TREND = " UNION ALL ".join(
    f"SELECT metric_code, '{x}' AS x_name, regr_slope(value_ug_m3, {x}) AS slope, "
    f"regr_intercept(value_ug_m3, {x}) AS intercept, CAST(regr_count(value_ug_m3, {x}) AS BIGINT) AS pairs, "
    f"MIN({x}) AS x_min, MAX({x}) AS x_max FROM air_sky "
    f"WHERE metric_code IS NOT NULL AND {x} IS NOT NULL GROUP BY 1" for x in XS)

on_warehouse("A19_linear_trend", f"""
SELECT metric_code, x_name, pairs, {nine('slope', 'intercept', 'x_min', 'x_max')} FROM ({TREND}) WHERE pairs > 1""")(
    lambda t: stats.linear_trends(views.v_observations_weather(t).filter("metric_code IS NOT NULL"), XS))

on_warehouse("A19_trend_line", f"""
SELECT metric_code, x_name, CAST(point AS INT) AS point, ROUND(x_min + point * ((x_max - x_min) / 99), 9) AS x,
       ROUND(intercept + slope * (x_min + point * ((x_max - x_min) / 99)), 8) AS y
FROM ({TREND}) , generate_series(0, 99) g(point) WHERE pairs > 1""")(
    lambda t: stats.trend_line(stats.linear_trends(
        views.v_observations_weather(t).filter("metric_code IS NOT NULL"), XS)).select(
        "metric_code", "x_name", "point", "x", F.round("y", 8).alias("y")))

on_warehouse("P10_metric_list", """
SELECT a.metric_code, a.metric_name, COUNT(*) AS rows FROM air a
WHERE a.metric_code NOT IN ('so2','co') GROUP BY 1, 2""")(
    lambda t: views.observations(t).drop("metric_name").join(list_metrics(t.dim_metric), "metric_code")
    .groupBy("metric_code", "metric_name").agg(F.count("*").alias("rows")))
