"""Views, filters, joins, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions import times, values
from airlattice.functions.times import date_bounds
from airlattice.operators import joins, reshape, scope, windows
from airlattice.plans import load_run, reports, views
from airlattice.sources import eventlog, gaps, sinks
from queries.base import AS_OF, SKY, nine, on_warehouse, query

on_warehouse("P1_v_observations", f"""
SELECT timestamp, city_name, country, metric_code, metric_name, unit, station_count,
       {nine('value', 'value_ug_m3', 'latitude', 'longitude')} FROM air""")(views.v_observations)

on_warehouse("P2_v_weather", f"""
SELECT timestamp, city_name, country, {nine(*SKY, 'latitude', 'longitude')} FROM sky""")(views.v_weather)

on_warehouse("J2_v_observations_weather", f"""
SELECT timestamp, city_name, country, metric_code, metric_name, {nine('value_ug_m3', *SKY)}
FROM air_sky""")(views.v_observations_weather)

DAILY_COLUMNS = nine("avg_value", "min_value", "max_value", "avg_temperature", "avg_humidity",
                     "total_precipitation", "avg_wind_speed")

on_warehouse("A1_v_daily_aggregates", f"""
SELECT date, city_name, country, metric_code, data_points, {DAILY_COLUMNS}
FROM (SELECT a.timestamp::DATE AS date, a.city_name, a.country, a.metric_code,
             AVG(a.value_ug_m3) AS avg_value, MIN(a.value_ug_m3) AS min_value, MAX(a.value_ug_m3) AS max_value,
             COUNT(*) AS data_points, AVG(w.temperature_c) AS avg_temperature,
             AVG(w.humidity_percent) AS avg_humidity, SUM(w.precipitation_mm) AS total_precipitation,
             AVG(w.wind_speed_ms) AS avg_wind_speed
      FROM air a LEFT JOIN fact_weather w ON w.city_id = a.city_id AND w.timestamp::DATE = a.timestamp::DATE
      GROUP BY ALL)""")(views.v_daily_aggregates)

on_warehouse("A1_daily_aggregates_each_row_once", f"""
WITH d AS (SELECT timestamp::DATE AS date, city_id, city_name, country, metric_code,
                  AVG(value_ug_m3) AS avg_value, MIN(value_ug_m3) AS min_value, MAX(value_ug_m3) AS max_value,
                  COUNT(*) AS data_points FROM air GROUP BY ALL),
     w AS (SELECT timestamp::DATE AS date, city_id, AVG(temperature_c) AS avg_temperature,
                  AVG(humidity_percent) AS avg_humidity, SUM(precipitation_mm) AS total_precipitation,
                  AVG(wind_speed_ms) AS avg_wind_speed FROM fact_weather GROUP BY ALL)
SELECT date, city_name, country, metric_code, data_points, {DAILY_COLUMNS}
FROM d LEFT JOIN w USING (date, city_id)""")(lambda t: views.v_daily_aggregates(t, weather="daily"))

on_warehouse("W1_v_moving_averages", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3,
       ROUND(AVG(value_ug_m3) OVER (PARTITION BY city_name, metric_code ORDER BY timestamp
                                    ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS moving_avg_7d
FROM air""")(views.v_moving_averages)

on_warehouse("W6_moving_average_days", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3,
       ROUND(CAST(SUM(CAST(value_ug_m3 AS DECIMAL(28,12))) OVER s AS DOUBLE) / COUNT(*) OVER s, 9) AS moving_avg_7d
FROM air WINDOW s AS (PARTITION BY city_name, metric_code ORDER BY timestamp
                      RANGE BETWEEN INTERVAL 604799 SECOND PRECEDING AND CURRENT ROW)""")(views.moving_average_days)

LAG_SQL = """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3,
       ROUND(LAG(value_ug_m3, 1) OVER s, 9) AS value_lag_1h, ROUND(LAG(value_ug_m3, 2) OVER s, 9) AS value_lag_2h,
       ROUND(LAG(value_ug_m3, 3) OVER s, 9) AS value_lag_3h, station_count
FROM air WINDOW s AS (PARTITION BY city_name, metric_code ORDER BY timestamp)"""
on_warehouse("W2_v_lags", LAG_SQL)(views.v_lags)
on_warehouse("W2_lags_in_small_blocks", LAG_SQL)(lambda t: views.v_lags(t, block_rows=64))

on_warehouse("W2_lags_on_hour_grid", """
SELECT a.timestamp, a.city_name, a.metric_code, ROUND(a.value_ug_m3, 9) AS value_ug_m3,
       ROUND(b.value_ug_m3, 9) AS value_lag_1h, ROUND(c.value_ug_m3, 9) AS value_lag_2h,
       ROUND(d.value_ug_m3, 9) AS value_lag_3h, a.station_count
FROM air a
LEFT JOIN air b ON b.city_id = a.city_id AND b.metric_id = a.metric_id AND b.timestamp = a.timestamp - INTERVAL 1 HOUR
LEFT JOIN air c ON c.city_id = a.city_id AND c.metric_id = a.metric_id AND c.timestamp = a.timestamp - INTERVAL 2 HOUR
LEFT JOIN air d ON d.city_id = a.city_id AND d.metric_id = a.metric_id AND d.timestamp = a.timestamp - INTERVAL 3 HOUR
""")(lambda t: views.v_lags(t, grid=True))


@on_warehouse("W3_W4_lags_and_means", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3,
       ROUND(LAG(value_ug_m3, 1) OVER s, 9) AS lag_1h, ROUND(LAG(value_ug_m3, 2) OVER s, 9) AS lag_2h,
       ROUND(LAG(value_ug_m3, 3) OVER s, 9) AS lag_3h, ROUND(LAG(value_ug_m3, 6) OVER s, 9) AS lag_6h,
       ROUND(LAG(value_ug_m3, 24) OVER s, 9) AS lag_24h,
       ROUND(AVG(value_ug_m3) OVER (s ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 9) AS ma_3h,
       ROUND(AVG(value_ug_m3) OVER (s ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 9) AS ma_6h,
       ROUND(AVG(value_ug_m3) OVER (s ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 9) AS ma_24h
FROM air WINDOW s AS (PARTITION BY city_name, metric_code ORDER BY timestamp)""")
def lags_and_means(t):
    base = views.observations(t).select("timestamp", *views.SERIES, "value_ug_m3")
    lagged = {f"lag_{k}h": windows.lag_of("value_ug_m3", k) for k in C.LAGS}
    means = {f"ma_{n}h": windows.trailing_mean("value_ug_m3", n) for n in C.MEANS}
    return windows.with_history(base, views.SERIES, "timestamp", max(C.LAGS), {**lagged, **means}, block_rows=128)


@on_warehouse("W5_position_in_series", """
SELECT timestamp, city_name, metric_code,
       ROW_NUMBER() OVER (PARTITION BY city_name, metric_code ORDER BY timestamp) - 1 AS position FROM air""")
def position(t):
    base = views.observations(t).select("timestamp", *views.SERIES)
    return windows.position_in_series(base, views.SERIES, ["timestamp"], F.to_date("timestamp"))


on_warehouse("E1_v_risk_map", f"""
SELECT date, hour, city_name, metric_code, risk_level,
       {nine('value_ug_m3', 'temperature_c', 'wind_speed_ms', 'precipitation_mm')} FROM risk""")(views.v_risk_map)

on_warehouse("A2_v_days_with_exceedances", f"""
SELECT date, city_name, metric_code, exceedance_hours, {nine('max_value', 'avg_value')},
       exceedance_hours > 0 AS has_exceedance FROM exceeding""")(views.v_days_with_exceedances)

on_warehouse("A3_v_data_completeness", """
SELECT city_name, metric_code, timestamp::DATE AS date, COUNT(*) AS actual_data_points,
       24 AS expected_data_points_per_day,
       CAST(ROUND(CAST(COUNT(*) * 100 AS DECIMAL(18,6)) / 24, 2) AS DOUBLE) AS completeness_percent,
       CAST(100.0 - ROUND(CAST(COUNT(*) * 100 AS DECIMAL(18,6)) / 24, 2) AS DOUBLE) AS missing_percent
FROM air GROUP BY 1, 2, 3""")(views.v_data_completeness)


# Filters and projections

@on_warehouse("P3_P4_scope", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3 FROM air
WHERE city_name IN ('AFRICA','ASIA') AND metric_code IN ('pm25','o3')
  AND timestamp >= TIMESTAMP '2024-01-05' AND timestamp < TIMESTAMP '2024-01-21'""")
def scoped(t):
    return scope.scope(views.v_observations(t), ["AFRICA", "ASIA"], ["pm25", "o3"], "2024-01-05", "2024-01-20").select(
        "timestamp", *views.SERIES, "value_ug_m3")


@on_warehouse("P4_scope_inclusive_midnight", """
SELECT timestamp, city_name, metric_code, ROUND(value_ug_m3, 9) AS value_ug_m3 FROM air
WHERE timestamp >= TIMESTAMP '2024-01-05' AND timestamp <= TIMESTAMP '2024-01-20'""")
def scoped_midnight(t):
    return scope.scope(views.v_observations(t), start="2024-01-05", end="2024-01-20", inclusive_midnight=True).select(
        "timestamp", *views.SERIES, "value_ug_m3")


@on_warehouse("P5_scope_on_date", f"""
SELECT date, city_name, metric_code, exceedance_hours, {nine('max_value', 'avg_value')},
       exceedance_hours > 0 AS has_exceedance
FROM exceeding WHERE date >= DATE '2024-01-10' AND date <= DATE '2024-01-19'""")
def scoped_date(t):
    return scope.scope(views.v_days_with_exceedances(t), start="2024-01-10", end="2024-01-19", on="date")


on_warehouse("P6_last_week", """
SELECT timestamp, city_id, metric_id, ROUND(value, 9) AS value FROM fact_observation
WHERE timestamp >= TIMESTAMP '2024-01-24' AND timestamp < TIMESTAMP '2024-01-31'""")(
    lambda t: scope.last(t.fact_observation, "7 days", AS_OF, until=True).select(
        "timestamp", "city_id", "metric_id", "value"))

on_warehouse("P8_keep_metrics", """
SELECT metric_code, COUNT(*) AS n FROM air WHERE metric_code IN ('pm25','pm10','no2') AND metric_code <> 'no2'
GROUP BY 1""")(lambda t: scope.keep_metrics(views.v_observations(t), ["PM25", "pm10", "no2"], ["NO2"])
               .groupBy("metric_code").agg(F.count("*").alias("n")))


@query("P9_select_cities", """
SELECT c_custkey, c_mktsegment AS city_name FROM customer WHERE lower(c_mktsegment) IN ('building','machinery')""")
def select_cities(spark, folder):
    cities = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("city_name"))
    return scope.select_cities(cities, ["Building", "MACHINERY", "nowhere"])


@query("P10_active_cities", """
SELECT DISTINCT c_mktsegment AS city_name FROM customer WHERE c_mktsegment IN ('BUILDING','FURNITURE','NOWHERE')""")
def active_cities(spark, folder):
    stored = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_mktsegment").alias("city_name"))
    return scope.list_active_cities(stored, ["FURNITURE", "BUILDING", "NOWHERE"])


@query("P11_valid_coordinates", """
SELECT value <= 90 AND value * 2 <= 180 AS valid, COUNT(*) AS n FROM events GROUP BY 1""")
def coordinates(spark, folder):
    rows = eventlog.events(spark, folder).select(F.col("value").alias("latitude"), (F.col("value") * 2).alias("longitude"))
    good, bad = scope.valid_coordinates(rows)
    return (good.select(F.lit(True).alias("valid")).unionByName(bad.select(F.lit(False).alias("valid")))
            .groupBy("valid").agg(F.count("*").alias("n")))


on_warehouse("P12_drop_missing", f"""
SELECT timestamp, city_name, metric_code, {nine('temperature_c')} FROM air_sky
WHERE temperature_c IS NOT NULL AND value_ug_m3 IS NOT NULL""")(
    lambda t: scope.drop_missing(views.v_observations_weather(t), ["value_ug_m3", "temperature_c"]).select(
        "timestamp", "city_name", "metric_code", "temperature_c"))


@on_warehouse("P13_date_bounds", """
SELECT city_name, COUNT(*) AS n FROM air
WHERE timestamp >= TIMESTAMP '2024-01-21' AND timestamp <= TIMESTAMP '2024-01-31' GROUP BY 1""")
def bounds(t):
    low, high = date_bounds(AS_OF, days=10)
    return (views.observations(t).filter(F.col("timestamp").between(low, high))
            .groupBy("city_name").agg(F.count("*").alias("n")))


# Joins

on_warehouse("J1_star", """
SELECT city_name, country, metric_code, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM air GROUP BY 1, 2, 3""")(
    lambda t: joins.star(t.fact_observation, t.dim_city, t.dim_metric).groupBy("city_name", "country", "metric_code")
    .agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")))


@on_warehouse("J4_same_day_join", """
SELECT a.city_id, a.metric_id, a.timestamp, ROUND(a.value, 9) AS value, COUNT(w.timestamp) AS weather_rows,
       ROUND(SUM(w.precipitation_mm), 9) AS precipitation_mm, ROUND(AVG(w.temperature_c), 9) AS temperature_c
FROM fact_observation a LEFT JOIN fact_weather w ON w.city_id = a.city_id
     AND w.timestamp::DATE = a.timestamp::DATE GROUP BY a.city_id, a.metric_id, a.timestamp, a.value""")
def same_day(t):
    return joins.join_same_day(t.fact_observation, t.fact_weather).select(
        "city_id", "metric_id", "timestamp", "value", F.coalesce("weather_rows", F.lit(0)).alias("weather_rows"),
        F.col("precipitation_mm_sum").alias("precipitation_mm"),
        (F.col("temperature_c_sum") / F.col("temperature_c_n")).alias("temperature_c"))


on_warehouse("J5_same_hour_join", f"""
SELECT a.city_id, a.metric_id, a.timestamp, ROUND(a.value, 9) AS value, {nine(*SKY)}
FROM fact_observation a LEFT JOIN (SELECT * EXCLUDE (latitude, longitude) FROM fact_weather) w
  ON w.city_id = a.city_id AND w.timestamp::DATE = a.timestamp::DATE AND hour(w.timestamp) = hour(a.timestamp)""")(
    lambda t: joins.join_same_hour(t.fact_observation, t.fact_weather).select(
        "city_id", "metric_id", "timestamp", "value", *C.WEATHER_COLUMNS))

on_warehouse("J6_with_metric", """
SELECT a.city_id, a.timestamp, ROUND(a.value_ug_m3, 9) AS pm25, ROUND(b.value_ug_m3, 9) AS pm10
FROM fact_observation a LEFT JOIN fact_observation b
  ON b.city_id = a.city_id AND b.timestamp = a.timestamp AND b.metric_id = 2 WHERE a.metric_id = 1""")(
    lambda t: joins.with_metric(t.fact_observation.filter("metric_id = 1"), t.fact_observation, 2, "pm10").select(
        "city_id", "timestamp", F.col("value_ug_m3").alias("pm25"), "pm10"))

WIDE_SQL = """
SELECT city_name AS city, timestamp, AVG(value_ug_m3) FILTER (metric_code = 'pm25') AS pm25,
       AVG(value_ug_m3) FILTER (metric_code = 'pm10') AS pm10, AVG(value_ug_m3) FILTER (metric_code = 'no2') AS no2,
       AVG(value_ug_m3) FILTER (metric_code = 'o3') AS o3 FROM air GROUP BY 1, 2"""


def long_hours(t):
    """City-hour long rows in the shape of the ingest frames."""
    return views.observations(t).select(
        F.col("city_name").alias("city"), F.col("timestamp").alias("timestamp_hour"),
        F.col("metric_code").alias("parameter"), "value_ug_m3", "latitude", "longitude", "location_id",
        "location_name", "station_count")


@on_warehouse("J7_merge_observations_and_weather", f"""
WITH wide AS ({WIDE_SQL})
SELECT COALESCE(a.city, w.city_name) AS city, COALESCE(a.timestamp, w.timestamp) AS timestamp,
       {nine('pm25', 'pm10', 'no2', 'o3')}, {nine(*SKY)}
FROM wide a FULL JOIN sky w ON w.city_name = a.city AND w.timestamp = a.timestamp""")
def merged(t):
    wide = reshape.pivot_metrics(long_hours(t), metrics=C.REQUESTED_METRICS)
    sky = reshape.hourly_weather(views.v_weather(t).withColumnRenamed("city_name", "city"))
    return joins.merge_observations_and_weather(wide, sky).drop("timestamp_hour")


COUNTS_SQL = """
SELECT city_name, CAST({aq} AS BIGINT) AS aq_count, CAST({wx} AS BIGINT) AS weather_count FROM (
  SELECT c.city_name,
    (SELECT COUNT(*) FROM fact_observation a WHERE a.city_id = c.city_id AND a.timestamp >= TIMESTAMP '2024-01-24') AS aq,
    (SELECT COUNT(*) FROM fact_weather w WHERE w.city_id = c.city_id AND w.timestamp >= TIMESTAMP '2024-01-24') AS wx
  FROM dim_city c)"""
on_warehouse("J10_records_by_city", """
SELECT c.city_name, COUNT(a.city_id) AS aq_count, COUNT(w.city_id) AS weather_count
FROM dim_city c LEFT JOIN fact_observation a ON a.city_id = c.city_id AND a.timestamp >= TIMESTAMP '2024-01-24'
LEFT JOIN fact_weather w ON w.city_id = c.city_id AND w.timestamp >= TIMESTAMP '2024-01-24'
GROUP BY c.city_id, c.city_name""")(
    lambda t: joins.records_by_city(t.dim_city, t.fact_observation, t.fact_weather, AS_OF))
on_warehouse("J10_records_by_city_dedup", COUNTS_SQL.format(aq="aq", wx="wx"))(
    lambda t: joins.records_by_city(t.dim_city, t.fact_observation, t.fact_weather, AS_OF, mode="dedup"))


# Reshaping

@query("A10_hourly_by_city", """
SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp_hour, event_type AS parameter, props AS city,
       ROUND(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 9) AS value_ug_m3,
       CAST(COUNT(*) AS INT) AS station_count, CAST(COUNT(DISTINCT user_id) AS INT) AS distinct_stations,
       arg_min(user_id, ts) AS location_id
FROM events GROUP BY 1, 2, 3""")
def hourly_by_city(spark, folder):
    obs = eventlog.events(spark, folder).select(
        F.col("props").alias("city"), F.col("event_type").alias("parameter"), F.col("ts").alias("timestamp"),
        F.col("user_id").alias("location_id"), F.col("value").cast("decimal(18,2)").alias("value_ug_m3"))
    return reshape.hourly_by_city(obs).select(
        "timestamp_hour", "parameter", "city", "value_ug_m3", "station_count", "distinct_stations", "location_id")


@query("A10_station_rollup_to_city", """
SELECT timestamp, city_id, metric_id, ROUND(value, 9) AS value, station_count, location_id, location_name,
       latitude, longitude FROM fact_observation""")
def rollup(spark, folder):
    return eventlog.fact_observation(spark, folder).drop("value_ug_m3")


@on_warehouse("A11_pivot_metrics", f"""
SELECT city, timestamp AS timestamp_hour, {nine('pm25', 'pm10', 'no2', 'o3')} FROM ({WIDE_SQL})""")
def pivoted(t):
    return reshape.pivot_metrics(long_hours(t), metrics=C.REQUESTED_METRICS)


@on_warehouse("A12_hourly_wide", f"""
SELECT city, timestamp AS timestamp_hour, location_id, {nine('pm25', 'pm10', 'no2', 'o3')} FROM ({WIDE_SQL})
JOIN (SELECT city_name AS city, timestamp, MIN(location_id) AS location_id FROM air GROUP BY 1, 2) USING (city, timestamp)""")
def rewide(t):
    keys = ["city", "timestamp_hour", "location_id"]
    spread = reshape.pivot_metrics(long_hours(t), keys, C.REQUESTED_METRICS)
    return reshape.hourly_wide(spread, metrics=C.REQUESTED_METRICS)


@query("A13_hourly_weather", """
SELECT props AS city, date_trunc('hour', ts)::TIMESTAMP AS timestamp_hour, ROUND(AVG(value), 9) AS temperature_c,
       ROUND(AVG(value / 2), 9) AS humidity_percent, ROUND(SUM(value), 9) AS precipitation_mm,
       ROUND(AVG(value / 4), 9) AS wind_speed_ms, ROUND(AVG(value / 8), 9) AS wind_direction_deg
FROM events GROUP BY 1, 2""")
def weather_hours(spark, folder):
    v = F.col("value")
    rows = eventlog.events(spark, folder).select(
        F.col("props").alias("city"), F.col("ts").alias("timestamp"), v.alias("temperature_c"),
        (v / 2).alias("humidity_percent"), v.alias("precipitation_mm"), (v / 4).alias("wind_speed_ms"),
        (v / 8).alias("wind_direction_deg"))
    return reshape.hourly_weather(rows)


@query("A13_hourly_weather_circular", """
SELECT event_type AS city, date_trunc('hour', ts)::TIMESTAMP AS timestamp_hour,
       ROUND(cos(radians((d + 360) % 360)), 6) AS x, ROUND(sin(radians((d + 360) % 360)), 6) AS y
FROM (SELECT event_type, date_trunc('hour', ts) AS ts,
             degrees(atan2(AVG(sin(radians(value))), AVG(cos(radians(value))))) AS d FROM events GROUP BY 1, 2)""")
def weather_circle(spark, folder):
    v = F.col("value")
    rows = eventlog.events(spark, folder).select(
        F.col("event_type").alias("city"), F.col("ts").alias("timestamp"), v.alias("temperature_c"),
        v.alias("humidity_percent"), v.alias("precipitation_mm"), v.alias("wind_speed_ms"),
        v.alias("wind_direction_deg"))
    turn = F.radians("wind_direction_deg")
    return reshape.hourly_weather(rows, circular=True).select(
        "city", "timestamp_hour", F.round(F.cos(turn), 6).alias("x"), F.round(F.sin(turn), 6).alias("y"))


@on_warehouse("A14_unpivot_metrics", """
SELECT city_name AS city, timestamp AS timestamp_hour, metric_code AS parameter,
       ROUND(value_ug_m3, 9) AS value_ug_m3 FROM air""")
def unpivoted(t):
    wide = reshape.pivot_metrics(long_hours(t), metrics=C.REQUESTED_METRICS)
    return reshape.unpivot_metrics(wide, ["city", "timestamp_hour"], C.REQUESTED_METRICS)


@query("S7_latest_per_series", """
SELECT user_id, event_type, MAX(ts) AS ts, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value
FROM events GROUP BY 1, 2""")
def latest(spark, folder):
    rows = eventlog.events(spark, folder).select("user_id", "event_type", "ts", "event_id", "value")
    return reshape.latest_per_series(rows, ["user_id", "event_type"], "ts")


# Scans, views, sinks, gaps

@query("S9_query_over_views", """
SELECT city_name, metric_code, COUNT(*) AS n, ROUND(AVG(value_ug_m3), 9) AS mean
FROM air WHERE value_ug_m3 > 10 GROUP BY 1, 2""")
def sql_scan(spark, folder):
    views.register_views(spark, eventlog.event_warehouse(spark, folder))
    return reports.run_query(spark, """
        SELECT city_name, metric_code, count(*) AS n, avg(value_ug_m3) AS mean
        FROM v_observations WHERE value_ug_m3 > 10 GROUP BY city_name, metric_code""")


@query("S10_view_catalogue", """
SELECT 'v_observations' AS view, COUNT(*) AS n FROM air UNION ALL SELECT 'v_weather', COUNT(*) FROM sky
UNION ALL SELECT 'v_observations_weather', COUNT(*) FROM air_sky
UNION ALL SELECT 'v_daily_aggregates', COUNT(*) FROM exceeding
UNION ALL SELECT 'v_moving_averages', COUNT(*) FROM air UNION ALL SELECT 'v_risk_map', COUNT(*) FROM air
UNION ALL SELECT 'v_lags', COUNT(*) FROM air
UNION ALL SELECT 'v_days_with_exceedances', COUNT(*) FROM exceeding
UNION ALL SELECT 'v_data_completeness', COUNT(*) FROM exceeding""")
def catalogue(spark, folder):
    names = views.register_views(spark, eventlog.event_warehouse(spark, folder))
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS view, count(*) AS n FROM {n}" for n in names))


@query("S12_upsert_dim", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL
SELECT (SELECT MAX(c_custkey) FROM customer) + ROW_NUMBER() OVER (ORDER BY md5(s_name)) AS id, s_name AS name
FROM supplier""")
def upsert(spark, folder):
    known = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    names = spark.read.parquet(f"{folder}/supplier.parquet").select(F.col("s_name").alias("name"))
    incoming = names.unionByName(names).unionByName(known.select("name")).withColumn("id", F.lit(None).cast("bigint"))
    return sinks.upsert_dim(known, incoming, "name", "id").withColumn("id", F.col("id").cast("bigint"))


@on_warehouse("S13_new_observations", """
SELECT timestamp, city_id, metric_id, ROUND(value, 9) AS value, ROUND(value_ug_m3, 9) AS value_ug_m3
FROM fact_observation WHERE timestamp >= TIMESTAMP '2024-01-16'""")
def append_observations(t):
    stored = t.fact_observation.filter("timestamp < TIMESTAMP '2024-01-16'")
    wide = reshape.pivot_metrics(long_hours(t)).withColumn("timestamp", F.col("timestamp_hour"))
    unknown = wide.withColumn("city", F.lit("Nowhere"))
    batch = wide.unionByName(wide).unionByName(unknown).drop("timestamp_hour")
    return sinks.new_observations(stored, batch, t.dim_city, t.dim_metric).select(
        "timestamp", "city_id", "metric_id", "value", "value_ug_m3")


@on_warehouse("S14_new_weather", f"""
SELECT timestamp, city_id, {nine(*SKY, 'latitude', 'longitude')}
FROM fact_weather WHERE timestamp >= TIMESTAMP '2024-01-16'""")
def append_weather(t):
    stored = t.fact_weather.filter("timestamp < TIMESTAMP '2024-01-16'")
    batch = views.v_weather(t).withColumnRenamed("city_name", "city")
    return sinks.new_weather(stored, batch.unionByName(batch), t.dim_city)


@on_warehouse("S15_new_quality", """
SELECT timestamp::DATE AS date, city_id, metric_id, COUNT(*) AS data_points_actual,
       0 AS value_range_violations, 0 AS sudden_jumps_count, TRUE AS is_monotonic
FROM fact_observation WHERE timestamp >= TIMESTAMP '2024-01-16' GROUP BY 1, 2, 3""")
def append_quality(t):
    rows = (t.fact_observation.groupBy(F.to_date("timestamp").alias("date"), "city_id", "metric_id")
            .agg(F.count("*").alias("data_points_actual")))
    stored = rows.filter("date < DATE '2024-01-16'")
    return sinks.new_quality(stored, rows.unionByName(rows))


@query("S16_export_csv", """
SELECT city_name, metric_code, date, exceedance_hours FROM exceeding""")
def export(spark, folder):
    from uuid import uuid4

    from airlattice.session import use_checkpoint_dir
    path = f"{use_checkpoint_dir(spark)}/export-{uuid4().hex}"
    frame = views.v_days_with_exceedances(eventlog.event_warehouse(spark, folder))
    sinks.export_csv(frame.select("city_name", "metric_code", "date", "exceedance_hours"), path)
    return spark.read.option("header", True).schema(
        "city_name STRING, metric_code STRING, date DATE, exceedance_hours BIGINT").csv(path)


DRAW = "md5('42|' || city_id || '|' || metric_id || '|' || strftime(timestamp, '%Y-%m-%d %H:%M:%S'))"
GAPS_SQL = f"""
WITH profile AS (SELECT * FROM (VALUES {{rows}}) p(city_id, metric_id, pct)),
ranked AS (SELECT f.city_id, f.metric_id, f.timestamp,
                  ROW_NUMBER() OVER (PARTITION BY f.city_id, f.metric_id ORDER BY {DRAW}) AS r,
                  COUNT(*) OVER (PARTITION BY f.city_id, f.metric_id) AS n
           FROM fact_observation f WHERE f.timestamp >= TIMESTAMP '2024-01-24'),
gone AS (SELECT city_id, metric_id, timestamp FROM ranked JOIN profile USING (city_id, metric_id)
         WHERE r <= floor(n * (pct / 100.0::DOUBLE)))
SELECT timestamp, city_id, metric_id, ROUND(value, 9) AS value
FROM fact_observation ANTI JOIN gone USING (city_id, metric_id, timestamp)"""
KEEP = ["timestamp", "city_id", "metric_id", "value"]

on_warehouse("S18_inject_gaps", GAPS_SQL.format(rows="(2, 1, 30.0::DOUBLE)"))(
    lambda t: gaps.inject_gaps(t, "ASIA", "pm25", 30.0, AS_OF).select(*KEEP))

on_warehouse("S19_drop_hours", """
SELECT timestamp, city_id, metric_id, ROUND(value, 9) AS value FROM fact_observation
WHERE NOT (city_id = 2 AND metric_id = 1 AND timestamp >= TIMESTAMP '2024-01-28' AND hour(timestamp) IN (3, 4, 5, 18))
""")(lambda t: gaps.drop_hours(t, "ASIA", "pm25", [3, 4, 5, 18], AS_OF).select(*KEEP))

# The share to remove follows from the ids of city and metric.
@on_warehouse("S20_inject_gap_profile", GAPS_SQL.replace("(VALUES {rows})", """(
    SELECT city_id, metric_id, 1.0::DOUBLE + (city_id * 7 + metric_id * 3) % 20 FROM dim_city, dim_metric)"""))
def gap_profile(t):
    pct = (1.0 + (F.col("city_id") * 7 + F.col("metric_id") * 3) % 20).cast("double")
    metrics = F.explode(F.array(*[F.struct(F.lit(m[0]).alias("metric_id"), F.lit(m[1]).alias("metric_code")) for m in C.METRICS]))
    profile = t.dim_city.select("city_id", "city_name", metrics.alias("m")).select("city_id", "city_name", "m.*")
    return gaps.inject_gap_profile(t, profile.select("city_name", "metric_code", pct.alias("pct")), AS_OF).select(*KEEP)


# Sets and scalar functions

@query("U2_union_with_missing_columns", """
SELECT user_id, ts, value, NULL::VARCHAR AS props FROM events WHERE event_type = 'click' UNION ALL
SELECT user_id, ts, NULL::DOUBLE AS value, props FROM events WHERE event_type = 'view'""")
def union_all(spark, folder):
    rows = eventlog.events(spark, folder)
    clicks = rows.filter("event_type = 'click'").select("user_id", "ts", "value")
    seen = rows.filter("event_type = 'view'").select("user_id", "ts", "props")
    return clicks.unionByName(seen, allowMissingColumns=True)


query("U3_distinct", "SELECT DISTINCT user_id, event_type, ts::DATE AS date FROM events")(
    lambda spark, folder: eventlog.events(spark, folder)
    .select("user_id", "event_type", F.to_date("ts").alias("date")).distinct())


@query("F_time_functions", """
SELECT event_id, ts AS parsed, CAST(NULL AS TIMESTAMP) AS unreadable,
       date_trunc('hour', ts)::TIMESTAMP AS hour_start, ts::DATE AS day, CAST(hour(ts) AS INT) AS hour,
       CAST(isodow(ts) - 1 AS INT) AS weekday, CAST(month(ts) AS INT) AS month,
       ROUND(sin(2 * pi() * hour(ts) / 24), 9) AS hour_sin, ROUND(cos(2 * pi() * hour(ts) / 24), 9) AS hour_cos,
       ts - INTERVAL 5 HOUR AS new_york, ts - INTERVAL 2 HOUR AS from_offset,
       CAST(floor((epoch_us(TIMESTAMP '2024-01-31') // 1000000 - epoch_us(ts) // 1000000) / 3600.0) + 1 AS BIGINT) AS hours_to_end,
       len(generate_series(ts::DATE, DATE '2024-01-31', INTERVAL 1 DAY)) AS days_to_end
FROM events""")
def time_functions(spark, folder):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    hour_sin, hour_cos = values.cycle(F.hour("ts"), 24)
    end = F.lit(AS_OF).cast("timestamp")
    return eventlog.events(spark, folder).select(
        "event_id", times.normalize_timestamp(text).alias("parsed"),
        times.normalize_timestamp(F.concat(F.lit("x"), text)).alias("unreadable"),
        times.hour_floor("ts").alias("hour_start"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour"),
        F.weekday("ts").alias("weekday"), F.month("ts").alias("month"),
        hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"),
        times.normalize_timestamp(F.concat(text, F.lit("Z")), "America/New_York").alias("new_york"),
        times.normalize_timestamp(F.concat(text, F.lit("+02:00"))).alias("from_offset"),
        times.hours_between("ts", end).alias("hours_to_end"),
        F.size(times.day_series("ts", end)).cast("bigint").alias("days_to_end"))


@query("F_value_functions", """
SELECT event_id, value AS ug, ROUND(value * 1000, 9) AS ppm, value AS other, event_id % 3 = 1 AS known,
       ROUND(value / 10 * cos(radians(value)), 9) AS wind_x, ROUND(value / 10 * sin(radians(value)), 9) AS wind_y,
       0.0::DOUBLE AS endless, 0.0::DOUBLE AS undefined, lower(replace(event_type || ' A b', ' ', '_')) AS slug,
       ROUND(2 * 6371000.0 * asin(least(1, sqrt(pow(sin(radians(value / 10) / 2), 2)
             + cos(radians(value / 10)) * pow(sin(radians(value / 5) / 2), 2)))), 3) AS metres,
       CAST(ROUND(CAST(user_id * 100 AS DECIMAL(18,6)) / 24, 2) AS DOUBLE) AS share
FROM events""")
def value_functions(spark, folder):
    v = F.col("value")
    unit = F.when(F.col("event_id") % 3 == 1, "UG/M3").otherwise("ppb")
    wind_x, wind_y = values.wind_vector(v / 10, v)
    zero = F.lit(0.0)
    return eventlog.events(spark, folder).select(
        "event_id", values.to_ug_m3("value", F.lit("µg/m³")).alias("ug"),
        values.to_ug_m3("value", F.lit("PPM")).alias("ppm"), values.to_ug_m3("value", F.lit("ppb")).alias("other"),
        values.known_unit(unit).alias("known"), wind_x.alias("wind_x"), wind_y.alias("wind_y"),
        values.finite(v * F.lit(float("inf"))).alias("endless"),
        values.finite(v * F.lit(float("nan"))).alias("undefined"),
        values.slug(F.concat("event_type", F.lit(" A b"))).alias("slug"),
        F.round(values.haversine_m(zero, zero, v / 10, v / 5), 3).alias("metres"),
        values.percent("user_id", F.lit(24)).alias("share"))


@on_warehouse("A20_run_summary", """
SELECT CAST(5 AS BIGINT) AS cities_processed, CAST(0 AS BIGINT) AS cities_failed,
       (SELECT COUNT(*) FROM fact_observation) AS total_aq_records,
       (SELECT COUNT(*) FROM fact_weather) AS total_weather_records,
       (SELECT COUNT(DISTINCT city_id) FROM fact_observation WHERE value > 100) AS cities_with_issues""")
def summary(t):
    air = views.observations(t).withColumnRenamed("city_name", "city")
    sky = views.v_weather(t).withColumnRenamed("city_name", "city")
    return load_run.run_summary(t.dim_city, air, sky, air.filter("value > 100"))
