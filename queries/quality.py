"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice import constants as C
from airlattice.operators import quality as Q
from airlattice.plans import views
from airlattice.sources import eventlog
from queries.base import AS_OF, SKY, on_warehouse, query

RULES = {"pm25": (1.0, 60.0), "pm10": (0.0, 1000.0), "no2": (0.0, 500.0), "o3": (5.0, 80.0)}
OUTSIDE = ("(metric_code = 'pm25' AND value_ug_m3 NOT BETWEEN 1 AND 60) "
           "OR (metric_code = 'o3' AND value_ug_m3 NOT BETWEEN 5 AND 80)")

on_warehouse("Q1_missing_ratios", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(AVG(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 9) AS missing_ratio FROM air_sky"
    for c in ["metric_code", "value_ug_m3", *SKY]))(
    lambda t: Q.missing_ratios(views.v_observations_weather(t), ["metric_code", "value_ug_m3", *SKY]))

on_warehouse("Q2_range_violation_count", """
SELECT 'value' AS "column", COUNT(*) FILTER (value NOT BETWEEN 2 AND 50) AS violations FROM fact_observation
UNION ALL SELECT 'absent', 0""")(
    lambda t: Q.range_violation_count(t.fact_observation, {"value": (2.0, 50.0), "absent": (0.0, 1.0)}))

WEATHER_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} < {lo}{'' if hi is None else f' OR {c} > {hi}'}) AS violations "
    f"FROM fact_weather" for c, (lo, hi) in C.WEATHER_RANGES.items())
on_warehouse("Q11_weather_ranges", WEATHER_SQL)(lambda t: Q.range_violation_count(t.fact_weather, C.WEATHER_RANGES))


@query("Q3_monotonicity", """
SELECT user_id, event_type, BOOL_AND(step) AS is_monotonic FROM (
  SELECT user_id, event_type, COALESCE(seen_at >= LAG(seen_at) OVER (PARTITION BY user_id, event_type ORDER BY event_id), TRUE) AS step
  FROM (SELECT *, CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-06-01' - (ts - TIMESTAMP '2024-01-01') ELSE ts END AS seen_at
        FROM events)) GROUP BY 1, 2""")
def monotonic(spark, folder):
    back = F.timestamp_micros(F.unix_micros(F.lit("2024-06-01").cast("timestamp"))
                              - F.unix_micros("ts") + F.unix_micros(F.lit("2024-01-01").cast("timestamp")))
    rows = eventlog.events(spark, folder).withColumn("at", F.when(F.col("event_type") == "error", back).otherwise(F.col("ts")))
    return Q.monotonicity(rows, "at", "event_id", ["user_id", "event_type"], slice_by=F.floor(F.col("_at") / 1000))


on_warehouse("Q4_freshness", """
SELECT MAX(timestamp) AS latest, ROUND((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(MAX(timestamp))) / 3.6e9, 9) AS age_hours,
       (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(MAX(timestamp))) / 3.6e9 <= 24 AS is_fresh
FROM fact_observation""")(lambda t: Q.freshness(t.fact_observation, "timestamp", AS_OF))

on_warehouse("Q5_zscore_by_series", """
WITH s AS (SELECT city_id, metric_id, AVG(value) AS m, STDDEV_SAMP(value) AS d FROM fact_observation GROUP BY 1, 2)
SELECT city_id, metric_id, COUNT(*) FILTER (abs(value - m) / nullif(d, 0) > 3) AS jumps
FROM fact_observation JOIN s USING (city_id, metric_id) GROUP BY 1, 2""")(
    lambda t: Q.zscore_outliers(t.fact_observation, "value", by=["city_id", "metric_id"]))

on_warehouse("Q5_zscore_global", """
SELECT COUNT(*) FILTER (abs(value - m) / d > 2) AS jumps
FROM fact_observation, (SELECT AVG(value) AS m, STDDEV_SAMP(value) AS d FROM fact_observation)""")(
    lambda t: Q.zscore_outliers(t.fact_observation, "value", 2.0))

GROUPED = """
SELECT city_name, metric_code, COUNT(*) AS actual_points,
       CAST(floor((epoch(MAX(timestamp)) - epoch(MIN(timestamp))) / 3600) + 1 AS BIGINT) AS expected_points
FROM air GROUP BY 1, 2"""
on_warehouse("Q6_completeness_by_group", f"""
SELECT city_name, metric_code, actual_points, expected_points,
       ROUND(actual_points / expected_points, 9) AS completeness_ratio,
       ROUND(1 - actual_points / expected_points, 9) AS missing_ratio FROM ({GROUPED})""")(
    lambda t: Q.completeness_by_group(views.observations(t), group=["city_name", "metric_code"]))

REPORT = f"""
WITH jumpy AS (SELECT metric_code, COUNT(*) FILTER (abs(value_ug_m3 - m) / nullif(d, 0) > 3) AS n
  FROM air JOIN (SELECT metric_code, AVG(value_ug_m3) AS m, STDDEV_SAMP(value_ug_m3) AS d FROM air GROUP BY 1) USING (metric_code)
  GROUP BY 1),
ranged AS (SELECT metric_code, COUNT(*) FILTER ({OUTSIDE}) AS n FROM air GROUP BY 1),
grouped AS ({GROUPED}),
r AS (SELECT 'missing_ratio' AS "check", 'all' AS scope, c AS "column", 0.0::DOUBLE AS value, 0.3::DOUBLE AS threshold, FALSE AS bad
      FROM (VALUES ('timestamp'), ('city_name'), ('metric_code'), ('value_ug_m3')) v(c)
  UNION ALL SELECT 'range', 'all', metric_code, n, 0, n > 0 FROM ranged
  UNION ALL SELECT 'freshness_hours', 'all', 'timestamp', ROUND((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(MAX(timestamp))) / 3.6e9, 9),
                   24, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(MAX(timestamp))) / 3.6e9 > 24 FROM air
  UNION ALL SELECT 'jumps', 'all', metric_code, n, 0, n > 0 FROM jumpy
  UNION ALL SELECT 'completeness', city_name, metric_code, ROUND(1 - actual_points / expected_points, 9), 0.3,
                   1 - actual_points / expected_points > 0.3 FROM grouped)
SELECT {{select}} FROM r"""


def report(t):
    rows = views.observations(t).select("timestamp", "city_name", "metric_code", "value_ug_m3")
    return Q.quality_report(rows, AS_OF, RULES)


on_warehouse("Q7_quality_report", REPORT.format(
    select="\"check\", scope, \"column\", value, threshold, CASE WHEN bad THEN 'warning' ELSE 'ok' END AS status"))(report)

on_warehouse("Q8_quality_verdict", REPORT.format(
    select="NOT BOOL_OR(bad) AS valid, COUNT(*) FILTER (bad) AS warnings"))(lambda t: Q.report_valid(report(t)))

on_warehouse("Q9_daily_quality_metrics", f"""
WITH s AS (SELECT timestamp::DATE AS date, city_id, metric_id, AVG(value) AS m, STDDEV_SAMP(value) AS d
           FROM fact_observation GROUP BY 1, 2, 3)
SELECT s.date, a.city_id, a.metric_id, ROUND(COUNT(DISTINCT a.timestamp) / 24, 9) AS completeness_ratio,
       ROUND(1 - COUNT(DISTINCT a.timestamp) / 24, 9) AS missing_ratio, 24 AS data_points_expected,
       CAST(COUNT(DISTINCT a.timestamp) AS INT) AS data_points_actual,
       CAST(COUNT(*) FILTER ({OUTSIDE}) AS INT) AS value_range_violations,
       CAST(COUNT(*) FILTER (abs(a.value - s.m) / nullif(s.d, 0) > 3) AS INT) AS sudden_jumps_count,
       TRUE AS is_monotonic
FROM air a JOIN s ON s.city_id = a.city_id AND s.metric_id = a.metric_id AND s.date = a.timestamp::DATE
GROUP BY 1, 2, 3""")(lambda t: Q.daily_quality_metrics(t, rules=RULES))

query("Q10_duplicate_keys", """
SELECT user_id, event_type, ts::DATE AS date, COUNT(*) AS copies FROM events GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")(
    lambda spark, folder: Q.duplicate_keys(
        eventlog.events(spark, folder).withColumn("date", F.to_date("ts")), ["user_id", "event_type", "date"]))

on_warehouse("A4_day_hours", """
SELECT city_name, metric_code, timestamp::DATE AS date, COUNT(DISTINCT date_trunc('hour', timestamp)) AS actual_hours
FROM air GROUP BY 1, 2, 3""")(lambda t: Q.day_hours(views.observations(t)))

on_warehouse("Q12_sparse_days", """
SELECT city_name, metric_code, timestamp::DATE AS date, COUNT(DISTINCT date_trunc('hour', timestamp)) AS actual_hours
FROM air GROUP BY 1, 2, 3 HAVING actual_hours < 20""")(lambda t: Q.sparse_days(views.observations(t)))


@query("Q13_schema_check", """
SELECT 'event_id' AS "column", TRUE AS present, TRUE AS type_ok, COUNT(*) FILTER (event_id IS NULL) AS nulls, TRUE AS nullable_ok FROM events
UNION ALL SELECT 'value', TRUE, FALSE, COUNT(*) FILTER (value IS NULL), TRUE FROM events
UNION ALL SELECT 'absent', FALSE, FALSE, NULL, FALSE""")
def schema_check(spark, folder):
    expected = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("value", T.StringType()),
                             T.StructField("absent", T.StringType(), False)])
    return Q.schema_check(eventlog.events(spark, folder), expected)


# Parts that are no customers' keys, and suppliers' keys that are no nations': real gaps between whole tables.
@query("Q14_orphans", """
SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS key, COUNT(*) AS rows FROM lineitem
WHERE l_partkey NOT IN (SELECT c_custkey FROM customer) GROUP BY l_partkey
UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), COUNT(*) FROM lineitem
WHERE l_suppkey NOT IN (SELECT n_nationkey FROM nation) GROUP BY l_suppkey""")
def orphans(spark, folder):
    def read(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")
    dims = {"l_partkey": read("customer").select(F.col("c_custkey").alias("l_partkey")),
            "l_suppkey": read("nation").select(F.col("n_nationkey").alias("l_suppkey"))}
    return Q.orphans(read("lineitem"), dims)
