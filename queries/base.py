"""Registration, output normalisation and the SQL form of the star schema."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice.sources.eventlog import event_warehouse
from airlattice.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31"
PM = "('pm25','pm10','no2','o3')"


def with_scratch(spark: SparkSession) -> SparkSession:
    """A session with a scratch folder: the given one, and only where Spark runs in one process a private one."""
    sc = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="queries-"))
    return spark


def finish(df: DataFrame) -> DataFrame:
    """Comparable types: times without zone, doubles and decimals as doubles of nine digits."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), 9)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a query; its function gets (spark, folder)."""
    def register(make):
        def run(spark, folder):
            return finish(make(with_scratch(use_utc(spark)), folder))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return make
    return register


def on_warehouse(name: str, sql: str | None = None):
    """Register a query over the star schema; its function gets the tables."""
    def register(make):
        query(name, sql)(lambda spark, folder: make(event_warehouse(spark, folder)))
        return make
    return register


TABLES = {
    "station_events": """
        SELECT e.event_id, e.ts, e.user_id, n.n_regionkey AS city_id, e.value, e.event_type, e.props,
               CASE e.event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
                                 WHEN 'error' THEN 4 END AS metric_id
        FROM events e JOIN customer c ON e.user_id = c.c_custkey
                      JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "dim_city": """
        SELECT r_regionkey AS city_id, r_name AS city_name, substr(r_name, 1, 2) AS country,
               r_regionkey * 10.0::DOUBLE AS latitude, r_regionkey * 20.0::DOUBLE - 40.0 AS longitude
        FROM region""",
    "dim_metric": """
        SELECT * FROM (VALUES (1, 'pm25', 'PM2.5', 'µg/m³'), (2, 'pm10', 'PM10', 'µg/m³'),
            (3, 'no2', 'Nitrogen Dioxide', 'µg/m³'), (4, 'o3', 'Ozone', 'µg/m³'),
            (5, 'co', 'Carbon Monoxide', 'µg/m³'), (6, 'so2', 'Sulfur Dioxide', 'µg/m³'))
            m(metric_id, metric_code, metric_name, unit)""",
    "fact_observation": """
        SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, city_id, metric_id,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS value,
               CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS value_ug_m3,
               CAST(COUNT(*) AS INT) AS station_count,
               CAST(arg_min(user_id % 90, ts) AS DOUBLE) AS latitude,
               CAST(arg_min(user_id % 180, ts) AS DOUBLE) AS longitude,
               CAST(arg_min(user_id, ts) AS VARCHAR) AS location_id,
               'Station ' || CAST(arg_min(user_id, ts) AS VARCHAR) AS location_name
        FROM station_events WHERE event_type <> 'signup' GROUP BY 1, 2, 3""",
    "fact_weather": """
        SELECT timestamp, city_id, v / n AS temperature_c, k / n AS humidity_percent,
               v / 100 AS precipitation_mm, v / n / 10 AS wind_speed_ms, (v / n) % 360 AS wind_direction_deg,
               city_id * 10.0::DOUBLE AS latitude, city_id * 20.0::DOUBLE - 40.0 AS longitude
        FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, city_id,
                     CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v, COUNT(*) AS n,
                     CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) AS k
              FROM station_events WHERE event_type = 'signup' GROUP BY 1, 2)""",
    "air": """
        SELECT f.*, c.city_name, c.country, m.metric_code, m.metric_name, m.unit
        FROM fact_observation f JOIN dim_city c USING (city_id) JOIN dim_metric m USING (metric_id)""",
    "sky": "SELECT w.*, c.city_name, c.country FROM fact_weather w JOIN dim_city c USING (city_id)",
    "limits": """
        SELECT * FROM (VALUES ('pm25', 15, 25), ('pm10', 30, 50), ('no2', 100, 200), ('o3', 120, 180))
            l(metric_code, moderate, high)""",
    "risk": """
        SELECT a.timestamp::DATE AS date, CAST(hour(a.timestamp) AS INT) AS hour, a.city_name, a.metric_code,
               a.value_ug_m3, CASE WHEN a.value_ug_m3 > l.high THEN 'HIGH'
                                   WHEN a.value_ug_m3 > l.moderate THEN 'MODERATE' ELSE 'LOW' END AS risk_level,
               w.temperature_c, w.wind_speed_ms, w.precipitation_mm
        FROM air a LEFT JOIN limits l USING (metric_code)
                   LEFT JOIN fact_weather w ON w.city_id = a.city_id AND w.timestamp = a.timestamp""",
    "exceeding": """
        SELECT a.timestamp::DATE AS date, a.city_name, a.metric_code,
               SUM(CASE WHEN a.value_ug_m3 > l.high THEN 1 ELSE 0 END)::BIGINT AS exceedance_hours,
               MAX(a.value_ug_m3) AS max_value, AVG(a.value_ug_m3) AS avg_value
        FROM air a LEFT JOIN limits l USING (metric_code) GROUP BY ALL""",
    "air_sky": """
        SELECT COALESCE(a.timestamp, w.timestamp) AS timestamp, COALESCE(a.city_name, w.city_name) AS city_name,
               COALESCE(a.country, w.country) AS country, a.metric_code, a.metric_name, a.value_ug_m3,
               w.temperature_c, w.humidity_percent, w.precipitation_mm, w.wind_speed_ms, w.wind_direction_deg
        FROM air a FULL JOIN sky w ON a.timestamp = w.timestamp AND a.city_name = w.city_name""",
    "pm": """
        SELECT a.city_name, a.timestamp, a.value_ug_m3 AS pm25, w.temperature_c, w.humidity_percent,
               w.precipitation_mm, w.wind_speed_ms, w.wind_direction_deg, p.value_ug_m3 AS pm10
        FROM air a LEFT JOIN fact_weather w ON w.city_id = a.city_id
                     AND w.timestamp::DATE = a.timestamp::DATE AND hour(w.timestamp) = hour(a.timestamp)
                   LEFT JOIN fact_observation p ON p.city_id = a.city_id AND p.timestamp = a.timestamp
                     AND p.metric_id = 2
        WHERE a.metric_id = 1""",
}


def with_tables(sql: str) -> str:
    """Prefix a SELECT with the tables it names, directly or through other tables."""
    text = sql.strip()
    wanted: list[str] = []
    frontier = text
    for name in reversed(TABLES):
        if _names(frontier, name):
            wanted.insert(0, name)
            frontier += " " + TABLES[name]
    if not wanted:
        return text
    recursive = "RECURSIVE " if text.upper().startswith("WITH RECURSIVE") else ""
    head = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in wanted)
    if text.upper().startswith("WITH"):
        body = text[len("WITH RECURSIVE" if recursive else "WITH"):].strip()
        return f"WITH {recursive}{head},\n{body}"
    return f"WITH {head}\n{text}"


def _names(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b(?:FROM|JOIN)\s+{name}\b|,\s*{name}\b", text) is not None


def nine(*columns: str) -> str:
    """Columns rounded to nine digits."""
    return ", ".join(f"ROUND(CAST({c} AS DOUBLE), 9) AS {c}" for c in columns)


SKY = ["temperature_c", "humidity_percent", "precipitation_mm", "wind_speed_ms", "wind_direction_deg"]
