"""Station search and selection. Customers stand for stations, regions for cities."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.operators import stations as S
from airlattice.sources import eventlog
from queries.base import query

# A station's place is spread around its region's centre by its key; its sensors are
# the wanted metrics whose divisor fits the key.
DIVISORS = {"no2": 3, "o3": 5, "pm10": 7, "pm25": 11}


def placed_stations(spark, folder):
    key = F.col("c_custkey")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    centre = F.col("n_regionkey")
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .select(key.alias("location_id"),
                    (centre * 10.0 + ((key * 37) % 1000) / 1000.0 - 0.5).alias("latitude"),
                    (centre * 20.0 - 40.0 + ((key * 91) % 1000) / 1000.0 - 0.5).alias("longitude")))


PLACED = """placed AS (
  SELECT c_custkey AS location_id, n_regionkey * 10.0::DOUBLE + ((c_custkey * 37) % 1000) / 1000.0 - 0.5 AS latitude,
         n_regionkey * 20.0::DOUBLE - 40.0 + ((c_custkey * 91) % 1000) / 1000.0 - 0.5 AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
near AS (
  SELECT c.city_name, p.location_id, 2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(p.latitude - c.latitude) / 2), 2)
           + cos(radians(c.latitude)) * cos(radians(p.latitude)) * pow(sin(radians(p.longitude - c.longitude) / 2), 2)))) AS distance_m
  FROM placed p, dim_city c),
ranked AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY distance_m, location_id) AS INT) AS rank
           FROM near WHERE distance_m <= 40000)"""


def near(spark, folder, k):
    found = S.stations_near(eventlog.dim_city(spark, folder), placed_stations(spark, folder), 40_000, k)
    return found.withColumn("distance_m", F.round("distance_m", 3)).select(
        "city_name", "location_id", "distance_m", *(["rank"] if k else []))


query("J11_stations_near", f"""
WITH {PLACED} SELECT city_name, location_id, ROUND(distance_m, 3) AS distance_m, rank FROM ranked WHERE rank <= 5""")(
    lambda spark, folder: near(spark, folder, 5))

query("J11_all_stations_in_radius", f"""
WITH {PLACED} SELECT city_name, location_id, ROUND(distance_m, 3) AS distance_m FROM ranked""")(
    lambda spark, folder: near(spark, folder, None))

query("T5_top_k_stations", f"""
WITH {PLACED} SELECT city_name, location_id, ROUND(distance_m, 3) AS distance_m, rank FROM ranked WHERE rank <= 20""")(
    lambda spark, folder: near(spark, folder, 20))


def sensors(spark, folder):
    """Every station with its sensors, one row each, ranked by key within its region."""
    key = F.col("c_custkey")
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = eventlog.dim_city(spark, folder).select("city_id", "city_name")
    fits = F.array_compact(F.array(*[F.when(key % d == 0, m) for m, d in DIVISORS.items()], F.lit("co")))
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, F.col("n_regionkey") == F.col("city_id"))
            .select("city_name", key.alias("location_id"), key.alias("rank"), F.explode(fits).alias("parameter")))


def texts(df):
    """Arrays as text, so that any engine compares them alike."""
    return df.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


COVERAGE = """coverage AS (
  SELECT r_name AS city_name, c_custkey AS location_id, c_custkey AS rank,
         list_filter([CASE WHEN c_custkey % 3 = 0 THEN 'no2' END, CASE WHEN c_custkey % 5 = 0 THEN 'o3' END,
                      CASE WHEN c_custkey % 7 = 0 THEN 'pm10' END, CASE WHEN c_custkey % 11 = 0 THEN 'pm25' END],
                     lambda x: x IS NOT NULL) AS parameters
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

query("A21_location_coverage", f"""
WITH {COVERAGE} SELECT city_name, location_id, rank, array_to_string(parameters, ',') AS parameters
FROM coverage WHERE len(parameters) > 0""")(
    lambda spark, folder: texts(S.location_coverage(sensors(spark, folder))))


def small_coverage(spark, folder):
    """Only the stations whose key is divisible by neither 7 nor 11: pm10 and pm25 lack."""
    everything = S.location_coverage(sensors(spark, folder))
    return everything.filter("location_id % 7 <> 0 AND location_id % 11 <> 0")


# No station measures so2, so it lacks everywhere and no station covers all.
WITH_SO2 = [*C.REQUESTED_METRICS, "so2"]

query("A21_city_coverage", f"""
WITH {COVERAGE} SELECT city_name, array_to_string(list_sort(list_distinct(flatten(list(parameters)))), ',') AS found,
  array_to_string(list_filter(['no2','o3','pm10','pm25','so2'], lambda x: NOT list_contains(flatten(list(parameters)), x)), ',') AS missing
FROM coverage WHERE len(parameters) > 0 GROUP BY 1""")(
    lambda spark, folder: texts(S.city_coverage(S.location_coverage(sensors(spark, folder), WITH_SO2), WITH_SO2)))


def greedy_sql(source: str) -> str:
    return f"""
WITH RECURSIVE {COVERAGE},
ordered AS (SELECT city_name, location_id, parameters,
                   ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY -len(parameters), rank, location_id) AS i
            FROM coverage WHERE len(parameters) > 0 {source}),
walk AS (SELECT DISTINCT city_name, 0::BIGINT AS i, ['no2','o3','pm10','pm25'] AS remaining,
                NULL::BIGINT AS location_id, []::VARCHAR[] AS adds FROM ordered
         UNION ALL
         SELECT w.city_name, o.i, list_filter(w.remaining, lambda x: NOT list_contains(o.parameters, x)),
                o.location_id, list_filter(w.remaining, lambda x: list_contains(o.parameters, x))
         FROM walk w JOIN ordered o ON o.city_name = w.city_name AND o.i = w.i + 1)
SELECT city_name, CAST(ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY i) - 1 AS INT) AS position,
       CAST(location_id AS VARCHAR) AS location_id, array_to_string(adds, ',') AS adds
FROM walk WHERE len(adds) > 0"""


def chosen(coverage, wanted=None):
    picks = S.select_stations(coverage, wanted)
    return texts(picks.withColumn("adds", F.sort_array("adds")).drop("missing"))


query("A22_select_stations", greedy_sql("").replace("'pm25'] AS remaining", "'pm25','so2'] AS remaining"))(
    lambda spark, folder: chosen(S.location_coverage(sensors(spark, folder), WITH_SO2), WITH_SO2))

query("A22_single_station_covers_all", greedy_sql(""))(
    lambda spark, folder: chosen(S.location_coverage(sensors(spark, folder))))


@query("A23_fill_coverage", f"""
WITH RECURSIVE {COVERAGE},
ordered AS (SELECT city_name, location_id, parameters,
                   ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY rank, location_id) AS i
            FROM coverage WHERE len(parameters) > 0 AND (location_id % 7 = 0 OR location_id % 11 = 0)),
walk AS (SELECT DISTINCT city_name, 0::BIGINT AS i, ['pm10','pm25'] AS remaining,
                NULL::BIGINT AS location_id, []::VARCHAR[] AS adds FROM ordered
         UNION ALL
         SELECT w.city_name, o.i, list_filter(w.remaining, lambda x: NOT list_contains(o.parameters, x)),
                o.location_id, list_filter(w.remaining, lambda x: list_contains(o.parameters, x))
         FROM walk w JOIN ordered o ON o.city_name = w.city_name AND o.i = w.i + 1)
SELECT city_name, location_id, array_to_string(adds, ',') AS parameters FROM walk WHERE len(adds) > 0
UNION ALL SELECT city_name, location_id, array_to_string(parameters, ',') FROM coverage
WHERE len(parameters) > 0 AND location_id % 7 <> 0 AND location_id % 11 <> 0""")
def filled(spark, folder):
    everything = S.location_coverage(sensors(spark, folder))
    out = S.fill_coverage(small_coverage(spark, folder), everything, C.REQUESTED_METRICS)
    return texts(out.select("city_name", F.col("location_id").cast("bigint").alias("location_id"), "parameters"))
