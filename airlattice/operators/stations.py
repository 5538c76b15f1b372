"""Stations near cities, what they measure, and a choice that covers the wanted metrics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.values import haversine_m
from airlattice.operators.reshape import top_per_group


def stations_near(cities: DataFrame, stations: DataFrame, radius_m: float = C.MAX_RADIUS_M,
                  k: int | None = None) -> DataFrame:
    """The stations within the radius of each city, or with ``k`` the nearest of them.

    The globe is cut into cells no smaller than the radius. A city asks the cells its
    circle can reach (more of them sideways near the poles, wrapping at the date line),
    which makes the distance test an equi-join on the cell.
    """
    radius = float(radius_m)
    reach = min(math.degrees(radius / C.EARTH_RADIUS_M), 180.0)
    columns = max(1, int(360 // reach)) if reach > 0 else 1
    cell = 360.0 / columns

    def row(lat):
        return F.floor((lat + 90.0) / cell)

    def column(lon):
        return F.pmod(F.floor((lon + 180.0) / cell), F.lit(columns))

    sine = math.sin(math.radians(reach))
    cosine = F.cos(F.radians("c_lat"))
    sideways = F.when(cosine > sine, F.degrees(F.asin(F.lit(sine) / cosine))).otherwise(180.0)
    steps = F.least(F.ceil(sideways / cell).cast("int"), F.lit(columns // 2 + 1))
    asked = (cities.select("city_name", F.col("latitude").alias("c_lat"), F.col("longitude").alias("c_lon"))
             .withColumn("_dy", F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)])))
             .withColumn("_dx", F.explode(F.sequence(-steps, steps)))
             .select("city_name", "c_lat", "c_lon", (row(F.col("c_lat")) + F.col("_dy")).alias("_row"),
                     F.pmod(column(F.col("c_lon")) + F.col("_dx"), F.lit(columns)).alias("_col"))
             .distinct())
    placed = (stations.withColumn("_row", row(F.col("latitude"))).withColumn("_col", column(F.col("longitude"))))
    near = (placed.join(asked, ["_row", "_col"])
            .withColumn("distance_m", haversine_m("c_lat", "c_lon", "latitude", "longitude"))
            .filter(F.col("distance_m") <= radius).drop("_row", "_col", "c_lat", "c_lon"))
    return near if k is None else top_per_group(near, ["city_name"], ["distance_m", "location_id"], k)


def location_coverage(sensors: DataFrame, wanted=None, keys=("city_name", "location_id"),
                      rank: str = "rank") -> DataFrame:
    """Wanted parameters of each location, with the location's rank.

    Only wanted parameters enter the set, so it never outgrows the wanted list.
    """
    wanted = list(wanted or C.REQUESTED_METRICS)
    return (sensors.filter(F.col("parameter").isin(wanted)).groupBy(*keys)
            .agg(F.sort_array(F.collect_set("parameter")).alias("parameters"), F.min(rank).alias(rank)))


def city_coverage(coverage: DataFrame, wanted=None, key: str = "city_name") -> DataFrame:
    """Found and missing parameters per city."""
    wanted = F.array(*[F.lit(p) for p in (wanted or C.REQUESTED_METRICS)])
    found = (coverage.select(key, F.explode("parameters").alias("_p")).groupBy(key)
             .agg(F.sort_array(F.collect_set("_p")).alias("found")))
    return found.withColumn("missing", F.sort_array(F.array_except(wanted, "found")))


def _best_per_set(coverage: DataFrame, key: str, rank: str) -> DataFrame:
    """The best-ranked location per city and parameter set.

    A later location with the same set can add nothing, so dropping it changes no choice
    and leaves at most 2^|wanted| candidates in a city.
    """
    return (coverage.groupBy(key, "parameters")
            .agg(F.min(F.struct(F.col(rank).alias("rank"), "location_id")).alias("_best"))
            .select(key, "parameters", "_best.rank", "_best.location_id"))


def select_stations(coverage: DataFrame, wanted=None, key: str = "city_name", rank: str = "rank") -> DataFrame:
    """Locations that cover the wanted parameters of each city, in the order chosen.

    One location that has everything wins by rank. Otherwise locations are taken in the
    fixed order of their initial overlap (then rank) while they still add something.
    """
    wanted = list(wanted or C.REQUESTED_METRICS)
    need = F.array(*[F.lit(p) for p in wanted])
    relevant = (coverage.withColumn("parameters", F.sort_array(F.array_intersect("parameters", need)))
                .filter(F.size("parameters") > 0))
    ordered = F.array_sort(F.collect_list(F.struct(
        (-F.size("parameters")).alias("order"), "rank", "location_id", "parameters"))).alias("candidates")
    grouped = _best_per_set(relevant, key, rank).groupBy(key).agg(ordered)
    start = F.struct(need.alias("remaining"),
                     F.array().cast("array<struct<location_id:string,adds:array<string>>>").alias("chosen"))

    def take(state, c):
        adds = F.array_intersect(state["remaining"], c["parameters"])
        pick = F.struct(c["location_id"].cast("string").alias("location_id"), adds.alias("adds"))
        return F.when(F.size(adds) > 0, F.struct(
            F.array_except(state["remaining"], c["parameters"]).alias("remaining"),
            F.concat(state["chosen"], F.array(pick)).alias("chosen"))).otherwise(state)

    return (grouped.select(key, F.aggregate("candidates", start, take).alias("s"))
            .select(key, F.posexplode("s.chosen").alias("position", "pick"), F.col("s.remaining").alias("missing"))
            .select(key, "position", "pick.location_id", "pick.adds", "missing"))


def fill_coverage(coverage: DataFrame, candidates: DataFrame, wanted=None, key: str = "city_name",
                  rank: str = "rank") -> DataFrame:
    """Coverage plus the further locations that supply parameters a city still lacks.

    Candidates are visited by rank; a location joins with just the parameters that were
    still missing when it was visited.
    """
    wanted = list(wanted or C.REQUESTED_METRICS)
    need = F.array(*[F.lit(p) for p in wanted])
    lacking = city_coverage(coverage, wanted, key).select(key, "missing")
    unseen = candidates.join(coverage.select(key, "location_id"), [key, "location_id"], "left_anti")
    useful = (unseen.join(lacking, key, "left")
              .withColumn("missing", F.coalesce("missing", need))
              .withColumn("parameters", F.sort_array(F.array_intersect("parameters", F.col("missing"))))
              .filter(F.size("parameters") > 0))
    best = _best_per_set(useful.drop("missing"), key, rank)
    grouped = (best.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct("rank", "location_id", "parameters"))).alias("candidates"))
        .join(lacking, key, "left").withColumn("missing", F.coalesce("missing", need)))
    start = F.struct(F.col("missing").alias("remaining"), F.array().cast(
        "array<struct<location_id:string,parameters:array<string>,rank:bigint>>").alias("added"))

    def visit(state, c):
        gives = F.array_intersect(c["parameters"], state["remaining"])
        entry = F.struct(c["location_id"].cast("string").alias("location_id"), gives.alias("parameters"),
                         c["rank"].cast("bigint").alias("rank"))
        return F.when(F.size(gives) > 0, F.struct(
            F.array_except(state["remaining"], gives).alias("remaining"),
            F.concat(state["added"], F.array(entry)).alias("added"))).otherwise(state)

    added = (grouped.select(key, F.inline(F.aggregate("candidates", start, visit)["added"])))
    return coverage.select(key, "location_id", "parameters", F.col(rank).cast("bigint").alias("rank")).unionByName(
        added.select(key, "location_id", F.sort_array("parameters").alias("parameters"), "rank"))
