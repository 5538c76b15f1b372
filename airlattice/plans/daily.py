"""Stored day profiles: what a day of a series adds to counts, hours, moments and co-moments.

A profile row is mergeable: counts and sums add up, hours are 24-bit masks joined by OR, means and squared deviations
merge by the parallel variance formula, distinct locations by a union of sketches. A report over any range of whole days
merges profile rows and reads no facts. A load replaces the profiles of the days it touches and no others.

``observation`` profiles have a row per (date, city_id, metric_id); ``joint`` profiles, of observations next to the
weather of the same time and city name, one per (date, city_name, metric_code).
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlattice.functions.values import exceeds_limit
from airlattice.operators.quality import hour_mask
from airlattice.operators.stats import CORRELATED
from airlattice.plans import views as V
from airlattice.session import stored
from airlattice.tables import Warehouse, load_warehouse, table_path

VALUE = "value_ug_m3"
OBSERVATION, JOINT = "daily_observation", "daily_joint"
PAIRS = list(combinations_with_replacement(CORRELATED, 2))


def observation_profile(t: Warehouse) -> DataFrame:
    """(date, city_id, metric_id) with rows, hours, first and last time, moments of the value and distinct places."""
    rows = t.fact_observation.join(t.dim_metric.select("metric_id", "metric_code"), "metric_id", "left")
    v = F.col(VALUE)
    return rows.groupBy(F.to_date("timestamp").alias("date"), "city_id", "metric_id").agg(
        F.count(F.lit(1)).alias("rows"), hour_mask("timestamp").alias("hours"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
        F.count(v).alias("n"), F.sum(v).alias("sum"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.count_if(exceeds_limit("metric_code", VALUE)).alias("over"),
        F.sum("station_count").alias("stations"), F.count("station_count").alias("stations_n"),
        F.hll_sketch_agg("location_id").alias("places"))


def joint_profile(t: Warehouse) -> DataFrame:
    """(date, city_name, metric_code, pairs): for each two columns their count, means, squared and cross deviations."""
    rows = V.v_observations_weather(t).filter("metric_code IS NOT NULL")
    cells = []
    for x, y in PAIRS:
        fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
        gx, gy = F.when(fy.isNotNull(), fx), F.when(fx.isNotNull(), fy)
        n = F.count(F.when(fy.isNotNull(), fx))
        cells.append(F.struct(
            F.lit(x).alias("x"), F.lit(y).alias("y"), n.alias("n"), F.avg(gx).alias("mx"), F.avg(gy).alias("my"),
            (F.var_pop(gx) * n).alias("sxx"), (F.var_pop(gy) * n).alias("syy"), (F.covar_pop(fx, fy) * n).alias("sxy"),
            F.min(gx).alias("x_min"), F.max(gx).alias("x_max"), F.min(gy).alias("y_min"), F.max(gy).alias("y_max")))
    return rows.groupBy(F.to_date("timestamp").alias("date"), "city_name", "metric_code").agg(F.array(*cells).alias("pairs"))


def with_profiles(t: Warehouse) -> Warehouse:
    """The warehouse with both profiles of all its days, stored in the scratch folder."""
    return t.but(daily=stored(observation_profile(t)), joint=stored(joint_profile(t)))


def refresh_profiles(spark: SparkSession, root: str, *batches: DataFrame) -> None:
    """Profiles of the days that the batches touch, from all facts of those days, in place of the earlier ones."""
    from airlattice.sources.sinks import stored_days
    t = load_warehouse(spark, root)
    days = None
    for batch in batches:
        own = batch.select(F.to_date("timestamp").alias("event_date"))
        days = own if days is None else days.unionByName(own)
    days = stored(days.distinct())
    touched = t.but(fact_observation=stored_days(t.fact_observation, days), fact_weather=stored_days(t.fact_weather, days))
    for name, rows in ((OBSERVATION, observation_profile(touched)), (JOINT, joint_profile(touched))):
        (rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date").parquet(table_path(root, name)))


def load_profiled(spark: SparkSession, root: str) -> Warehouse:
    """The stored tables with their profiles."""
    read = lambda name: spark.read.parquet(table_path(root, name))
    return load_warehouse(spark, root).but(daily=read(OBSERVATION), joint=read(JOINT))


def _merged(n: str, x: str, sxx: str, y: str | None = None) -> Column:
    """Squared (or cross) deviations of all rows from those of each day. What rounding leaves of equal values is 0."""
    y = y or x
    total = F.sum(n)
    between = F.sum(F.col(n) * F.col(x) * F.col(y)) - F.try_divide(F.sum(F.col(n) * F.col(x)) * F.sum(F.col(n) * F.col(y)), total)
    whole = F.sum(sxx) + between
    return F.when(F.abs(whole) <= 1e-13 * F.sum(F.col(n) * F.abs(F.col(x) * F.col(y))), 0.0).otherwise(whole)


def moments(t: Warehouse, by) -> DataFrame:
    """(by, _n, _mean, _std): sample moments of the observed value, merged from the days."""
    return (t.daily.groupBy(*by).agg(F.sum("n").alias("_n"), F.try_divide(F.sum("sum"), F.sum("n")).alias("_mean"), _merged("n", "mean", "m2").alias("_m2"))
            .select(*by, "_n", "_mean", F.when(F.col("_n") > 1, F.sqrt(F.greatest(F.col("_m2"), F.lit(0.0)) / (F.col("_n") - 1))).alias("_std")))


def _pairs(t: Warehouse, by) -> DataFrame:
    """(by, x, y) with merged counts, means and deviations."""
    cells = t.joint.select(*by, F.inline("pairs")).filter("n > 0")
    total = F.sum("n")
    return cells.groupBy(*by, "x", "y").agg(
        total.alias("n"), (F.sum(F.col("n") * F.col("mx")) / total).alias("mx"), (F.sum(F.col("n") * F.col("my")) / total).alias("my"),
        _merged("n", "mx", "sxx").alias("sxx"), _merged("n", "my", "syy").alias("syy"), _merged("n", "mx", "sxy", "my").alias("sxy"),
        *[f(c).alias(c) for c, f in (("x_min", F.min), ("x_max", F.max), ("y_min", F.min), ("y_max", F.max))])


def correlations(t: Warehouse, by=("metric_code",)) -> DataFrame:
    """Pearson matrix as (by, x, y, r) from joint profiles; a column without variance, or without pairs, gives NULL."""
    by = list(by)
    spread = F.sqrt(F.col("sxx")) * F.sqrt(F.col("syy"))
    r = _pairs(t, by).select(*by, "x", "y", F.try_divide("sxy", spread).alias("r"))
    cells = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in PAIRS])
    every = t.joint.select(*by).distinct().select(*by, F.inline(cells)).join(r, [*by, "x", "y"], "left")
    mirrored = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return every.select(*by, "r", F.inline(mirrored)).select(*by, "x", "y", "r")


def trends(t: Warehouse, xs, by=("metric_code",)) -> DataFrame:
    """Least-squares lines of the observed value on weather columns from joint profiles, as ``linear_trends`` gives."""
    by = list(by)
    # The observed value is the first column of every pair it is in, so it is x there and the regressor is y.
    lines = _pairs(t, by).filter((F.col("x") == VALUE) & F.col("y").isin(list(xs)) & (F.col("n") > 1))
    slope = F.try_divide("sxy", "syy")
    return lines.select(*by, F.col("y").alias("x_name"), slope.alias("slope"), (F.col("mx") - slope * F.col("my")).alias("intercept"),
                        F.col("n").alias("pairs"), F.col("y_min").alias("x_min"), F.col("y_max").alias("x_max"))
