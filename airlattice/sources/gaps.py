"""Seeded removal of observations, to exercise the completeness reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlattice.functions.times import ago
from airlattice.operators.scope import last
from airlattice.operators.windows import position_in_series
from airlattice.tables import Warehouse, lookup

KEY = ["city_id", "metric_id", "timestamp"]


def draw(seed) -> Column:
    """A repeatable random-looking order of fact rows."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), "city_id", "metric_id",
                             F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")))


def rows_to_drop(t: Warehouse, profile: DataFrame, as_of, seed=42, interval: str = "7 days") -> DataFrame:
    """Keys of the ``int(n * pct / 100)`` rows drawn in each series of the profile.

    A series is ranked by digest prefix, so even one very long series is spread out.
    """
    ids = (profile.join(t.dim_city.select("city_id", "city_name"), "city_name")
           .join(t.dim_metric.select("metric_id", "metric_code"), "metric_code")
           .select("city_id", "metric_id", "pct"))
    series = ["city_id", "metric_id"]
    recent = (last(t.fact_observation, interval, as_of).select(*KEY)
              .join(ids.select(*series), series, "left_semi").withColumn("_draw", draw(seed)))
    size = (recent.groupBy(*series).agg(F.count(F.lit(1)).alias("_n")).join(ids, series)
            .select(*series, F.floor(F.col("_n") * (F.col("pct") / 100.0)).alias("_k")))
    ranked = position_in_series(recent, series, ["_draw", "timestamp"], F.substring("_draw", 1, 3), "_position")
    return lookup(ranked, size, series).filter(F.col("_position") < F.col("_k")).select(*KEY)


def inject_gap_profile(t: Warehouse, profile: DataFrame, as_of, seed=42, interval: str = "7 days") -> DataFrame:
    """The observation fact without the drawn rows of every series in the profile."""
    return t.fact_observation.join(rows_to_drop(t, profile, as_of, seed, interval), KEY, "left_anti")


def inject_gaps(t: Warehouse, city: str, metric: str, pct: float, as_of, seed=42,
                interval: str = "7 days") -> DataFrame:
    """The observation fact with ``pct`` percent of one recent series removed."""
    profile = t.dim_city.filter(F.col("city_name") == city).select(
        "city_name", F.lit(metric).alias("metric_code"), F.lit(float(pct)).alias("pct")).distinct()
    return inject_gap_profile(t, profile, as_of, seed, interval)


def drop_hours(t: Warehouse, city: str, metric: str, hours, as_of, interval: str = "3 days") -> DataFrame:
    """The observation fact without the given hours of the day in one recent series."""
    named = (t.fact_observation
             .join(t.dim_city.select("city_id", "city_name"), "city_id", "left")
             .join(t.dim_metric.select("metric_id", "metric_code"), "metric_id", "left"))
    hit = ((F.col("city_name") == city) & (F.col("metric_code") == metric)
           & (F.col("timestamp") >= ago(as_of, interval)) & F.hour("timestamp").isin(list(hours)))
    return named.filter(~F.coalesce(hit, F.lit(False))).select(*t.fact_observation.columns)
