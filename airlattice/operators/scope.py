"""Filters and small projections shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import ago
from airlattice.functions.values import coordinates_valid


def scope(df: DataFrame, cities=None, metrics=None, start=None, end=None,
          on: str = "timestamp", inclusive_midnight: bool = False,
          city: str = "city_name", metric: str = "metric_code") -> DataFrame:
    """Rows of the chosen cities, metrics and closed time range.

    On a time column an ``end`` date covers that whole day; ``inclusive_midnight``
    compares it as midnight instead. A matching filter on ``event_date`` is added where
    the frame has that column, so stored folders are pruned.
    """
    if cities is not None:
        df = df.filter(F.col(city).isin(list(cities)))
    if metrics is not None and metric in df.columns:
        df = df.filter(F.col(metric).isin(list(metrics)))
    stored_by_day = on != "event_date" and "event_date" in df.columns
    if start is not None:
        lower = F.lit(str(start)).cast("date" if on == "date" else "timestamp")
        df = df.filter(F.col(on) >= lower)
        if stored_by_day:
            df = df.filter(F.col("event_date") >= F.to_date(F.lit(str(start))))
    if end is not None:
        text = str(end)
        if on == "date":
            df = df.filter(F.col(on) <= F.lit(text).cast("date"))
        elif len(text) <= 10 and not inclusive_midnight:
            df = df.filter(F.col(on) < F.date_add(F.lit(text).cast("date"), 1).cast("timestamp"))
        else:
            df = df.filter(F.col(on) <= F.lit(text).cast("timestamp"))
        if stored_by_day:
            df = df.filter(F.col("event_date") <= F.to_date(F.lit(text)))
    return df


def between(df: DataFrame, lower: Column | None = None, upper: Column | None = None, closed: bool = False,
            ts: str = "timestamp") -> DataFrame:
    """Rows from ``lower`` on and before ``upper`` (``closed``: up to it).

    Where the frame is stored by ``event_date`` its days are limited too, so that other
    folders are not read.
    """
    by_day = "event_date" in df.columns
    if lower is not None:
        df = df.filter(F.col(ts) >= lower)
        df = df.filter(F.col("event_date") >= F.to_date(lower)) if by_day else df
    if upper is not None:
        df = df.filter(F.col(ts) <= upper if closed else F.col(ts) < upper)
        df = df.filter(F.col("event_date") <= F.to_date(upper)) if by_day else df
    return df


def last(df: DataFrame, interval: str, as_of, ts: str = "timestamp", until: bool = False) -> DataFrame:
    """Rows from ``interval`` before ``as_of`` on; with ``until`` only those before it."""
    return between(df, ago(as_of, interval), F.lit(as_of).cast("timestamp") if until else None, ts=ts)


def keep_metrics(df: DataFrame, allow=None, deny=None, metric: str = "metric_code") -> DataFrame:
    name = F.lower(F.col(metric))
    if allow is not None:
        df = df.filter(name.isin([m.lower() for m in allow]))
    if deny is not None:
        df = df.filter(~name.isin([m.lower() for m in deny]))
    return df


def select_cities(cities: DataFrame, names) -> DataFrame:
    """Cities by name in any case; names that are not stored are left out."""
    return cities.filter(F.lower("city_name").isin([n.lower() for n in names]))


def list_active_cities(stored: DataFrame, active) -> DataFrame:
    """Distinct stored names that are also active, sorted."""
    return stored.filter(F.col("city_name").isin(list(active))).select("city_name").distinct().orderBy("city_name")


def list_metrics(metrics: DataFrame) -> DataFrame:
    """Offered metrics, sorted by code."""
    return (keep_metrics(metrics, deny=C.HIDDEN_METRICS)
            .select("metric_code", "metric_name").orderBy("metric_code"))


def valid_coordinates(df: DataFrame, lat="latitude", lon="longitude") -> tuple[DataFrame, DataFrame]:
    """(rows with usable coordinates, the others)."""
    ok = coordinates_valid(lat, lon)
    return df.filter(ok), df.filter(~ok)


def drop_missing(df: DataFrame, columns) -> DataFrame:
    return df.na.drop(subset=list(columns))
