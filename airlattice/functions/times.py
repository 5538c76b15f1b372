"""Time expressions. Text without an offset is UTC; the session clock is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def normalize_timestamp(value, zone: str | Column | None = None) -> Column:
    """Text or time to an instant; NULL when unreadable. With ``zone``, its wall clock."""
    instant = F.try_to_timestamp(col(value))
    if zone is None:
        return instant
    return F.from_utc_timestamp(instant, zone)


def naive_in_zone(value, zone: str | Column) -> Column:
    """Text without an offset, written in ``zone``, to an instant."""
    return F.to_utc_timestamp(F.try_to_timestamp(col(value)), zone)


def hour_floor(ts) -> Column:
    return F.date_trunc("hour", col(ts))


def hours_between(start, end) -> Column:
    """Number of hourly steps from ``start`` to ``end``, both ends counted."""
    seconds = F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))
    return F.floor(seconds / 3600) + 1


def day_series(start, end) -> Column:
    """Every date from ``start`` to ``end`` as an array."""
    return F.sequence(F.to_date(col(start)), F.to_date(col(end)), F.expr("INTERVAL 1 DAY"))


def ago(as_of, interval: str) -> Column:
    """``as_of`` minus an interval such as ``7 days``."""
    return F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {interval}")


def date_bounds(as_of, days: int = 7, start=None, end=None) -> tuple[Column, Column]:
    """Explicit bounds where given, else the last ``days`` days up to ``as_of``."""
    upper = F.lit(end if end is not None else as_of).cast("timestamp")
    lower = F.lit(start).cast("timestamp") if start is not None else (
        upper - F.make_interval(days=F.lit(days)))
    return lower, upper
