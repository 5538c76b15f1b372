"""Unit, geometry, feature and clean-up expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import col


def to_ug_m3(value, unit) -> Column:
    """Concentration in micrograms per cubic metre; unknown units pass unchanged."""
    return F.when(F.lower(col(unit)) == "ppm", col(value) * C.PPM_FACTOR).otherwise(col(value))


def known_unit(unit) -> Column:
    return F.coalesce(F.lower(col(unit)).isin(C.MICROGRAM_UNITS + ["ppm"]), F.lit(False))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    half_lat = (p2 - p1) / 2
    half_lon = F.radians(col(lon2) - col(lon1)) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), 2)
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * C.EARTH_RADIUS_M)


def coordinates_valid(lat="latitude", lon="longitude") -> Column:
    return F.coalesce(col(lat).between(-90, 90) & col(lon).between(-180, 180), F.lit(False))


def in_range(value, low, high) -> Column:
    """Inside [low, high]; an open side is None. NULL stays NULL."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (col(value) >= low)
    if high is not None:
        ok = ok & (col(value) <= high)
    return ok


def metric_violation(metric, value, ranges=None) -> Column:
    """True where the value is outside its metric's range. NULLs are no violation."""
    hit = F.lit(False)
    for code, (low, high) in (ranges or C.VALUE_RANGES).items():
        hit = hit | ((col(metric) == code) & ~in_range(value, low, high))
    return F.coalesce(hit, F.lit(False))


def exceeds_limit(metric, value) -> Column:
    """True above the HIGH limit of the metric."""
    hit = F.lit(False)
    for code, (_, high) in C.RISK_LIMITS.items():
        hit = hit | ((col(metric) == code) & (col(value) > high))
    return F.coalesce(hit, F.lit(False))


def risk_level(metric, value) -> Column:
    """HIGH, MODERATE or LOW by strict limits; NULL values and other metrics are LOW."""
    level = None
    for code, (moderate, high) in C.RISK_LIMITS.items():
        for label, limit in (("HIGH", high), ("MODERATE", moderate)):
            test = (col(metric) == code) & (col(value) > limit)
            level = F.when(test, label) if level is None else level.when(test, label)
    return level.otherwise("LOW")


def cycle(value, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position in a cycle."""
    angle = col(value) * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def wind_vector(speed, direction) -> tuple[Column, Column]:
    angle = F.radians(col(direction))
    return col(speed) * F.cos(angle), col(speed) * F.sin(angle)


def finite(value) -> Column:
    """The value, with infinities and NaN replaced by 0. NULL stays NULL."""
    c = col(value)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def percent(part, whole) -> Column:
    """100 * part / whole in decimal arithmetic, rounded half up to two digits."""
    share = col(part).cast("decimal(18,0)") * 100 / col(whole).cast("decimal(18,0)")
    return F.round(share, 2)


def slug(name) -> Column:
    """Lower case, blanks to underscores."""
    return F.replace(F.lower(col(name)), F.lit(" "), F.lit("_"))
