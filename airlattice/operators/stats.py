"""Correlation, trend and pivot statistics."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice import constants as C

CORRELATED = ["value_ug_m3", "temperature_c", "humidity_percent", "precipitation_mm", "wind_speed_ms"]


def correlation_matrix(df: DataFrame, cols=None, by=("metric_code",)) -> DataFrame:
    """Pearson matrix as (by, x, y, r) over the rows where both columns are known.

    All pairs come from one aggregation. A column without variance gives NULL.
    """
    cols = list(cols or CORRELATED)
    measures, cells = [], []
    for i, (x, y) in enumerate(combinations_with_replacement(cols, 2)):
        fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
        x_seen, y_seen = F.when(fy.isNotNull(), fx), F.when(fx.isNotNull(), fy)
        r = F.try_divide(F.covar_pop(fx, fy), F.stddev_pop(x_seen) * F.stddev_pop(y_seen))
        measures.append(r.alias(f"r{i}"))
        for a, b in {(x, y), (y, x)}:
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{i}").alias("r")))
    wide = df.groupBy(*by).agg(*measures) if by else df.agg(*measures)
    return wide.select(*by, F.inline(F.array(*cells)))


def rank_correlations(matrix: DataFrame, target: str = "value_ug_m3", by=("metric_code",)) -> DataFrame:
    """Correlations with the target, strongest positive first, the target itself left out."""
    return (matrix.filter((F.col("x") == target) & (F.col("y") != target))
            .select(*by, F.col("y").alias("parameter"), "r")
            .orderBy(*by, F.desc_nulls_last("r"), "parameter"))


def linear_trend(df: DataFrame, x: str, y: str = "value_ug_m3", by=("metric_code",)) -> DataFrame:
    """Least-squares line of y on x with the x range; needs two known pairs."""
    fx = F.when(F.col(y).isNotNull(), F.col(x))
    return (df.groupBy(*by)
            .agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                 F.regr_count(y, x).alias("pairs"), F.min(fx).alias("x_min"), F.max(fx).alias("x_max"))
            .filter("pairs > 1").withColumn("x_name", F.lit(x)))


def linear_trends(df: DataFrame, xs, y: str = "value_ug_m3", by=("metric_code",)) -> DataFrame:
    """Lines of y on several columns in one pass, as (by, x_name, slope, ...)."""
    measures, rows = [], []
    for i, x in enumerate(xs):
        fx = F.when(F.col(y).isNotNull(), F.col(x))
        parts = {"slope": F.regr_slope(y, x), "intercept": F.regr_intercept(y, x),
                 "pairs": F.regr_count(y, x), "x_min": F.min(fx), "x_max": F.max(fx)}
        measures += [m.alias(f"{k}{i}") for k, m in parts.items()]
        rows.append(F.struct(F.lit(x).alias("x_name"), *[F.col(f"{k}{i}").alias(k) for k in parts]))
    return df.groupBy(*by).agg(*measures).select(*by, F.inline(F.array(*rows))).filter("pairs > 1")


def trend_line(fit: DataFrame, n: int = 100) -> DataFrame:
    """``n`` evenly spaced points of each fitted line between the ends of its x range."""
    step = (F.col("x_max") - F.col("x_min")) / (n - 1)
    return (fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("point"))
            .withColumn("x", F.col("x_min") + F.col("point") * step)
            .withColumn("y", F.col("intercept") + F.col("slope") * F.col("x")))


def risk_pivot(counts: DataFrame, metric: str) -> DataFrame:
    """Mean count over cities per (date, hour) and level; absent levels are 0."""
    return (counts.filter(F.col("metric_code") == metric).groupBy("date", "hour")
            .pivot("risk_level", C.RISK_LEVELS).agg(F.avg("count")).na.fill(0.0))


def completeness_heatmap(completeness: DataFrame, metrics=None) -> DataFrame:
    """City by metric grid of mean completeness, of all metrics by default."""
    return (completeness.groupBy("city_name").pivot("metric_code", list(metrics or C.METRIC_CODES))
            .agg(F.avg(F.col("avg_completeness").cast("double"))))
