"""Report queries over the views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlattice.constants import METRIC_CODES
from airlattice.functions.times import ago, day_series
from airlattice.functions.values import metric_violation, percent
from airlattice.operators.joins import star
from airlattice.operators.quality import day_hours, hours_in
from airlattice.operators.scope import last, scope
from airlattice.operators.stats import CORRELATED, correlation_matrix
from airlattice.plans import views as V
from airlattice.tables import Warehouse

PAIR = ["city_name", "metric_code"]
# Views whose rows look back at earlier rows: a time limit may only follow them.
TIMED = {"v_observations", "v_weather", "v_observations_weather"}
LOOKS_BACK = {"v_moving_averages": 6, "v_lags": 3}


def within(t: Warehouse, start=None, end=None, inclusive_midnight: bool = False, days: bool = False) -> Warehouse:
    """The tables with both facts limited in time, so that stored folders are pruned.

    ``days`` widens the limits to whole days, as a limit on a date column means.
    """
    whole = days or (not inclusive_midnight and all(x is None or len(str(x)) <= 10 for x in (start, end)))
    if days:
        start, end = [None if x is None else str(x)[:10] for x in (start, end)]
        inclusive_midnight = False

    def limited(fact):
        return scope(fact, start=start, end=end, inclusive_midnight=inclusive_midnight)

    # Profiles hold whole days: they serve limits on days, other limits go to the facts.
    kept = {name: scope(df, start=start, end=end, on="date") for name, df in (("daily", t.daily), ("joint", t.joint)) if whole and df is not None}
    return Warehouse(t.dim_city, t.dim_metric, limited(t.fact_observation), limited(t.fact_weather), **kept)


def reaching_back(t: Warehouse, history: int, start=None, end=None, cities=None, metrics=None, **_) -> Warehouse:
    """The tables with facts limited to the days that rows of the range, looking back ``history`` rows, can need.

    The row counts of the stored day profiles tell the earliest such day: of each series that has rows in the range, the
    day of the ``history``-th row before it. Times are widened to whole days. Without profiles nothing is limited.
    """
    if t.daily is None or (start is None and end is None):
        return t
    first, last = [None if x is None else F.to_date(F.lit(str(x)[:10])) for x in (start, end)]
    fact = t.fact_observation
    day = F.col("event_date") if "event_date" in fact.columns else F.to_date("timestamp")
    if last is not None:
        fact = fact.filter((day <= last) | day.isNull())
    if first is not None:
        counts = scope(V.profiles(t), cities, metrics).groupBy(*PAIR, "date").agg(F.sum("rows").alias("n"))
        inside = F.col("date") >= first if last is None else F.col("date").between(first, last)
        asked = counts.filter(inside).select(*PAIR).distinct()
        nearer = Window.partitionBy(*PAIR).orderBy(F.desc_nulls_last("date")).rowsBetween(Window.unboundedPreceding, -1)
        before = counts.filter((F.col("date") < first) | F.col("date").isNull())
        needed = (before.join(asked, PAIR, "left_semi").withColumn("_nearer", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
                  .filter(F.col("_nearer") < history))
        lower = needed.agg(F.coalesce(F.min("date"), first)).scalar()
        # Rows without a time come before all others in a series; they lie in a folder of their own, which is kept.
        fact = fact.filter((day >= lower) | day.isNull())
    return t.but(fact_observation=fact)


def _limits(where: dict) -> tuple[dict, dict]:
    """(time limits, name filters) of a scope."""
    names = {k: v for k, v in where.items() if k in ("cities", "metrics")}
    return {k: v for k, v in where.items() if k not in names}, names


def trends(t: Warehouse, **where) -> DataFrame:
    """Values of the chosen series in time order."""
    limits, names = _limits(where)
    return (scope(V.v_observations(within(t, **limits)), **names)
            .select("timestamp", *PAIR, "value_ug_m3").orderBy("timestamp", *PAIR))


def browse(t: Warehouse, view: str, n: int | None = None, **where) -> DataFrame:
    """The rows of a view in scope, newest first in a total order; with ``n`` only that many."""
    limits, names = _limits(where)
    if view in LOOKS_BACK:
        df = V.VIEWS[view](reaching_back(t, LOOKS_BACK[view], **where))
    else:
        df, where = V.VIEWS[view](within(t, days=view not in TIMED, **limits)), names
    on = "timestamp" if "timestamp" in df.columns else "date"
    newest = [c for c in (on, "hour") if c in df.columns]
    ties = [c for c in PAIR if c in df.columns]
    out = scope(df, on=on, **where).orderBy(*[F.desc(c) for c in newest], *ties)
    return out if n is None else out.limit(n)


def exceedance_days(t: Warehouse, **where) -> DataFrame:
    """Days above the limit, newest first, longest first within a day."""
    limits, names = _limits(where)
    return (scope(V.v_days_with_exceedances(within(t, days=True, **limits)), **names).filter("has_exceedance")
            .orderBy(F.desc("date"), F.desc("exceedance_hours"), *PAIR))


def risk_counts(t: Warehouse, n: int | None = None, **where) -> DataFrame:
    """Rows per (date, hour, city, metric, level) in that order; with ``n`` the first of them."""
    keys = ["date", "hour", *PAIR, "risk_level"]
    limits, names = _limits(where)
    out = (scope(V.v_risk_map(within(t, days=True, **limits)), **names)
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys))
    return out if n is None else out.limit(n)


def completeness_range(t: Warehouse, start, end, cities=None, metrics=None,
                       include_empty: bool = False) -> DataFrame:
    """Distinct hours with data against all hours of the days from ``start`` to ``end``."""
    kept = within(t, start, end, days=True)
    if kept.daily is None:
        hours = day_hours(scope(V.observations(kept), cities, metrics))
    else:
        merged = scope(V.profiles(kept), cities, metrics).groupBy(*PAIR, "date").agg(F.bit_or("hours").alias("_hours"))
        hours = merged.select(*PAIR, "date", hours_in("_hours").alias("actual_hours"))
    days = F.size(day_series(F.lit(str(start)), F.lit(str(end))))
    expected = (days * 24).cast("bigint")
    per_series = (hours.groupBy(*PAIR)
                  .agg(F.count(F.lit(1)).alias("days_with_data"), F.sum("actual_hours").alias("total_points")))
    if include_empty:
        names = t.dim_city.select("city_name").distinct()
        codes = t.dim_metric.select("metric_code")
        if cities is not None:
            names = names.filter(F.col("city_name").isin(list(cities)))
        if metrics is not None:
            codes = codes.filter(F.col("metric_code").isin(list(metrics)))
        every = names.withColumn("metric_code", F.explode(F.array(*[
            F.lit(m) for m in (metrics or METRIC_CODES)])))
        per_series = (every.join(codes, "metric_code").join(per_series, PAIR, "left")
                      .na.fill(0, ["days_with_data", "total_points"]))
    share = F.col("total_points").cast("decimal(18,0)") * 100 / expected.cast("decimal(18,0)")
    return (per_series.select(*PAIR, "days_with_data", "total_points", expected.alias("total_expected"),
                              percent("total_points", expected).alias("avg_completeness"),
                              F.round(F.lit(100).cast("decimal(5,0)") - share, 2).alias("avg_missing"))
            .orderBy(*PAIR))


def range_violations(t: Warehouse, rules=None, **where) -> DataFrame:
    """Values outside their metric's range, with the share in percent rounded half even."""
    bad = F.count_if(metric_violation("metric_code", "value_ug_m3", rules))
    limits, names = _limits(where)
    return (scope(V.observations(within(t, **limits)), **names).groupBy(*PAIR)
            .agg(F.count(F.lit(1)).alias("total_records"), bad.alias("range_violations"),
                 F.min("value_ug_m3").alias("min_value"), F.max("value_ug_m3").alias("max_value"),
                 F.avg("value_ug_m3").alias("avg_value"))
            .withColumn("violation_rate",
                        F.bround(F.col("range_violations") / F.col("total_records") * 100, 2)))


def station_metadata(t: Warehouse, approximate: bool = False, **where) -> DataFrame:
    """Mean station count, number of locations and rows per series.

    ``approximate`` counts locations by sketches, within 2 % of the exact count in two of three cases; from stored
    profiles it merges those of the days and reads no facts.
    """
    limits, names = _limits(where)
    kept = within(t, **limits)
    if approximate and kept.daily is not None:
        return (scope(V.profiles(kept), **names).groupBy(*PAIR)
                .agg(F.try_divide(F.sum("stations"), F.sum("stations_n")).alias("avg_stations"),
                     F.hll_sketch_estimate(F.hll_union_agg("places")).alias("unique_locations"), F.sum("rows").alias("total_records")))
    places = F.hll_sketch_estimate(F.hll_sketch_agg("location_id")) if approximate else F.count_distinct("location_id")
    return (scope(V.observations(kept), **names).groupBy(*PAIR)
            .agg(F.avg("station_count").alias("avg_stations"), places.alias("unique_locations"),
                 F.count(F.lit(1)).alias("total_records")))


def period_statistics(t: Warehouse, weather: str = "fanout", **where) -> DataFrame:
    """Value and weather statistics of each series over the period, scoped before any join."""
    limits, names = _limits(where)
    totals = V.value_totals(within(t, **limits))
    named = scope(star(totals, t.dim_city, t.dim_metric), **names)
    sky = within(t, days=True, **limits).fact_weather
    return (V.weighted_summary(named, sky, PAIR, weather)
            .select(*PAIR, "avg_value", "min_value", "max_value",
                    F.col("data_points").alias("total_records"), "avg_temperature", "avg_wind_speed")
            .orderBy(*PAIR))


def table_status(t: Warehouse, as_of) -> DataFrame:
    """(check, number, latest): sizes, recent rows and newest times of the tables."""
    def recent(interval):
        return F.count_if(F.col("timestamp") >= ago(as_of, interval))

    def facts(df, name):
        week = last(df, "7 days", as_of).agg(recent("7 days").alias("week"), recent("24 hours").alias("day"))
        newest = df
        if "event_date" in df.columns:  # only the newest folder is read for the newest time
            newest = df.filter(F.col("event_date") == df.agg(F.max("event_date")).scalar())
        one = week.withColumn("latest", newest.agg(F.max("timestamp")).scalar())

        def row(check, number, latest):
            return F.struct(F.lit(f"{name}_{check}").alias("check"), number.cast("bigint").alias("number"),
                            latest.cast("timestamp").alias("latest"))

        none = F.lit(None)
        return one.select(F.inline(F.array(row("last_7_days", F.col("week"), none),
                                           row("last_24_hours", F.col("day"), none),
                                           row("latest", none, F.col("latest")))))

    def size(df, name):
        return df.agg(F.count(F.lit(1)).alias("number")).select(
            F.lit(name).alias("check"), "number", F.lit(None).cast("timestamp").alias("latest"))

    return (size(t.dim_city, "cities").unionByName(size(t.dim_metric, "metrics"))
            .unionByName(facts(t.fact_observation, "observation"))
            .unionByName(facts(t.fact_weather, "weather")))


def weather_correlations(t: Warehouse, cols=None, **where) -> DataFrame:
    """Correlation matrix per metric over every row in scope.

    From stored profiles, where whole days are asked for and there are any, it reads no facts.
    Both sides carry the time the rows are joined on, so limiting them first keeps the result.
    """
    limits, names = _limits(where)
    kept = within(t, **limits)
    if kept.joint is not None and cols is None:
        from airlattice.plans import daily
        return daily.correlations(kept.but(joint=scope(kept.joint, **names)))
    rows = scope(V.v_observations_weather(kept), **names)
    return correlation_matrix(rows, cols or CORRELATED)


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Any SQL over the registered views."""
    return spark.sql(sql)
