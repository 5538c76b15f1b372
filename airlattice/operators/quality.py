"""Data-quality checks, as frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice import constants as C
from airlattice.functions.times import hours_between
from airlattice.functions.values import in_range, metric_violation
from airlattice.operators.windows import lag_of, with_history
from airlattice.tables import Warehouse, lookup


#: Parts of a day of a series while its rows are read twice; a power of two.
SALTS = 4


class QualityError(ValueError):
    """Raised by the gate when a report is not valid."""


def missing_ratios(df: DataFrame, columns=None) -> DataFrame:
    """(column, missing_ratio) from one pass; 1.0 everywhere on an empty frame."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.coalesce(F.avg(F.col(c).isNull().cast("double")), F.lit(1.0)).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_ratio")) for c in columns])))


def range_violation_count(df: DataFrame, rules: dict) -> DataFrame:
    """(column, violations) outside the closed ranges; absent columns count 0."""
    counts = [(F.count_if(~in_range(c, *rules[c])) if c in df.columns else F.max(F.lit(0))).alias(c)
              for c in rules]
    one = df.agg(*counts)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("violations"))
        for c in rules])))


def monotonicity(df: DataFrame, ts: str, arrival: str, by=(), slice_by: Column | None = None) -> DataFrame:
    """(by, is_monotonic): does time never step back along the order of arrival?

    ``slice_by`` cuts the arrival order into bounded runs. Without it the range of arrival
    numbers is cut into runs of about 65,536 rows, whatever its unit.
    """
    keys = list(by) or ["_all"]
    narrow = df.withColumn("_all", F.lit(1)).select(*keys, F.col(ts).alias("_ts"), F.col(arrival).alias("_at"))
    if slice_by is None:
        at = F.col("_at").cast("double")
        width = narrow.agg(F.greatest((F.max(at) - F.min(at)) / F.greatest(F.ceil(F.count("*") / 65_536), F.lit(1)), F.lit(1.0))).scalar()
        cut = F.floor(at / width)
    else:
        cut = slice_by
    steps = with_history(narrow, keys, "_at", 1, {"_prev": lag_of("_ts", 1)}, slice_by=cut)
    out = steps.groupBy(*keys).agg(
        F.coalesce(F.bool_and(F.col("_prev").isNull() | (F.col("_ts") >= F.col("_prev"))),
                   F.lit(True)).alias("is_monotonic"))
    return out.drop("_all")


def freshness(df: DataFrame, ts: str, as_of, max_age_hours: float = C.MAX_AGE_HOURS) -> DataFrame:
    """One row: newest time, its age in hours and whether that is young enough."""
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("latest"))) / 3.6e9
    return (df.agg(F.max(F.col(ts).cast("timestamp")).alias("latest")).withColumn("age_hours", age)
            .withColumn("is_fresh", F.coalesce(F.col("age_hours") <= max_age_hours, F.lit(False))))


def zscore_outliers(df: DataFrame, column: str, k: float = C.Z_LIMIT, by=(), moments: DataFrame | None = None) -> DataFrame:
    """(by, jumps): values more than ``k`` sample deviations from the mean of their group.

    ``moments`` (by, _mean, _std) saves the pass that makes them, as from stored day profiles.
    """
    keys = list(by)
    mean, deviation = F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")
    if keys:
        found = df.groupBy(*keys).agg(mean, deviation) if moments is None else moments.select(*keys, "_mean", "_std")
        joined = lookup(df.select(*keys, column), found, keys)
    else:
        joined = df.select(column, df.agg(mean).scalar().alias("_mean"), df.agg(deviation).scalar().alias("_std"))
    z = F.try_divide(F.abs(F.col(column) - F.col("_mean")), F.col("_std"))
    return joined.groupBy(*keys).agg(F.count_if(z > k).alias("jumps"))


def completeness_by_group(df: DataFrame, ts: str = "timestamp", group=("city",)) -> DataFrame:
    """Rows per group against the hourly steps between its first and last time."""
    ratio = F.col("actual_points") / F.col("expected_points")
    return (df.groupBy(*group)
            .agg(F.count(F.lit(1)).alias("actual_points"),
                 hours_between(F.min(ts), F.max(ts)).alias("expected_points"))
            .withColumn("completeness_ratio", ratio).withColumn("missing_ratio", 1 - ratio))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """(column, key, rows) of fact keys that a dimension lacks.

    Keys are counted first, so the anti join handles one row per distinct key.
    """
    parts = []
    for key, dim in dims.items():
        counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
        missing = counted.join(dim.select(key).distinct(), key, "left_anti")
        parts.append(missing.select(F.lit(key).alias("column"), F.col(key).cast("string").alias("key"), "rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column, present, type_ok, nulls, nullable_ok) for each expected column."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    counts = df.agg(*[(F.count_if(F.col(f.name).isNull()) if f.name in actual else F.lit(None).cast("bigint"))
                      .alias(f.name) for f in expected.fields])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.name in actual).alias("present"),
                 F.lit(actual.get(f.name) == f.dataType).alias("type_ok"),
                 F.col(f.name).alias("nulls"),
                 (F.lit(f.nullable) | (F.coalesce(F.col(f.name), F.lit(1)) == 0)).alias("nullable_ok"))
        for f in expected.fields])))


def hour_mask(ts: str) -> Column:
    """Aggregate: a bit for each hour of the day that has a row, 0 without any time."""
    return F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(ts))), F.lit(0))


def hours_in(mask) -> Column:
    return F.bit_count(mask).cast("bigint")


def day_hours(named: DataFrame, by=("city_name", "metric_code")) -> DataFrame:
    """Distinct hours with data per day and series, one row per day through the shuffle."""
    return (named.groupBy(*by, F.to_date("timestamp").alias("date")).agg(hour_mask("timestamp").alias("_hours"))
            .select(*by, "date", hours_in("_hours").alias("actual_hours")))


def sparse_days(named: DataFrame, minimum: int = C.MIN_POINTS_PER_DAY, by=("city_name", "metric_code")) -> DataFrame:
    """Days of a series with fewer distinct hours than ``minimum``."""
    return day_hours(named, by).filter(F.col("actual_hours") < minimum)


def quality_report(df: DataFrame, as_of, rules=None, city: str = "city_name", metric: str = "metric_code",
                   value: str = "value_ug_m3", ts: str = "timestamp", arrival: str | None = None,
                   max_missing: float = C.MAX_MISSING_RATIO, z_limit: float = C.Z_LIMIT,
                   max_age_hours: float = C.MAX_AGE_HOURS) -> DataFrame:
    """All checks of a long frame as (check, scope, column, value, threshold, status).

    One pass gives a profile per series. Each profile row is unfolded into its share of
    every check, and one small aggregation adds the shares up. Only the outlier count
    needs the means first and takes a second pass.
    """
    rules = rules or C.VALUE_RANGES
    columns = df.columns
    profile = df.groupBy(city, metric).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
        F.count_if(metric_violation(metric, value, rules)).alias("_violations"),
        F.min(ts).alias("_first"), F.max(ts).alias("_last"))

    def share(check, scope_, column, part, whole, latest=None):
        return F.struct(F.lit(check).alias("check"), scope_.alias("scope"), column.alias("column"),
                        part.cast("bigint").alias("part"), whole.cast("bigint").alias("whole"),
                        F.lit(latest).cast("timestamp").alias("latest"))

    all_, zero, rows = F.lit("all"), F.lit(0), F.col("_rows")
    shares = [share("missing_ratio", all_, F.lit(c), F.col(f"_null_{c}"), rows) for c in columns]
    shares += [
        share("range", all_, F.when(F.col(metric).isin(list(rules)), F.col(metric)), F.col("_violations"), zero),
        share("freshness_hours", all_, F.lit(ts), zero, zero, F.col("_last")),
        share("completeness", F.col(city), F.col(metric), rows, hours_between("_first", "_last")),
        share("not_empty", all_, F.lit("rows"), rows, zero)]
    # An empty frame has no profile rows; these stand for its columns.
    seeds = [share("missing_ratio", all_, F.lit(c), zero, zero) for c in columns]
    seeds += [share("freshness_hours", all_, F.lit(ts), zero, zero), share("not_empty", all_, F.lit("rows"), zero, zero)]
    unfolded = (profile.select(F.inline(F.array(*shares))).filter("`column` IS NOT NULL OR check = 'completeness'")
                .unionByName(df.sparkSession.range(1).select(F.inline(F.array(*seeds)))))
    added = unfolded.groupBy("check", "scope", "column").agg(
        F.sum("part").alias("part"), F.sum("whole").alias("whole"), F.max("latest").alias("latest"))
    ratio = F.try_divide(F.col("part"), F.col("whole"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("latest")) / 3.6e9
    number = {"missing_ratio": F.coalesce(ratio, F.lit(1.0)), "range": F.col("part").cast("double"),
              "freshness_hours": age, "completeness": 1 - ratio, "not_empty": F.col("part").cast("double")}
    limit = {"missing_ratio": max_missing, "range": 0.0, "freshness_hours": max_age_hours,
             "completeness": max_missing, "not_empty": 1.0}

    def per_check(values):
        out = F
        for check, column in values.items():
            out = out.when(F.col("check") == check, column)
        return out

    report = (added.withColumn("value", per_check(number))
              .withColumn("threshold", per_check({k: F.lit(float(v)) for k, v in limit.items()}))
              .filter("check <> 'not_empty' OR value = 0")
              .withColumn("bad", F.coalesce(F.col("value") > F.col("threshold"), F.lit(True)) | (F.col("check") == "not_empty")))
    jumps = (zscore_outliers(df.filter(F.col(metric).isin(list(rules))), value, z_limit, [metric])
             .select(F.lit("jumps").alias("check"), F.lit("all").alias("scope"), F.col(metric).alias("column"),
                     F.col("jumps").cast("double").alias("value"), F.lit(0.0).alias("threshold"),
                     (F.col("jumps") > 0).alias("bad")))
    report = report.select("check", "scope", "column", "value", "threshold", "bad").unionByName(jumps)
    if arrival is not None:
        report = report.unionByName(monotonicity(df, ts, arrival).select(
            F.lit("monotonic").alias("check"), F.lit("all").alias("scope"), F.lit(ts).alias("column"),
            F.col("is_monotonic").cast("double").alias("value"), F.lit(1.0).alias("threshold"),
            (~F.col("is_monotonic")).alias("bad")))
    return report.withColumn("status", F.when(F.col("bad"), "warning").otherwise("ok")).drop("bad")


def report_valid(report: DataFrame) -> DataFrame:
    """One row: is every check ok, and how many warn."""
    return report.agg(F.coalesce(F.bool_and(F.col("status") == "ok"), F.lit(False)).alias("valid"),
                      F.count_if(F.col("status") == "warning").alias("warnings"))


def quality_gate(report: DataFrame) -> None:
    """Raise when a report warns. This is an action; it fetches the one verdict row."""
    verdict = report_valid(report).first()
    if not verdict["valid"]:
        raise QualityError(f"data quality validation failed with {verdict['warnings']} warnings")


def in_order_of_loads(rows: DataFrame, keys, loaded: str, ts: str = "timestamp") -> DataFrame:
    """(keys, is_monotonic): no load brings a time before the newest one of an earlier load.

    Loads are counted first, so only one row per key and load is put in order. The rows of
    one load arrive together and have no order among themselves.
    """
    loads = rows.groupBy(*keys, loaded).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    before = Window.partitionBy(*keys).orderBy(loaded).rowsBetween(Window.unboundedPreceding, -1)
    back = F.coalesce(F.col("_first") < F.max("_last").over(before), F.lit(False))
    return loads.select(*keys, back.alias("_back")).groupBy(*keys).agg((~F.bool_or("_back")).alias("is_monotonic"))


def daily_quality_metrics(t: Warehouse, arrival: str | None = None, rules=None, loaded: str | None = None) -> DataFrame:
    """One quality row per (date, city, metric), in the layout of the quality table.

    The order of arrival is that of a column (``arrival``) or of the loads (``loaded``).
    """
    keys = ["date", "city_id", "metric_id"]
    code = t.dim_metric.select("metric_id", "metric_code")
    rows = t.fact_observation.withColumn("date", F.to_date("timestamp")).join(code, "metric_id")
    v = F.col("value_ug_m3")
    # A struct of the keys is never null, and equal where nulls stand in the same places. Several passes need the rows:
    # moments, outliers, order of loads. What they need lies in one array, so no pass prunes columns and all read the
    # same exchange. The salt spreads a heavy day over tasks.
    seconds = [F.unix_micros(F.col(c).cast("timestamp")).cast("double") for c in ([loaded, "timestamp"] if loaded is not None and arrival is None else [])]
    packed = [v.cast("double"), F.call_function("shiftleft", F.lit(1), F.hour("timestamp")).cast("double"),
              metric_violation("metric_code", "value_ug_m3", rules).cast("double"), *seconds]
    dealt = (rows.select(F.struct(*keys).alias("_key"), F.hash("timestamp", v).bitwiseAND(F.lit(SALTS - 1)).alias("_salt"), F.array(*packed).alias("_row"))
             .repartition("_key", "_salt"))
    v = F.get("_row", F.lit(0))
    profile = dealt.groupBy("_key").agg(F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"),
                                        F.coalesce(F.bit_or(F.get("_row", F.lit(1)).cast("int")), F.lit(0)).alias("_hours"),
                                        F.count_if(F.get("_row", F.lit(2)) == 1).alias("_bad"))
    each = profile.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    z = F.try_divide(F.abs(v - F.col("_mean")), F.col("_std"))
    out = (dealt.join(each, ["_key", "_salt"])
           .groupBy("_key").agg(F.count_if(z > C.Z_LIMIT).alias("jumps"), hours_in(F.max("_hours")).alias("hours"), F.max("_bad").alias("bad")))
    if seconds:
        loads = dealt.select("_key", F.get("_row", F.lit(3)).alias("_loaded"), F.get("_row", F.lit(4)).alias("_ts"))
        out = out.join(in_order_of_loads(loads, ["_key"], "_loaded", "_ts"), "_key")
    out = out.select("_key.*", *[c for c in out.columns if c != "_key"])
    if arrival is not None:
        out = lookup(out, monotonicity(rows, "timestamp", arrival, keys), keys)
    elif not seconds:
        out = out.withColumn("is_monotonic", F.lit(True))
    ratio = F.col("hours") / F.lit(C.POINTS_PER_DAY)
    return out.select(*keys, ratio.alias("completeness_ratio"), (1 - ratio).alias("missing_ratio"),
                      F.lit(C.POINTS_PER_DAY).alias("data_points_expected"),
                      F.col("hours").cast("int").alias("data_points_actual"),
                      F.col("bad").cast("int").alias("value_range_violations"),
                      F.col("jumps").cast("int").alias("sudden_jumps_count"), "is_monotonic")
