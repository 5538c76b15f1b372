"""Forecast frames, features, splits, metrics, models and backtests."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.plans import forecast as M
from airlattice.session import use_checkpoint_dir

from queries.base import AS_OF, SKY, nine, on_warehouse, query

BASE = [*SKY, "pm10"]
# Few and shallow trees: these queries check the wiring, not the default model size.
SMALL = {"maxIter": 5, "maxDepth": 3}


def frame(t):
    return M.training_frame(t, days=90, as_of=AS_OF)


on_warehouse("M1_training_frame", f"""
SELECT city_name, timestamp, {nine('pm25', *BASE)} FROM pm
WHERE timestamp >= TIMESTAMP '2024-01-11' AND timestamp < TIMESTAMP '2024-01-31'""")(
    lambda t: M.training_frame(t, days=20, as_of=AS_OF))

FILLED = ", ".join(f"COALESCE({c}, median({c}) OVER (PARTITION BY city_name), 0) AS {c}" for c in BASE)
on_warehouse("M3_impute_median", f"""
SELECT city_name, timestamp, {nine('pm25', *BASE)} FROM (SELECT city_name, timestamp, pm25, {FILLED} FROM pm)""")(
    lambda t: M.impute_median(frame(t), C.BASE_FEATURES))


def features_sql(partition: str, source: str, extra: str = "") -> str:
    """Common table expressions up to ``feat``: the 24 features over ``source``."""
    filled = ", ".join(f"COALESCE({c}, median({c}) OVER (PARTITION BY {partition}), 0) AS {c}" for c in BASE)
    lags = ", ".join(f"LAG(pm25, {k}) OVER s AS pm25_lag_{k}h" for k in C.LAGS)
    means = ", ".join(f"AVG(pm25) OVER (s ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS pm25_ma_{n}h" for n in C.MEANS)
    lag_filled = ", ".join(f"COALESCE(pm25_lag_{k}h, median(pm25_lag_{k}h) OVER (PARTITION BY {partition}), 0) AS pm25_lag_{k}h"
                           for k in C.LAGS)
    return f"""
base AS (SELECT {partition}, timestamp, pm25, {filled}{extra} FROM {source} WHERE pm25 IS NOT NULL),
lagged AS (SELECT *, {lags}, {means} FROM base WINDOW s AS (PARTITION BY {partition} ORDER BY timestamp)),
feat AS (SELECT * REPLACE ({lag_filled}), CAST(hour(timestamp) AS DOUBLE) AS hour,
    CAST(isodow(timestamp) - 1 AS DOUBLE) AS day_of_week, CAST(month(timestamp) AS DOUBLE) AS month,
    sin(2 * pi() * hour(timestamp) / 24) AS hour_sin, cos(2 * pi() * hour(timestamp) / 24) AS hour_cos,
    sin(2 * pi() * (isodow(timestamp) - 1) / 7) AS day_sin, cos(2 * pi() * (isodow(timestamp) - 1) / 7) AS day_cos,
    temperature_c * humidity_percent AS temp_humidity,
    wind_speed_ms * cos(radians(wind_direction_deg)) AS wind_x,
    wind_speed_ms * sin(radians(wind_direction_deg)) AS wind_y FROM lagged)"""


on_warehouse("M4_features", f"""
WITH {features_sql('city_name', 'pm')}
SELECT city_name, timestamp, {nine('pm25', *M.FEATURES)} FROM feat""")(lambda t: M.build_features(frame(t)))

on_warehouse("M4_features_in_small_blocks", f"""
WITH {features_sql('city_name', 'pm')}
SELECT city_name, timestamp, {nine('pm25', *M.FEATURES)} FROM feat""")(
    lambda t: M.build_features(frame(t), block_rows=48))

on_warehouse("M4_features_leak_free", """
SELECT city_name, timestamp, ROUND(pm25, 9) AS pm25, ROUND(l, 9) AS pm25_lag_1h, ROUND(m, 9) AS pm25_ma_6h FROM (
  SELECT *, LAG(pm25) OVER s AS l, AVG(pm25) OVER (s ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS m
  FROM pm WINDOW s AS (PARTITION BY city_name ORDER BY timestamp)) WHERE l IS NOT NULL""")(
    lambda t: M.build_features(frame(t), leak_free=True).select(
        "city_name", "timestamp", "pm25", "pm25_lag_1h", "pm25_ma_6h"))

on_warehouse("M5_align_features", f"""
SELECT city_name, timestamp, {nine('pm25', *BASE)}, 0.0::DOUBLE AS pm25_lag_1h, 0.0::DOUBLE AS hour_sin FROM pm""")(
    lambda t: M.align_features(frame(t)).select("city_name", "timestamp", "pm25", *BASE, "pm25_lag_1h", "hour_sin"))

DIGEST = "md5('42|' || city_name || '|' || strftime(timestamp, '%Y-%m-%d %H:%M:%S'))"
PART = f"CASE WHEN {DIGEST} < 'a3d7' THEN 'train' WHEN {DIGEST} < 'cccd' THEN 'validation' ELSE 'test' END"
on_warehouse("M6_split_by_hash", f"SELECT city_name, timestamp, {PART} AS part FROM pm")(
    lambda t: M.split(frame(t).select("city_name", "timestamp")))

on_warehouse("M6_split_by_time", """
SELECT city_name, timestamp, CASE WHEN p / n < 0.64 THEN 'train' WHEN p / n < 0.8 THEN 'validation' ELSE 'test' END AS part
FROM (SELECT city_name, timestamp, ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY timestamp) - 1 AS p,
             COUNT(*) OVER (PARTITION BY city_name) AS n FROM pm)""")(
    lambda t: M.split(frame(t).select("city_name", "timestamp"), mode="time"))


def metrics_sql(source: str, by: str) -> str:
    return f"""
SELECT {by}, COUNT(*) AS n, ROUND(sqrt(AVG(pow(pm25 - prediction, 2))), 9) AS rmse,
       ROUND(1 - SUM(pow(pm25 - prediction, 2)) / nullif(var_pop(pm25) * COUNT(*), 0), 9) AS r2,
       ROUND(AVG(abs(pm25 - prediction)), 9) AS mae
FROM {source} WHERE prediction IS NOT NULL GROUP BY {by}"""


LAGGED = """(SELECT city_name, pm25, LAG(pm25) OVER (PARTITION BY city_name ORDER BY timestamp) AS prediction FROM pm)"""


@on_warehouse("M8_metrics_of_last_value", metrics_sql(LAGGED, "city_name"))
def last_value_metrics(t):
    from airlattice.operators.windows import lag_of, with_history
    rows = with_history(frame(t), ["city_name"], "timestamp", 1, {"prediction": lag_of("pm25", 1)})
    return M.regression_metrics(rows)


# Test rows of seven days of training and two of testing, by position in the series.
FOLDS = """
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY city_name ORDER BY timestamp) - 1 AS p,
                  COUNT(*) OVER (PARTITION BY city_name) AS rows FROM {source}),
folded AS (SELECT placed.*, fold, CASE WHEN p < fold * 48 + 168 THEN 'train' ELSE 'test' END AS role
           FROM placed, generate_series(0, 40) g(fold)
           WHERE fold * 48 < rows - 168 - 48 AND p >= fold * 48 AND p < fold * 48 + 168 + 48)"""

on_warehouse("M10_M11_folds", f"""
WITH {FOLDS.format(source='pm')} SELECT city_name, timestamp, fold, role FROM folded""")(
    lambda t: M.fold_rows(frame(t), 7, 2).select("city_name", "timestamp", "fold", "role"))

TESTED = f"""
WITH {features_sql('city_name', 'pm')}, {FOLDS.format(source='feat')},
scored AS (SELECT city_name, fold, timestamp, pm25, pm25_lag_1h AS prediction FROM folded WHERE role = 'test')"""


def tested(t):
    return M.backtest(M.build_features(frame(t)), 7, 2, model="persistence")


on_warehouse("M10_backtest_per_fold", TESTED + metrics_sql("scored", "city_name, fold"))(
    lambda t: M.backtest_metrics(tested(t))[0])
on_warehouse("M10_backtest_overall", TESTED + metrics_sql("scored", "city_name"))(
    lambda t: M.backtest_metrics(tested(t))[1])

# Fitted models have no SQL form, but how many rows each part gets does.
@on_warehouse("M7_train_boosted_trees", f"""
SELECT part, COUNT(*) AS n, TRUE AS better_than_mean, TRUE AS better_than_last_value FROM (SELECT {PART} AS part FROM pm) GROUP BY 1""")
def trained(t):
    features = M.build_features(frame(t))
    _, metrics = M.train(features, **SMALL)
    naive = M.regression_metrics(M.split(features), predicted="pm25_lag_1h", by=["part"])
    both = metrics.join(naive.select("part", F.col("rmse").alias("naive")), "part")
    return both.select("part", "n", (F.col("r2") > 0).alias("better_than_mean"),
                       (F.col("rmse") < F.col("naive")).alias("better_than_last_value"))


@on_warehouse("M12_train_per_city", f"""
SELECT city_name, part, COUNT(*) AS n, TRUE AS usable FROM (SELECT city_name, {PART} AS part FROM pm) GROUP BY 1, 2
UNION ALL SELECT 'NOWHERE', 'left out', 0, FALSE""")
def trained_cities(t):
    names = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "NOWHERE"]
    _, metrics, left_out = M.train_cities(M.build_features(frame(t)), names, maxIter=2, maxDepth=2)
    # Two small trees: an error under 100 where values reach 500.
    out = metrics.select("city_name", "part", "n", (F.col("rmse") < 100).alias("usable"))
    return out.unionByName(left_out.select("city_name", F.lit("left out").alias("part"), F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("usable")))


@on_warehouse("S17_M9_saved_model_predicts_alike", """
SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS different, 24 AS features FROM pm""")
def saved(t):
    features = M.build_features(frame(t))
    model, _ = M.train(features, **SMALL)
    path = M.model_path(f"{use_checkpoint_dir(features.sparkSession)}/{uuid4().hex}", "All Cities")
    M.save_model(model, path)
    loaded = M.load_model(path)
    both = M.predict(loaded, M.predict(model, features).withColumnRenamed("prediction", "before"))
    return both.agg(F.count("*").alias("rows"), F.count_if(F.col("before") != F.col("prediction")).alias("different"),
                    F.max(F.lit(len(M.model_features(loaded)))).alias("features"))


def judged(scored, by):
    fitted = M.regression_metrics(scored, by=by)
    naive = M.regression_metrics(scored, predicted="last_value", by=by).select(*by, F.col("rmse").alias("naive"))
    return fitted.join(naive, by).select(*by, "n", (F.col("rmse") < F.col("naive")).alias("better_than_last_value"))


@on_warehouse("M10_backtest_boosted_trees", f"""
WITH {FOLDS.format(source='pm')} SELECT city_name, fold, COUNT(*) AS n, TRUE AS better_than_last_value
FROM folded WHERE role = 'test' GROUP BY 1, 2""")
def boosted_backtest(t):
    return judged(M.backtest(M.build_features(frame(t)), 7, 2, maxIter=2, maxDepth=2), ["city_name", "fold"])


# Folds by calendar: days since the earliest day of any series.
CALENDAR = """
placed AS (SELECT *, date_diff('day', MIN(CAST(timestamp AS DATE)) OVER (), CAST(timestamp AS DATE)) AS p,
                  date_diff('day', MIN(CAST(timestamp AS DATE)) OVER (), MAX(CAST(timestamp AS DATE)) OVER ()) + 1 AS days FROM pm),
folded AS (SELECT placed.*, fold, CASE WHEN p < fold * 2 + 7 THEN 'train' ELSE 'test' END AS role
           FROM placed, generate_series(0, 60) g(fold) WHERE fold * 2 < days - 9 AND p >= fold * 2 AND p < fold * 2 + 9)"""

on_warehouse("M10_calendar_folds", f"WITH {CALENDAR} SELECT city_name, timestamp, fold, role FROM folded")(
    lambda t: M.fold_rows(frame(t), 7, 2, calendar=True).select("city_name", "timestamp", "fold", "role"))


@on_warehouse("M10_backtest_pooled_by_calendar", f"""
WITH {CALENDAR} SELECT fold, COUNT(*) AS n, TRUE AS better_than_last_value FROM folded WHERE role = 'test' GROUP BY 1""")
def pooled_backtest(t):
    return judged(M.backtest(M.build_features(frame(t)), 7, 2, model="pooled", maxIter=2, maxDepth=2), ["fold"])


@on_warehouse("M13_compare", """
SELECT city_name, COUNT(*) AS n, ROUND(AVG(pm25), 9) AS actual, TRUE AS usable FROM pm
WHERE timestamp >= TIMESTAMP '2024-01-20' AND timestamp <= TIMESTAMP '2024-01-27' GROUP BY 1""")
def compared(t):
    model, _ = M.train(M.build_features(frame(t)), **SMALL)
    rows = M.compare(model, t, "2024-01-20", "2024-01-27")
    error = F.sqrt(F.avg((F.col("actual") - F.col("predicted")) ** 2))
    return rows.groupBy("city_name").agg(F.count("*").alias("n"), F.avg("actual").alias("actual"),
                                         (error < F.stddev_pop("actual")).alias("usable"))


@query("M14_model_paths", """
SELECT c_custkey, '/models/pm25_model_' || lower(replace(c_mktsegment || ' ' || c_nationkey, ' ', '_')) AS model_path
FROM customer""")
def model_paths(spark, folder):
    rows = spark.read.parquet(f"{folder}/customer.parquet").select(
        "c_custkey", F.concat_ws(" ", "c_mktsegment", "c_nationkey").alias("city_name"))
    return M.with_model_path(rows, "/models/").select("c_custkey", "model_path")


