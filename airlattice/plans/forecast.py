"""Short-term concentration forecasts: frames, features, models and backtests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlattice import constants as C
from airlattice.functions.times import ago, hour_floor
from airlattice.functions.values import cycle, finite, slug, wind_vector
from airlattice.operators.boosting import fit_groups, predict_groups
from airlattice.operators.joins import join_same_hour, star, with_metric
from airlattice.operators.scope import between
from airlattice.operators.windows import exact_medians, lag_of, position_in_series, trailing_mean, with_history
from airlattice.session import stored
from airlattice.tables import Warehouse, lookup

TARGET = "pm25"
CITY = ["city_name"]
LAG_FEATURES = [f"{TARGET}_lag_{k}h" for k in C.LAGS]
MEAN_FEATURES = [f"{TARGET}_ma_{n}h" for n in C.MEANS]
TIME_FEATURES = ["hour", "day_of_week", "month", "hour_sin", "hour_cos", "day_sin", "day_cos"]
MIXED_FEATURES = ["temp_humidity", "wind_x", "wind_y"]
CITY_INDEX = "city_index"
FEATURES = C.BASE_FEATURES + LAG_FEATURES + MEAN_FEATURES + TIME_FEATURES + MIXED_FEATURES
# Shares 64 / 16 / 20 of the digest space, as the first hex digits of their ends.
TRAIN_BELOW, VALIDATION_BELOW = "a3d7", "cccd"


def _metric_id(code: str) -> int:
    return next(m[0] for m in C.METRICS if m[1] == code)


def period_frame(t: Warehouse, start, end, cities=None, include_end: bool = False) -> DataFrame:
    """Target, same-hour weather and pm10 of every city, one row per city and time."""
    start, end = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    observed = between(t.fact_observation, start, end, closed=include_end)
    names = t.dim_city if cities is None else t.dim_city.filter(F.col("city_name").isin(list(cities)))
    air = (star(observed.filter(F.col("metric_id") == _metric_id(TARGET)), names)
           .select("city_id", "city_name", "timestamp", F.col("value_ug_m3").alias(TARGET)))
    weather = between(t.fact_weather, hour_floor(start), end + F.expr("INTERVAL 1 HOUR"), closed=True)
    joined = with_metric(join_same_hour(air, weather), observed, _metric_id("pm10"), "pm10")
    return joined.select("city_name", "timestamp", TARGET, *C.BASE_FEATURES)


def training_frame(t: Warehouse, cities=None, days: int = 90, as_of=None) -> DataFrame:
    """The last ``days`` days before ``as_of``, all cities in one plan."""
    return period_frame(t, ago(as_of, f"{days} days"), F.lit(as_of).cast("timestamp"), cities)


def impute_median(df: DataFrame, cols, by=CITY) -> DataFrame:
    """NULL and NaN cells become the exact median of their group, or 0 without any value.

    The medians and the rows are separate passes over the input, so it is stored first.
    """
    cols, by, df = list(cols), list(by), stored(df)
    medians = (exact_medians(df, cols, by).groupBy(*by)
               .pivot("column", cols).agg(F.max("median"))
               .withColumnsRenamed({c: f"_m_{c}" for c in cols}))
    joined = lookup(df, medians, by, "left")
    return joined.withColumns({
        c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), f"_m_{c}", F.lit(0.0))
        for c in cols}).drop(*[f"_m_{c}" for c in cols])


def build_features(df: DataFrame, by=CITY, leak_free: bool = False, **layout) -> DataFrame:
    """The 24 model inputs next to the series keys, time and target.

    As first written the trailing means contain the current target; ``leak_free`` ends
    them one row earlier and drops rows without a previous value instead of imputing.

    Several passes read the input (row counts, rows), so it is stored in the shared folder.
    """
    by = list(by)
    for name in C.BASE_FEATURES:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(0.0))
    base = stored(df.filter(F.col(TARGET).isNotNull()))
    made = {f"{TARGET}_lag_{k}h": lag_of(TARGET, k) for k in C.LAGS}
    for n in C.MEANS:
        made[f"{TARGET}_ma_{n}h"] = (
            (lambda spec, n=n: F.avg(TARGET).over(spec.rowsBetween(-n, -1))) if leak_free
            else trailing_mean(TARGET, n))
    lagged = with_history(base, by, "timestamp", max(C.LAGS), made, **layout)
    if leak_free:
        lagged = lagged.filter(F.col(f"{TARGET}_lag_1h").isNotNull())
    out = impute_median(lagged, C.BASE_FEATURES + LAG_FEATURES, by)
    hour, weekday = F.hour("timestamp"), F.weekday("timestamp")
    hour_sin, hour_cos = cycle(hour, 24)
    day_sin, day_cos = cycle(weekday, 7)
    wind_x, wind_y = wind_vector("wind_speed_ms", "wind_direction_deg")
    out = out.withColumns({
        "hour": hour, "day_of_week": weekday, "month": F.month("timestamp"),
        "hour_sin": hour_sin, "hour_cos": hour_cos, "day_sin": day_sin, "day_cos": day_cos,
        "temp_humidity": F.col("temperature_c") * F.col("humidity_percent"),
        "wind_x": wind_x, "wind_y": wind_y})
    return out.select(*by, "timestamp", TARGET,
                      *[F.coalesce(finite(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in FEATURES])


def city_index(df: DataFrame) -> DataFrame:
    """The city as a number that trees can split on, from a hash: no list of cities is needed."""
    city = F.col("city_name") if "city_name" in df.columns else F.lit("")
    return df.withColumn(CITY_INDEX, F.pmod(F.xxhash64(city), F.lit(1 << 16)).cast("double"))


def align_features(df: DataFrame, names=None) -> DataFrame:
    """Feature columns in the trained order; absent ones are 0."""
    names = list(names or FEATURES)
    keep = [c for c in df.columns if c not in names]
    return df.select(*keep, *[(F.col(c) if c in df.columns else F.lit(0.0)).alias(c) for c in names])


def split(df: DataFrame, mode: str = "hash", keys=("city_name", "timestamp"), seed=42) -> DataFrame:
    """Add ``part``: train, validation or test in shares 64 / 16 / 20.

    ``hash`` draws by a digest of the key and never changes between runs; ``time`` cuts
    each series in time order.
    """
    if mode == "hash":
        text = [F.date_format(k, "yyyy-MM-dd HH:mm:ss") if k == "timestamp" else F.col(k).cast("string")
                for k in keys]
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *text))
        part = F.when(digest < TRAIN_BELOW, "train").when(digest < VALIDATION_BELOW, "validation")
        return df.withColumn("part", part.otherwise("test"))
    series = [k for k in keys if k != "timestamp"]
    placed = position_in_series(df, series, ["timestamp"], F.to_date("timestamp"), "_position")
    sizes = df.groupBy(*series).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.col("_position") / F.col("_rows")
    return (lookup(placed, sizes, series)
            .withColumn("part", F.when(share < 0.64, "train").when(share < 0.8, "validation").otherwise("test"))
            .drop("_position", "_rows"))


def regression_metrics(df: DataFrame, actual: str = TARGET, predicted: str = "prediction", by=CITY) -> DataFrame:
    """RMSE, R² and MAE per group in one pass; R² is NULL without variance."""
    a, p = F.col(actual), F.col(predicted)
    error = a - p
    spread = F.var_pop(a) * F.count(a)
    return (df.filter(a.isNotNull() & p.isNotNull()).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"),
                 (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
                 F.avg(F.abs(error)).alias("mae")))


def fit(features: DataFrame, **params) -> PipelineModel:
    """A boosted-tree model on prepared features, fitted by all executors.

    The frame is stored first: boosting reads it once per tree, and a lost executor must
    not replay the whole plan. The checkpoint folder bounds the lineage over many trees.
    """
    rows = stored(city_index(features).select(TARGET, *FEATURES, CITY_INDEX))
    assembler = VectorAssembler(inputCols=[*FEATURES, CITY_INDEX], outputCol="features")
    trees = GBTRegressor(labelCol=TARGET, featuresCol="features", predictionCol="prediction",
                         **{**C.BOOSTING, **params})
    return PipelineModel([assembler, trees.fit(assembler.transform(rows))])


def predict(model: PipelineModel | None, features: DataFrame) -> DataFrame:
    if model is None:
        raise ValueError("no trained model; call train() or load_model() first")
    return model.transform(city_index(align_features(features))).drop("features", CITY_INDEX)


def train(features: DataFrame, by=CITY, mode: str = "hash", **params) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train part; the frame holds the metrics of every part."""
    parts = split(features, mode, keys=(*by, "timestamp"))
    model = fit(parts.filter("part = 'train'"), **params)
    return model, regression_metrics(predict(model, parts), by=["part"])


# What the grouped trees call the settings of the pooled ones.
GROUPED = {"maxIter": "trees", "maxDepth": "depth", "stepSize": "step", "minInstancesPerNode": "min_child"}


def fit_by(rows: DataFrame, by, **params) -> DataFrame:
    """One model per group of ``by``, all groups in the same jobs: a table with a row per group.

    Settings have the names of ``train``; a node is split from ``minSplit`` rows on, by default 10.
    """
    chosen = {**C.BOOSTING, **params}
    return fit_groups(rows, list(by), FEATURES, TARGET, min_split=chosen.get("minSplit", 10),
                      **{ours: chosen[theirs] for theirs, ours in GROUPED.items()})


def train_cities(features: DataFrame, cities=None, min_rows: int = 1, root: str | None = None,
                 **params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(models, metrics per city and part, left out with a reason): one model for each city, whatever their number.

    A city needs ``min_rows`` rows, by default any. Without ``cities`` all are trained. With ``root`` the models are saved
    in one table there, each with its ``model_path``.
    """
    counted = features.groupBy(*CITY).agg(F.count(F.lit(1)).alias("n"))
    if cities is not None:
        names = features.sparkSession.createDataFrame([(c,) for c in cities], "city_name STRING").distinct()
        counted = lookup(names, counted, CITY, "left")
    sized = stored(counted.select(*CITY, F.coalesce("n", F.lit(0)).cast("long").alias("n")))
    enough = sized.filter(F.col("n") >= min_rows).select(*CITY, F.lit(True).alias("_in"))
    parts = stored(split(lookup(features, enough, CITY).drop("_in"), "hash"))
    models = fit_by(parts.filter("part = 'train'"), CITY, **params)
    if root is not None:
        with_model_path(models, root).write.mode("overwrite").parquet(city_models_path(root))
    metrics = regression_metrics(predict_groups(models, parts, CITY, FEATURES), by=[*CITY, "part"])
    left_out = sized.filter(F.col("n") < min_rows).select(*CITY, F.concat("n", F.lit(f" rows, {min_rows} needed")).alias("reason"))
    return models, metrics, left_out


def city_models_path(root: str) -> str:
    return f"{root.rstrip('/')}/{TARGET}_models"


def load_city_models(spark, root: str) -> DataFrame:
    return spark.read.parquet(city_models_path(root))


def predict_cities(models: DataFrame, features: DataFrame) -> DataFrame:
    """Predictions of every city's own model; null for a city without one."""
    return predict_groups(models.select(*CITY, "base", "trees"), features, CITY, FEATURES)


def model_path(root: str, city: str) -> str:
    return f"{root.rstrip('/')}/{TARGET}_model_{city.lower().replace(' ', '_')}"


def with_model_path(df: DataFrame, root: str, city: str = "city_name") -> DataFrame:
    """The same path as a column."""
    return df.withColumn("model_path", F.concat(F.lit(f"{root.rstrip('/')}/{TARGET}_model_"), slug(city)))


def save_model(model: PipelineModel, path: str) -> None:
    """Stored with its feature names and their order."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    return [c for c in model.stages[0].getInputCols() if c != CITY_INDEX]


def fold_rows(df: DataFrame, train_days: int = 30, test_days: int = 7, by=CITY,
              last_fold: bool = False, calendar: bool = False) -> DataFrame:
    """Rows with ``fold`` and ``role`` of a rolling-origin backtest.

    By default by position in the series, as first written: a fold trains on ``train_days * 24`` rows and tests on the
    next ``test_days * 24``. With ``calendar`` by days since the earliest day of any series, so that no row of a fold's
    train part, of whatever series, is later than a test row. Folds start one test length apart. A fold that
    ends exactly with the last row or day is left out; ``last_fold`` keeps it.
    """
    by = list(by)
    if calendar:
        train, test = train_days, test_days
        day = F.unix_date(F.to_date("timestamp"))
        ends = df.agg(F.struct(F.min(day).alias("lo"), F.max(day).alias("hi"))).scalar()
        placed = (df.withColumn("_ends", ends).withColumns({"_p": day - F.col("_ends.lo"), "_size": F.col("_ends.hi") - F.col("_ends.lo") + 1})
                  .drop("_ends"))
    else:
        train, test = train_days * 24, test_days * 24
        placed = position_in_series(df, by, ["timestamp"], F.to_date("timestamp"), "_p")
        placed = lookup(placed, df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size")), by)
    room = F.col("_size") - train - test
    folds = F.greatest(F.floor(room / test) + 1, F.lit(0)) if last_fold else F.ceil(room / test)
    first = F.greatest(F.floor((F.col("_p") - train - test) / test) + 1, F.lit(0))
    final = F.least(F.floor(F.col("_p") / test), folds - 1)
    return (placed.withColumn("_folds", F.when(first <= final, F.sequence(first, final)))
            .withColumn("fold", F.explode("_folds"))
            .withColumn("role", F.when(F.col("_p") < F.col("fold") * test + train, "train").otherwise("test"))
            .drop("_p", "_size", "_folds"))


def backtest(features: DataFrame, train_days: int = 30, test_days: int = 7, by=CITY,
             model: str = "boosting", last_fold: bool = False, **params) -> DataFrame:
    """Test rows of all folds with their prediction, and the previous value as ``last_value``.

    ``boosting`` fits a model for each series and fold on that series' own rows, ``pooled`` one for each fold on
    the rows of all series, with folds by calendar. Either fits all its models in the same jobs. ``persistence`` predicts
    the previous value.
    """
    pooled = model == "pooled"
    rows = fold_rows(features, train_days, test_days, by, last_fold, calendar=pooled)
    rows = rows.withColumn("last_value", F.col(f"{TARGET}_lag_1h"))
    if model == "persistence":
        return rows.filter("role = 'test'").withColumn("prediction", F.col("last_value"))
    rows, group = stored(rows), ["fold"] if pooled else [*by, "fold"]
    models = fit_by(rows.filter("role = 'train'"), group, **params)
    return predict_groups(models, rows.filter("role = 'test'"), group, FEATURES)


def backtest_metrics(scored: DataFrame, by=CITY) -> tuple[DataFrame, DataFrame]:
    """(metrics per fold, metrics over all folds) per series."""
    return regression_metrics(scored, by=[*by, "fold"]), regression_metrics(scored, by=list(by))


def compare(model: PipelineModel, t: Warehouse, start, end, cities=None, warmup_days: int = 2) -> DataFrame:
    """Prediction next to actual in a period. Earlier rows only feed lags and means."""
    lower, upper = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    frame = period_frame(t, lower - F.make_interval(days=F.lit(warmup_days)), upper, cities, include_end=True)
    scored = predict(model, build_features(frame)).filter(F.col("timestamp").between(lower, upper))
    return scored.select("city_name", "timestamp", F.col(TARGET).alias("actual"),
                         F.coalesce(finite("prediction"), F.lit(0.0)).alias("predicted"))
