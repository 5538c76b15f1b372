"""Features, metrics, folds and models on formula data."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlattice.operators import boosting as B
from airlattice.plans import forecast as M

START = datetime(2024, 1, 1)
SMALL = {"maxIter": 5, "maxDepth": 3}


def frame(spark, hours=720, city="x"):
    rows = [(city, START + timedelta(hours=h), 20 + 5 * math.sin(h / 4), 50.0 + h % 20, 0.0, 5.0 + h % 5, float(h % 360),
             30.0 + h % 7, 15 + 5 * math.sin(2 * math.pi * h / 24) + h / 200) for h in range(hours)]
    return spark.createDataFrame(rows, "city_name STRING, timestamp TIMESTAMP, temperature_c DOUBLE, humidity_percent DOUBLE, "
                                 "precipitation_mm DOUBLE, wind_speed_ms DOUBLE, wind_direction_deg DOUBLE, pm10 DOUBLE, pm25 DOUBLE")


@pytest.fixture(scope="module")
def features(spark):
    return M.build_features(frame(spark)).cache()


def test_feature_columns(features):
    assert len(M.FEATURES) == 24 and set(M.FEATURES) <= set(features.columns)
    assert features.count() == 720
    assert features.filter(" OR ".join(f"{c} IS NULL OR isnan({c})" for c in M.FEATURES)).count() == 0


def test_absent_base_column_is_zero(spark):
    got = M.build_features(frame(spark, 30).drop("pm10", "wind_direction_deg"))
    assert got.agg(F.max("pm10"), F.max("wind_x")).first() == (0.0, 9.0)


def test_median_imputation(spark):
    df = frame(spark, 5).withColumn("pm10", F.when(F.hour("timestamp") < 3, F.hour("timestamp").cast("double")))
    df = df.withColumn("temperature_c", F.lit(None).cast("double"))
    rows = M.impute_median(df, ["pm10", "temperature_c"]).orderBy("timestamp").collect()
    assert [r["pm10"] for r in rows] == [0.0, 1.0, 2.0, 1.0, 1.0] and {r["temperature_c"] for r in rows} == {0.0}


def test_leak_free_means_end_one_row_earlier(spark):
    rows = M.build_features(frame(spark, 30), leak_free=True).orderBy("timestamp").collect()
    source = frame(spark, 30).orderBy("timestamp").collect()
    assert len(rows) == 29
    assert rows[5]["pm25_ma_3h"] == pytest.approx(sum(r["pm25"] for r in source[3:6]) / 3)


def test_splits(features):
    parts = {r["part"]: r["count"] for r in M.split(features).groupBy("part").count().collect()}
    assert sum(parts.values()) == 720 and abs(parts["train"] - 461) < 60
    timed = M.split(features, mode="time")
    assert {r["part"]: r["count"] for r in timed.groupBy("part").count().collect()} == {"train": 461, "validation": 115, "test": 144}
    ends = {r["part"]: (r["lo"], r["hi"]) for r in timed.groupBy("part").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()}
    assert ends["train"][1] < ends["validation"][0] and ends["validation"][1] < ends["test"][0]


def test_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("a", 5.0, 4.0), ("a", None, 4.0), ("b", 2.0, 3.0)], "city_name STRING, pm25 DOUBLE, prediction DOUBLE")
    got = {r["city_name"]: r for r in M.regression_metrics(df).collect()}
    assert got["a"]["n"] == 3 and got["a"]["rmse"] == pytest.approx(math.sqrt(2 / 3))
    assert got["a"]["r2"] == pytest.approx(0.75) and got["a"]["mae"] == pytest.approx(2 / 3)
    assert got["b"]["r2"] is None


def test_train_save_load(spark, features, tmp_path):
    model, metrics = M.train(features, **SMALL)
    assert {r["part"]: r["r2"] > 0 for r in metrics.collect()} == {"train": True, "validation": True, "test": True}
    path = M.model_path(str(tmp_path), "New York")
    assert path.endswith("/pm25_model_new_york")
    M.save_model(model, path)
    loaded = M.load_model(path)
    assert M.model_features(loaded) == M.FEATURES
    before, after = [sorted((r["timestamp"], r["prediction"]) for r in M.predict(m, features).collect()) for m in (model, loaded)]
    assert before == after and all(math.isfinite(p) for _, p in before)
    with pytest.raises(ValueError):
        M.predict(None, features)


def test_short_cities_are_trained_or_reported(spark, features, tmp_path):
    few = features.limit(50).withColumn("city_name", F.lit("few"))
    both = features.unionByName(few)
    models, metrics, left_out = M.train_cities(both, ["x", "few", "none"], root=str(tmp_path), maxIter=2, maxDepth=2)
    assert {r["city_name"] for r in models.collect()} == {"x", "few"}
    assert {(r["city_name"], r["part"]) for r in metrics.collect()} == {(c, p) for c in ("x", "few") for p in ("train", "validation", "test")}
    assert [tuple(r) for r in left_out.collect()] == [("none", "0 rows, 1 needed")]
    models, metrics, left_out = M.train_cities(both, ["few"], min_rows=100, maxIter=1, maxDepth=1)
    assert models.count() == 0 and metrics.count() == 0 and left_out.first()["reason"] == "50 rows, 100 needed"
    loaded = M.load_city_models(spark, str(tmp_path))
    assert {r["model_path"].rsplit("/", 1)[1] for r in loaded.collect()} == {"pm25_model_x", "pm25_model_few"}
    assert M.predict_cities(loaded, both).filter("prediction IS NULL").count() == 0
    assert {r["city_name"] for r in M.train_cities(both, maxIter=1, maxDepth=1)[0].collect()} == {"x", "few"}


def grow(rows, features, trees, depth, step, cuts, min_child, min_split):
    """Plain boosting on one group; rows are (x, y); returns a predictor."""
    base = sum(y for _, y in rows) / len(rows)
    left = [y - base for _, y in rows]
    forest = []

    def best(at):
        found = (1e-9, None)
        total = sum(left[i] for i in at)
        for f in range(features):
            for cut in cuts[f]:
                lo = [i for i in at if rows[i][0][f] <= cut]
                if len(lo) < min_child or len(at) - len(lo) < min_child or len(at) < min_split:
                    continue
                s = sum(left[i] for i in lo)
                gain = s * s / len(lo) + (total - s) ** 2 / (len(at) - len(lo)) - total * total / len(at)
                if gain > found[0] + 1e-9 * abs(found[0]):
                    found = (gain, (f, cut))
        return found[1]

    def build(at, level):
        split = best(at) if level < depth else None
        if split is None:
            return sum(left[i] for i in at) / len(at)
        f, cut = split
        return (f, cut, build([i for i in at if rows[i][0][f] <= cut], level + 1), build([i for i in at if rows[i][0][f] > cut], level + 1))

    def value(tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(trees):
        tree = build(range(len(rows)), 0)
        forest.append(tree)
        left = [r - step * value(tree, x) for r, (x, _) in zip(left, rows)]
    return lambda x: base + step * sum(value(tree, x) for tree in forest)


def test_grouped_trees_equal_plain_boosting(spark):
    """Few distinct values, so bins hold one value each and cuts are known; groups of all sizes, null group values too."""
    rng = random.Random(11)
    data = [(g, f, float(rng.randrange(5)), float(rng.randrange(7)), 3.0, None) for g, n in (("a", 200), (None, 60), ("tiny", 3)) for f in (0, 1) for _ in range(n)]
    data = [(*r[:5], r[2] * (r[1] + 1) - (r[3] > 3) * 4 + rng.random()) for r in data] + [("a", 0, 1.0, 1.0, 3.0, None)]
    df = spark.createDataFrame(data, "g STRING, fold INT, p DOUBLE, q DOUBLE, same DOUBLE, y DOUBLE").repartition(3)
    by, names = ["g", "fold"], ["p", "q", "same"]
    models = B.fit_groups(df, by, names, "y", trees=4, depth=3, step=0.3, min_child=2, min_split=10)
    got = {(r["g"], r["fold"], r["p"], r["q"]): r["prediction"] for r in B.predict_groups(models, df, by, names).collect()}
    for group in {r[:2] for r in data}:
        rows = [(r[2:5], r[5]) for r in data if r[:2] == group and r[5] is not None]
        cuts = [sorted({x[k] for x, _ in rows}) for k in range(3)]
        plain = grow(rows, 3, 4, 3, 0.3, cuts, 2, 10)
        for x, _ in rows:
            assert got[(*group, x[0], x[1])] == pytest.approx(plain(x), abs=1e-6)
    assert B.predict_groups(models, df.withColumn("g", F.lit("unknown")), by, names).filter("prediction IS NOT NULL").count() == 0
    assert B.fit_groups(df.filter("false"), by, names, "y", trees=1, depth=1).count() == 0


def test_no_train_row_of_any_series_is_later_than_a_test_row(spark):
    """Series that begin at different times: positions do not line up, calendar days do."""
    later = frame(spark, 600, "late").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 11 DAYS"))
    both = frame(spark, 900, "x").unionByName(later)
    folds = M.fold_rows(both, 10, 3, calendar=True)
    ends = folds.groupBy("fold").agg(F.max(F.when(F.col("role") == "train", F.col("timestamp"))).alias("train"),
                                     F.min(F.when(F.col("role") == "test", F.col("timestamp"))).alias("test")).collect()
    assert len(ends) == 9 and all(r["train"] < r["test"] for r in ends)
    assert {r["city_name"] for r in folds.filter("role = 'test'").select("city_name").distinct().collect()} == {"x", "late"}


@pytest.mark.parametrize("hours,last_fold,folds", [(888, False, 0), (889, False, 1), (888, True, 1), (887, True, 0), (1100, False, 2), (1056, True, 2)])
def test_fold_admission(spark, hours, last_fold, folds):
    rows = M.fold_rows(frame(spark, hours), 30, 7, last_fold=last_fold)
    assert rows.select("fold").distinct().count() == folds
    sizes = {(r["fold"], r["role"]): r["count"] for r in rows.groupBy("fold", "role").count().collect()}
    assert all(n == (720 if role == "train" else 168) for (_, role), n in sizes.items())


def test_backtests(features):
    per_fold, overall = M.backtest_metrics(M.backtest(features, 20, 3, model="persistence"))
    assert per_fold.count() == 3 and overall.first()["n"] == 3 * 72
    boosted = M.backtest(features, 20, 3, model="boosting", maxIter=2, maxDepth=2)
    assert boosted.count() == 3 * 72 and boosted.filter("prediction IS NULL").count() == 0
    pooled = M.backtest(features, 20, 3, model="pooled", maxIter=2, maxDepth=2)
    assert pooled.count() == 3 * 72 and pooled.filter("prediction IS NULL").count() == 0
