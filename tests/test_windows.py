"""Blocked windows, ranks and medians against plain Python."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from airlattice.operators import windows as W

START = datetime(2024, 1, 1)


def series(spark, seed, sizes, gap=200):
    """Series with long gaps, empty days and days of many rows."""
    rng = random.Random(seed)
    rows = []
    for key, size in sizes.items():
        at = START
        for _ in range(size):
            at += timedelta(minutes=rng.choice([1, 1, 1, 7, 61, gap * 60]))
            rows.append((key, at, rng.choice([None, rng.random(), float(rng.randint(0, 5))])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k STRING, timestamp TIMESTAMP, v DOUBLE").repartition(5)


@pytest.mark.parametrize("seed,block", [(1, 6), (2, 7), (3, 25), (4, 400), (5, 1 << 18)])
def test_blocks_equal_one_window(spark, seed, block):
    df = series(spark, seed, {"a": 700, "b": 40, "c": 1})
    made = {"lag6": W.lag_of("v", 6), "lag1": W.lag_of("v", 1), "mean7": W.trailing_mean("v", 7)}
    got = W.with_history(df, ["k"], "timestamp", 6, made, block_rows=block)
    spec = Window.partitionBy("k").orderBy("timestamp")
    want = df.withColumns({name: make(spec) for name, make in made.items()})
    columns = ["k", "timestamp", "v", "lag1", "lag6", F.round("mean7", 9)]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))


def exchanges(plan):
    """Shuffle exchanges of a physical plan, those inside query stages included, without broadcast subplans' own rows."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node)
        inner = [node.plan()] if name.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
        todo += inner
    return found


def plan_node_output(node):
    return node.output().mkString(",")


def test_one_hot_series_is_cut_into_blocks(spark):
    """A series with almost all rows ends up in many window partitions of bounded size."""
    df = spark.range(20_000).select(
        F.when(F.col("id") < 19_000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(START) + F.make_interval(mins=F.col("id").cast("int"))).alias("timestamp"), F.col("id").alias("v"))
    placed = W.in_blocks(df, ["k"], F.to_date("timestamp"), 24, 2_000)
    sizes = placed.filter("k = 'hot'").groupBy("_block").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] >= 9 and sizes[1] <= 2_000 + 2 * 1_440
    assert placed.filter("k <> 'hot'").agg(F.max("_block"), F.count("*")).first()[:] == (0, 1_000)


def test_history_longer_than_block_makes_longer_blocks(spark):
    df = series(spark, 1, {"a": 60, "b": 3})
    plain = Window.partitionBy("k").orderBy("timestamp")
    want = {(r.k, r.timestamp, r.back) for r in df.withColumn("back", F.lag("v", 10).over(plain)).collect()}
    got = W.with_history(df, ["k"], "timestamp", 10, {"back": W.lag_of("v", 10)}, block_rows=5)
    assert {(r.k, r.timestamp, r.back) for r in got.collect()} == want


def test_number_of_edges_is_bounded(spark):
    """Blocks grow so that all series together have no more starts than asked for."""
    df = spark.range(40_000).select((F.col("id") % 4).alias("k"), (F.col("id") / 40).cast("int").alias("day"), "id")
    sliced = df.withColumn("_slice", F.struct("day"))
    edges = W.block_edges(sliced, ["k"], 3, 10, edges=64)
    assert 32 <= edges.agg(F.sum(F.size("_starts"))).first()[0] <= 64
    few = W.position_in_series(df, ["k"], ["id"], F.col("day"), block_rows=10)
    assert few.filter(F.col("position") != F.floor(F.col("id") / 4)).count() == 0


def test_rows_are_shuffled_once(spark, tmp_path):
    """On stored rows, the one exchange that carries values is that of the window; counts and starts are all else."""
    series(spark, 5, {"a": 4_000, "b": 50}).write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    for frame in (W.with_history(stored, ["k"], "timestamp", 6, {"m": W.trailing_mean("v", 7)}, block_rows=500),
                  W.position_in_series(stored, ["k"], ["timestamp", "v"], F.to_date("timestamp"), block_rows=500)):
        frame.collect()
        for final in (False, True):
            plan = frame._jdf.queryExecution().executedPlan()
            plan = plan.executedPlan() if final else plan.initialPlan()
            names = plan.toString()
            # What an exchange sends is listed in its output; the value column is in one only.
            sent = [plan_node_output(x) for x in exchanges(plan)]
            assert sum("v#" in s for s in sent) == 1, names


def test_null_keys_and_times_are_kept(spark):
    df = spark.createDataFrame([(None, START, 1.0), (None, START + timedelta(hours=1), 2.0), ("a", None, 3.0)],
                               "k STRING, timestamp TIMESTAMP, v DOUBLE")
    got = W.with_history(df, ["k"], "timestamp", 1, {"prev": W.lag_of("v", 1)})
    assert {(r["k"], r["v"], r["prev"]) for r in got.collect()} == {(None, 1.0, None), (None, 2.0, 1.0), ("a", 3.0, None)}


def test_position(spark):
    df = series(spark, 9, {"a": 300, "b": 20})
    got = W.position_in_series(df, ["k"], ["timestamp"], F.to_date("timestamp"))
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("timestamp")) - 1)
    assert {(r["k"], r["timestamp"], r["position"]) for r in got.collect()} == {
        (r["k"], r["timestamp"], r["position"]) for r in want.collect()}


def test_lag_and_mean_helpers(spark):
    df = series(spark, 3, {"a": 30}).filter("v IS NOT NULL")
    lags = W.lag_features(df, "v", [1, 2], ["k"])
    means = W.rolling_means(df, "v", [3], ["k"])
    assert {"v_lag_1h", "v_lag_2h"} <= set(lags.columns) and "v_ma_3h" in means.columns
    ordered = sorted(means.collect(), key=lambda r: r["timestamp"])
    assert ordered[0]["v_ma_3h"] == ordered[0]["v"]
    assert ordered[2]["v_ma_3h"] == pytest.approx(sum(r["v"] for r in ordered[:3]) / 3)


def test_trailing_days(spark):
    df = series(spark, 5, {"a": 200, "b": 30}, gap=30).filter("v IS NOT NULL")
    rows = df.collect()
    got = W.trailing_days_mean(df, "v", 3, ["k"], block_days=4).collect()
    assert len(got) == len(rows)
    for r in got:
        inside = [x["v"] for x in rows if x["k"] == r["k"]
                  and timedelta(0) <= r["timestamp"] - x["timestamp"] < timedelta(days=3)]
        assert r["mean"] == pytest.approx(sum(inside) / len(inside))


def test_fill_hours(spark):
    df = spark.createDataFrame([("a", START, 1.0), ("a", START + timedelta(hours=26), 2.0), ("b", START, 3.0)],
                               "k STRING, timestamp TIMESTAMP, v DOUBLE")
    got = W.fill_hours(df, ["k"])
    assert got.filter("k = 'a'").count() == 27 and got.filter("k = 'b'").count() == 1
    assert got.filter("v IS NOT NULL").count() == 3


@pytest.mark.parametrize("cells", [1, 3, 4096])
def test_exact_medians(spark, cells):
    rng = random.Random(4)
    data = {"a": [rng.gauss(0, 1e6) for _ in range(101)], "b": [rng.choice([1.0, 2.0]) for _ in range(50)],
            "c": [7.0], "d": [1.0, 1.0, 1.0, 1e300]}
    rows = [(k, v, None) for k, vs in data.items() for v in vs] + [("a", None, None), ("a", float("nan"), None)]
    df = spark.createDataFrame(rows, "k STRING, x DOUBLE, y DOUBLE")
    got = {(r["k"], r["column"]): r["median"] for r in W.exact_medians(df, ["x", "y"], ["k"], cells).collect()}
    assert got == {(k, "x"): statistics.median(v) for k, v in data.items()}
