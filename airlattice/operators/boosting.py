"""Gradient-boosted regression trees for very many groups at once, without a Python UDF.

All groups (a city, a city and a fold, ...) grow their trees in the same jobs. A level of a tree is one aggregate: sums
and counts of the residuals per group, node, feature and bin. Bins are bounded per feature by quantiles of the group's
own rows. The number of jobs depends on the number of trees and levels alone, never on the number of groups or rows, and
a hot group is spread like any other, since partial sums are formed before the shuffle.

A fitted model is a table: one row per group, its trees as arrays in heap order (children of node i at 2i+1 and 2i+2).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlattice.session import drop_stored, stored
from airlattice.tables import lookup

BINS = 32


def _cut_points(rows: DataFrame, by: list[str], features: list[str], bins: int) -> DataFrame:
    """(by, _mean, _cuts): the group's mean target and, per feature, the distinct bounds between its bins."""
    shares = [k / bins for k in range(1, bins)]
    cuts = [F.array_distinct(F.percentile_approx(F.col("_x")[k], shares, 10 * bins)) for k in range(len(features))]
    return rows.groupBy(*by).agg(F.avg("_y").alias("_mean"), F.array(*cuts).alias("_cuts"))


def _best_splits(rows: DataFrame, by: list[str], min_child: int, min_split: int) -> DataFrame:
    """(by, node, f, b, cut sums): the split of each node with the greatest gain; none where nothing is gained.

    Rows of bin ``b`` or lower of feature ``f`` go left. Equal gains go to the lower feature, then the lower bin.
    """
    bins = rows.select(*by, "_node", "_r", F.posexplode("_b").alias("f", "b"))
    cells = bins.groupBy(*by, "_node", "f", "b").agg(F.sum("_r").alias("s"), F.count(F.lit(1)).alias("n"))
    feature = Window.partitionBy(*by, "_node", "f")
    upto = feature.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    sums = (cells.withColumns({"ls": F.sum("s").over(upto), "ln": F.sum("n").over(upto)})
            .withColumns({"rs": F.sum("s").over(feature) - F.col("ls"), "rn": F.sum("n").over(feature) - F.col("ln")})
            .filter((F.col("ln") >= min_child) & (F.col("rn") >= min_child) & (F.col("ln") + F.col("rn") >= min_split)))
    total = F.col("ls") + F.col("rs")
    gain = F.col("ls") ** 2 / F.col("ln") + F.col("rs") ** 2 / F.col("rn") - total ** 2 / (F.col("ln") + F.col("rn"))
    best = (sums.withColumn("gain", gain).filter("gain > 1e-9")
            .groupBy(*by, "_node").agg(F.max(F.struct("gain", -F.col("f"), -F.col("b"), F.col("ls") / F.col("ln"), F.col("rs") / F.col("rn"))).alias("m")))
    return best.select(*by, "_node", (-F.col("m.col2")).alias("f"), (-F.col("m.col3")).alias("b"),
                       F.col("m.col4").alias("left"), F.col("m.col5").alias("right"))


def _tree_table(splits: DataFrame, by: list[str]) -> DataFrame:
    """(by, _tree): a map from node to its split."""
    entry = F.struct("_node", F.struct("f", "b", "left", "right"))
    return splits.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("_tree"))


def _walk(tree: Column, bins: Column, levels: int) -> Column:
    """The node where a row ends after so many levels; it stays where there is no split."""
    def down(node: Column, _: Column) -> Column:
        split = F.try_element_at(tree, node)
        return F.when(split.isNull(), node).otherwise(2 * node + 1 + (F.get(bins, split["f"]) > split["b"]).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), down)


def _value(tree: Column, node: Column) -> Column:
    """Mean residual in a node, as its parent's split knows it; 0 in the root, where residuals average to 0."""
    parent = F.try_element_at(tree, F.floor((node - 1) / 2).cast("int"))
    return F.when(node == 0, 0.0).otherwise(F.when(node % 2 == 1, parent["left"]).otherwise(parent["right"]))


def fit_groups(rows: DataFrame, by: list[str], features: list[str], target: str, trees: int = 200, depth: int = 7,
               step: float = 0.05, bins: int = BINS, min_child: int = 5, min_split: int = 10) -> DataFrame:
    """(by, base, trees): one model for each group of ``rows``; squared loss, each tree scaled by ``step``.

    ``trees`` is an array of arrays, for each node (f, cut, value): rows with feature ``f`` up to ``cut`` go to the left child; a
    node without a split has f = -1 and the tree's value there. A row without a target takes no part; features must not
    be null. Null group values form a group. Each level stores one small table, each tree the rows with their residuals.
    """
    narrow = rows.filter(F.col(target).isNotNull()).select(
        *by, F.col(target).cast("double").alias("_y"), F.array(*[F.col(f).cast("double") for f in features]).alias("_x"))
    narrow = stored(narrow)
    groups = stored(_cut_points(narrow, by, features, bins))
    binned = F.zip_with("_x", "_cuts", lambda x, cuts: F.size(F.filter(cuts, lambda c: c < x)))
    now = stored(lookup(narrow, groups, by).select(*by, binned.alias("_b"), (F.col("_y") - F.col("_mean")).alias("_r")))
    drop_stored(narrow)
    grown = []
    for _ in range(trees):
        levels, tree = [], None
        for level in range(depth):
            at = now.withColumn("_node", F.lit(0))
            if tree is not None:
                at = (lookup(now, tree, by).withColumn("_node", _walk(F.col("_tree"), F.col("_b"), level))
                      .filter(F.col("_node") >= (1 << level) - 1).drop("_tree"))
            levels.append(stored(_best_splits(at, by, min_child, min_split)))
            tree = _tree_table(reduce(DataFrame.unionByName, levels), by)
        tree = stored(tree)
        for level in levels:
            drop_stored(level)
        grown.append(tree)
        if len(grown) < trees:
            moved = lookup(now, tree, by, "left").withColumn("_node", F.when(F.col("_tree").isNull(), 0).otherwise(_walk(F.col("_tree"), F.col("_b"), depth)))
            gain = F.when(F.col("_tree").isNull(), 0.0).otherwise(_value(F.col("_tree"), F.col("_node")))
            later = stored(moved.select(*by, "_b", (F.col("_r") - step * gain).alias("_r")))
            drop_stored(now)
            now = later
    drop_stored(now)
    return _models(groups, grown, by, depth, step)


def _models(groups: DataFrame, grown: list[DataFrame], by: list[str], depth: int, step: float) -> DataFrame:
    """The groups' trees with bounds of bins turned into bounds of the features, by number of the tree."""
    numbered = reduce(DataFrame.unionByName, [t.withColumn("_at", F.lit(k)) for k, t in enumerate(grown)])
    collected = numbered.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_at", "_tree"))).alias("_trees"))
    joined = lookup(groups, collected, by, "left")
    nodes = F.sequence(F.lit(0), F.lit((1 << (depth + 1)) - 2))

    def node_of(tree: Column, node: Column) -> Column:
        split = F.try_element_at(tree, node)
        leaf = F.struct(F.lit(-1).alias("f"), F.lit(0.0).alias("cut"), (step * F.coalesce(_value(tree, node), F.lit(0.0))).alias("value"))
        inner = F.struct(split["f"].alias("f"), F.get(F.get(F.col("_cuts"), split["f"]), split["b"]).alias("cut"), leaf["value"].alias("value"))
        return F.when(split.isNull(), leaf).otherwise(inner)

    trees = F.transform(F.sequence(F.lit(0), F.lit(len(grown) - 1)),
                        lambda k: F.transform(nodes, lambda n: node_of(F.try_element_at(F.col("_trees"), k), n)))
    return stored(joined.select(*by, F.col("_mean").alias("base"), trees.alias("trees")))


def predict_groups(models: DataFrame, rows: DataFrame, by: list[str], features: list[str], name: str = "prediction") -> DataFrame:
    """``rows`` with the prediction of their group's model; null where the group has none."""
    fitted = models.withColumnsRenamed({"base": "_base", "trees": "_trees"})
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    joined = lookup(rows, fitted, by, "left").withColumn("_x", x)

    def leaf(tree: Column) -> Column:
        def down(node: Column, _: Column) -> Column:
            here = F.get(tree, node)
            return F.when(here["f"] < 0, node).otherwise(2 * node + 1 + (F.get(F.col("_x"), here["f"]) > here["cut"]).cast("int"))

        levels = F.sequence(F.lit(1), F.ceil(F.log2(F.size(tree) + 1.0)).cast("int"))
        return F.get(tree, F.aggregate(levels, F.lit(0), down))["value"]

    total = F.aggregate("_trees", F.col("_base"), lambda sum_, tree: sum_ + leaf(tree))
    return joined.withColumn(name, total).drop("_base", "_trees", "_x")
