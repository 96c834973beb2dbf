"""Classification trees over integer codes, grown level by level from class counts.

All trees of all regions, seasons and slots grow together: a level is one search over the
class counts of every open node, so its cost follows the number of distinct code tuples and
not the number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from firnspark.operators.training import ABSENT, GROUP, fan_out_training, rank_classes
from firnspark.functions.aspects import SLOTS
from firnspark.session import materialise

CODES = ["k0", "k1", "k2"]
TREE = [*GROUP, "slot"]
NODE = [*TREE, "node"]
# Children of node i are 2i and 2i + 1, in a 64-bit integer.
DEEPEST = 61


def tree_cells(counts: DataFrame, years: tuple[int, int]) -> DataFrame:
    """Class counts per tree and code tuple; the tree of slot 0 sees the first code only."""
    gone = F.lit(ABSENT).cast("long")
    hidden = {name: F.when(F.col("slot") == 0, gone).otherwise(F.col(name)) for name in CODES[1:]}
    windows = fan_out_training(counts, years).withColumns(hidden)
    return windows.groupBy(*TREE, *CODES, "y").agg(F.sum("n").alias("n"))


def code_at(feature: Column) -> Column:
    return F.get(F.array(*CODES), feature)


def best_splits(cells: DataFrame) -> DataFrame:
    """(node, feature, threshold) with the least Gini impurity behind it, for every node that is
    neither pure nor a single tuple.

    Thresholds lie midway between neighbouring values.  Of equally good splits the first feature
    counts, then the lowest threshold.  A node that no split improves is split all the same.
    """
    features = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(name).alias("v")) for i, name in enumerate(CODES)])
    entries = cells.withColumn("entry", F.explode(features)).select(*NODE, "entry.*", "y", "n")
    histogram = entries.groupBy(*NODE, "feature", "v", "y").agg(F.sum("n").alias("n"))
    # Everything of a node: rows, and squares of its class counts.
    classes = cells.groupBy(*NODE, "y").agg(F.sum("n").alias("of_class"))
    square = F.col("of_class").cast("double") * F.col("of_class")
    totals = classes.groupBy(*NODE).agg(
        F.sum("of_class").alias("rows"), F.sum(square).alias("squares"), F.count(F.lit(1)).alias("classes")
    )
    mixed = totals.where("classes > 1").drop("classes")
    ordered = Window.partitionBy(*NODE, "feature").orderBy("v")
    cuts = (
        histogram.select(*NODE, "feature", "v").distinct()
        .withColumn("after", F.lead("v").over(ordered))
        .where("after IS NOT NULL")
        .select(*NODE, "feature", F.col("v").alias("cut"), ((F.col("v") + F.col("after")) / 2.0).alias("threshold"))
    )
    # Pairs of a cut and a value of one feature of one node: at most the square of the codes there are.
    left = (
        histogram.join(cuts, [*NODE, "feature"]).where("v <= cut")
        .groupBy(*NODE, "feature", "threshold", "y").agg(F.sum("n").alias("n"))
        .join(classes, [*NODE, "y"])
        .groupBy(*NODE, "feature", "threshold")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n").cast("double") * F.col("n")).alias("own"),
            F.sum(F.col("n").cast("double") * F.col("of_class")).alias("shared"),
        )
    )
    right = F.col("squares") - 2 * F.col("shared") + F.col("own")
    purity = F.col("own") / F.col("n") + right / (F.col("rows") - F.col("n"))
    order = F.struct(purity, -F.col("feature"), -F.col("threshold"))
    chosen = F.max_by(F.struct("feature", "threshold"), order).alias("split")
    return left.join(mixed, NODE).groupBy(*NODE).agg(chosen).select(*NODE, "split.*")


def grow_trees(cells: DataFrame, max_depth: int | None = None) -> DataFrame:
    """One row per node: its split (nulls in a leaf), its classes from the most frequent on, its rows.

    Trees grow until every leaf is pure or a single tuple, or down to ``max_depth`` splits.  No
    cells give no trees.
    """
    if max_depth is not None and not 0 <= max_depth <= DEEPEST:
        raise ValueError(f"max_depth must lie between 0 and {DEEPEST}")
    open_cells = materialise(cells.withColumn("node", F.lit(1).cast("long")))
    levels: list[DataFrame] = []
    for depth in range(DEEPEST + 1):
        ranked = rank_classes(open_cells.groupBy(*NODE, "y").agg(F.sum("n").alias("n")), NODE)
        if depth == max_depth:
            none = {"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")}
            levels.append(materialise(ranked.withColumns(none)))
            break
        levels.append(materialise(ranked.join(best_splits(open_cells), NODE, "left")))
        splits = levels[-1].where("feature IS NOT NULL").select(*NODE, "feature", "threshold")
        beyond = (code_at(F.col("feature")) > F.col("threshold")).cast("long")
        below = open_cells.join(splits, NODE).withColumn("node", 2 * F.col("node") + beyond)
        open_cells = materialise(below.select(*open_cells.columns))
        if open_cells.isEmpty():
            break
    else:
        raise ValueError(f"trees are deeper than {DEEPEST} splits; give max_depth")
    return reduce(DataFrame.unionByName, levels)


def fit_trees(counts: DataFrame, years: tuple[int, int], max_depth: int | None = None) -> DataFrame:
    """Trees of every region, season and slot, from the class counts of ``training.class_counts``."""
    return grow_trees(tree_cells(counts, years), max_depth)


def descend(tree: Column) -> Column:
    """The leaf that the codes of a row lead to in a map of nodes."""
    longest = F.length(F.bin(F.array_max(F.map_keys(tree))))

    def step(node: Column, _: Column) -> Column:
        split = F.element_at(tree, node)
        side = (code_at(split["feature"]) > split["threshold"]).cast("long")
        return F.when(split["feature"].isNull(), node).otherwise(2 * node + side)

    return F.aggregate(F.sequence(F.lit(1), longest), F.lit(1).cast("long"), step)


def resolve_by_trees(tuples: DataFrame, trees: DataFrame) -> DataFrame:
    """Ranked classes of the three slots for distinct (region, season, codes) tuples, seen or not.

    A tree has no more nodes than twice its distinct tuples, so it travels as one map.  Tuples of a
    region and season without trees are dropped.
    """
    held = F.struct("node", F.struct("feature", "threshold", "ranked"))
    maps = trees.groupBy(*TREE).agg(F.map_from_entries(F.collect_list(held)).alias("tree"))
    per_group = maps.groupBy(*GROUP).agg(
        *[F.first(F.when(F.col("slot") == s, F.col("tree")), ignorenulls=True).alias(f"tree_{s}") for s in SLOTS]
    )
    leaves = [F.element_at(F.col(f"tree_{s}"), descend(F.col(f"tree_{s}")))["ranked"].alias(f"ranked_{s}") for s in SLOTS]
    return tuples.join(per_group, GROUP).select(*tuples.columns, *leaves)
