"""A fitted forest as a table of nodes: scored by native columns, importances from the nodes' impurity.

The table has one row a node, (tree, id, feature, threshold, left, right, gain, weight, positive), as the model's own files
tell it; `feature` is -1 for a leaf, and `positive` the share of the positive class among the weighted rows of the node. It
is read by Spark from a saved model, so no library of another kind is needed to score with it. Its size is fixed by the
number of trees and their depth, not by the data.
"""

from __future__ import annotations

import uuid
from math import prod

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from outbreaklens.session import checkpointed, ensure_checkpoint_dir

GRID_CELLS = 1 << 17  # a forest of three features with 32 bins has at most 2**15


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node table of the forest saved at `path`."""
    split, stats = F.col("nodeData.split"), F.col("nodeData.impurityStats")
    weight = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("id"),
        split["featureIndex"].alias("feature"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.gain").alias("gain"),
        weight.alias("weight"),
        F.when(weight > 0, F.get(stats, F.lit(1)) / weight).otherwise(F.lit(0.0)).alias("positive"),
    )


def nodes(model: PipelineModel | RandomForestClassificationModel, spark: SparkSession) -> DataFrame:
    """Node table of a fitted forest, stored."""
    forest = model.stages[-1] if isinstance(model, PipelineModel) else model
    path = scratch_path(spark, "forest")
    forest.save(path)
    return checkpointed(stored_nodes(spark, path))


def with_probability(df: DataFrame, table: DataFrame, features: tuple[str, ...], depth: int, out: str = "onset_probability") -> DataFrame:
    """Add the probability of the positive class: every tree is walked from its root to a leaf.

    A forest asks only on which side of its thresholds a value lies, so rows between the same thresholds go the same way.
    While the thresholds of all features cut out at most `GRID_CELLS` cells, every cell is walked once, as one small job whose
    result is one value of a scalar subquery, and a row takes the mean of its cell. Otherwise every row is walked.
    """
    cuts = table.where("feature >= 0").groupBy("feature").agg(F.array_sort(F.collect_set("threshold")).alias("cuts"))
    found = {row["feature"]: row["cuts"] for row in cuts.collect()}  # no more numbers than the forest has nodes
    cuts_of = [found.get(i, []) for i in range(len(features))]
    if prod(len(cuts) + 1 for cuts in cuts_of) > GRID_CELLS:
        return _walked(df, table, [F.col(name).cast("double") for name in features], depth, out)
    cells = df.sparkSession.range(prod(len(cuts) + 1 for cuts in cuts_of))
    cell, inside, below = F.lit(0), [], F.col("id")
    for name, cuts in zip(features, cuts_of):
        edges = F.array(*[F.lit(float(cut)) for cut in cuts]) if cuts else F.array().cast("array<double>")
        cell = cell * F.lit(len(cuts) + 1) + _passed(F.col(name).cast("double"), edges)
    for cuts in reversed(cuts_of):
        ends = F.array(*[F.lit(float(cut)) for cut in cuts], F.lit(float("inf")))
        inside.append(F.get(ends, (below % (len(cuts) + 1)).cast("int")))
        below = F.call_function("div", below, F.lit(len(cuts) + 1))
    means = _walked(cells, table, inside[::-1], depth, "mean").agg(F.sort_array(F.collect_list(F.struct("id", "mean"))).alias("cells")).select(F.col("cells.mean"))
    return df.withColumn(out, F.get(means.scalar(), cell))


def _passed(value: Column, edges: Column) -> Column:
    """The number of thresholds that `value` lies behind; as in a walk, a missing one lies behind all."""
    return F.size(F.filter(edges, lambda cut: ~F.coalesce(value <= cut, F.lit(False))))


def _walked(df: DataFrame, table: DataFrame, values: list[Column], depth: int, out: str) -> DataFrame:
    """Add the mean over the trees of the share in the leaf that `values` reach.

    The trees are one value of a scalar subquery. A tree gives the share of its leaf; the forest gives the mean over its
    trees, in the order of their numbers.
    """
    node = F.struct("id", "feature", "threshold", "left", "right", "positive")
    trees = (
        table.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        .agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))
        .scalar()
    )
    point = F.array(*values)

    def walked(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(tree["nodes"], at)
            down = F.when(F.get(point, here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])
            return F.when(here["feature"] < 0, at).otherwise(down)

        leaf = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
        return F.get(tree["nodes"], leaf)["positive"]

    # The trees are named once, so the optimizer folds both projections into one and no row carries them.
    nothing = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
    mean = F.aggregate(
        "_trees",
        nothing,
        lambda so_far, tree: F.struct((so_far["sum"] + walked(tree)).alias("sum"), (so_far["n"] + 1).alias("n")),
        lambda total: total["sum"] / total["n"],
    )
    return df.withColumn("_trees", trees).withColumn(out, mean).drop("_trees")


def importances(table: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """(feature, importance) that add up to 1: weighted falls of impurity, each tree's adding up to 1, averaged.

    Trees without a split tell nothing; a feature that no tree splits by has importance 0.
    """
    falls = table.where("feature >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("fall"))
    trees = falls.groupBy("tree").agg(F.sum("fall").alias("all"))
    shares = falls.join(trees, "tree").where("all > 0").groupBy("feature").agg(F.sum(F.col("fall") / F.col("all")).alias("share"))
    named = F.element_at(F.array(*[F.lit(name) for name in features]), (F.col("feature") + 1).cast("int"))
    everyone = table.sparkSession.createDataFrame([(name, 0.0) for name in features], "name string, share double")
    both = shares.select(named.alias("name"), "share").unionByName(everyone).groupBy("name").agg(F.sum("share").alias("share"))
    total = both.agg(F.sum("share")).scalar()
    return both.select(F.col("name").alias("feature"), F.when(total > 0, F.col("share") / total).otherwise(F.lit(0.0)).alias("importance"))
