"""A trained tree ensemble as a table, and scores computed from that table.

A saved model keeps its trees as Parquet rows, one a node. Here they become one
row of arrays, and a row of features walks down every tree by array look-ups:
plain expressions, no Python, no shuffle. The table can be read, compared and
stored like any other, and its scores check the model's own row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE = "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, value double, weight double"


def tree_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """One row a node of the last stage of a saved pipeline: ``x[feature] <=
    threshold`` goes left (of a categorical split: ``x[feature]`` in
    ``categories``); leaves have no children and a value."""
    stage = f"{model_path}/stages/*"
    kept = spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*")
    tree, _, weight = (meta := spark.read.parquet(f"{stage}/treesMetadata")).columns
    weights = meta.select(F.col(tree).alias("treeID"), F.col(weight).alias("weight"))
    inner = F.col("leftChild") >= 0
    plain = F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    return kept.join(F.broadcast(weights), "treeID").select(       # a row a tree
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & plain, F.get(values, F.lit(0))).alias("threshold"),
        F.when(inner & ~plain, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.col("prediction").alias("value"), "weight")


def ensemble(nodes: DataFrame) -> DataFrame:
    """The trees in one row: ``trees``, an array of (weight, arrays over the
    nodes). Its size is the model's: trees x 2 ** (depth + 1) nodes at most."""
    per_node = F.struct("node", "feature", "threshold", "categories", "left", "right", "value")
    tree = nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.sort_array(F.collect_list(per_node)).alias("nodes"))
    one = F.struct("tree", "weight", F.col("nodes.feature").alias("feature"), F.col("nodes.threshold").alias("threshold"),
                   F.col("nodes.categories").alias("categories"), F.col("nodes.left").alias("left"),
                   F.col("nodes.right").alias("right"), F.col("nodes.value").alias("value"))
    return tree.agg(F.sort_array(F.collect_list(one)).alias("trees"))


def _leaf(tree: Column, x: Column, depth: int) -> Column:
    """The leaf that ``x`` reaches in one tree."""
    def step(node: Column, _: Column) -> Column:
        at = F.get(x, F.get(tree["feature"], node))
        categories = F.get(tree["categories"], node)
        goes_left = F.when(categories.isNotNull(), F.array_contains(categories, at)).otherwise(at <= F.get(tree["threshold"], node))
        below = F.when(goes_left, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
        return F.when(F.get(tree["left"], node).isNull(), node).otherwise(below)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def score_with_trees(df: DataFrame, nodes: DataFrame, features: Sequence[str], depth: int) -> DataFrame:
    """``df`` with ``margin`` (weighted sum over the trees) and ``prediction`` (1
    where it is positive). A missing feature is NaN, which goes right."""
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    margin = F.aggregate(F.col("__m.trees"), F.lit(0.0),
                         lambda sum_, t: sum_ + t["weight"] * F.get(t["value"], _leaf(t, F.col("__x"), depth)))
    model = ensemble(nodes).select(F.struct("trees").alias("__m"), F.lit(1).alias("__one"))
    own = [F.col(f"`{c}`") for c in df.columns]
    return (df.withColumns({"__x": x, "__one": F.lit(1)}).join(F.broadcast(model), "__one")      # one row of bounded size
            .select(*own, margin.alias("margin")).withColumn("prediction", (F.col("margin") > 0).cast("double")))
