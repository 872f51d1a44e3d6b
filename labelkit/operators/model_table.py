"""A fitted classifier as tables, scored and explained by joins.

A saved model is a table already: a tree ensemble's nodes, a linear model's
coefficients.  :func:`export_model` brings either into one plain form and the
functions below work on that form alone, with relational operators:

* ``nodes``        — ``(tree, node, feature, threshold, left_set, left, right, leaf, rows, gain)``;
* ``coefficients`` — ``(feature, coefficient)``, the intercept at feature −1;
* :func:`feature_entries` — a row's non-zero features as a map, from the
  relational feature twins (no MLlib stage takes part);
* :func:`score_entries` — the class-1 margin and probability.  Trees are walked
  level by level: each level joins the current ``(tree, node)`` with the node
  table and steps to a child.  Margins follow from the leaves by one aggregation
  per row;
* :func:`node_importances` — gain × rows per split feature, as shares of one.

This is a second way to every figure that MLlib gives, so a run can be checked
against it.  The node table (trees × nodes) is broadcast while it is measured to
be small; beyond that the planner shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelkit.functions.local import local_table
from labelkit.operators.features import assembled_entries, category_index, numeric_std
from labelkit.session import scratch_path, stored

#: Largest node table that is broadcast (rows).
BROADCAST_NODES = 500_000


@dataclass(frozen=True)
class ModelTable:
    """A fitted classifier: ``kind`` is ``forest``, ``boosted`` or ``linear``; ``depth`` its deepest node."""

    kind: str
    table: DataFrame
    depth: int = 0
    trees: int = 0


def export_model(spark, model) -> ModelTable:
    """Nodes of a tree ensemble (written by its own writer, read as a table) or coefficients of a linear model."""
    if hasattr(model, "coefficients"):
        # one row per feature dimension, as many as the model itself holds on the driver
        rows = [(-1, float(model.intercept)), *enumerate(map(float, model.coefficients.toArray()))]
        return ModelTable("linear", local_table(spark, rows, "feature int, coefficient double"))
    path = scratch_path(spark, "model-table")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weights").drop("metadata")
    boosted = type(model).__name__.startswith("GBT")
    stats, split = F.col("impurityStats"), F.col("split")
    rows = F.get(stats, 0) if boosted else F.aggregate(stats, F.lit(0.0), lambda s, x: s + x)
    if boosted:  # a tree's vote is its weight times the leaf's value
        leaf = F.col("weights") * F.col("prediction")
    else:  # the class-1 share of the leaf's (weighted) training rows
        leaf = F.when(rows > 0, F.get(stats, 1) / rows).otherwise(0.0)
    inner = F.col("leftChild") >= 0
    continuous = split["numCategories"] == -1
    table = nodes.join(weights, "treeID").select(
        F.col("treeID").cast("int").alias("tree"),
        F.col("id").cast("int").alias("node"),
        F.when(inner, split["featureIndex"]).cast("int").alias("feature"),
        F.when(inner & continuous, F.get(split["leftCategoriesOrThreshold"], 0)).alias("threshold"),
        F.when(inner & ~continuous, split["leftCategoriesOrThreshold"]).alias("left_set"),
        F.when(inner, F.col("leftChild")).cast("int").alias("left"),
        F.when(inner, F.col("rightChild")).cast("int").alias("right"),
        F.when(~inner, leaf).cast("double").alias("leaf"),
        rows.alias("rows"),
        F.when(inner, F.col("gain")).alias("gain"),
    )
    depth = max(t.depth for t in model.trees)
    return ModelTable("boosted" if boosted else "forest", stored(table, "model-nodes"), depth, len(model.trees))


def feature_entries(
    train: DataFrame, rows: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str], key: str
) -> DataFrame:
    """``(key, entries)``: the non-zero features of ``rows`` as a map position → value, with categories
    and deviations of ``train``.  A row has one entry per column, so a map stays small."""
    index = category_index(train, cat_cols, materialize=True)
    std = numeric_std(train, num_cols)
    long = assembled_entries(rows, index, cat_cols, num_cols, std, key)
    pairs = F.collect_list(F.struct("position", "value"))
    return long.groupBy(key).agg(F.map_from_entries(pairs).alias("entries"))


def vector_entries(rows: DataFrame, key: str, features: str = "features") -> DataFrame:
    """``(key, entries)`` from an assembled vector column."""
    dense = F.transform(vector_to_array(features), lambda x, i: F.struct(i.cast("int").alias("i"), x.alias("x")))
    return rows.select(key, F.map_from_entries(F.filter(dense, lambda e: e["x"] != 0)).alias("entries"))


def _node_side(model: ModelTable) -> DataFrame:
    return F.broadcast(model.table) if model.table.count() <= BROADCAST_NODES else model.table


def score_entries(model: ModelTable, entries: DataFrame, key: str) -> DataFrame:
    """P13/P14 — ``(key, margin, p1, predicted_label)`` of the rows in ``entries``."""
    if model.kind == "linear":
        weights = model.table.agg(F.map_from_entries(F.collect_list(F.struct("feature", "coefficient"))).alias("w"))
        # one row: the model itself
        joined = entries.join(F.broadcast(weights))
        products = F.transform(
            F.map_entries("entries"),
            lambda e: e["value"] * F.coalesce(F.try_element_at("w", e["key"]), F.lit(0.0)),
        )
        margin = F.aggregate(products, F.try_element_at("w", F.lit(-1)), lambda s, x: s + x)
        scored = joined.select(key, margin.alias("margin"))
    else:
        nodes = _node_side(model)
        trees = F.sequence(F.lit(0), F.lit(model.trees - 1))
        state = entries.select(key, "entries", F.explode(trees).alias("tree"), F.lit(0).alias("node"))
        for level in range(model.depth + 1):
            value = F.coalesce(F.try_element_at("entries", F.col("feature")), F.lit(0.0))
            goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("left_set", value))
            step = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
            found = state.join(nodes.select("tree", "node", "feature", "threshold", "left_set", "left", "right", "leaf"),
                               ["tree", "node"])
            # a row that stands on a leaf stays there: its vote is kept beside the state
            vote = F.col("leaf") if level == 0 else F.coalesce("vote", "leaf")
            after = F.when(F.col("leaf").isNull(), step).otherwise(F.col("node"))
            state = found.select(key, "entries", "tree", after.alias("node"), vote.alias("vote"))
        scored = state.groupBy(key).agg(F.sum("vote").alias("margin"))
    p1 = {
        "linear": 1 / (1 + F.exp(-F.col("margin"))),
        "boosted": 1 / (1 + F.exp(-2 * F.col("margin"))),
        "forest": F.col("margin") / F.lit(float(model.trees or 1)),
    }[model.kind]
    scored = scored.withColumn("p1", p1)
    return scored.withColumn("predicted_label", (F.col("p1") > 0.5).cast("int"))


def node_importances(model: ModelTable) -> DataFrame:
    """M9 — ``(feature, importance)`` per feature dimension that a split uses, from the node table.

    A split counts its gain times its rows.  In a forest a tree's splits are
    shares of one before they are added up; boosted trees count as they are.
    The sums over all trees are shares of one.  A linear model's importances
    are its absolute coefficients."""
    if model.kind == "linear":
        return model.table.filter("feature >= 0").select("feature", F.abs("coefficient").alias("importance"))
    splits = model.table.filter("left is not null")
    per_tree = splits.groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("worth"))
    whole = per_tree.groupBy("tree").agg(F.sum("worth").alias("whole"))
    if model.kind == "boosted":
        whole = whole.withColumn("whole", F.when(F.col("whole") > 0, 1.0).otherwise(0.0))
    # one row per tree
    shares = per_tree.join(F.broadcast(whole), "tree").filter("whole > 0")
    summed = shares.groupBy("feature").agg(F.sum(F.col("worth") / F.col("whole")).alias("share"))
    total = summed.agg(F.sum("share").alias("total"))
    return summed.join(F.broadcast(total)).select("feature", (F.col("share") / F.col("total")).alias("importance"))


def column_importances(model: ModelTable, layout: Sequence[tuple[str, str]]) -> DataFrame:
    """G13/M9 — importance per base column; ``layout`` gives every dimension's (name, column)."""
    spark = model.table.sparkSession
    names = local_table(spark, [(i, column) for i, (_, column) in enumerate(layout)], "feature int, column string")
    joined = names.join(node_importances(model), "feature", "left")
    return joined.groupBy("column").agg(F.sum(F.coalesce("importance", F.lit(0.0))).alias("importance"))
