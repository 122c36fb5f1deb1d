"""A fitted forest as a table of nodes, walked by joins."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermalis.operators.forecast import DEPTH, FEATURES
from thermalis.sources.durable import scratch_path, settle


def node_table(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """tree, node, prediction, weight, gain, feature (by number), left_values, n_values, left, right: a row per node.

    A split on a category lists the values that go left, any other has its threshold there; n_values is negative then.
    A leaf's children are negative.
    """
    path = scratch_path(spark, "forest")
    model.stages[-1].write().save(path)
    node = "nodeData"
    return settle(spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{node}.id").alias("node"), f"{node}.prediction", F.col(f"{node}.impurityStats")[0].alias("weight"),
        f"{node}.gain", F.col(f"{node}.split.featureIndex").alias("feature"), F.col(f"{node}.split.leftCategoriesOrThreshold").alias("left_values"),
        F.col(f"{node}.split.numCategories").alias("n_values"), F.col(f"{node}.leftChild").alias("left"), F.col(f"{node}.rightChild").alias("right")), "nodes")


def walk(rows: DataFrame, nodes: DataFrame, *keys: str, depth: int = DEPTH) -> DataFrame:
    """keys and walked: the mean prediction of the leaves that each row reaches. rows have the columns of FEATURES.

    Every row goes down all trees, a level per join with the nodes: a broadcast join while they are small enough.
    """
    trees = nodes.agg(F.max("tree")).first()[0] + 1
    now = rows.select(*keys, F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("x"),
                      F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    split = nodes.select("tree", "node", "feature", "left_values", "n_values", "left", "right")
    for _ in range(depth):
        value = F.element_at("x", F.greatest(F.col("feature"), F.lit(0)) + 1)
        goes_left = F.when(F.col("n_values") < 0, value <= F.col("left_values")[0]).otherwise(F.array_contains("left_values", value))
        child = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        now = now.join(split, ["tree", "node"]).select(*keys, "x", "tree", child.alias("node"))
    return now.join(nodes.select("tree", "node", "prediction"), ["tree", "node"]).groupBy(*keys).agg(F.avg("prediction").alias("walked"))


def node_importances(nodes: DataFrame) -> DataFrame:
    """feature, importance: the weighted gains of a feature's splits, of each tree in equal parts."""
    gains = (nodes.filter("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("gain")))
    totals = gains.groupBy("tree").agg(F.sum("gain").alias("total")).filter("total > 0")
    shares = gains.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    whole = shares.agg(F.sum("share").alias("whole"))
    names = F.array(*[F.lit(c) for c in FEATURES])
    return shares.select(F.element_at(names, F.col("feature") + 1).alias("feature"), (F.col("share") / whole.scalar()).alias("importance"))
