"""Cluster summaries for curation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.columns import percentage


def cluster_summary(df: DataFrame, cluster: str = "topic_id", label: str = "Name") -> DataFrame:
    """(cluster, label, Count, Percentage): rows without a cluster are not listed, but count in the whole."""
    total = df.agg(F.count("*").alias("_total"))
    groups = df.where(F.col(cluster).isNotNull()).groupBy(F.col(cluster).alias("cluster")).agg(F.min_by(label, "ord").alias("label"), F.count("*").alias("Count"))
    return groups.crossJoin(F.broadcast(total)).select("cluster", "label", "Count", percentage(F.col("Count"), F.col("_total")).alias("Percentage"))  # the total is one row


def by_count(summary: DataFrame) -> DataFrame:
    """A summary with `place`, 1 for the cluster of most rows; ties go by cluster."""
    order = Window.orderBy(F.desc("Count"), "cluster")  # a row for each cluster
    return summary.withColumn("place", F.row_number().over(order)).orderBy("place")


def layer_rows(df: DataFrame, layers: list[int]) -> DataFrame:
    """(ord, layer, cluster, label): the wide layer columns as rows, in one pass."""
    each = F.array(*(F.struct(F.lit(k).alias("layer"), F.col(f"topic_layer_{k}_id").alias("cluster"), F.col(f"topic_layer_{k}_label").alias("label")) for k in layers))
    return df.select("ord", F.explode(each).alias("l")).select("ord", "l.*")


def hierarchy_summary(df: DataFrame, layers: list[int], working: int) -> DataFrame:
    """cluster_summary of every layer, with the layer and whether it is the working one."""
    total = df.agg(F.count("*").alias("_total"))
    groups = layer_rows(df, layers).where("cluster is not null").groupBy("layer", "cluster").agg(F.min_by("label", "ord").alias("label"), F.count("*").alias("Count"))
    return groups.crossJoin(F.broadcast(total)).select(
        "layer", "cluster", "label", "Count", percentage(F.col("Count"), F.col("_total")).alias("Percentage"), (F.col("layer") == working).alias("is_working_layer"))


def working_layer(n_layers: int, choice: int | str = "auto") -> int:
    """The coarsest layer, or a valid number."""
    if choice == "auto":
        return n_layers - 1
    if not 0 <= int(choice) < n_layers:
        raise ValueError(f"layer {choice} is not among 0..{n_layers - 1}")
    return int(choice)


def wide_layers(assigned: DataFrame, layers: list[int], primary: int) -> DataFrame:
    """A row for each Bibcode with id and label of each layer, from (Bibcode, layer, cluster_id, label)."""
    columns = []
    for k in layers:
        here = F.col("layer") == k
        columns += [F.max(F.when(here, F.col("cluster_id"))).alias(f"topic_layer_{k}_id"), F.max(F.when(here, F.col("label"))).alias(f"topic_layer_{k}_label")]
    return assigned.groupBy("Bibcode").agg(*columns).withColumns({"topic_primary_layer_index": F.lit(primary), "topic_layer_count": F.lit(len(layers))})


def clusters_per_layer(assigned: DataFrame) -> DataFrame:
    """(layer, clusters) without noise."""
    return assigned.groupBy("layer").agg(F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id"))).alias("clusters"))


def parents(tree: DataFrame) -> DataFrame:
    """(child_layer, child_id, parent_layer, parent_id) from (parent_layer, parent_id, children)."""
    return tree.select(F.explode("children").alias("c"), "parent_layer", "parent_id").select(F.col("c.layer").alias("child_layer"), F.col("c.id").alias("child_id"), "parent_layer", "parent_id")


def colours(df: DataFrame, palette: list[str], label: str = "Name") -> DataFrame:
    """(label, colour): palette colours by the order in which labels are first seen."""
    seen = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.min("ord").alias("_first"))
    number = F.row_number().over(Window.orderBy("_first", "label")) - 1  # one row for each label
    return seen.select("label", F.get(F.array(*map(F.lit, palette)), number % len(palette)).alias("colour"))
