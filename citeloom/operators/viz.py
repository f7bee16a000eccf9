"""Data for an interactive map of a corpus; drawing it is left to a renderer."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.columns import marker_size, publication_date
from citeloom.functions.text import authors_text, shorten
from citeloom.operators.curation import colours
from citeloom.operators.topics import OUTLIER

UNLABELLED = "Unlabelled"


def label_layers(columns: list[str]) -> list[tuple[int, str, str]]:
    """(layer, id column, label column) of a wide hierarchy, in the order of layers; none for a flat one."""
    found = {int(m[1]) for c in columns if (m := re.fullmatch(r"topic_layer_(\d+)_label", c))}
    return [(k, f"topic_layer_{k}_id", f"topic_layer_{k}_label") for k in sorted(found) if f"topic_layer_{k}_id" in columns]


def point_payload(df: DataFrame) -> DataFrame:
    """A row for each point of the map, with its hover texts; a bad citation count is 0."""
    has = lambda c, default="": F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(default)) if c in df.columns else F.lit(default)
    citations = F.coalesce(F.col("`Citation Count`").try_cast("int"), F.lit(0)) if "Citation Count" in df.columns else F.lit(0)
    author = authors_text(F.col("Author")) if dict(df.dtypes).get("Author", "").startswith("array") else has("Author")
    words = F.array_join("tokens", " ") if "tokens" in df.columns else F.lit("")
    return df.select(
        F.col("Bibcode").alias("bibcode"), F.col("embedding_2d_x").alias("x"), F.col("embedding_2d_y").alias("y"), F.col("topic_id"),
        has("Title_en").alias("title"), author.alias("author"), F.col("Year").alias("year"), has("Journal").alias("journal"),
        shorten(has("Abstract_en")).alias("abstract"), citations.alias("citation_count"), has("DOI").alias("doi"), words.alias("words"),
        publication_date(F.col("Year")).alias("date"), marker_size(citations).alias("size"))


def noise_label(df: DataFrame, label: str = "Name", cluster: str = "topic_id") -> DataFrame:
    """One row: the label that noise rows have; fixed names come first, then the label seen first."""
    rank = F.when(F.col(label) == UNLABELLED, 0).when(F.col(label) == OUTLIER, 1).otherwise(2)
    noise = df.where((F.col(cluster) == -1) & F.col(label).isNotNull())
    return noise.agg(F.coalesce(F.min_by(label, F.struct(rank, F.col("ord"))), F.lit(UNLABELLED)).alias("noise_label"))


def marker_colours(df: DataFrame, palette: list[str], noise: str = "#999999", label: str = "Name") -> DataFrame:
    """df with the colour of each point: its label's, or the noise colour."""
    found = colours(df.where(F.col("topic_id") != -1), palette, label)
    joined = df.join(found.withColumnRenamed("label", "_label"), F.col(label) == F.col("_label"), "left")
    return joined.withColumn("colour", F.when(F.col("topic_id") == -1, F.lit(noise)).otherwise(F.coalesce("colour", F.lit(noise)))).drop("_label")


def row_key(cluster: Column, label: Column, prefix: str) -> Column:
    """The key of a panel row: by cluster, or by label where there is no cluster; noise has its own."""
    return F.when(cluster == -1, F.lit(f"{prefix}::noise::")).when(cluster.isNull(), F.concat(F.lit(f"{prefix}::label::"), F.coalesce(label, F.lit("")))).otherwise(F.concat(F.lit(f"{prefix}::"), cluster.cast("string")))


def panel_rows(df: DataFrame, cluster: str = "topic_id", label: str = "Name", prefix: str = "flat") -> DataFrame:
    """(key, label, count, first) of each topic, `first` being where it is first seen."""
    keyed = df.withColumn("key", row_key(F.col(cluster), F.col(label), prefix))
    return keyed.groupBy("key").agg(F.min_by(label, "ord").alias("label"), F.count("*").alias("count"), F.min("ord").alias("first"))


def hierarchical_panel(df: DataFrame, layers: list[int]) -> DataFrame:
    """Panel rows of all layers, coarsest first, each below the parent with which it is first seen: key, parent, path."""
    out, coarser = None, None
    for layer in sorted(layers, reverse=True):
        own = row_key(F.col(f"topic_layer_{layer}_id"), F.col(f"topic_layer_{layer}_label"), f"layer_{layer}")
        up = row_key(F.col(f"topic_layer_{coarser}_id"), F.col(f"topic_layer_{coarser}_label"), f"layer_{coarser}") if coarser is not None else F.lit(None).cast("string")
        keyed = df.select("ord", own.alias("key"), up.alias("parent"), F.col(f"topic_layer_{layer}_label").alias("label"))
        rows = keyed.groupBy("key").agg(F.min_by("parent", "ord").alias("parent"), F.min_by("label", "ord").alias("label"), F.count("*").alias("count"), F.min("ord").alias("first"))
        place = F.lpad(F.col("first").cast("string"), 12, "0")
        if out is None:
            rows = rows.withColumn("path", place)
        else:
            above = out.select(F.col("key").alias("parent"), F.col("path").alias("_path"))
            rows = rows.join(above, "parent", "left").withColumn("path", F.concat_ws("/", F.col("_path"), place)).drop("_path")
        rows = rows.withColumn("layer", F.lit(layer)).select("layer", "key", "parent", "label", "count", "path")
        out, coarser = rows if out is None else out.union(rows), layer
    return out
