"""Streams of publications: running citation counts, and event counts in windows with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.columns import references
from citeloom.operators.filters import keep_in_array


def read_publications(spark: SparkSession, path: str, schema, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def citation_counts(pubs: DataFrame) -> DataFrame:
    """(target, mentions, first_year), kept up to date as publications arrive."""
    rows = pubs.select(F.col("Year").alias("year"), F.explode(references(F.col("References"))).alias("target"))
    return rows.groupBy("target").agg(F.count("*").alias("mentions"), F.min("year").alias("first_year"))


def append_edges(pubs: DataFrame, path: str, checkpoint: str):
    """Direct citations of each micro-batch as a Parquet folder of its own, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        edges = batch.select(F.col("Bibcode").alias("source"), "Year", F.posexplode(references(F.col("References"))).alias("ref_index", "target"))
        edges.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return pubs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts and sums by key and time window; windows close when the watermark passes them."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("start"), key, "n", "total")


def known_only(refs: DataFrame) -> Callable[[DataFrame, int], DataFrame]:
    """A batch function that cuts references to the cited works of a static table."""
    return lambda batch, number: keep_in_array(batch, "Bibcode", "References", refs.select("Bibcode"))
