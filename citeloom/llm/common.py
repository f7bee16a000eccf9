"""Session helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.plans.written import clear, delete, materialize, scratch, shared_dir, table_path

__all__ = ["clear", "delete", "materialize", "scratch", "shared_dir", "table_path"]


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id written as text; it deals rows to folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(column: str = "doc_id"):
    """True for the fold that no model may learn from; a null id is not held out."""
    return F.coalesce(crc32_of_id(column) % 4 == 2, F.lit(False))


def own_text(docs: DataFrame):
    """A 64-bit hash of a row's text as it stands; with the id it names the row."""
    return F.xxhash64(docs["text"].cast("string"))


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without the rows that rows(doc_id, own) names by id, null or not, and own_text."""
    return _by_name(docs, rows, "left_anti")


def _by_name(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    named = rows.select(F.col("doc_id").alias("_gone"), F.col("own").alias("_own")).distinct()
    return docs.join(named.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(named["_gone"]) & (own_text(docs).eqNullSafe(named["_own"])), how)


def keep_rows(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of docs that judged(doc_id, own, kept, single) keeps, with all their columns.

    Rows that are kept and repeat id and text are one row where single says so, with the other columns of any of them.
    """
    judged = materialize(judged.select("doc_id", "own", "kept", "single"), "judged")
    out = without(docs, judged.where(~F.col("kept")))
    again = judged.where(F.col("kept") & F.col("single")).groupBy("doc_id", "own").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return out
    # rows of one text are combined in the tasks, so even very many of them are one row for each task
    held = _by_name(docs, again, "left_semi")
    once = held.groupBy(held["doc_id"].cast("long").alias("_id"), own_text(held).alias("_own")).agg(F.first(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("_row"))
    return without(out, again).union(once.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns)))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow by a function from one record batch to any number of them."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(over, schema)
