"""The corpus pipeline: stages that each apply one training-data operator to all that its predecessor kept.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's docs.  All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from citeloom.llm.common import materialize, scratch, table_path
from citeloom.llm.exact_dedup import keep_first_copies
from citeloom.llm.near_dedup import keep_one_of_each
from citeloom.llm.packing import added_tokens, pack
from citeloom.llm.quality import keep_good
from citeloom.llm.suffix_dedup import without_repeats


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), cutoff=0.7)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays."""
    return keep_first_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, at a similarity of 0.8 of their sets of five-word shingles, one document stays."""
    return keep_one_of_each(docs, per_cent=80)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the bytes of 100-byte strings that start earlier in the corpus."""
    return without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts are packed into sequences of 1024 tokens; one row for each piece."""
    ranks, added = public_tokenizers.path("byte_bpe_50k.tiktoken"), added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack(docs, ranks, public_tokenizers.PATTERN, capacity=1024, end_id=2, added=added)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("suffix-array dedup", suffix_stage),
    ("best-fit packing", packing_stage),
]

#: SQL can't express a trained classifier or the packing; the tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents of a folder; what a stage writes on its way is deleted after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        name = "pipeline-" + name.replace(" ", "-")
        path = table_path(spark, name)
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, path)
    return docs
