"""Counters and summaries: costs, runs, searches, coverage and languages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cost_summary(ledger: DataFrame) -> DataFrame:
    """Calls, tokens and cost by step, provider and model; a cost is null where none is known."""
    return ledger.groupBy("step", "provider", "model").agg(
        F.count("*").alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"), F.sum("cost_usd").alias("cost_usd"))


def cost_resolution(calls: DataFrame) -> DataFrame:
    """How many calls have a price, and where it came from."""
    return calls.agg(
        F.count("*").alias("calls"), F.count("cost_usd").alias("priced"), F.count_if(F.col("cost_usd").isNull()).alias("missing"),
        F.count_if(F.col("cost_source") == "direct").alias("direct"), F.count_if(F.col("cost_source") == "fetched").alias("fetched"))


def with_fetched_costs(calls: DataFrame, fetched: DataFrame) -> DataFrame:
    """calls with the costs fetched by generation id; one fetch may serve many calls."""
    return calls.join(fetched.select("generation_id", F.col("cost_usd").alias("_c")).dropDuplicates(["generation_id"]), "generation_id", "left").withColumns(
        {"cost_source": F.when(F.col("cost_usd").isNotNull(), F.lit("direct")).when(F.col("_c").isNotNull(), F.lit("fetched")), "cost_usd": F.coalesce("cost_usd", "_c")}).drop("_c")


def run_counts(df: DataFrame) -> DataFrame:
    """Rows, topics (noise is one), noise rows and their share."""
    return df.agg(
        F.count("*").alias("rows"), F.countDistinct("topic_id").alias("topics_nunique"), F.count_if(F.col("topic_id") == -1).alias("outliers"),
        F.round(F.count_if(F.col("topic_id") == -1) / F.greatest(F.count("*"), F.lit(1)), 4).alias("outlier_rate"))


def search_stats(found: DataFrame) -> DataFrame:
    """Publications, references and distinct references of a search result."""
    refs = found.select(F.explode("References").alias("ref")).agg(F.count("*").alias("total_references"), F.countDistinct("ref").alias("unique_references"))
    return found.agg(F.count("*").alias("publications")).crossJoin(refs)  # one row each


def export_coverage(expected: DataFrame, parsed: DataFrame, key: str = "Bibcode") -> DataFrame:
    """Expected and parsed keys, and how many are missing."""
    a, b = expected.select(key).distinct(), parsed.select(key).distinct()
    gone = a.join(b, key, "left_anti").agg(F.count("*").alias("missing"))
    return a.agg(F.count("*").alias("expected")).crossJoin(b.agg(F.count("*").alias("parsed"))).crossJoin(gone)  # one row each


def source_coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """The share of rows in which each column has a value."""
    def has(c: str):
        kind = df.schema[c].dataType.typeName()
        value = F.size(c) > 0 if kind == "array" else F.trim(F.col(c)) != "" if kind == "string" else F.col(c).isNotNull()
        return F.coalesce(value, F.lit(False)).cast("int")
    return df.agg(*(F.round(F.avg(has(c)), 4).alias(f"{c}_coverage") for c in columns))


def link_retention(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    """Links of publications to cited works as given, those to known works, and the share of these, 0 without links."""
    links = pubs.select(F.explode("References").alias("ref"))
    known = refs.select(F.col("Bibcode").alias("ref"), F.lit(1).alias("_k")).distinct()
    return links.join(known, "ref", "left").agg(F.count("*").alias("raw_links"), F.count("_k").alias("retained_links"), F.countDistinct("ref").alias("unique_references")).withColumn(
        "retention", F.round(F.col("retained_links") / F.greatest("raw_links", F.lit(1)), 4))


def language_tally(df: DataFrame, columns: list[str], target: str = "en") -> DataFrame:
    """Texts of each column that exist and are not in the target language."""
    other = lambda c: F.coalesce(F.col(f"{c}_lang") != target, F.lit(True)) & F.col(c).isNotNull() & (F.col(c) != "")
    return df.agg(*(F.count_if(other(c)).alias(f"{c}_other") for c in columns))


def histogram_years(df: DataFrame, column: str = "Year", span: tuple[str, str] | None = None) -> DataFrame:
    """The first day of the least year and the first day after the greatest, or a span of days that is given.

    Without any year it is the year 1900.  A span must end after it starts.
    """
    if span is not None:
        first, end = (dt.date.fromisoformat(x) for x in span)
        if end <= first:
            raise ValueError(f"the span {span} must end after it starts")
        return df.sparkSession.createDataFrame([(first, end)], "first_day date, end_day date")
    years = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    day = lambda year: F.make_date(year, F.lit(1), F.lit(1))
    return years.select(day(F.coalesce("a", F.lit(1900))).alias("first_day"), day(F.coalesce("b", F.lit(1900)) + 1).alias("end_day"))


def failures(df: DataFrame, column: str = "error", most: int = 3) -> DataFrame:
    """The first failures by key."""
    return df.where(F.col(column).isNotNull()).orderBy("ord").limit(most)
