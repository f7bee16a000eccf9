"""Array, date, number and fingerprint columns."""

from __future__ import annotations

import functools
import hashlib
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import bind, strip


def clean_list(c: Column) -> Column:
    """An array of texts: trimmed, without nulls and empty ones, each once in the order of first sight; null is empty."""
    return F.coalesce(F.array_distinct(F.filter(F.transform(c, strip), lambda x: x.isNotNull() & (x != ""))), F.array().cast("array<string>"))


def list_from_text(c: Column, sign: str = ";") -> Column:
    """clean_list of a text with separators."""
    return clean_list(F.split(c, sign))


def references(c: Column) -> Column:
    """A reference list without nulls and empty keys; neither trimmed nor made distinct; null is empty."""
    return F.coalesce(F.filter(c, lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))


def overlaps(c: Column, values: list[str]) -> Column:
    """Whether an array shares a value with a list; never null."""
    if not values:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(F.filter(c, lambda x: x.isNotNull()), F.array(*map(F.lit, values))), F.lit(False))


def numeric_year(c: Column) -> Column:
    """A year that is a whole number, as an integer; null otherwise."""
    value = c.cast("string").try_cast("double")
    return F.when(value == F.floor(value), value.cast("int"))


def publication_date(year: Column) -> Column:
    """The last day of a year; null for a bad year."""
    return F.try_to_date(F.concat(F.lpad(year.try_cast("int").cast("string"), 4, "0"), F.lit("-12-31")))


def year_in_text(c: Column) -> Column:
    """The first year of the last or this century in a text."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"((?:19|20)\d{2})", 1).try_cast("int")


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole to one decimal, half to even."""
    return F.bround(F.lit(100.0) * part / whole, 1)


def marker_size(citations: Column) -> Column:
    return F.log1p(F.coalesce(citations.try_cast("double"), F.lit(0.0))) + 1


def page_count(first: Column, last: Column) -> Column:
    """last - first + 1 where both are whole numbers other than 0."""
    a, b = first.try_cast("int"), last.try_cast("int")
    return F.when((a != 0) & (b != 0), b - a + 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return bind(norms, lambda n: F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0)))


def token_ceiling(prompt_tokens: Column, most: int) -> Column:
    """The answer budget of a prompt: half as much again and some, within bounds."""
    return F.least(F.lit(most), F.greatest(F.lit(96), F.ceil(prompt_tokens * 1.5).cast("int") + 64))


def cluster_defaults(n: int) -> dict[str, int]:
    """Clustering parameters that scale with the number of documents."""
    return {
        "min_cluster_size": max(15, math.floor(0.001 * n)), "base_min_cluster_size": max(10, min(55, math.floor(0.001 * n))),
        "min_clusters": max(3, min(10, math.floor(0.006 * n))), "min_df": max(1, min(5, n // 100)),
    }


def capped_min_df(min_df: int, n: int) -> int:
    return min(min_df, max(1, n // 20))


def memory_estimate(n: int, dim: int, itemsize: int = 4) -> int:
    """Bytes of a dense matrix and half as much again."""
    return int(n * dim * itemsize * 1.5)


def frame_fingerprint(df: DataFrame, columns: list[str]) -> str:
    """A digest of some columns of a table that does not depend on the order of rows or partitions."""
    row = F.xxhash64(*(F.to_json(F.struct(F.col(c).alias("v"))) for c in columns))
    n, a, b = df.agg(F.count("*"), F.sum(row.cast("decimal(20,0)")), F.bit_xor(F.xxhash64(row, F.lit(7)))).first()
    return hashlib.sha256(json.dumps([columns, n, str(a), b]).encode()).hexdigest()


def document_fingerprint(*columns: Column) -> Column:
    """SHA-256 of a row's texts, separated by a sign that texts do not hold."""
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256)


def params_fingerprint(params: dict) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()


def any_of(conditions: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions, F.lit(False))
