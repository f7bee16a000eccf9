"""Row and array filters; membership tests never drop rows through nulls."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.columns import any_of, overlaps
from citeloom.functions.text import authors_text, casefold, strip


def require_columns(df: DataFrame, columns: list[str], caller: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{caller} needs the columns {', '.join(missing)}")


def numeric_years(df: DataFrame, column: str = "Year") -> DataFrame:
    """Rows whose year is a whole number, with the year as an integer."""
    value = F.col(column).cast("string").try_cast("double")
    return df.where(value == F.floor(value)).withColumn(column, value.cast("int"))


def authors_match(authors: Column, patterns: list[str]) -> Column:
    """Whether the joined author names match any of some regular expressions, whatever their case."""
    pattern = "|".join(patterns)
    return F.coalesce(authors_text(authors).rlike(f"(?i){pattern}"), F.lit(False)) if patterns else F.lit(True)


def authors_contain(authors: Column, names: list[str]) -> Column:
    """Whether the joined author names contain any of some texts literally, whatever their case."""
    joined = F.lower(authors_text(authors))
    return F.coalesce(any_of([F.contains(joined, F.lit(n.lower())) for n in names]), F.lit(False))


def citing_filter(authors: list[str] | None, uids: list[str] | None, columns: list[str]) -> Column:
    """Rows by an author pattern or an author id; all rows without either."""
    if uids and "author_uids" not in columns:
        raise ValueError("the filter on author ids needs the column author_uids")
    parts = []
    if authors:
        parts.append(authors_match(F.col("Author"), authors))
    if uids:
        parts.append(overlaps(F.col("author_uids"), uids))
    return any_of(parts) if parts else F.lit(True)


def excluded_references(refs: DataFrame, authors: list[str] | None, uids: list[str] | None) -> DataFrame:
    """Keys of the cited works by an author pattern or id."""
    if not authors and not uids:
        return refs.select("Bibcode").limit(0)
    return refs.where(citing_filter(authors, uids, refs.columns)).select("Bibcode").distinct()


def keep_in_array(df: DataFrame, row_key: str, column: str, keys: DataFrame, keep: bool = True) -> DataFrame:
    """df with an array column cut to the items that are (or are not) in a table of keys, in their order.

    The items meet the keys in a join, so neither the keys nor their number have to fit one machine.
    """
    name = keys.columns[0]
    items = df.select(F.col(row_key).alias("_row"), F.posexplode(column).alias("_pos", "_item"))
    kept = items.join(keys.select(F.col(name).alias("_item")).distinct(), "_item", "left_semi" if keep else "left_anti")
    lists = kept.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_item"))), lambda x: x["_item"]).alias("_kept"))
    joined = df.join(lists, df[row_key].eqNullSafe(lists["_row"]), "left")
    return joined.withColumn(column, F.coalesce("_kept", F.array().cast("array<string>"))).select(df.columns)


def filter_corpus(pubs: DataFrame, refs: DataFrame, authors: list[str] | None = None, uids: list[str] | None = None,
                  exclude_authors: list[str] | None = None, exclude_uids: list[str] | None = None) -> DataFrame:
    """Publications by author, and their references without excluded works, before any pair is built."""
    pubs = pubs.where(citing_filter(authors, uids, pubs.columns))
    if not exclude_authors and not exclude_uids:
        return pubs
    return keep_in_array(pubs, "Bibcode", "References", excluded_references(refs, exclude_authors, exclude_uids), keep=False)


def remove_clusters(df: DataFrame, ids: list[int], column: str = "topic_id") -> DataFrame:
    """Rows outside some clusters; rows without a cluster stay."""
    return df.where(~F.coalesce(F.col(column).isin(ids), F.lit(False))) if ids else df


def unmatched_clusters(df: DataFrame, ids: list[int], column: str = "topic_id") -> list[int]:
    found = {r[0] for r in df.where(F.col(column).isin(ids)).select(column).distinct().collect()} if ids else set()
    return sorted(set(ids) - found)


def remove_layered_clusters(df: DataFrame, targets: list[dict]) -> DataFrame:
    """Rows in none of some (layer, cluster) targets."""
    by: dict[int, list[int]] = {}
    for layer, ids in ((t["layer"], t["cluster_id"]) for t in layered_selection(targets)):
        by.setdefault(layer, []).append(ids)
    require_columns(df, [f"topic_layer_{k}_id" for k in by], "remove_layered_clusters")
    return df.where(~any_of([F.coalesce(F.col(f"topic_layer_{k}_id").isin(ids), F.lit(False)) for k, ids in by.items()]))


def _whole(value: object, what: str) -> int:
    if isinstance(value, bool) or not re.fullmatch(r"\s*-?\d+\s*", str(value)):
        raise ValueError(f"{what} must be a whole number: {value!r}")
    return int(value)


def layered_selection(targets: list[dict] | None) -> list[dict]:
    """Targets as whole numbers, each once; a layer is not negative."""
    out: list[dict] = []
    for t in targets or []:
        if not isinstance(t, dict) or {"layer", "cluster_id"} - set(t):
            raise ValueError("a target is a mapping with layer and cluster_id")
        one = {"layer": _whole(t["layer"], "layer"), "cluster_id": _whole(t["cluster_id"], "cluster_id")}
        if one["layer"] < 0:
            raise ValueError("a layer is not negative")
        if one not in out:
            out.append(one)
    return out


def flat_selection(ids: object) -> list[int]:
    if ids is None:
        return []
    if not isinstance(ids, (list, tuple)):
        raise ValueError("clusters to remove are a list")
    return [_whole(x, "cluster") for x in ids]


def filter_by_field(df: DataFrame, column: str, values: list, keep: bool = True) -> DataFrame:
    """Rows whose field is (or is not) one of some values; texts match whatever their case, nulls never match."""
    require_columns(df, [column], "filter_by_field")
    texts = all(isinstance(v, str) for v in values)
    match = casefold(F.col(column)).isin([v.casefold() for v in values]) if texts else F.col(column).isin(values)
    match = F.coalesce(match, F.lit(False))
    return df.where(match if keep else ~match)


def translation_targets(df: DataFrame, column: str, target: str = "en") -> DataFrame:
    """Rows whose text exists and is not known to be in the target language."""
    return df.where(F.coalesce(F.col(f"{column}_lang") != target, F.lit(True)) & F.col(column).isNotNull() & (F.col(column) != ""))


#: Author ids that stand for nobody, and parts between double colons of which one is enough for that.
PLACEHOLDERS = ["", "nan", "none", "unknown", "no author", "no_author", "no-author", "n.author"]
PLACEHOLDER_PARTS = ["", "unknown", "no author", "no_author", "no-author", "n.author"]


def placeholder_uid(c: Column) -> Column:
    """Whether an author id, or a part of it between double colons, stands for nobody; true for null."""
    low = F.lower(strip(F.coalesce(c, F.lit(""))))
    parts = F.transform(F.split(low, "::"), strip)
    return low.isin(PLACEHOLDERS) | F.arrays_overlap(parts, F.array(*map(F.lit, PLACEHOLDER_PARTS)))


def meaningful(df: DataFrame, column: str) -> Column:
    """Whether a field says something: blank texts, and arrays of nothing but blanks, do not."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(f"`{column}`")
    if kind == "string":
        return F.coalesce(strip(c) != "", F.lit(False))
    if kind == "array":
        return F.coalesce(F.exists(c, lambda x: F.coalesce(strip(x.cast("string")), F.lit("")) != ""), F.lit(False))
    return c.isNotNull()


def exportable(df: DataFrame, column: str) -> Column:
    """Whether a field is an attribute worth writing: nulls and empty containers are not, empty texts are."""
    c = F.col(f"`{column}`")
    return (F.size(c) > 0) if df.schema[column].dataType.typeName() in ("array", "map") else c.isNotNull()


def top_references(pubs: DataFrame, least: int = 1, most: int | None = None) -> DataFrame:
    """(ref, n) of the works cited at least so often, most cited first, then by first sight."""
    items = pubs.select(F.col("ord"), F.posexplode("References").alias("pos", "ref"))
    counts = items.groupBy("ref").agg(F.count("*").alias("n"), F.min(F.struct("ord", "pos")).alias("first")).where(F.col("n") >= least)
    ordered = counts.orderBy(F.desc("n"), "first")
    return (ordered.limit(most) if most is not None else ordered).select("ref", "n")
