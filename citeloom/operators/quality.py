"""Final cleaning of a dataset bundle: one best row for each key, known references, author identities, and its report."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.text import key, strip
from citeloom.operators.filters import meaningful, placeholder_uid
from citeloom.plans.written import materialize

EXAMPLES = 20


def best_rows(df: DataFrame) -> DataFrame:
    """One row for each non-empty key: most references, then most fields that say something, then the earliest."""
    fields = sum((meaningful(df, c).cast("int") for c in df.columns if c not in ("ord", "Bibcode")), F.lit(0))
    n_refs = F.coalesce(F.size("References"), F.lit(0)) if "References" in df.columns else F.lit(0)
    best = Window.partitionBy("Bibcode").orderBy(F.desc("_refs"), F.desc("_fields"), "ord")
    rows = df.withColumns({"Bibcode": key(F.col("Bibcode")), "_refs": n_refs, "_fields": fields}).where("Bibcode != ''")
    return rows.withColumn("_n", F.row_number().over(best)).where("_n = 1").select(df.columns)


def clean_references(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    """Publications whose lists hold trimmed known keys, each once, in their order."""
    items = pubs.select(F.col("Bibcode").alias("_row"), F.posexplode("References").alias("_pos", "_item")).withColumn("_item", key(F.col("_item")))
    known = refs.select(key(F.col("Bibcode")).alias("_item")).where("_item != ''").distinct()
    kept = items.where("_item != ''").groupBy("_row", "_item").agg(F.min("_pos").alias("_pos")).join(known, "_item", "left_semi")
    lists = kept.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_item"))), lambda x: x["_item"]).alias("_kept"))
    joined = pubs.join(lists, pubs["Bibcode"] == lists["_row"], "left")
    return joined.withColumn("References", F.coalesce("_kept", F.array().cast("array<string>"))).select(pubs.columns)


def reference_mentions(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    """(Bibcode, pos, ref, is_empty, is_repeat, is_known) of every item of every list."""
    items = pubs.select("Bibcode", F.posexplode("References").alias("pos", "_item")).select("Bibcode", "pos", key(F.col("_item")).alias("ref"))
    first = Window.partitionBy("Bibcode", "ref").orderBy("pos")
    known = refs.select(key(F.col("Bibcode")).alias("ref"), F.lit(True).alias("_known")).where("ref != ''").distinct()
    rows = items.withColumn("_n", F.row_number().over(first)).join(known, "ref", "left")
    return rows.select("Bibcode", "pos", "ref", (F.col("ref") == "").alias("is_empty"), ((F.col("ref") != "") & (F.col("_n") > 1)).alias("is_repeat"), F.coalesce("_known", F.lit(False)).alias("is_known"))


def missing_references(mentions: DataFrame, most: int | None = EXAMPLES) -> DataFrame:
    """(ref, mentions) of keys that no cited work has, most mentioned first."""
    gone = mentions.where("not is_empty and not is_repeat and not is_known").groupBy("ref").agg(F.count("*").alias("mentions"))
    ordered = gone.orderBy(F.desc("mentions"), "ref")
    return ordered.limit(most) if most else ordered


def _pairs(uids: str, names: str) -> Column:
    """Ids with their names and places, ids that stand for nobody left out; a missing name is empty."""
    at = F.transform(F.col(uids), lambda u, i: F.struct(
        strip(F.coalesce(u, F.lit(""))).alias("uid"), F.coalesce(strip(F.get(F.coalesce(F.col(names), F.array().cast("array<string>")), i)), F.lit("")).alias("name"), i.alias("pos")))
    return F.filter(at, lambda p: ~placeholder_uid(p["uid"]))


def clean_identities(df: DataFrame, uids: str = "author_uids", names: str = "author_display_names") -> DataFrame:
    """Rows whose identity arrays are cleaned in step: no placeholder, no id twice, a name or an empty text for each."""
    if uids not in df.columns:
        return df
    if names not in df.columns:
        df = df.withColumn(names, F.array().cast("array<string>"))
    pairs = _pairs(uids, names)
    first = F.transform(F.array(pairs), lambda ps: F.filter(ps, lambda p, i: F.array_position(F.transform(ps, lambda q: q["uid"]), p["uid"]) == i + 1))[0]
    rows = df.withColumn("_pairs", F.coalesce(first, F.array().cast("array<struct<uid:string,name:string,pos:int>>")))
    return rows.withColumns({uids: F.transform("_pairs", lambda p: p["uid"]), names: F.transform("_pairs", lambda p: p["name"])}).drop("_pairs")


def _changed_identities(df: DataFrame) -> Column:
    """How many ids of a row stand for nobody, and how many of the others are repeats."""
    every = F.coalesce("author_uids", F.array().cast("array<string>"))
    valid = F.filter(every, lambda u: ~placeholder_uid(u))
    return F.struct((F.size(every) - F.size(valid)).alias("placeholders"), (F.size(valid) - F.size(F.array_distinct(F.transform(valid, strip)))).alias("repeats"))


def best_pair(pubs: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The best rows of both tables, written once, for the cleaning, its report and its examples."""
    return materialize(best_rows(pubs), "best"), materialize(best_rows(refs), "best")


def cleaning_report(pubs: DataFrame, refs: DataFrame, best: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row of counters about keys, references and identities before cleaning; best holds what best_pair gave."""

    def keys(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(key(F.col("Bibcode")).alias("k"), (key(F.col("Bibcode")) != F.coalesce("Bibcode", F.lit(""))).alias("padded"))
        by = rows.groupBy("k").agg(F.count("*").alias("n"), F.count_if("padded").alias("padded"))
        full = F.col("k") != ""
        return by.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias(f"{name}_rows"), F.coalesce(F.sum(F.when(~full, F.col("n"))), F.lit(0)).alias(f"{name}_empty_keys"),
            F.coalesce(F.sum(F.when(full, F.col("n") - 1)), F.lit(0)).alias(f"{name}_duplicate_rows"), F.count_if(full & (F.col("n") > 1)).alias(f"{name}_duplicate_keys"),
            F.count_if(full).alias(f"{name}_output_rows"), F.coalesce(F.sum("padded"), F.lit(0)).alias(f"{name}_padded_keys"))

    best_pubs, best_refs = best or (best_rows(pubs), best_rows(refs))
    items = reference_mentions(best_pubs, refs).agg(
        F.count_if("is_empty").alias("empty_mentions"), F.count_if("is_repeat").alias("duplicate_mentions"),
        F.count_if(~F.col("is_empty") & ~F.col("is_repeat") & ~F.col("is_known")).alias("missing_mentions"),
        F.countDistinct(F.when(~F.col("is_empty") & ~F.col("is_known"), F.col("ref"))).alias("missing_keys"))
    out = keys(pubs, "publications").crossJoin(keys(refs, "references")).crossJoin(items)  # one row each
    for name, df in (("publications", best_pubs), ("references", best_refs)):
        if "author_uids" in df.columns:
            rows = df.select(_changed_identities(df).alias("c")).select("c.*")
            out = out.crossJoin(rows.agg(  # one row
                F.coalesce(F.sum("placeholders"), F.lit(0)).alias(f"{name}_placeholder_uids"), F.coalesce(F.sum("repeats"), F.lit(0)).alias(f"{name}_duplicate_uids"),
                F.count_if(F.col("placeholders") + F.col("repeats") > 0).alias(f"{name}_uid_changed_rows")))
    return out


def cleaning_examples(pubs: DataFrame, refs: DataFrame, most: int = EXAMPLES, best: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(kind, value, n) of a few values behind the counters: repeated keys, missing references and placeholder ids.

    Keys and ids are those first seen, missing references those of most mentions.
    """
    parts = []
    best_pubs, best_refs = best or (best_rows(pubs), best_rows(refs))
    for name, df, own in (("publications", pubs, best_pubs), ("references", refs, best_refs)):
        keys = df.select("ord", key(F.col("Bibcode")).alias("value")).where("value != ''").groupBy("value").agg(F.count("*").alias("n"), F.min("ord").alias("first")).where("n > 1")
        parts.append(keys.orderBy("first", "value").limit(most).select(F.lit(f"{name}_duplicate_key").alias("kind"), "value", "n"))
        if "author_uids" in df.columns:
            uids = own.select("ord", F.posexplode("author_uids").alias("pos", "uid")).select("ord", "pos", key(F.col("uid")).alias("value")).where((F.col("value") != "") & placeholder_uid(F.col("value")))
            first = uids.groupBy("value").agg(F.count("*").alias("n"), F.min(F.struct("ord", "pos")).alias("first"))
            parts.append(first.orderBy("first", "value").limit(most).select(F.lit(f"{name}_placeholder_uid").alias("kind"), "value", "n"))
    missing = missing_references(reference_mentions(best_pubs, refs), most)
    parts.append(missing.select(F.lit("missing_reference").alias("kind"), F.col("ref").alias("value"), F.col("mentions").alias("n")))
    return functools.reduce(DataFrame.unionByName, parts)


def prepare_bundle(pubs: DataFrame, refs: DataFrame, best: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(publications, references, report): best rows of both, lists against the cleaned references, then identities."""
    best_pubs, best_refs = best or (best_rows(pubs), best_rows(refs))
    return clean_identities(clean_references(best_pubs, best_refs)), clean_identities(best_refs), cleaning_report(pubs, refs, best)


def sync_topic_counts(topic_info: DataFrame, pubs: DataFrame) -> DataFrame:
    """topic_info with Count as the number of publications of each topic, 0 without any."""
    counts = pubs.groupBy(F.col("topic_id").alias("Topic")).agg(F.count("*").alias("_n"))
    return topic_info.join(counts, "Topic", "left").withColumn("Count", F.coalesce("_n", F.lit(0))).select(topic_info.columns)


#: The columns that lead a dataset, in order, those that end it, and those that lead a topic table.
FRONT = [
    "Bibcode", "Year", "Author", "author_display_names", "author_uids", "Title", "Title_lang", "Title_en", "Abstract", "Abstract_lang", "Abstract_en",
    "Journal", "Journal Abbreviation", "Citation Count", "DOI", "Affiliation", "Keywords", "Category", "Volume", "Issue", "First Page", "Last Page",
    "References", "full_text", "tokens", "topic_id", "Name", "Main", "MMR", "POS", "KeyBERT", "topic_primary_layer_index", "topic_layer_count",
]
TAIL = ["full_embeddings"]
TOPIC_FRONT = ["Topic", "Count", "Name", "Main", "MMR", "POS", "KeyBERT", "Representation", "Representative_Docs"]


def order_columns(df: DataFrame) -> DataFrame:
    """Leading columns, topic layers by number with ids before labels, the rest, embedding coordinates by number, the tail."""

    def layer(c: str) -> tuple:
        parts = c.split("_")
        return (0, int(parts[2]), not c.endswith("_id"), c) if len(parts) > 3 and parts[2].isdigit() else (1, 0, False, c)

    def coordinate(c: str) -> tuple:
        axis = c.rsplit("_", 1)[1]
        return (c.startswith("embedding_2d_"), int(axis) if axis.isdigit() else 10**6, c)

    front = [c for c in FRONT if c in df.columns]
    layers = sorted((c for c in df.columns if c.startswith("topic_layer_") and c not in front), key=layer)
    points = sorted((c for c in df.columns if c.startswith("embedding_5d_") or c in ("embedding_2d_x", "embedding_2d_y")), key=coordinate)
    tail = [c for c in TAIL if c in df.columns]
    rest = [c for c in df.columns if c not in {*front, *layers, *points, *tail}]
    return df.select([f"`{c}`" for c in front + layers + rest + points + tail])


def order_topic_columns(info: DataFrame) -> DataFrame:
    """Leading columns of a topic table, then the others as they are."""
    front = [c for c in TOPIC_FRONT if c in info.columns]
    return info.select([f"`{c}`" for c in front + [c for c in info.columns if c not in front]])
