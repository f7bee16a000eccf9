"""Corpora from files: delimited export records, own Parquet tables, nested JSON records, snapshots with metadata."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.functions import columns as fc
from citeloom.functions import text as ft
from citeloom.operators.filters import keep_in_array, numeric_years, require_columns
from citeloom.plans.written import numbered

#: The fields of an export record in order, and its signs.
EXPORT_FIELDS = ["Bibcode", "Author", "Title", "Year", "Journal", "Journal Abbreviation", "Issue", "Volume", "First Page", "Last Page", "Abstract", "Keywords", "DOI", "Affiliation", "Category", "Citation Count"]
FIELD_END, RECORD_END = "xOx", "xOx\n"


def _empty() -> Column:
    return F.array().cast("array<string>")


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The records of export files as (value); a record may hold line feeds."""
    return spark.read.text(path, lineSep=RECORD_END)


def parse_export(records: DataFrame, fields: list[str] = EXPORT_FIELDS) -> DataFrame:
    """Rows of the records that have all fields; newlines become blanks, authors become a list, keys are trimmed."""
    n = len(fields)
    whole = records.select(F.split("value", FIELD_END).alias("_f")).where((F.size("_f") == n) | (F.size("_f") == n + 1) & (F.get("_f", F.lit(n)) == ""))
    rows = whole.select(*(ft.flatten_newlines(F.col("_f")[k]).alias(name) for k, name in enumerate(fields)))
    changes: dict[str, Column] = {"Bibcode": ft.strip(F.col("Bibcode"))}
    if "Author" in fields:
        changes["Author"] = ft.parse_authors(F.col("Author"))
    return rows.withColumns(changes)


def clean_ingest(df: DataFrame) -> DataFrame:
    """Whole-number years, texts without entities and tags, names without hyphens, first parts of ranges."""
    require_columns(df, ["Year", "Title", "Abstract"], "clean_ingest")
    out = numeric_years(df)
    changes = {c: ft.clean_html(F.col(c)) for c in ("Title", "Abstract", "full_text") if c in df.columns}
    changes |= {c: ft.clean_range(F.col(f"`{c}`")) for c in ("Issue", "Volume", "First Page", "Last Page") if c in df.columns}
    if "Author" in df.columns:
        changes["Author"] = ft.without_hyphens(F.col("Author"))
    changes["References"] = F.coalesce("References", _empty()) if "References" in df.columns else _empty()
    return out.withColumns(changes)


def all_references(found: DataFrame) -> DataFrame:
    """(Bibcode, ord): every cited key once, numbered in the order of first sight."""
    items = found.select("ord", F.posexplode("References").alias("pos", "Bibcode"))
    first = items.groupBy("Bibcode").agg(F.min(F.struct("ord", "pos")).alias("first"))
    return numbered(first.select("Bibcode", "first.*"), ["ord", "pos"], "number").select("Bibcode", F.col("number").alias("ord"))


def export_records(exported: DataFrame) -> DataFrame:
    """The records of exported texts as (value); what stands behind the last record end is no record."""
    return exported.where("value is not null").select(F.explode(F.split("value", RECORD_END)).alias("value")).where("value != ''")


def resolve(found: DataFrame, pubs: DataFrame) -> DataFrame:
    """Exported publications, each row with the place, references and links of the search result; keys not found have none."""
    links = [F.first("PDF_URL").alias("PDF_URL")] if "PDF_URL" in found.columns else []
    own = found.groupBy("Bibcode").agg(F.min("ord").alias("ord"), F.min_by("References", "ord").alias("References"), *links)
    return pubs.drop("References", "PDF_URL", "ord").join(own, "Bibcode", "left")


def resolve_dataset(found: DataFrame, exported_pubs: DataFrame, exported_refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(publications, references) of a search result and what was exported for its keys and for those that they cite.

    found is (ord, Bibcode, References[, PDF_URL]); the others are records as (value).  Both come back parsed and clean.
    """
    pubs = clean_ingest(resolve(found, parse_export(exported_pubs)))
    refs = clean_ingest(parse_export(exported_refs).join(all_references(found), "Bibcode", "left")).drop("References")
    return pubs, refs


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files of JSON lines; a schema, as types can't be told from empty lists and nulls."""
    return spark.read.schema(schema).json(path)


def load_latest_search(spark: SparkSession, folder: str) -> DataFrame:
    """The search result that was written last."""
    return spark.read.parquet(f"{folder}/{spark.read.text(f'{folder}/search_results_latest').first()[0]}")


def load_curated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(publications, references, topic table) of a run, as curation left them."""
    return tuple(spark.read.parquet(f"{folder}/data/{name}.parquet") for name in ("curated", "dataset_refs", "curated_info"))


#: Columns by another name, columns that are lists, and columns with defaults.
ALIASES = {"citation_count": "Citation Count", "venue": "Journal"}
LISTS = ["Author", "author_uids", "author_display_names", "References", "Keywords", "Category", "Affiliation"]
DEFAULTS = {"Journal": "", "Volume": "", "Issue": "", "First Page": "", "Last Page": "", "DOI": "", "Citation Count": 0}
KEPT = ["ord", "Bibcode", "Year", "Title", "Abstract", *LISTS, *DEFAULTS]


def _normalize(df: DataFrame, publications: bool) -> DataFrame:
    for old, new in ALIASES.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    require_columns(df, ["Bibcode", "Year", "Title", "Author", *(["References", "Abstract"] if publications else [])], "normalize_source")
    df = df.select([c for c in KEPT if c in df.columns and (publications or c != "References")])
    kinds = dict(df.dtypes)
    changes: dict[str, Column] = {"Bibcode": ft.key(F.col("Bibcode")), "Year": fc.numeric_year(F.col("Year"))}
    for c in LISTS:
        if c == "References" and not publications:
            continue
        if c not in df.columns:
            changes[c] = _empty()
        else:
            changes[c] = fc.clean_list(F.col(c)) if kinds[c].startswith("array") else fc.list_from_text(F.col(c).cast("string"))
    for c in ("Title", "Abstract"):
        changes[c] = F.coalesce(ft.squeeze(F.col(c)), F.lit("")) if c in df.columns else F.lit("")
    for c, default in DEFAULTS.items():
        changes[c] = F.coalesce(F.col(f"`{c}`"), F.lit(default)) if c in df.columns else F.lit(default)
    return df.withColumns(changes)


def normalize_source(pubs: DataFrame, refs: DataFrame, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """Own publications and cited works in the engine's columns; references without a cited work are cut.

    With check, raises where keys are empty or repeat.
    """
    pubs, refs = _normalize(pubs, True), _normalize(refs, False)
    if check:
        for name, df in (("publications", pubs), ("references", refs)):
            n, empty, different = df.agg(F.count("*"), F.count_if(F.col("Bibcode") == ""), F.countDistinct("Bibcode")).first()
            if empty or different < n:
                raise ValueError(f"{name}: {empty} empty and {n - different} repeated keys")
    return keep_in_array(pubs, "Bibcode", "References", refs.select("Bibcode")), refs


def load_pair(spark: SparkSession, publications: str, references: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(publications), spark.read.parquet(references)


#: The parts of a nested literature record that rows are made of.
RECORD_SCHEMA = "struct<id:string,title:string,abstract:string,year:string,date:string,venue:string,pages:string,doi:string,citations:int,authors:array<struct<id:string,name:string>>,references:array<struct<id:string>>,keywords:array<string>>"


def parse_records(records: DataFrame, prefix: str, column: str = "value") -> DataFrame:
    """Rows of nested JSON records: prefixed keys, page ranges, distinct names and references without nulls."""
    r = records.select(F.from_json(column, RECORD_SCHEMA).alias("r")).where("r.id is not null").select("r.*")
    pages = ft.page_range(F.col("pages"))
    named = F.filter("authors", lambda a: F.coalesce(ft.strip(a["name"]), F.lit("")) != "")
    rows = r.select(
        F.concat(F.lit(f"{prefix}:"), "id").alias("Bibcode"), F.coalesce(fc.numeric_year(F.col("year")), fc.year_in_text(F.col("date"))).alias("Year"),
        ft.squeeze(F.coalesce("title", F.lit(""))).alias("Title"), ft.squeeze(F.coalesce("abstract", F.lit(""))).alias("Abstract"),
        F.coalesce(F.nullif(F.trim("venue"), F.lit("")), F.lit("")).alias("Journal"), F.coalesce("doi", F.lit("")).alias("DOI"), F.coalesce("citations", F.lit(0)).alias("Citation Count"),
        F.coalesce(F.transform(named, lambda a: ft.strip(a["name"])), _empty()).alias("Author"),
        F.coalesce(F.transform(named, lambda a: F.when(F.coalesce(a["id"], F.lit("")) != "", F.concat(F.lit(f"{prefix}:author:"), a["id"])).otherwise(F.lit(""))), _empty()).alias("author_uids"),
        fc.clean_list(F.transform("references", lambda x: F.concat(F.lit(f"{prefix}:"), x["id"]))).alias("References"), fc.clean_list(F.col("keywords")).alias("Keywords"), pages.alias("_pages"))
    return rows.withColumns({"First Page": F.col("_pages.first"), "Last Page": F.col("_pages.last")}).drop("_pages")


def yearly_quota(df: DataFrame, per_year: int) -> DataFrame:
    """The first rows of each year, each key once."""
    first = df.withColumn("_n", F.row_number().over(Window.partitionBy("Bibcode").orderBy("ord"))).where("_n = 1")
    return first.withColumn("_n", F.row_number().over(Window.partitionBy("Year").orderBy("ord"))).where(F.col("_n") <= per_year).drop("_n")


#: The link to a source of a publication's text.
LINK = "{bibcode}/{resource}"


#: Rows of a page at most, for the order of rows in a scan.
PAGE_ROWS = 1_000_000


def search_rows(pages: DataFrame, column: str = "value", link: str = LINK, page: str | None = None) -> DataFrame:
    """(Bibcode, References, esources, PDF_URL) of search pages; the link is a template filled with the first PDF source.

    With the column of a page's number, `ord` is the place of a row in the whole scan.
    """
    schema = "struct<response:struct<docs:array<struct<bibcode:string,reference:array<string>,esources:array<string>>>>,nextCursorMark:string>"
    number = F.lit(0) if page is None else F.col(page)
    docs = pages.select(number.cast("long").alias("page"), F.posexplode(F.from_json(column, schema)["response"]["docs"]).alias("pos", "d"))
    source = F.try_element_at(F.filter(F.coalesce("d.esources", _empty()), lambda e: e.contains("ADS_PDF") | e.contains("PUB_PDF")), F.lit(1))
    place = [] if page is None else [(F.col("page") * PAGE_ROWS + F.col("pos")).alias("ord")]
    return docs.select(
        *place, F.col("d.bibcode").alias("Bibcode"), F.coalesce("d.reference", _empty()).alias("References"), F.coalesce("d.esources", _empty()).alias("esources"),
        F.when(source.isNotNull(), F.replace(F.replace(F.lit(link), F.lit("{bibcode}"), F.col("d.bibcode")), F.lit("{resource}"), source)).alias("PDF_URL"))


def save_snapshot(df: DataFrame, path: str, metadata: dict) -> None:
    """A Parquet table and, after it, the metadata that it belongs to, by Spark's writers."""
    df.write.mode("overwrite").parquet(f"{path}/data")
    line = json.dumps(metadata, sort_keys=True)
    df.sparkSession.range(1).select(F.lit(line).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def _metadata(spark: SparkSession, path: str) -> dict | None:
    try:
        held = spark.read.text(f"{path}/metadata").first()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return None if held is None else json.loads(held[0])


def load_snapshot(spark: SparkSession, path: str, metadata: dict) -> DataFrame | None:
    """The table, if its metadata are the same; other metadata are like no table."""
    return spark.read.parquet(f"{path}/data") if _metadata(spark, path) == json.loads(json.dumps(metadata)) else None


def any_snapshot(spark: SparkSession, path: str, some: dict) -> DataFrame | None:
    """The table, if its metadata hold at least these; for what was made of other rows and is taken further."""
    held = _metadata(spark, path)
    return spark.read.parquet(f"{path}/data") if held is not None and held | json.loads(json.dumps(some)) == held else None


def append_snapshot(df: DataFrame, path: str) -> None:
    """More rows for a table that has its metadata; those that are there are not written again."""
    df.write.mode("append").parquet(f"{path}/data")
