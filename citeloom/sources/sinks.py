"""Writers: tables, graph files, citation text and dataset bundles.

Documents that are one file are written by tasks as sorted parts, which are then copied one behind the other.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.columns import page_count
from citeloom.functions.text import squeeze, surname
from citeloom.operators.quality import order_columns, order_topic_columns
from citeloom.plans import files
from citeloom.plans.written import numbered, scratch

HIDDEN = ("References", "tokens")


def attribute(df: DataFrame, column: str) -> Column:
    """A field as text: containers as JSON, others as they are; null where there is nothing to write."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(f"`{column}`")
    return F.when(F.size(c) > 0, F.to_json(c)) if kind in ("array", "map") else F.to_json(c) if kind == "struct" else c.cast("string")


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*(attribute(df, c).alias(c) for c in df.columns))


def write_csv(df: DataFrame, path: str) -> None:
    _flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_network_csv(edges: DataFrame, nodes: DataFrame, folder: str, evidence: DataFrame | None = None) -> None:
    for name, df in (("edges", edges), ("nodes", nodes), ("evidence", evidence)):
        if df is not None:
            write_csv(df, f"{folder}/{name}.csv")


def graph_json_rows(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, value): a JSON object for each node and each edge."""
    shown = [c for c in nodes.columns if c not in ("id", *HIDDEN)]
    extra = [c for c in edges.columns if c not in ("source", "target")]
    node = F.to_json(F.struct(F.col("id").cast("string").alias("key"), F.struct(*(attribute(nodes, c).alias(c) for c in shown)).alias("attributes"))) if shown else F.to_json(F.struct(F.col("id").cast("string").alias("key")))
    edge = F.to_json(F.struct(F.col("source").cast("string").alias("source"), F.col("target").cast("string").alias("target"), F.struct(*(F.col(c) for c in extra)).alias("attributes")))
    return nodes.select(F.col("id").cast("string").alias("key"), node.alias("value")), edges.select(F.concat_ws("\x1f", F.col("source").cast("string"), F.col("target").cast("string")).alias("key"), edge.alias("value"))


def write_graph_json(edges: DataFrame, nodes: DataFrame, path: str, directed: bool = False) -> None:
    """Nodes and edges of a graph as one JSON document."""
    node_rows, edge_rows = graph_json_rows(edges, nodes)
    head = '{"options":{"type":"%s","multi":false,"allowSelfLoops":true},"nodes":[' % ("directed" if directed else "undirected")
    files.write_document(edges.sparkSession, path, [head, (node_rows, ["key"], ",", False), '],"edges":[', (edge_rows, ["key"], ",", False), "]}"])


def quoted(c: Column) -> Column:
    """A text as an XML attribute's value with its quotation marks: single ones where only that saves escaping; null is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    for sign, name in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    double = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit("&quot;")), F.lit('"'))
    return F.when(F.contains(text, F.lit('"')) & ~F.contains(text, F.lit("'")), F.concat(F.lit("'"), text, F.lit("'"))).otherwise(double)


def write_gexf(edges: DataFrame, nodes: DataFrame, path: str, directed: bool = False) -> None:
    """A graph as GEXF; every attribute is text, and empty ones are left out.  Edges are numbered by source and target."""

    def declare(kind: str, names: list[str]) -> str:
        return f'<attributes class="{kind}">' + "".join(f"<attribute id={quoteattr(n)} title={quoteattr(n)} type=\"string\"/>" for n in names) + "</attributes>\n"

    def values(names: list[str]) -> Column:
        each = [F.when(F.col(f"`{n}`").isNotNull(), F.concat(F.lit(f"<attvalue for={quoteattr(n)} value="), quoted(F.col(f"`{n}`")), F.lit("/>"))) for n in names]
        return F.concat_ws("", F.lit("<attvalues>"), *each, F.lit("</attvalues>"))

    node_names = [c for c in nodes.columns if c not in ("id", *HIDDEN)]
    edge_names = [c for c in edges.columns if c not in ("source", "target", "weight")]
    flat = _flat(nodes.select("id", *(f"`{c}`" for c in node_names)))
    label = F.coalesce("label", "id") if "label" in node_names else F.col("id")
    node_rows = flat.select("id", F.concat(F.lit("<node id="), quoted(F.col("id")), F.lit(" label="), quoted(label), F.lit(">"), values(node_names), F.lit("</node>")).alias("value"))
    weight = F.concat(F.lit(" weight="), quoted(F.col("weight"))) if "weight" in edges.columns else F.lit("")
    rest = F.concat(F.lit(" source="), quoted(F.col("source")), F.lit(" target="), quoted(F.col("target")), weight, F.lit(">"), values(edge_names), F.lit("</edge>"))
    spark = edges.sparkSession
    with scratch(spark):
        numbers = numbered(_flat(edges).select("source", "target", rest.alias("rest")), ["source", "target", "rest"], "k")
        edge_rows = numbers.select("k", F.concat(F.lit('<edge id="'), F.col("k").cast("string"), F.lit('"'), "rest").alias("value"))
        files.write_document(spark, path, [
            f'<?xml version="1.0" encoding="UTF-8"?>\n<gexf xmlns="http://gexf.net/1.3" version="1.3">\n<graph defaultedgetype="{"directed" if directed else "undirected"}">\n',
            declare("node", node_names) + declare("edge", edge_names) + "<nodes>\n", (node_rows, ["id"], "\n", True), "</nodes>\n<edges>\n", (edge_rows, ["k"], "\n", True),
            "</edges>\n</graph>\n</gexf>\n"])


def citation_records(pubs: DataFrame, refs: DataFrame) -> DataFrame:
    """(ord, Bibcode, value): a tagged citation record for each publication.

    Title and abstract are the translated ones where they say something.  A cited work is listed by first author, year,
    journal, volume and page, without dots; unknown keys are skipped.  Lists are joined by semicolons.
    """

    def text(df: DataFrame, c: str) -> Column:
        if c not in df.columns:
            return F.lit("")
        value = F.array_join(F.col(f"`{c}`").cast("array<string>"), "; ") if df.schema[c].dataType.typeName() == "array" else F.col(f"`{c}`").cast("string")
        return squeeze(F.coalesce(value, F.lit("")))

    first = refs.groupBy("Bibcode").agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in refs.columns if c not in ("ord", "Bibcode"))), "ord").alias("r"))
    known = first.select(F.col("Bibcode").alias("_ref"), "r.*")
    part = lambda c, sign: F.when(text(known, c) != "", F.concat(F.lit(sign), text(known, c)))
    must = lambda c: F.when(text(known, c) != "", text(known, c)).otherwise(F.lit("Unknown"))
    name = F.coalesce(surname(F.try_element_at("Author", F.lit(1))), F.lit("")) if "Author" in known.columns else F.lit("Unknown")
    cited = known.select("_ref", F.replace(F.concat_ws(", ", name, must("Year"), must("Journal"), part("Volume", "V"), part("First Page", "P")), F.lit("."), F.lit("")).alias("_cr"))
    items = pubs.select(F.col("Bibcode").alias("_k"), F.posexplode("References").alias("_pos", "_ref")).join(cited, "_ref")
    lists = items.groupBy("_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_cr"))), lambda x: x["_cr"]).alias("_crs"))
    rows = pubs.join(lists, pubs["Bibcode"] == lists["_k"], "left")
    has = lambda c: text(pubs, c)
    either = lambda c: F.when(has(f"{c}_en") != "", has(f"{c}_en")).otherwise(has(c))
    always = lambda tag, value: F.concat(F.lit(f"{tag} "), F.coalesce(value, F.lit("")))
    line = lambda tag, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{tag} "), value))
    cites = F.nullif(has("Citation Count"), F.lit("0"))
    pages = page_count(F.col("`First Page`"), F.col("`Last Page`")).cast("string") if {"First Page", "Last Page"} <= set(pubs.columns) else F.lit(None).cast("string")
    fields = [
        F.lit("PT J"), always("AU", F.array_join("Author", "\n   ")), always("TI", either("Title")), always("SO", has("Journal")), always("DT", has("Category")),
        line("C1", has("Affiliation")), line("DE", has("Keywords")), line("AB", either("Abstract")), line("CR", F.array_join("_crs", "\n   ")), always("PY", has("Year")),
        line("VL", has("Volume")), line("IS", has("Issue")), line("BP", has("First Page")), line("EP", has("Last Page")), line("DI", has("DOI")), line("TC", cites),
        line("BI", F.col("Bibcode")), line("PG", pages), F.lit("ER")]
    return rows.select("ord", "Bibcode", F.concat_ws("\n", *fields).alias("value"))


def write_citation_records(pubs: DataFrame, refs: DataFrame, path: str) -> None:
    """The records in the order of rows, with a blank line between."""
    files.write_document(pubs.sparkSession, path, [(citation_records(pubs, refs), ["ord"], "\n\n", False)])


def write_json_lines(df: DataFrame, path: str) -> None:
    """A JSON object for each row, with nulls, in files of lines."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_search(df: DataFrame, folder: str, now: dt.datetime) -> str:
    """A search result under its time, and the name `latest` for the one written last; the path of its table."""
    name = f"search_results_{now:%Y%m%d_%H%M%S}.parquet"
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    df.sparkSession.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/search_results_latest")
    return f"{folder}/{name}"


def file_digests(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The SHA-256 of each file, read by tasks block by block."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for path in rows["path"]:
                # as a URI with an authority, which may be empty
                system, name = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
                digest = hashlib.sha256()
                with system.open_input_stream(name, compression=None) as data:
                    while block := data.read(1 << 20):
                        digest.update(block)
                found.append(digest.hexdigest())
            yield pd.DataFrame({"path": rows["path"], "sha256": found})

    if not paths:
        return {}
    asked = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 10_000))
    return {r["path"]: r["sha256"] for r in asked.mapInPandas(over, "path string, sha256 string").collect()}  # a row for each file


def manifest_entry(spark: SparkSession, path: str) -> dict:
    """Size and digest of a file, or of a folder's Parquet files: the digest of their digests in the order of their names."""
    found = files.listed(spark, path)
    whole = len(found) == 1 and found[0][0].rstrip("/").endswith(path.rstrip("/").rsplit("/", 1)[-1])
    found = found if whole else [(p, n) for p, n in found if p.endswith(".parquet")]
    digests = file_digests(spark, [p for p, _ in found])
    digest = digests[found[0][0]] if whole else hashlib.sha256("".join(digests[p] for p, _ in found).encode()).hexdigest()
    return {"path": path.rstrip("/").rsplit("/", 1)[-1], "bytes": sum(n for _, n in found), "sha256": digest}


def write_bundle(folder: str, pubs: DataFrame, refs: DataFrame, topic_info: DataFrame | None = None, report: DataFrame | None = None) -> dict:
    """The tables of a dataset and a manifest of their sizes and digests, on any file system."""
    spark = pubs.sparkSession
    tables = {"publications": order_columns(pubs), "references": order_columns(refs)} | ({"topic_info": order_topic_columns(topic_info)} if topic_info is not None else {})
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    manifest = {"schema_version": 1, "artifacts": {name: manifest_entry(spark, f"{folder}/{name}.parquet") for name in tables}}
    if report is not None:
        manifest["cleaning"] = json.loads(report.toJSON().first())
    files.write_text(spark, f"{folder}/manifest.json", json.dumps(manifest, indent=2))
    return manifest


def write_once(df: DataFrame, path: str) -> bool:
    """Write a table unless it is there; whether it was written."""
    spark = df.sparkSession
    try:
        spark.read.parquet(path)
        return False
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    df.write.mode("overwrite").parquet(path)
    return True
