"""The stages of a run over lazy tables: order, prerequisites, invalidation, snapshots, variants and summaries."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import json
import logging
import re
import shutil
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import columns as fc
from citeloom.functions import text as ft
from citeloom.operators import curation, density, filters, identities, layout, networks, providers, quality, reports, topics, viz
from citeloom.plans import files
from citeloom.plans.config import Config, as_dict, changed_settings, fill_title, from_dict, redact, with_overrides
from citeloom.plans.written import delete, materialize, scratch
from citeloom.sources import corpus, rest, sinks

logger = logging.getLogger(__name__)

#: The names of the stages, in order.
STAGES = ("search", "export", "translate", "tokenize", "author_disambiguation", "embeddings", "reduction", "topic_fit", "topic_dataframe", "visualize", "curate", "citations")
#: The stage that a changed setting makes stale, by section or by section and key; the earliest match counts.
STALE: dict[str, str] = {
    "search": "search", "export": "export", "source": "export", "translate": "translate", "tokenize": "tokenize", "authors": "author_disambiguation",
    "topic.embedder": "embeddings", "topic.dimensions": "embeddings", "topic.sample_size": "embeddings", "topic.reduction": "reduction", "topic.reduction_params": "reduction",
    "topic": "topic_fit", "run.seed": "embeddings", "visualize": "visualize", "curation": "curate", "citations": "citations",
}
#: The tables that each stage makes.
MAKES: dict[str, tuple[str, ...]] = {
    "search": ("found",), "export": ("pubs", "refs"), "translate": ("pubs_translated", "refs_translated"), "tokenize": ("pubs_tokens",),
    "author_disambiguation": ("pubs_authors", "refs_authors"), "embeddings": ("vectors",), "reduction": ("reduced",), "topic_fit": ("assigned", "terms"),
    "topic_dataframe": ("dataset", "dataset_refs", "topic_info"), "visualize": ("map",), "curate": ("curated", "curated_info"), "citations": (),
}
NEEDS: dict[str, tuple[str, ...]] = {
    "search": (), "export": (), "translate": ("pubs", "refs"), "tokenize": ("pubs_translated",), "author_disambiguation": ("pubs_tokens", "refs_translated"),
    "embeddings": ("pubs_authors",), "reduction": ("vectors",), "topic_fit": ("reduced", "pubs_authors"), "topic_dataframe": ("assigned", "terms", "reduced", "pubs_authors", "refs_authors"),
    "visualize": ("dataset",), "curate": ("dataset", "dataset_refs", "topic_info"), "citations": ("curated", "dataset_refs"),
}


#: Fixed value: density clusters that part at less than this distance stay one.
EPSILON = 0.02


@dataclass
class Context:
    spark: SparkSession
    config: Config
    folder: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    notes: dict[str, Any] = field(default_factory=dict)
    providers: providers.Registry = field(default_factory=providers.Registry)
    #: What providers used in the stage that runs.
    calls: list[DataFrame] = field(default_factory=list)
    #: Called with a stage and `begins` or `ends`.
    progress: Callable[[str, str], None] = lambda stage, event: None

    def save(self, name: str, df: DataFrame) -> None:
        """A table of the run: written, and read again, so that later stages do not repeat the work."""
        path = f"{self.folder}/data/{name}.parquet"
        df.write.mode("overwrite").parquet(path)
        self.tables[name] = self.spark.read.parquet(path)


def stage_slice(start: str, stop: str) -> list[str]:
    for s in (start, stop):
        if s not in STAGES:
            raise ValueError(f"unknown stage {s!r}; known: {', '.join(STAGES)}")
    a, b = STAGES.index(start), STAGES.index(stop)
    if a > b:
        raise ValueError(f"{start} comes after {stop}")
    return list(STAGES[a : b + 1])


def maker(table: str) -> str:
    return next(s for s, made in MAKES.items() if table in made)


def first_stale(settings: list[str]) -> str | None:
    """The earliest stage that changed settings make stale; curation starts again at the topics, as it overwrites them."""
    found = [STALE.get(s) or STALE.get(s.split(".")[0]) for s in settings]
    stages = sorted(STAGES.index(s) for s in found if s)
    return STAGES[stages[0]] if stages else None


def invalidate(ctx: Context, config: Config) -> str | None:
    """Take a new configuration, and forget the tables of stale stages."""
    stale = first_stale(changed_settings(ctx.config, config))
    if stale:
        for stage in STAGES[STAGES.index(stale) :]:
            for table in MAKES[stage]:
                ctx.tables.pop(table, None)
    ctx.config = config
    return stale


def search(ctx: Context) -> None:
    """The pages of a search as rows, kept under its time where search.cache names a folder, which later runs read instead."""
    s = ctx.config.search
    if "found" in ctx.tables:
        return
    if s.cache and (held := _latest(ctx.spark, s.cache)) is not None:
        ctx.save("found", held)
    else:
        if not s.url:
            raise ValueError("the search stage needs search.url, or source tables and a later start")
        params = {"q": s.query, "rows": s.rows, "sort": "date desc, id asc"}
        asked = {"transport": ctx.notes.get("transport", s.transport), "token": s.token, "pause": s.pause}
        # kept as pages come where there is a cache, so that a scan that breaks off goes on at its cursor
        name = hashlib.sha256(json.dumps([s.url, params]).encode()).hexdigest()[:16]
        kept = f"{s.cache or ctx.folder + '/data'}/unfinished-{name}"
        rows = corpus.search_rows(rest.scan(ctx.spark, s.url, params, kept, **asked), link=s.link, page="part")
        ctx.save("found", rows)
        delete(ctx.spark, kept)
        if s.cache:
            sinks.write_search(ctx.tables["found"], s.cache, dt.datetime.now(dt.timezone.utc))
    ctx.notes["search"] = {k: int(v) for k, v in reports.search_stats(ctx.tables["found"]).first().asDict().items()}


def _latest(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return corpus.load_latest_search(spark, folder)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def export(ctx: Context) -> None:
    """Publications and cited works: own tables, or what a service exports for the keys that were found and those cited."""
    s, c = ctx.config.source, ctx.config.export
    if s.publications and s.references:
        pubs, refs = corpus.normalize_source(*corpus.load_pair(ctx.spark, s.publications, s.references))
        ctx.save("pubs", pubs)
        ctx.save("refs", refs)
        ctx.notes["export"] = {k: float(v) for k, v in reports.source_coverage(ctx.tables["pubs"], ["Abstract", "References", "Journal", "DOI"]).first().asDict().items() if v is not None}
        return
    if not c.url or "found" not in ctx.tables:
        raise ValueError("the export stage reads source.publications and source.references, or asks export.url for what a search has found")
    found = ctx.tables["found"]
    keys = {"pubs": found.where("Bibcode is not null").groupBy("Bibcode").agg(F.min("ord").alias("ord")), "refs": corpus.all_references(found)}
    for name, wanted in keys.items():
        if c.cache and (held := corpus.load_snapshot(ctx.spark, f"{c.cache}/{name}", _export_metadata(ctx, wanted))) is not None:
            ctx.save(f"exported_{name}", held)
            continue
        asked = rest.export_keys(wanted, c.url, c.format, ctx.notes.get("transport", c.transport), ctx.config.search.token, c.chunk, c.workers)
        ctx.save(f"exported_{name}", asked)
        if c.cache and not ctx.tables[f"exported_{name}"].where("error is not null").limit(1).count():
            corpus.save_snapshot(ctx.tables[f"exported_{name}"], f"{c.cache}/{name}", _export_metadata(ctx, wanted))
    pubs, refs = corpus.resolve_dataset(found, *(corpus.export_records(ctx.tables[f"exported_{name}"]) for name in ("pubs", "refs")))
    for name, df in (("pubs", pubs), ("refs", refs)):
        ctx.save(name, df)
        failed = ctx.tables[f"exported_{name}"].withColumn("ord", F.col("chunk"))
        covered = reports.export_coverage(keys[name], ctx.tables[name]).first().asDict()
        ctx.notes.setdefault("export", {})[name] = covered | {"failed": [f"chunk {r['chunk']}: {r['error']}" for r in reports.failures(failed).collect()]}  # the first three


def _export_metadata(ctx: Context, keys: DataFrame) -> dict:
    return {"url": ctx.config.export.url, "format": ctx.config.export.format, "keys": fc.frame_fingerprint(keys, ["Bibcode"])}


def translate(ctx: Context) -> None:
    c = ctx.config.translate
    profiles = ctx.notes.get("profiles")  # of this session
    if c.enabled and c.provider != "identity" and not profiles:
        if not c.profiles:
            raise ValueError("translation needs translate.profiles, a table of text and lang to learn languages from")
        ctx.notes["profiles"] = profiles = providers.train_language_profiles(ctx.spark.read.parquet(c.profiles), "text", "lang")
    for name in ("pubs", "refs"):
        df = ctx.tables[name]
        for column in c.columns:
            if column not in df.columns:
                continue
            if c.enabled and c.provider != "identity":
                df = providers.identify_language(df, column, profiles)
                answered: list[DataFrame] = []
                df = providers.translate(df, "Bibcode", column, ctx.providers.get("translate", c.provider), c.target, answered)
                ctx.calls += [providers.calls(a, "translate", c.provider) for a in answered]
            else:
                df = df.withColumns({f"{column}_lang": F.lit(None).cast("string"), f"{column}_en": F.col(column)})
        ctx.save(f"{name}_translated", df)


def tokenize(ctx: Context) -> None:
    df = ctx.tables["pubs_translated"]
    df = df.withColumn("full_text", ft.full_text(F.col("Title_en"), F.col("Abstract_en")))
    ctx.save("pubs_tokens", df.withColumn("tokens", topics.tokens(F.col("full_text"), ctx.config.tokenize.min_length)))


def disambiguate(ctx: Context) -> None:
    """Author identities by blocking, by evidence, as written (`passthrough`), or by a provider over all mentions; kept in authors.cache.

    By evidence, ids that the cache holds for other rows are kept where their mentions are still there.
    """
    c, pubs, refs = ctx.config.authors, ctx.tables["pubs_tokens"], ctx.tables["refs_translated"]
    if not c.enabled:
        ctx.save("pubs_authors", pubs)
        ctx.save("refs_authors", refs)
        return
    metadata = {"stage": "author_disambiguation", "provider": c.provider, "rows": [fc.frame_fingerprint(df, ["Bibcode", "Author"]) for df in (pubs, refs)]}
    named = corpus.load_snapshot(ctx.spark, c.cache, metadata) if c.cache else None
    if named is None and c.provider != "passthrough":
        extra = [k for k in ("Year", "Journal") if c.provider == "evidence" and k in pubs.columns and k in refs.columns]
        mentions = lambda df, n: df.select(F.lit(n).alias("table"), "Bibcode", *extra, F.posexplode("Author").alias("pos", "name"))
        before = corpus.any_snapshot(ctx.spark, c.cache, {"stage": metadata["stage"], "provider": c.provider}) if c.cache and c.provider == "evidence" else None
        built_in = {"blocking": providers.block_authors, "evidence": lambda asked: identities.evident_authors(asked, before)}
        run = built_in.get(c.provider) or ctx.providers.get("authors", c.provider)
        asked = materialize(mentions(pubs, 0).union(mentions(refs, 1)), "mentions")
        named = materialize(run(asked).select("table", "Bibcode", "pos", "author_uid", "author_display_name"), "identities")
        providers.check_mentions(asked, named)
        if c.cache:
            corpus.save_snapshot(named, c.cache, metadata)
            named = corpus.load_snapshot(ctx.spark, c.cache, metadata)
    for k, (name, df) in enumerate((("pubs_authors", pubs), ("refs_authors", refs))):
        if c.provider == "passthrough":
            ctx.save(name, providers.passthrough_identities(df))
            continue
        ctx.save(name, providers.attach_identities(df, named.where(F.col("table") == k)))
        providers.check_identities(ctx.tables[name])


def embed(ctx: Context) -> None:
    """Vectors of documents; those whose text the cache has, from the same provider in the same size, are not made again."""
    c = ctx.config.topic
    docs = ctx.tables["pubs_authors"]
    if c.sample_size is not None:
        docs = topics.sample_documents(docs, c.sample_size, ctx.config.run.seed)
    provider = providers.hash_embedder(c.dimensions) if c.embedder == "hash" else ctx.providers.get("embed", c.embedder)
    metadata, held = {"provider": c.embedder, "dimensions": c.dimensions}, None
    if c.embedding_cache:
        held = corpus.load_snapshot(ctx.spark, c.embedding_cache, metadata)
    fresh = materialize(providers.new_vectors(docs, "Bibcode", "full_text", provider, held), "vectors")
    ctx.calls.append(providers.calls(fresh, "embeddings", c.embedder))
    ctx.save("vectors", providers.embed_documents(docs, "Bibcode", "full_text", provider, held, fresh=fresh))
    if c.embedding_cache:
        new = fresh.select("text_sha256", "embedding")
        if held is None:
            corpus.save_snapshot(new, c.embedding_cache, metadata)
        elif not new.isEmpty():  # what is there stays as it is
            corpus.append_snapshot(new, c.embedding_cache)


def reduce(ctx: Context) -> None:
    """Coordinates of the vectors; those of the same vectors, method, parameters and seed are taken from topic.reduction_cache."""
    c, seed, vectors = ctx.config.topic, ctx.config.run.seed, ctx.tables["vectors"]
    params = dict(c.reduction_params)
    metadata = {"method": c.reduction, "params": params, "seed": seed, "vectors": fc.frame_fingerprint(vectors, ["Bibcode", "text_sha256"]), "embedder": c.embedder, "dimensions": c.dimensions}
    rows = corpus.load_snapshot(ctx.spark, c.reduction_cache, metadata) if c.reduction_cache else None
    ctx.notes["reduction_cached"] = rows is not None
    if rows is None:
        if c.reduction == "pca":
            rows = providers.reduce_dimensions(vectors, "Bibcode")
        elif c.reduction == "spectral":
            rows = layout.spectral_layout(vectors, "Bibcode", seed=seed, **params)
        else:
            rows = ctx.providers.get("reduce", c.reduction)(vectors, providers.validate_reduction(c.reduction, params))
        if c.reduction_cache:
            corpus.save_snapshot(rows, c.reduction_cache, metadata)
            rows = corpus.load_snapshot(ctx.spark, c.reduction_cache, metadata)
    ctx.save("reduced", vectors.join(rows, "Bibcode"))


def fit_topics(ctx: Context) -> None:
    c, rows = ctx.config.topic, ctx.tables["reduced"]
    if c.clusterer == "kmeans":
        found = providers.cluster_kmeans(rows, "Bibcode", "reduced_5d", c.clusters, ctx.config.run.seed, noise_quantile=0.95)
    elif c.clusterer == "density":
        found = density.cluster_density(rows, "Bibcode", "reduced_5d", fc.cluster_defaults(rows.count())["min_cluster_size"], epsilon=EPSILON, seed=ctx.config.run.seed)
    else:
        found = ctx.providers.get("cluster", c.clusterer)(rows)
    rows = rows.join(found, "Bibcode")
    assigned = topics.reassign_outliers(rows, "Bibcode", "topic_id", "reduced_5d", c.outlier_threshold).select("Bibcode", "topic_id")
    ctx.save("assigned", assigned)
    words = ctx.tables["pubs_authors"].select("Bibcode", "tokens").join(ctx.tables["assigned"], "Bibcode")
    ctx.save("terms", topics.class_tfidf(topics.term_counts(words), c.top_terms))


def topic_dataframe(ctx: Context) -> None:
    c = ctx.config.topic
    docs = ctx.tables["pubs_authors"].join(ctx.tables["assigned"], "Bibcode").join(ctx.tables["reduced"].select("Bibcode", "reduced_5d", "reduced_2d"), "Bibcode")
    names = topics.topic_names(ctx.tables["terms"])
    if c.labeler != "keywords":
        asked = providers.label_topics(ctx.tables["terms"], docs.select("ord", "topic_id", F.col("full_text").alias("text")), ctx.providers.get("label", c.labeler))
        answered = materialize(asked, "labels")
        ctx.calls.append(providers.calls(answered, "topic_dataframe", c.labeler))
        names = answered.drop("_usage")
        ctx.notes["label_failures"] = names.where("error is not null").count()
    if c.layers > 1:
        docs = docs.join(topic_layers(ctx), "Bibcode", "left")
    info = topics.topic_info(docs, names)
    topics.check_names(info)
    framed = materialize(topics.topic_frame(docs, info), "framed")  # the dataset, its report, its examples and its links read it
    best = quality.best_pair(framed, ctx.tables["refs_authors"])
    pubs, refs, report = quality.prepare_bundle(framed, ctx.tables["refs_authors"], best)
    ctx.save("dataset", quality.order_columns(pubs))
    ctx.save("dataset_refs", quality.order_columns(refs))
    ctx.save("topic_info", quality.order_topic_columns(quality.sync_topic_counts(info, ctx.tables["dataset"])))
    ctx.notes["cleaning"] = json.loads(report.toJSON().first())
    examples = quality.cleaning_examples(framed, ctx.tables["refs_authors"], best=best).collect()  # at most 20 of each kind
    ctx.notes["cleaning_examples"] = [r.asDict() for r in examples]
    kept = reports.link_retention(framed, ctx.tables["refs_authors"]).first().asDict()
    ctx.notes["links"] = {k: float(v) if isinstance(v, float) else int(v) for k, v in kept.items()}


def topic_layers(ctx: Context) -> DataFrame:
    """A row for each document with its cluster and that cluster's label in each of topic.layers layers, finest first.

    Coarser layers join clusters; needless noise is taken into them, by the tree or by the nearest centroid.
    """
    c, rows = ctx.config.topic, ctx.tables["reduced"].select("Bibcode", F.col("reduced_5d").alias("embedding")).join(ctx.tables["assigned"], "Bibcode")
    above = materialize(density.coarser_layers(topics.centroids(rows, "topic_id", "embedding"), c.layers, seed=ctx.config.run.seed), "layer-tree")
    member = above.select("layer", "cluster_id", F.explode("top").alias("topic_id"))
    every = rows.select("Bibcode", "topic_id").crossJoin(F.broadcast(above.select("layer").distinct()))  # as many rows as layers
    assigned = every.join(member, ["layer", "topic_id"], "left").select("Bibcode", "layer", F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"))
    fine, coarse = above.select(F.col("layer").alias("child_layer"), F.col("cluster_id").alias("child_id"), "top"), above.select(F.col("layer").alias("parent_layer"), F.col("cluster_id").alias("parent_id"), F.explode("top").alias("_t"))
    tree = fine.join(coarse, (F.col("parent_layer") == F.col("child_layer") + 1) & (F.col("_t") == F.col("top")[0])).select("child_layer", "child_id", "parent_layer", "parent_id")
    assigned = materialize(topics.reassign_layers(assigned, rows.select("Bibcode", "embedding"), tree, c.layers, c.outlier_threshold), "layers")
    words = ctx.tables["pubs_authors"].select("Bibcode", "tokens")
    labelled = []
    for layer in range(c.layers):
        own = assigned.where(F.col("layer") == layer)
        named = topics.topic_names(topics.class_tfidf(topics.term_counts(words.join(own.where("cluster_id <> -1"), "Bibcode"), "cluster_id"), c.top_terms))
        label = F.when(F.col("cluster_id") == -1, F.lit(topics.OUTLIER)).otherwise(F.coalesce("name", F.concat(F.lit("Topic "), F.col("cluster_id").cast("string"))))
        labelled.append(own.join(named.withColumnRenamed("topic", "cluster_id"), "cluster_id", "left").select("Bibcode", "layer", "cluster_id", label.alias("label")))
    layers = list(range(c.layers))
    ctx.notes["clusters_per_layer"] = {int(r["layer"]): int(r["clusters"]) for r in curation.clusters_per_layer(assigned).collect()}
    return curation.wide_layers(functools.reduce(DataFrame.union, labelled), layers, curation.working_layer(c.layers, c.working_layer))


def visualize(ctx: Context) -> None:
    if ctx.config.visualize.enabled:
        ctx.save("map", viz.point_payload(ctx.tables["dataset"]))
        layers = [k for k, _, _ in viz.label_layers(ctx.tables["dataset"].columns)]
        ctx.save("panel", viz.hierarchical_panel(ctx.tables["dataset"], layers) if layers else viz.panel_rows(ctx.tables["dataset"]))
        counts = reports.run_counts(ctx.tables["dataset"]).first()
        ctx.notes["title"] = fill_title(ctx.config.visualize.title, {"n_documents": counts["rows"], "n_topics": counts["topics_nunique"] - (counts["outliers"] > 0)})


def curate(ctx: Context) -> None:
    c = ctx.config.curation
    df = filters.remove_clusters(ctx.tables["dataset"], filters.flat_selection(list(c.clusters_to_remove)))
    if c.layered_clusters_to_remove:
        df = filters.remove_layered_clusters(df, list(c.layered_clusters_to_remove))
    ctx.save("curated", df)
    ctx.save("curated_info", quality.sync_topic_counts(ctx.tables["topic_info"], ctx.tables["curated"]))


def cite(ctx: Context) -> None:
    c = ctx.config.citations
    found = networks.citation_networks(
        ctx.tables["curated"], ctx.tables["dataset_refs"], tuple(c.metrics), dict(c.min_counts), authors=list(c.authors), uids=list(c.author_uids),
        exclude_authors=list(c.exclude_authors), exclude_uids=list(c.exclude_uids))
    tail = "_filtered" if any((c.authors, c.author_uids, c.exclude_authors, c.exclude_uids)) else ""
    for metric, parts in found.items():
        folder = f"{ctx.folder}/citations/{metric}{tail}"
        if c.output_format in ("csv", "all"):
            sinks.write_network_csv(parts["edges"], parts["nodes"], folder, parts["evidence"])
        if c.output_format in ("gexf", "all"):
            sinks.write_gexf(parts["edges"], parts["nodes"], f"{folder}/graph.gexf", metric == "direct")
        if c.output_format in ("graphology", "all"):
            sinks.write_graph_json(parts["edges"], parts["nodes"], f"{folder}/graph.json", metric == "direct")
        if c.output_format not in ("csv", "all") and networks.has_distinct_evidence(parts["evidence"], parts["edges"]):
            sinks.write_csv(parts["evidence"], f"{folder}/evidence.csv")
    sinks.write_citation_records(ctx.tables["curated"], ctx.tables["dataset_refs"], f"{ctx.folder}/citations/records{tail}.txt")
    ctx.notes["networks"] = sorted(found)


RUN: dict[str, Callable[[Context], None]] = {
    "search": search, "export": export, "translate": translate, "tokenize": tokenize, "author_disambiguation": disambiguate, "embeddings": embed,
    "reduction": reduce, "topic_fit": fit_topics, "topic_dataframe": topic_dataframe, "visualize": visualize, "curate": curate, "citations": cite,
}


def needs(config: Config, stage: str) -> tuple[str, ...]:
    """The tables that a stage reads: an export without own tables reads what a search has found."""
    return ("found",) if stage == "export" and not config.source.publications else NEEDS[stage]


def work(ctx: Context, stage: str) -> None:
    """A stage alone: what it writes on its way is deleted, its seconds are noted, what providers used is kept in the run's folder."""
    began = time.monotonic()
    ctx.calls = []
    with scratch(ctx.spark):
        RUN[stage](ctx)
        if ctx.calls:
            functools.reduce(DataFrame.unionByName, ctx.calls).write.mode("overwrite").parquet(f"{ctx.folder}/usage/{stage}.parquet")
            ctx.notes.setdefault("usage", {})[stage] = f"{ctx.folder}/usage/{stage}.parquet"
    ctx.calls = []
    ctx.notes.setdefault("seconds", {})[stage] = round(time.monotonic() - began, 3)


def costs(ctx: Context) -> dict | None:
    """What providers used in the stages so far, by step, provider and model, and how many calls have a price; None without any call."""
    paths = list(ctx.notes.get("usage", {}).values())
    if not paths or (used := ctx.spark.read.parquet(*paths)).isEmpty():
        return None
    priced = reports.with_fetched_costs(used, used.select("generation_id", "cost_usd").limit(0))
    return {"by_model": [r.asDict() for r in reports.cost_summary(used).orderBy("step", "provider", "model").collect()], "calls": reports.cost_resolution(priced).first().asDict()}


def run_stage(ctx: Context, stage: str) -> list[str]:
    """Run a stage, and before it whatever makes the tables that it lacks; returns the stages that ran, in order."""
    ran: list[str] = []
    for table in needs(ctx.config, stage):
        if table not in ctx.tables:
            ran += run_stage(ctx, maker(table))
    ctx.progress(stage, "begins")
    logger.info("%s begins", stage)
    work(ctx, stage)
    ctx.progress(stage, "ends")
    logger.info("%s ends", stage)
    return [*ran, stage]


def run_folder(spark: SparkSession, root: str, name: str, now: dt.datetime | None = None) -> str:
    """A new folder of a run, on the file system that root names: where Spark's tasks write, not on the driver's disk."""
    stamp = (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/run_{stamp}_{re.sub(r'[^A-Za-z0-9_-]+', '-', name)}"
    for part in ("data", "citations"):
        files.make_folder(spark, f"{path}/{part}")
    return path


def run(spark: SparkSession, config: Config, root: str, tables: dict[str, DataFrame] | None = None, registry: providers.Registry | None = None,
        progress: Callable[[str, str], None] | None = None) -> Context:
    """The slice of stages of a configuration; configuration and summary are written whether it ends well or not."""
    ctx = Context(spark, config, run_folder(spark, root, config.run.name), dict(tables or {}), providers=registry or providers.Registry())
    ctx.progress = progress or ctx.progress
    start = config.run.start_stage
    if start == "search" and config.source.publications:  # own tables take the place of a search
        start = "export"
    files.write_text(spark, f"{ctx.folder}/config.yaml", yaml.safe_dump(json.loads(json.dumps(redact(as_dict(config))))))
    ran: list[str] = []
    error = None
    try:
        for stage in stage_slice(start, config.run.stop_stage):
            if stage not in ran:
                ran += run_stage(ctx, stage)
        return ctx
    except Exception as e:
        error = f"{type(e).__name__}: {str(e)[:500]}"
        raise
    finally:
        ctx.notes["stages"] = ran
        files.write_text(spark, f"{ctx.folder}/run_summary.yaml", yaml.safe_dump(summary(ctx, error)))


def summary(ctx: Context, error: str | None = None) -> dict:
    out: dict[str, Any] = {"stages": ctx.notes.get("stages", []), "status": "failed" if error else "completed"}
    if error:
        out["error"] = redact(error)
    table = next((ctx.tables[t] for t in ("curated", "dataset") if t in ctx.tables), None)
    if table is not None and not error:
        out["counts"] = {k: float(v) if isinstance(v, float) else int(v) for k, v in reports.run_counts(table).first().asDict().items()}
    if not error and (used := costs(ctx)):
        out["costs"] = used
    for k in ("seconds", "search", "export", "links", "cleaning", "cleaning_examples", "clusters_per_layer", "label_failures", "title", "networks"):
        if k in ctx.notes:
            out[k] = ctx.notes[k]
    return out


@dataclass(frozen=True)
class Variant:
    source: str
    config: Config
    changed: tuple[str, ...]
    start: str
    reused: tuple[str, ...]

    def text(self) -> str:
        return f"variant of {self.source}\nchanged: {', '.join(self.changed) or 'nothing'}\nstarts at: {self.start}\nreuses: {', '.join(self.reused) or 'nothing'}"


def plan_variant(folder: str, overrides: dict[str, Any], start: str | None = None, spark: SparkSession | None = None) -> Variant:
    """What a run with other settings can take over from an earlier one; without any session its folder is one of this machine."""
    spark = spark or SparkSession.getActiveSession()
    there = lambda name: files.exists(spark, f"{folder}/{name}") if spark else Path(folder, name).exists()
    if not there("config.yaml"):
        raise ValueError(f"{folder} is no run folder")
    held = yaml.safe_load(files.read_text(spark, f"{folder}/config.yaml") if spark else Path(folder, "config.yaml").read_text())
    held = {s: {k: None if v == "***" else v for k, v in own.items()} for s, own in held.items()}
    old = from_dict(held)
    new = with_overrides(old, overrides)
    changed = changed_settings(old, new)
    first = start or first_stale(changed) or "citations"
    if first == "curate" and not start:
        first = "topic_fit"
    wanted = {t for s in STAGES[STAGES.index(first) :] for t in NEEDS[s] if STAGES.index(maker(t)) < STAGES.index(first)}
    reused = tuple(sorted(t for t in wanted if there(f"data/{t}.parquet")))
    return Variant(folder, replace(new, run=replace(new.run, start_stage=first)), tuple(changed), first, reused)


def run_variant(spark: SparkSession, variant: Variant, root: str, registry: providers.Registry | None = None) -> Context:
    """Reused tables are read where they are."""
    tables = {t: spark.read.parquet(f"{variant.source}/data/{t}.parquet") for t in variant.reused}
    return run(spark, variant.config, root, tables, registry)


#: Names that need no provider, by task: the setting and the stage that reads it.
BUILT_IN: dict[str, tuple[str, str, str, set[str]]] = {
    "translate": ("translate", "translate", "provider", {"identity"}), "authors": ("author_disambiguation", "authors", "provider", {"blocking", "evidence", "passthrough"}),
    "embed": ("embeddings", "topic", "embedder", {"hash"}), "reduce": ("reduction", "topic", "reduction", {"pca", "spectral"}), "cluster": ("topic_fit", "topic", "clusterer", {"kmeans", "density"}),
    "label": ("topic_dataframe", "topic", "labeler", {"keywords"}),
}


def doctor(config: Config, registry: providers.Registry | None = None) -> list[str]:
    """What would stop a run before it starts, for the stages that it has."""
    out = []
    stages = stage_slice(config.run.start_stage, config.run.stop_stage)
    own = config.source.publications and config.source.references
    if "search" in stages and not (config.search.url or config.search.cache or config.source.publications):
        out.append("search: neither search.url nor source tables are set")
    if "search" in stages and config.search.url and not config.source.publications and not config.search.query:
        out.append("search: search.query is empty")
    if "export" in stages and bool(config.source.publications) != bool(config.source.references):
        out.append("source: publications and references belong together")
    if "export" in stages and (config.search.url or config.search.cache) and not own and not (config.export.url and config.export.format):
        out.append("export: a search needs export.url and export.format")
    known = (registry or providers.Registry()).known
    for task, (stage, section, key, built_in) in BUILT_IN.items():
        name = getattr(getattr(config, section), key)
        if stage in stages and getattr(getattr(config, section), "enabled", True) and name not in built_in and name not in known.get(task, {}):
            out.append(f"{section}.{key}: no provider {name!r}; known: {', '.join(sorted({*built_in, *known.get(task, {})}))}")
    if "translate" in stages and config.translate.enabled and config.translate.provider != "identity" and not config.translate.profiles:
        out.append("translate.profiles: a provider needs a table of text and lang, or texts of any language would be sent to it")
    for name in ("publications", "references"):
        path = getattr(config.source, name)
        if "export" in stages and path and "://" not in path and not Path(path).exists():
            out.append(f"source.{name}: {path} does not exist")
    if shutil.disk_usage(".").free < 1 << 30:
        out.append("less than 1 GB of disk is free")
    return out


def layer_summary(ctx: Context) -> DataFrame:
    return curation.cluster_summary(ctx.tables["dataset"])
