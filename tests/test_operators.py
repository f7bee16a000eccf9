"""Texts, arrays, cleaning, curation, topics, reports and map data on literal rows."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.functions import columns as fc
from citeloom.functions import text as ft
from citeloom.operators import curation, density, filters, providers, quality, reports, topics, viz


def values(spark, expression, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]
from tests.exact_density import density_cluster


def test_text_functions(spark):
    assert values(spark, ft.clean_html, "a &lt;b&gt;x&lt;/b&gt; &eacute;", "<i>t</i> &amp;amp;", None, "2 < 3") == ["a x é", "t &amp;", None, "2 < 3"]
    assert values(spark, ft.strip_tags, "&lt;b&gt;x", "a&nbsp;b") == ["x", "a\xa0b"]
    assert values(spark, ft.clean_range, "12-19", " 7 ", None) == ["12", "7", None]
    assert [(r["first"], r["last"]) for r in values(spark, ft.page_range, "10–19", "5", None, "1 — 2")] == [("10", "19"), ("5", ""), ("", ""), ("1", "2")]
    assert values(spark, ft.squeeze, " a\xa0 b\n\tc ", "") == ["a b c", ""]
    assert values(spark, ft.key, "\t x \n", None) == ["x", ""]
    assert values(spark, ft.parse_authors, "Doe, J; Roe, K and Poe, L", "and Doe, J & 12 colleagues", "Doe, J et al.", "") == [["Doe, J", "Roe, K", "Poe, L"], ["Doe, J"], ["Doe, J"], []]
    names = values(spark, ft.parse_authors, "Doe, J; 12 colleagues.; and 3 colleagues", "Et Alia, P and Roe ,", "Doe AND Roe", "Roe, et al", "& Li, X", None, " ;; ", "Sander Andand; Band, A & Co")
    assert names == [["Doe, J"], ["Et Alia, P", "Roe"], ["Doe AND Roe"], ["Roe"], ["Li, X"], [], [], ["Sander Andand", "Band, A", "Co"]]
    assert values(spark, ft.surname, "Doe, Jane", "Jane van Doe", "  ", None) == ["Doe", "Doe", None, None]
    assert values(spark, ft.without_thinking, "<think>a\nb</think> answer", "plain") == ["answer", "plain"]
    assert values(spark, ft.topic_label, "Topic: \"Dark matter\"\nmore", "topic:x") == ["Dark matter", "x"]
    assert values(spark, ft.shorten, "x" * 201, "y") == ["x" * 200 + "...", "y"]
    assert values(spark, ft.flatten_newlines, "a\nb\\nc") == ["a b c"]
    assert values(spark, lambda c: ft.full_text(c, F.lit("Gamma")), None, "T") == [". Gamma", "T. Gamma"]
    assert values(spark, lambda c: ft.badges(F.array(c, F.lit("<b>"))), "a & b", None) == ['<span class="badge">a &amp; b</span><span class="badge">&lt;b&gt;</span>', '<span class="badge">&lt;b&gt;</span>']
    assert values(spark, lambda c: ft.fill_prompt("K [KEYWORDS] D [DOCUMENTS]", F.array(c), F.array(F.lit("d" * 300))), "k") == ["K k D - " + "d" * 255]
    assert values(spark, lambda c: ft.without_hyphens(F.split(c, ";")), "Jean-Luc; ;B") == [["JeanLuc", "B"]]


def test_references_become_characters_as_in_html(spark):
    import html
    import random

    rng = random.Random(1)
    pieces = ["&amp", "&amp;", "&notit;", "&notin;", "&copy", "&copyright", "&#65;", "&#x41", "&#0;", "&#128;", "&#x9f;", "&#xD800;", "&#1114112;", "&#99999999999999;", "&#11;", "&#13;", "&#xFFFE;", "&#127;",
              "&#;", "&", "&;", "&lt;b&gt;", "&CounterClockwiseContourIntegral;", "&nosuch;", "&fjlig;", "&#x1F600;", "a b", "<", "é", "&Eacute", "&#0065x", "&#X3c;"]
    texts = pieces + ["".join(rng.choice(pieces) for _ in range(rng.randint(2, 12))) for _ in range(200)]
    assert values(spark, ft.unescape, *texts, None) == [*map(html.unescape, texts), None]


def test_chunks_join_again(spark):
    text = " ".join(f"word{i}" for i in range(4000))
    parts = ft.chunk_text(text, 3000, 300)
    assert all(len(p) <= 3000 for p in parts) and len(parts) > 5
    assert ft.merge_chunks(["a b c D E", "d e f", "g"]) == "a b c D E f g"
    assert ft.merge_chunks(["x", "y"]) == "x y" and ft.chunk_text("") == []
    assert values(spark, lambda c: F.size(ft.chunks(c, 12_000, 1_500)), text, None, "short") == [len(ft.chunk_text(text)), 0, 1]
    assert values(spark, lambda c: ft.merged(F.split(c, ";")), "a b;b c", None) == ["a b c", None]


def test_array_date_and_number_functions(spark):
    assert values(spark, lambda c: fc.list_from_text(c), " b; a ;b;;", None) == [["b", "a"], []]
    assert values(spark, fc.numeric_year, "2020", "2020.0", "2020.5", "x", None) == [2020, 2020, None, None, None]
    assert values(spark, fc.publication_date, "2020", "bad", None) == [dt.date(2020, 12, 31), None, None]
    assert values(spark, fc.year_in_text, "in 1899, 1987 or 2001", "none", None) == [1987, None, None]
    assert values(spark, lambda c: fc.percentage(c.cast("int"), F.lit(800)), "98") == [12.2]
    assert values(spark, lambda c: fc.page_count(c, F.lit("19")), "10", "0", "x") == [10, None, None]
    assert values(spark, lambda c: fc.overlaps(F.array(c, F.lit(None).cast("string")), ["a"]), "a", "b", None) == [True, False, False]
    assert values(spark, lambda c: fc.token_ceiling(c.cast("int"), 400), "1", "100", "1000") == [96, 214, 400]
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert fc.frame_fingerprint(df, ["k", "v"]) == fc.frame_fingerprint(df.orderBy(F.desc("k")).repartition(3), ["k", "v"]) != fc.frame_fingerprint(df.limit(1), ["k", "v"])
    assert fc.cluster_defaults(100_000) == {"min_cluster_size": 100, "base_min_cluster_size": 55, "min_clusters": 10, "min_df": 5} and fc.capped_min_df(5, 40) == 2
    assert spark.range(1).select(fc.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(0.0)))).first()[0] == 0.0


def test_filters_keep_nulls(spark):
    df = spark.createDataFrame([(1, -1, "Straße"), (2, None, None), (3, 5, "other")], "k int, topic_id int, j string")
    keys = lambda d: sorted(r["k"] for r in d.collect())
    assert keys(filters.remove_clusters(df, [-1])) == [2, 3] and filters.unmatched_clusters(df, [5, 9]) == [9] and keys(filters.remove_clusters(df, [])) == [1, 2, 3]
    assert keys(filters.filter_by_field(df, "j", ["STRASSE"])) == [1] and keys(filters.filter_by_field(df, "j", ["strasse"], keep=False)) == [2, 3]
    with pytest.raises(ValueError):
        filters.filter_by_field(df, "missing", ["x"])
    with pytest.raises(ValueError):
        filters.layered_selection([{"layer": -1, "cluster_id": 1}])
    with pytest.raises(ValueError):
        filters.flat_selection("1,2")
    with pytest.raises(ValueError):
        filters.remove_layered_clusters(df, [{"layer": 0, "cluster_id": 1}])
    assert filters.layered_selection([{"layer": "0", "cluster_id": "2"}] * 2) == [{"layer": 0, "cluster_id": 2}]
    lang = spark.createDataFrame([(1, "a", "en"), (2, "b", None), (3, "", "de"), (4, None, "de"), (5, "c", "de")], "k int, t string, t_lang string")
    assert keys(filters.translation_targets(lang, "t")) == [2, 5]
    uids = values(spark, filters.placeholder_uid, "Unknown", "x::no author", "uid:1", None, " ", "x::none", "N.Author", "a:: ::b", "null", "no_author")
    assert uids == [True, True, False, True, True, False, True, True, False, True]
    assert values(spark, ft.casefold, "STRASSE", "Straße", "ﬁN", "İ", None) == ["strasse", "strasse", "fin", "İ".casefold(), None]
    years = spark.createDataFrame([("2020",), ("bad",), (None,), ("2020.5",)], "Year string")
    assert [r[0] for r in filters.numeric_years(years).collect()] == [2020]


PUBS = "ord int, Bibcode string, Title string, References array<string>, author_uids array<string>, author_display_names array<string>"


def test_bundle_cleaning(spark):
    pubs = spark.createDataFrame([
        (1, " p1 ", None, ["r1"], ["unknown"], ["x"]), (2, "p1", "T", ["r1", " r2 ", "r1", "", "gone", "gone2"], ["uid:real", " uid:real", "nan"], ["R"]),
        (3, "p2", "T", ["r2"], None, None), (4, " ", "T", ["r1"], [], [])], PUBS)
    refs = spark.createDataFrame([(1, " r1", None, None, [], []), (2, "r1", "longer", None, ["uid:known", "x::unknown"], ["K"]), (3, "r2", "t", None, None, None), (4, None, "t", None, [], [])], PUBS)
    p, r, report = quality.prepare_bundle(pubs, refs.drop("References"))
    rows = {x["Bibcode"]: x for x in p.collect()}
    assert set(rows) == {"p1", "p2"} and rows["p1"]["ord"] == 2
    assert rows["p1"]["References"] == ["r1", "r2"] and rows["p2"]["References"] == ["r2"]
    assert rows["p1"]["author_uids"] == ["uid:real"] and rows["p1"]["author_display_names"] == ["R"] and rows["p2"]["author_uids"] == []
    assert {x["Bibcode"]: x["author_uids"] for x in r.collect()} == {"r1": ["uid:known"], "r2": []}
    counts = report.first().asDict()
    assert (counts["publications_empty_keys"], counts["publications_duplicate_rows"], counts["empty_mentions"], counts["duplicate_mentions"], counts["missing_keys"]) == (1, 1, 1, 1, 2)
    assert (counts["publications_placeholder_uids"], counts["publications_duplicate_uids"], counts["publications_uid_changed_rows"]) == (1, 1, 1)
    assert (counts["publications_output_rows"], counts["publications_duplicate_keys"], counts["missing_mentions"], counts["references_placeholder_uids"], counts["references_uid_changed_rows"]) == (2, 1, 2, 1, 1)
    examples = {(e["kind"], e["value"], e["n"]) for e in quality.cleaning_examples(pubs, refs.drop("References")).collect()}
    assert examples == {("publications_duplicate_key", "p1", 2), ("references_duplicate_key", "r1", 2), ("publications_placeholder_uid", "nan", 1), ("references_placeholder_uid", "x::unknown", 1), ("missing_reference", "gone", 1), ("missing_reference", "gone2", 1)}
    own = refs.drop("References")
    best = quality.best_pair(pubs, own)  # written once, they give the same
    again = quality.prepare_bundle(pubs, own, best)
    assert again[2].first() == report.first() and sorted(again[0].collect()) == sorted(p.collect())
    assert sorted(quality.cleaning_examples(pubs, own, best=best).collect()) == sorted(quality.cleaning_examples(pubs, own).collect())
    assert quality.order_topic_columns(spark.createDataFrame([], "z int, Name string, Main string, Topic int")).columns == ["Topic", "Name", "Main", "z"]
    names = ["embedding_2d_y", "full_embeddings", "z", "embedding_5d_10", "topic_layer_10_id", "topic_layer_2_label", "topic_layer_2_id", "embedding_2d_x", "embedding_5d_2", "topic_layer_count", "Name", "Title_lang", "Title", "Year", "Bibcode", "embedding_other"]
    ordered = quality.order_columns(spark.createDataFrame([], ", ".join(f"{n} int" for n in names))).columns
    assert ordered == ["Bibcode", "Year", "Title", "Title_lang", "Name", "topic_layer_count", "topic_layer_2_id", "topic_layer_2_label", "topic_layer_10_id", "z", "embedding_other", "embedding_5d_2", "embedding_5d_10", "embedding_2d_x", "embedding_2d_y", "full_embeddings"]


def test_curation(spark):
    df = spark.createDataFrame([(1, 1, "A"), (2, 1, "B"), (3, 2, "C"), (4, None, "D"), (5, -1, None)], "ord int, topic_id int, Name string")
    assert sorted(tuple(r) for r in curation.cluster_summary(df).collect()) == [(-1, None, 1, 20.0), (1, "A", 2, 40.0), (2, "C", 1, 20.0)]
    assert curation.working_layer(3) == 2 and curation.working_layer(3, 1) == 1
    with pytest.raises(ValueError):
        curation.working_layer(3, 3)
    tree = spark.createDataFrame([(1, 0, [(0, 3), (0, 4)])], "parent_layer int, parent_id int, children array<struct<layer:int,id:int>>")
    assert sorted(tuple(r) for r in curation.parents(tree).collect()) == [(0, 3, 1, 0), (0, 4, 1, 0)]
    assigned = spark.createDataFrame([("a", 0, -1, None), ("a", 1, 2, "x"), ("b", 0, 1, "y"), ("b", 1, 2, "x")], "Bibcode string, layer int, cluster_id int, label string")
    assert {r["layer"]: r["clusters"] for r in curation.clusters_per_layer(assigned).collect()} == {0: 1, 1: 1}


def test_topics(spark):
    docs = spark.createDataFrame([(0, "The dark matter of 12 halos; dark matter!"), (1, "is it an ab"), (1, None)], "topic_id int, t string").withColumn("tokens", topics.tokens(F.col("t")))
    assert [r["tokens"] for r in docs.collect()] == [["dark", "matter", "halos", "dark", "matter"], [], []]
    counts = {r["term"]: r["tf"] for r in topics.term_counts(docs).collect()}
    assert counts["dark matter"] == 2 and counts["dark matter halos"] == 1 and len(counts) == 3 + 3 + 3
    weights = topics.class_tfidf(topics.term_counts(docs), 2).collect()
    assert {r["term"] for r in weights} <= {"dark", "matter", "dark matter"} and len(weights) == 2
    info = topics.topic_info(docs, spark.createDataFrame([(0, "dark")], "topic int, name string"))
    assert sorted(tuple(r) for r in info.collect()) == [(0, 1, "dark"), (1, 2, "Topic 1")]
    with pytest.raises(ValueError):
        topics.check_names(info.withColumn("Name", F.lit(" ")))


def test_outliers(spark, monkeypatch):
    rows = [("a", 0, [1.0, 0.0]), ("b", 1, [0.0, 1.0]), ("c", -1, [0.9, 0.1]), ("d", -1, [-1.0, -1.0]), ("e", -1, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "Bibcode string, topic_id int, embedding array<double>")
    for size in (64 << 20, 8):  # one block of centroids, or several
        monkeypatch.setattr(topics, "BROADCAST_BYTES", size)
        out = {r["Bibcode"]: r["topic_id"] for r in topics.reassign_outliers(df, threshold=0.5).collect()}
        assert out == {"a": 0, "b": 1, "c": 0, "d": -1, "e": -1}
    assert {r["topic_id"] for r in topics.reassign_outliers(df.where("Bibcode = 'c'").union(df.limit(2)), threshold=0.999).collect()} == {0, 1, -1}
    assigned = spark.createDataFrame([("a", 0, 0), ("b", 0, 1), ("c", 0, -1), ("a", 1, 1), ("b", 1, 0), ("c", 1, -1)], "Bibcode string, layer int, cluster_id int")
    tree = spark.createDataFrame([(0, 0, 1, 1), (0, 1, 1, 0)], "child_layer int, child_id int, parent_layer int, parent_id int")
    out = {(r["Bibcode"], r["layer"]): r["cluster_id"] for r in topics.reassign_layers(assigned, df.select("Bibcode", "embedding"), tree, 2, 0.5).collect()}
    assert out["c", 0] == 0 and out["c", 1] == 1
    assert topics.sample_documents(df, 3, 1).count() == 3 and topics.sample_documents(df, 30).count() == 5


def test_reports(spark):
    ledger = spark.createDataFrame([("s", "p", "m", 1, 2, 3, None), ("s", "p", "m", 1, None, 3, None), ("t", "p", "m", 1, 2, 3, 0.5)], "step string, provider string, model string, prompt_tokens int, completion_tokens int, total_tokens int, cost_usd double")
    out = {r["step"]: r for r in reports.cost_summary(ledger).collect()}
    assert out["s"]["cost_usd"] is None and out["s"]["calls"] == 2 and out["t"]["cost_usd"] == 0.5
    counts = reports.run_counts(spark.createDataFrame([(-1,), (1,), (None,)], "topic_id int")).first()
    assert (counts["topics_nunique"], counts["outliers"], counts["outlier_rate"]) == (2, 1, 0.3333)
    assert reports.run_counts(spark.createDataFrame([], "topic_id int")).first()["rows"] == 0


def test_spans_of_years(spark):
    df = spark.createDataFrame([(2003,), (1999,), (None,)], "Year int")
    day = lambda y: dt.date(y, 1, 1)
    assert tuple(reports.histogram_years(df).first()) == (day(1999), day(2004))
    assert tuple(reports.histogram_years(df.limit(0)).first()) == (day(1900), day(1901))
    assert tuple(reports.histogram_years(df, span=("1980-01-01", "1985-01-01")).first()) == (day(1980), day(1985))
    with pytest.raises(ValueError, match="end after"):
        reports.histogram_years(df, span=("1980-01-01", "1980-01-01"))
    links = reports.link_retention(spark.createDataFrame([(["a", "b"],), (["b", "c"],), ([],)], "References array<string>"), spark.createDataFrame([("b",), ("c",), ("c",)], "Bibcode string")).first()
    assert tuple(links) == (4, 3, 3, 0.75)


def test_map_data(spark):
    df = spark.createDataFrame([(1, "b1", 0.0, 0.0, 1, "A", "x"), (2, "b2", 0.0, 0.0, -1, "Outlier Topic", None), (3, "b3", 0.0, 0.0, -1, "Unlabelled", "3")], "ord int, Bibcode string, embedding_2d_x double, embedding_2d_y double, topic_id int, Name string, `Citation Count` string").withColumn("Year", F.lit(2000))
    assert [r["citation_count"] for r in viz.point_payload(df).orderBy("bibcode").collect()] == [0, 0, 3]
    assert viz.noise_label(df).first()[0] == "Unlabelled" and viz.noise_label(df.limit(0)).first()[0] == "Unlabelled" and viz.noise_label(df.where("ord < 3")).first()[0] == "Outlier Topic"
    assert {r["ord"]: r["colour"] for r in viz.marker_colours(df, ["#1"]).collect()} == {1: "#1", 2: "#999999", 3: "#999999"}
    assert {r["key"] for r in viz.panel_rows(df).collect()} == {"flat::1", "flat::noise::"}
    assert viz.label_layers(["topic_layer_10_label", "topic_layer_10_id", "topic_layer_2_id", "topic_layer_2_label", "topic_layer_3_label"]) == [(2, "topic_layer_2_id", "topic_layer_2_label"), (10, "topic_layer_10_id", "topic_layer_10_label")]


def test_providers(spark):
    df = spark.createDataFrame([(1, "hallo welt", "de"), (2, "hi", "en"), (3, "kaputt", "de"), (4, None, None)], "k int, t string, t_lang string")

    def shout(texts, languages):
        if "kaputt" in texts:
            if len(texts) == 1:
                raise ValueError("cannot")
            raise RuntimeError("batch")
        return [t.upper() for t in texts]

    out = {r["k"]: (r["t_en"], r["t_error"]) for r in providers.translate(df, "k", "t", shout).collect()}
    assert out == {1: ("HALLO WELT", None), 2: ("hi", None), 3: ("kaputt", "cannot"), 4: (None, None)}
    emb = providers.embed_documents(df, "k", "t", providers.hash_embedder(8))
    assert emb.count() == 4 and all(len(r["embedding"]) == 8 for r in emb.collect())
    cached = providers.embed_documents(df, "k", "t", lambda t: 1 / 0, cache=emb.dropDuplicates(["text_sha256"]))
    assert cached.count() == 4
    registry = providers.Registry()
    registry.add("embed", "hash", providers.hash_embedder)
    with pytest.raises(ValueError, match="hash"):
        registry.get("embed", "other")
    named = spark.createDataFrame([(1, "Doe, Jane"), (2, "Doe, J"), (3, "Roe, J"), (4, None)], "k int, name string")
    ids = {r["k"]: r["author_uid"] for r in providers.block_authors(named).collect()}
    assert ids[1] == ids[2] != ids[3] and len(ids) == 4
    profiles = {"a": {"the": -1.0, " th": -2.0, "日本語": -1.0}, "b": {"der": -1.0, "er ": -1.0}}
    guessed = providers.identify_language(spark.createDataFrame([(1, "the thing"), (2, "Der Leder"), (3, " 12 "), (4, None), (5, "x"), (6, "日本語")], "k int, t string"), "t", profiles)
    slow = lambda t: max(sorted(profiles), key=lambda k: sum(profiles[k].get(f" {t.lower()} "[i : i + 3], -12.0) for i in range(len(t)))) if t and any(map(str.isalpha, t)) else None
    assert all(r["t_lang"] == slow(r["t"]) for r in guessed.collect())
    assert providers.identify_language(df, "t", {}).where("t_lang is not null").count() == 0
    terms = spark.createDataFrame([(0, "dark", 2.0), (0, "matter", 1.0), (1, "star", 1.0), (2, "gas", 1.0)], "topic int, term string, weight double")
    docs = spark.createDataFrame([(1, 0, "text of one"), (2, 0, None), (3, 1, "text of two")], "ord int, topic_id int, text string")

    def label(prompts):
        if "gas" in prompts[0]:
            raise ValueError("no answer")
        return ["<think>hm</think> Topic: \"Dark halos\"" if "dark, matter" in prompts[0] and "- text of one" in prompts[0] else " "]

    assert {r["topic"]: (r["name"], r["error"]) for r in providers.label_topics(terms, docs, label).collect()} == {0: ("Dark halos", None), 1: ("star", None), 2: ("gas", "no answer")}
    means = spark.createDataFrame([(k, [float(k // 3 * 10), float(k % 3)]) for k in range(9)], "cluster int, centroid array<double>").withColumn("n", F.lit(1))
    layers = {}
    for r in density.coarser_layers(means, 3).collect():
        layers.setdefault(r["layer"], []).append(r["top"])
    assert sorted(layers[0]) == [[k] for k in range(9)] and sorted(layers[1]) == [[0, 1, 2], [3, 4, 5], [6, 7, 8]] and layers[2] == [list(range(9))]
    assert density.coarser_layers(means.limit(0), 2).count() == 0
    spread = spark.createDataFrame([(i, [float(i % 2 * 50 + i % 7), float(i % 5)]) for i in range(60)], "k int, v array<double>")
    assert {r["topic_id"] for r in density.cluster_density(spread, "k", "v", 10).collect()} - {-1} == {0, 1}
    assert providers.validate_reduction("pacmap", {"metric": "cosine", "min_dist": 1}) == {"distance": "angular"}


def test_density_clusters():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.1, (60, 2)) for c in ((0, 0), (3, 0), (0, 3))] + [rng.uniform(-4, 7, (12, 2))])
    label = density_cluster(points, 15)
    assert len({*label[:60]} - {-1}) == len({*label[60:120]} - {-1}) == len({*label[120:180]} - {-1}) == 1
    assert len(set(label) - {-1}) == 3 and (label[:180] >= 0).mean() > 0.9
    assert (density_cluster(points[:10], 15) == -1).all()
    assert providers.diverse_terms(["a", "b", "c"], np.array([[1, 0.0], [1, 0.01], [0.6, 0.8]]), np.array([1.0, 0.2]), top=2, balance=0.7)[1] == "c"


def test_mentions_of_a_provider_are_checked(spark):
    schema = "table int, Bibcode string, pos int"
    asked = spark.createDataFrame([(0, "a", 0), (0, "a", 1), (1, None, 0)], schema)
    providers.check_mentions(asked, asked)
    for named, said in (([(0, "a", 0), (1, None, 0)], "left 1 "), ([(0, "a", 0), (0, "a", 1), (1, None, 0), (1, "b", 0)], "named 1 that"), ([(0, "a", 0), (0, "a", 0), (0, "a", 1), (1, None, 0)], "repeated 1")):
        with pytest.raises(ValueError, match=said):
            providers.check_mentions(asked, spark.createDataFrame(named, schema))


def test_trigrams_of_long_texts_are_cut_in_linear_time(spark):
    """Cutting each trigram from a text's start took minutes for a text of this length."""
    import time

    long = "abcdefghij klmnop " * 60_000
    rows = [("a", long), ("a", "Ünï😀 çode"), ("b", ""), ("b", "zz"), ("b", None), (None, "zzz")]
    began = time.time()
    got = providers.train_language_profiles(spark.createDataFrame(rows, "lang string, text string"), "text", "lang")
    assert time.time() - began < 30
    padded = [f" {t.lower()} " for lang, t in rows if lang == "a"]
    want = Counter(t[i : i + 3] for t in padded for i in range(len(t) - 2))
    assert set(got) == {"a", "b"} and set(got["a"]) == set(want) and all(abs(got["a"][g] - np.log(n / want.total())) < 1e-12 for g, n in want.items())
    assert set(got["b"]) == {" zz", "zz "}


def test_totals_are_made_of_terms_that_can_be_best(spark, monkeypatch):
    held, write = {}, topics.materialize
    monkeypatch.setattr(topics, "materialize", lambda df, name: held.setdefault(name, write(df, name)))
    rows = [(t, f"w{k}", 1 + (k * 7919 + t) % 5 + 300 // (k + 1)) for t in (0, 1) for k in range(1500)] + [(None, "w1", 2), (None, "only", 1)]
    counts = spark.createDataFrame(rows, "topic int, term string, tf long")
    every = topics.class_tfidf(counts, None).collect()
    held.clear()
    want = [r for t in (0, 1, None) for r in sorted((r for r in every if r["topic"] == t), key=lambda r: (-r["weight"], r["term"]))[:5]]
    assert sorted(map(str, topics.class_tfidf(counts, 5).collect())) == sorted(map(str, want))
    assert held["terms-of-weight"].where("topic is not null").count() < 300


def test_term_counts_make_no_row_for_each_run(spark, monkeypatch):
    rng = random.Random(7)
    docs = [(rng.choice(["a", "b", None]), rng.choice([None, [], *([[rng.choice(["x", "yy", "zz z", "é", None][: 4 + (i % 9 == 0)]) for _ in range(rng.randint(1, 9))]] * 6)])) for i in range(120)]
    df = spark.createDataFrame(docs, "topic_id string, tokens array<string>")
    want = Counter()
    for topic, words in docs:
        for n in (1, 2, 3):
            for i in range(len(words or []) - n + 1):
                run = words[i : i + n]
                want[topic, None if None in run else " ".join(run)] += 1
    for limit in (topics.RUN_WORDS, 11, 1):
        monkeypatch.setattr(topics, "RUN_WORDS", limit)
        counts = topics.term_counts(df)
        rows = [((r["topic"], r["term"]), r["tf"]) for r in counts.collect()]
        assert dict(rows) == want and len(rows) == len(want)
        plan = counts._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan
    assert topics.term_counts(df.limit(0)).count() == 0
    assert {r["term"] for r in topics.term_counts(df, most=1).collect()} == {"x", "yy", "zz z", "é", None}
