"""Sources, sinks, configuration, staged runs, variants and streams."""

import json
import threading
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from citeloom import cli
from citeloom.operators import networks, providers
from citeloom.plans import config as cfg
from citeloom.plans import stages, written
from citeloom.sources import corpus, rest, sinks
from citeloom.streaming import arrivals


def test_export_records(spark, tmp_path):
    fields = ["k1", "Doe, J and Roe, K", "A\ntitle", "2020", *[""] * 12]
    path = tmp_path / "export.txt"
    path.write_text("xOx".join(fields) + "xOx\n" + "shortxOxrecordxOx\n" + "xOx".join([" k2 ", "Doe, J et al.", "T\\nU", "x", *[""] * 12]) + "xOx\n")
    rows = corpus.parse_export(corpus.read_export(spark, str(path))).orderBy("Bibcode").collect()
    assert [(r["Bibcode"], r["Author"], r["Title"]) for r in rows] == [("k1", ["Doe, J", "Roe, K"], "A title"), ("k2", ["Doe, J"], "T U")]
    clean = corpus.clean_ingest(corpus.parse_export(corpus.read_export(spark, str(path)))).collect()
    assert [(r["Bibcode"], r["Year"], r["References"]) for r in clean] == [("k1", 2020, [])]


def test_own_tables(spark):
    pubs = spark.createDataFrame([(1, " p1", "2020", "A; B;A", "T\n x", None, ["r1", "r1", "gone"], 7, "V")], "ord int, Bibcode string, Year string, Author string, Title string, Abstract string, References array<string>, citation_count int, venue string")
    refs = spark.createDataFrame([(1, "r1", 1999, ["X"], "R")], "ord int, Bibcode string, Year int, Author array<string>, Title string")
    p, r = corpus.normalize_source(pubs, refs)
    row = p.first()
    assert (row["Bibcode"], row["Year"], row["Author"], row["Title"], row["Abstract"], row["References"], row["Citation Count"], row["Journal"], row["DOI"]) == ("p1", 2020, ["A", "B"], "T x", "", ["r1"], 7, "V", "")
    assert r.first()["author_uids"] == []
    with pytest.raises(ValueError, match="repeated"):
        corpus.normalize_source(pubs.union(pubs), refs)
    with pytest.raises(ValueError, match="Title"):
        corpus.normalize_source(pubs.drop("Title"), refs)


PAGES = {"*": ({"response": {"docs": [{"bibcode": "b1", "reference": ["r1"], "esources": ["PUB_HTML", "PUB_PDF"]}]}, "nextCursorMark": "c1"}), "c1": ({"response": {"docs": [{"bibcode": "b2"}]}, "nextCursorMark": "c1"})}


def transport(url, params):
    if "chunk" in params:
        return (400, {}, "") if params["chunk"] == 2 else (200, {}, json.dumps({"chunk": params["chunk"]}))
    return 200, {}, json.dumps(PAGES[params["cursorMark"]])


def test_literature_source(spark):
    spark.dataSource.register(rest.LiteratureSource)
    source = lambda **o: spark.read.format("literature").option("url", "u").option("transport", "tests.test_sources_and_runs:transport").options(**o).load()
    rows = corpus.search_rows(source()).orderBy("Bibcode").collect()
    assert [(r["Bibcode"], r["References"], r["PDF_URL"]) for r in rows] == [("b1", ["r1"], "b1/PUB_PDF"), ("b2", [], None)]
    parts = source(mode="parts", parts=json.dumps([{"chunk": k} for k in (1, 2, 3)])).collect()
    assert sum(r["error"] is None for r in parts) == 2 and sum("400" in (r["error"] or "") for r in parts) == 1
    linked = corpus.search_rows(source(), link="https://example.org/{resource}?of={bibcode}").where("Bibcode = 'b1'").first()
    assert linked["PDF_URL"] == "https://example.org/PUB_PDF?of=b1"


RECORD_FIELDS = {"Title": 2, "Year": 3, "Abstract": 10}
CALLS = []


def service(url, params):
    """A search of two pages, and an export that fails for one chunk."""
    if "cursorMark" in params:
        docs = {"*": [{"bibcode": "p1", "reference": ["r1", "r2"], "esources": ["ADS_PDF"]}, {"bibcode": "p2", "reference": ["r2", "r3"]}], "c1": [{"bibcode": "p3", "reference": ["r4"]}]}
        return 200, {}, json.dumps({"response": {"docs": docs[params["cursorMark"]]}, "nextCursorMark": "c1"})
    if "r4" in params["bibcode"]:
        return 400, {}, ""
    assert params["format"] == "form" and params["sort"] == "score desc"
    rows = []
    for key in params["bibcode"]:
        if key == "p3":
            continue  # the service does not know it
        fields = [key, "Doe, J and Roe-Poe, K", f"Title &amp; of <i>{key}</i>", "2001" if key != "r3" else "no year", "J", "J", "1-2", "3", "10-12", "19", f"Abstract of {key} on dark matter and stars", "k", "", "", "", "5"]
        rows.append("xOx".join(fields) + "xOx\n")
    return 200, {}, json.dumps({"export": "".join(rows)})


def test_search_is_exported_and_resolved_into_a_dataset(spark, tmp_path):
    """Search, export of what was found and of what it cites, resolution, cleaning, and all stages after."""
    spark.dataSource.register(rest.LiteratureSource)
    c = cfg.with_overrides(cfg.Config(), {
        "search.url": "u", "search.query": "q", "search.transport": "tests.test_sources_and_runs:service", "search.link": "https://example.org/{bibcode}/{resource}", "search.cache": str(tmp_path / "found"),
        "export.url": "e", "export.format": "form", "export.chunk": 3, "export.transport": "tests.test_sources_and_runs:service", "export.cache": str(tmp_path / "exported"),
        "topic.clusters": 2, "topic.dimensions": 8, "topic.layers": 2, "authors.cache": str(tmp_path / "authors"), "topic.embedding_cache": str(tmp_path / "vectors")})
    assert stages.doctor(c) == []
    events = []
    ctx = stages.run(spark, c, str(tmp_path / "runs"), progress=lambda stage, event: events.append((stage, event)))
    assert events[:3] == [("search", "begins"), ("search", "ends"), ("export", "begins")] and events[-1] == ("citations", "ends")
    pubs = {r["Bibcode"]: r for r in ctx.tables["pubs"].collect()}
    assert set(pubs) == {"p1", "p2"} and pubs["p1"]["References"] == ["r1", "r2"] and pubs["p1"]["PDF_URL"] == "https://example.org/p1/ADS_PDF" and pubs["p2"]["PDF_URL"] is None
    assert (pubs["p1"]["Title"], pubs["p1"]["Year"], pubs["p1"]["Author"], pubs["p1"]["Issue"], pubs["p1"]["First Page"]) == ("Title & of p1", 2001, ["Doe, J", "RoePoe, K"], "1", "10")
    assert {r["Bibcode"]: r["ord"] for r in ctx.tables["refs"].collect()} == {"r1": 0, "r2": 1}  # r3 has no year, r4's chunk failed
    notes = ctx.notes["export"]
    assert (notes["pubs"]["expected"], notes["pubs"]["parsed"], notes["pubs"]["missing"]) == (3, 2, 1) and notes["pubs"]["failed"] == []
    assert notes["refs"]["expected"] == 4 and len(notes["refs"]["failed"]) == 1 and "400" in notes["refs"]["failed"][0]
    assert ctx.notes["search"] == {"publications": 3, "total_references": 5, "unique_references": 4}
    dataset = {r["Bibcode"]: r for r in ctx.tables["dataset"].collect()}
    assert dataset["p2"]["References"] == ["r2"] and "topic_layer_1_label" in ctx.tables["dataset"].columns and ctx.tables["dataset"].columns[:2] == ["Bibcode", "Year"]
    assert ctx.notes["links"]["raw_links"] == 4 and ctx.notes["links"]["retained_links"] == 3
    assert {"missing_reference"} == {e["kind"] for e in ctx.notes["cleaning_examples"]}
    assert corpus.load_curated(spark, ctx.folder)[0].count() == 2
    # a second run reads the search, what was exported whole, identities and vectors from their caches
    broken = cfg.with_overrides(c, {"search.url": "", "authors.provider": "blocking"})
    assert corpus.load_snapshot(spark, str(tmp_path / "authors"), {}) is None
    again = stages.run(spark, broken, str(tmp_path / "runs2"))
    for table in ("pubs", "refs", "dataset", "vectors"):
        order = sorted(ctx.tables[table].columns)
        assert sorted(map(str, again.tables[table].select(order).collect())) == sorted(map(str, ctx.tables[table].select(order).collect())), table


MANY = {f"c{k}": {"response": {"docs": [{"bibcode": f"b{k}-{i}"} for i in range(3)]}, "nextCursorMark": f"c{k + 1}"} for k in range(1, 7)}
MANY["*"] = {"response": {"docs": [{"bibcode": "b0-0"}]}, "nextCursorMark": "c1"}


def breaking(url, params):
    """A search of seven pages that says what it was asked, and whose fifth page fails while a file is there."""
    folder = Path(params["q"])
    with open(folder / "asked", "a") as asked:
        asked.write(params["cursorMark"] + " ")
    if params["cursorMark"] == "c4" and (folder / "broken").exists():
        return 400, {}, ""
    page = MANY.get(params["cursorMark"], {"response": {"docs": []}})
    return 200, {}, json.dumps(page)


def test_a_search_that_breaks_off_fails_and_goes_on_at_its_cursor(spark, tmp_path):
    spark.dataSource.register(rest.LiteratureSource)
    (tmp_path / "broken").touch()
    c = cfg.with_overrides(cfg.Config(), {"search.url": "u", "search.query": str(tmp_path), "search.transport": "tests.test_sources_and_runs:breaking", "search.cache": str(tmp_path / "found"), "run.stop_stage": "search"})
    with pytest.raises(rest.RequestFailed, match="not whole"):
        stages.run(spark, c, str(tmp_path / "runs"))
    assert not (tmp_path / "found" / "search_results_latest").exists()  # nothing that a later run would take for the search
    (tmp_path / "broken").unlink()
    ctx = stages.run(spark, c, str(tmp_path / "runs"))
    rows = ctx.tables["found"].orderBy("ord").collect()
    assert [r["Bibcode"] for r in rows] == ["b0-0", *(f"b{k}-{i}" for k in range(1, 7) for i in range(3))]
    assert [p.name for p in (tmp_path / "found").iterdir() if "unfinished" in p.name] == []


def test_a_scan_asks_no_page_twice(spark, tmp_path):
    spark.dataSource.register(rest.LiteratureSource)
    (tmp_path / "broken").touch()
    again = lambda: rest.scan(spark, "u", {"q": str(tmp_path), "sort": "x"}, str(tmp_path / "kept"), transport="tests.test_sources_and_runs:breaking", pages="2")
    with pytest.raises(rest.RequestFailed):
        again()
    (tmp_path / "broken").unlink()
    before = (tmp_path / "asked").read_text().split()
    assert before[:4] == ["*", "c1", "c2", "c3"] and set(before[4:]) == {"c4"}
    pages = again().orderBy("part").collect()
    asked = (tmp_path / "asked").read_text().split()[len(before):]
    assert asked == ["c4", "c5", "c6", "c7"] and [json.loads(r["value"])["nextCursorMark"] for r in pages] == [f"c{k}" for k in range(1, 8)]
    assert again().count() == 7 and len((tmp_path / "asked").read_text().split()) == len(before) + 4


def tokens(url, params):
    """A service with page tokens and records of its own."""
    page = {None: (["a", "b"], "t1"), "t1": (["c"], None)}[params.get("token")]
    return 200, {}, json.dumps({"data": page[0], "token": page[1]})


def test_page_tokens(spark, tmp_path):
    spark.dataSource.register(rest.LiteratureSource)
    rows = rest.scan(spark, "u", {}, str(tmp_path), transport="tests.test_sources_and_runs:tokens", cursorparam="token", cursorfirst=" ", cursorkey="token", recordspath="data")
    assert [json.loads(r["value"])["data"] for r in rows.orderBy("part").collect()] == [["a", "b"], ["c"]]


def test_only_texts_in_other_languages_are_sent(spark, tmp_path):
    """A run learns its languages from a table; without one it says so before it starts."""
    english, german = "the stars and the dark matter of the galaxies are in the halo", "die Sterne und die dunkle Materie der Galaxien sind in dem Halo"
    spark.createDataFrame([(english, "en"), (german, "de")] * 3, "text string, lang string").write.parquet(str(tmp_path / "labelled"))
    pubs = spark.createDataFrame([(1, "p1", 2000, ["A"], english[:29], "", []), (2, "p2", 2000, ["A"], german[:29], "", [])], "ord int, Bibcode string, Year int, Author array<string>, Title string, Abstract string, References array<string>")
    refs = spark.createDataFrame([(1, "r1", 1999, ["X"], "the halo of the stars")], "ord int, Bibcode string, Year int, Author array<string>, Title string")
    for name, df in (("pubs", pubs), ("refs", refs)):
        df.write.parquet(str(tmp_path / name))
    c = cfg.with_overrides(cfg.Config(), {"source.publications": str(tmp_path / "pubs"), "source.references": str(tmp_path / "refs"), "translate.provider": "shout", "run.stop_stage": "translate"})
    registry = providers.Registry()
    registry.add("translate", "shout", lambda texts, languages: [t.upper() for t in texts])
    assert any("translate.profiles" in line for line in stages.doctor(c, registry))
    with pytest.raises(ValueError, match="translate.profiles"):
        stages.run(spark, c, str(tmp_path / "runs"), registry=registry)
    c = cfg.with_overrides(c, {"translate.profiles": str(tmp_path / "labelled")})
    assert stages.doctor(c, registry) == []
    ctx = stages.run(spark, c, str(tmp_path / "runs"), registry=registry)
    got = {r["Bibcode"]: (r["Title_lang"], r["Title_en"]) for r in ctx.tables["pubs_translated"].collect()}
    assert got == {"p1": ("en", english[:29]), "p2": ("de", german[:29].upper())}


def test_scratch_folders_belong_to_a_thread(spark):
    opened, wrote = threading.Event(), threading.Event()
    held = {}

    def other():
        opened.wait(60)
        held["table"] = written.materialize(spark.range(5), "other")
        wrote.set()

    thread = threading.Thread(target=other)
    thread.start()
    with written.scratch(spark):
        own = written.materialize(spark.range(3), "own")
        with written.scratch(spark):
            written.materialize(spark.range(3), "inner")
        opened.set()
        wrote.wait(60)
        assert own.count() == 3
    thread.join()
    assert held["table"].count() == 5 and "scratch" not in held["table"].inputFiles()[0]


def test_export_in_chunks(spark):
    keys = spark.createDataFrame([(7 - k, f"x{k}") for k in range(7)], "ord int, Bibcode string")
    out = rest.export_keys(keys, "e", "form", "tests.test_sources_and_runs:service", chunk=3).orderBy("chunk").collect()
    assert [(r["chunk"], r["n"], r["error"]) for r in out] == [(0, 3, None), (1, 3, None), (2, 1, None)]
    assert [v["value"] for v in corpus.export_records(spark.createDataFrame([(out[2]["value"],), (None,)], "value string")).collect()][0].startswith("x0xOx")


def test_json_lines_and_providers(spark, tmp_path):
    df = spark.createDataFrame([("p1", None, ["a"]), ("p2", 3, [])], "Bibcode string, n int, l array<string>")
    sinks.write_json_lines(df, str(tmp_path / "lines"))
    assert sorted(map(tuple, corpus.read_json_lines(spark, str(tmp_path / "lines"), "Bibcode string, n int, l array<string>").collect())) == [("p1", None, ["a"]), ("p2", 3, [])]
    import citeloom

    assert citeloom.run is stages.run and citeloom.Config is cfg.Config
    with pytest.raises(AttributeError):
        citeloom.nothing  # noqa: B018
    for bad in ({"topic.labeler": "x"}, {"authors.provider": "x"}, {"topic.reduction": "umap"}, {"source.publications": "/no/such", "source.references": "/no/such"}, {"search.url": "u", "search.query": "q"}):
        assert stages.doctor(cfg.with_overrides(cfg.Config(), bad))
    with pytest.raises(ValueError, match="positive"):
        cfg.with_overrides(cfg.Config(), {"export.chunk": 0})
    assert cli.main(["bootstrap", str(tmp_path / "work"), "--preset", "hierarchy"]) == 0
    assert cfg.load(path=str(tmp_path / "work" / "config.yaml")).topic.layers == 3
    assert cli.main(["preset", "flat", "--write", str(tmp_path / "flat.yaml")]) == 0 and cfg.load(path=str(tmp_path / "flat.yaml")).topic.clusters == 20


def test_retries():
    answers, waits = [(429, {"Retry-After": "7"}, ""), (503, {}, ""), (200, {}, "ok")], []
    assert rest.request(lambda u, p: answers.pop(0), "u", {}, sleep=waits.append) == "ok" and waits == [7.0, 2.0]
    with pytest.raises(rest.RequestFailed, match="400"):
        rest.request(lambda u, p: (400, {}, ""), "u", {}, sleep=waits.append)
    with pytest.raises(rest.RequestFailed, match="3 attempts"):
        rest.request(lambda u, p: (500, {}, ""), "u", {}, attempts=3, sleep=lambda s: None)
    assert rest.retryable(None) and rest.retryable(529) and not rest.retryable(404)


def test_records_and_quota(spark):
    record = {"id": "9", "title": " A  b ", "date": "1999-01-01", "pages": "3-9", "authors": [{"id": "1", "name": "X"}, {"name": ""}], "references": [{"id": "5"}, {"id": None}, {"id": "5"}]}
    row = corpus.parse_records(spark.createDataFrame([(json.dumps(record),), ("{}",)], "value string"), "s2").first()
    assert (row["Bibcode"], row["Year"], row["Title"], row["Author"], row["author_uids"], row["References"], row["First Page"], row["Last Page"]) == ("s2:9", 1999, "A b", ["X"], ["s2:author:1"], ["s2:5"], "3", "9")


@pytest.fixture(scope="module")
def network(spark):
    pubs = spark.createDataFrame([(1, "p1", 2020, ["Doe, J", "Roe, K"], ["r1", "r2", "zz"], "T & <x>", "10", "19"), (2, "p2", 2021, ["Poe"], ["r1", "r2"], None, "", "")], "ord int, Bibcode string, Year int, Author array<string>, References array<string>, Title string, `First Page` string, `Last Page` string")
    refs = spark.createDataFrame([(1, "r1", 1990, ["Ann B. Lee"], "J. Phys.", "3", "7"), (2, "r2", 1991, [], None, None, None), (3, "r1", 1, ["Z"], "", "", "")], "ord int, Bibcode string, Year int, Author array<string>, Journal string, Volume string, `First Page` string")
    edges = networks.graph_edges(networks.co_citations(pubs, 2))
    return pubs, refs, edges, networks.nodes_in_edges(networks.graph_nodes(pubs, refs), edges)


def test_graph_files(network, tmp_path):
    pubs, refs, edges, nodes = network
    sinks.write_gexf(edges, nodes, str(tmp_path / "g.gexf"))
    root = ET.parse(tmp_path / "g.gexf").getroot()
    ns = {"g": "http://gexf.net/1.3"}
    assert [n.get("id") for n in root.findall(".//g:node", ns)] == ["r1", "r2"] and root.find(".//g:edge", ns).get("weight") == "2"
    sinks.write_graph_json(edges, nodes, str(tmp_path / "g.json"), directed=True)
    graph = json.loads((tmp_path / "g.json").read_text())
    assert graph["options"]["type"] == "directed" and [n["key"] for n in graph["nodes"]] == ["r1", "r2"] and graph["edges"][0]["attributes"]["weight"] == 2
    sinks.write_network_csv(edges, nodes, str(tmp_path / "csv"), networks.co_citations(pubs))
    assert {p.name for p in (tmp_path / "csv").iterdir()} == {"edges.csv", "nodes.csv", "evidence.csv"}


def test_citation_records(network, tmp_path):
    pubs, refs, _, _ = network
    sinks.write_citation_records(pubs, refs, str(tmp_path / "r.txt"))
    text = (tmp_path / "r.txt").read_text()
    assert "CR Lee, 1990, J Phys, V3, P7\n   , 1991, Unknown\nPY 2020" in text and "AU Doe, J\n   Roe, K\n" in text and "PG 10\nER\n\nPT J" in text and text.endswith("\nER")
    assert text.count("PT J") == 2 and text.count("PG ") == 1 and "TI T & <x>\nSO \nDT \n" in text
    wide = pubs.withColumns({"Title_en": F.when(F.col("ord") == 2, F.lit("English\n title")).otherwise(F.lit(" ")), "Abstract_en": F.lit(None).cast("string"), "Abstract": F.lit("Of  words"), "Keywords": F.array(F.lit("a"), F.lit("b")), "Category": F.lit("article"), "Citation Count": F.col("ord") - 1})
    first, second = (r["value"] for r in sinks.citation_records(wide, refs).orderBy("ord").collect())
    assert "TI T & <x>\nSO \nDT article\nDE a; b\nAB Of words\n" in first and "TI English title\n" in second and "TC 1" in second and "TC" not in first


def test_bundle_and_snapshots(spark, network, tmp_path):
    pubs, refs, _, _ = network
    manifest = sinks.write_bundle(str(tmp_path / "b"), pubs, refs)
    assert manifest == json.loads((tmp_path / "b" / "manifest.json").read_text()) and manifest["artifacts"]["publications"]["bytes"] > 0
    assert not sinks.write_once(refs, str(tmp_path / "b" / "references.parquet")) and sinks.write_once(refs, str(tmp_path / "b" / "more.parquet"))
    corpus.save_snapshot(refs, str(tmp_path / "s"), {"a": 1})
    assert corpus.load_snapshot(spark, str(tmp_path / "s"), {"a": 1}).count() == 3
    assert corpus.load_snapshot(spark, str(tmp_path / "s"), {"a": 2}) is None and corpus.load_snapshot(spark, str(tmp_path / "none"), {}) is None


def test_configuration():
    c = cfg.load("flat", overrides=["topic.clusters=5", "citations.metrics=[direct]"])
    assert c.topic.clusters == 5 and c.citations.metrics == ("direct",)
    for bad in ("topic.unknown=1", "nothing", "x.y=1"):
        with pytest.raises(ValueError):
            cfg.load(overrides=[bad])
    with pytest.raises(ValueError, match="unknown section"):
        cfg.from_dict({"oops": {}})
    assert cfg.redact({"token": "abc", "note": "Bearer xyz", "n": [1]}) == {"token": "***", "note": "***", "n": [1]}
    assert cfg.fill_title("{n} {other}", {"n": 3}) == "3 {other}"
    assert stages.first_stale(["citations.metrics", "topic.clusters"]) == "topic_fit" and stages.first_stale(["run.name"]) is None
    with pytest.raises(ValueError):
        stages.stage_slice("citations", "search")


def test_run_and_variant(spark, tmp_path):
    n = 40
    pubs = spark.createDataFrame([(i, f"p{i}", 2000 + i % 5, [f"Author{i % 7}, A"], f"title {'dark matter' if i % 2 else 'star formation'}", f"abstract number {i}", [f"r{i % 4}", f"r{(i + 1) % 4}"]) for i in range(n)], "ord long, Bibcode string, Year int, Author array<string>, Title string, Abstract string, References array<string>")
    refs = spark.createDataFrame([(i, f"r{i}", 1990, [f"Cited{i}, B"], f"cited {i}") for i in range(4)], "ord long, Bibcode string, Year int, Author array<string>, Title string")
    pubs.write.parquet(str(tmp_path / "pubs"))
    refs.write.parquet(str(tmp_path / "refs"))
    c = cfg.with_overrides(cfg.Config(), {"source.publications": str(tmp_path / "pubs"), "source.references": str(tmp_path / "refs"), "topic.clusters": 3, "topic.dimensions": 16, "citations.output_format": "all", "search.token": "secret"})
    ctx = stages.run(spark, c, str(tmp_path / "runs"))
    assert ctx.notes["networks"] == ["author_co_citation", "bibliographic_coupling", "co_citation", "direct"]
    assert ctx.tables["curated"].count() == n and "secret" not in Path(ctx.folder, "config.yaml").read_text()
    assert "completed" in Path(ctx.folder, "run_summary.yaml").read_text() and Path(ctx.folder, "citations/direct/graph.gexf").exists()
    variant = stages.plan_variant(ctx.folder, {"citations.min_counts": {"co_citation": 30}, "citations.metrics": ["co_citation", "direct"]})
    assert variant.start == "citations" and variant.reused == ("curated", "dataset_refs")
    assert stages.run_variant(spark, variant, str(tmp_path / "runs2")).notes["networks"] == ["direct"]
    assert stages.plan_variant(ctx.folder, {"curation.clusters_to_remove": [0]}).start == "topic_fit"
    assert cli.main(["variant", ctx.folder, "--set", "citations.output_format=csv", "--dry-run"]) == 0
    assert cli.main(["doctor"]) == 1 and cli.main(["preset"]) == 0
    lacking = stages.Context(spark, c, ctx.folder)
    assert stages.run_stage(lacking, "tokenize") == ["export", "translate", "tokenize"]
    assert stages.invalidate(lacking, cfg.with_overrides(c, {"tokenize.min_length": 4})) == "tokenize" and "pubs_tokens" not in lacking.tables and "pubs" in lacking.tables


def test_session(spark, tmp_path):
    from citeloom.plans.session import Session

    pubs = spark.createDataFrame([(1, "p1", 2000, ["A"], "t", "a", ["r1"])], "ord long, Bibcode string, Year int, Author array<string>, Title string, Abstract string, References array<string>")
    pubs.write.parquet(str(tmp_path / "pubs"))
    pubs.select("ord", F.lit("r1").alias("Bibcode"), "Year", "Author", "Title").write.parquet(str(tmp_path / "refs"))
    session = Session(spark, str(tmp_path / "runs"))
    with pytest.raises(ValueError, match="export"):
        session.run_stage("translate")
    assert session.set_section("source", publications=str(tmp_path / "pubs"), references=str(tmp_path / "refs")) == "export"
    session.run_stage("export")
    session.run_stage("translate")
    assert session.table("pubs_translated").first()["Title_en"] == "t"
    assert session.set_section("translate", target="de") == "translate" and "pubs_translated" not in session.ctx.tables
    with pytest.raises(ValueError):
        session.set_section("nothing", x=1)
    assert session.save_summary()["stages"] == ["export", "translate"]


def test_streams(spark, small, tmp_path):
    pubs = spark.createDataFrame([(1, "p1", 2020, ["r1", "r2"]), (2, "p2", 2019, ["r1", None])], "ord int, Bibcode string, Year int, References array<string>")
    for k in (1, 2):
        pubs.where(F.col("ord") == k).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = arrivals.read_publications(spark, str(tmp_path / "in/*"), pubs.schema, 1)
    q = arrivals.citation_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(tuple(r) for r in spark.table("counts").collect()) == [("r1", 2, 2019), ("r2", 1, 2020)]
    q = arrivals.append_edges(stream, str(tmp_path / "out"), str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    refs = spark.createDataFrame([("r1",)], "Bibcode string")
    assert sorted(r["References"] for r in arrivals.known_only(refs)(pubs, 0).collect()) == [["r1"], ["r1"]]
