"""Whole documents against a plain writer, and folders that are named by URIs."""

import hashlib
import json
from pathlib import Path
from xml.sax.saxutils import quoteattr

import pytest
from pyspark.sql import functions as F

from citeloom import queries as q
from citeloom.operators import networks
from citeloom.plans import config as cfg
from citeloom.plans import files, stages
from citeloom.sources import sinks

ODD = ['a "b"', "it's", "both \" and '", "<&>\n\t\r", "", None, "plain"]


@pytest.fixture(scope="module")
def graph(spark, small):
    edges = networks.graph_edges(networks.direct_citations(q.publications(spark, small)), directed=True)
    nodes = networks.graph_nodes(q.publications(spark, small), q.cited_works(spark, small))
    odd = F.get(F.array(*map(F.lit, ODD)), F.pmod(F.xxhash64("id"), F.lit(len(ODD))).cast("int"))
    return edges, nodes.withColumns({"odd <name>": odd, "label": odd})


def _attributes(row, names):
    return "<attvalues>" + "".join(f"<attvalue for={quoteattr(n)} value={quoteattr(row[n])}/>" for n in names if row[n] is not None) + "</attvalues>"


def test_gexf_is_that_of_a_plain_writer(spark, graph, tmp_path):
    edges, nodes = graph
    sinks.write_gexf(edges, nodes, f"file://{tmp_path}/g.gexf", directed=True)
    flat = sinks._flat(nodes).collect()
    names = [c for c in nodes.columns if c not in ("id", *sinks.HIDDEN)]
    declared = lambda kind, own: f'<attributes class="{kind}">' + "".join(f'<attribute id={quoteattr(n)} title={quoteattr(n)} type="string"/>' for n in own) + "</attributes>\n"
    text = '<?xml version="1.0" encoding="UTF-8"?>\n<gexf xmlns="http://gexf.net/1.3" version="1.3">\n<graph defaultedgetype="directed">\n' + declared("node", names) + declared("edge", ["year"]) + "<nodes>\n"
    for r in sorted(flat, key=lambda r: r["id"].encode()):
        text += f"<node id={quoteattr(r['id'])} label={quoteattr(r['label'] if r['label'] is not None else r['id'])}>{_attributes(r, names)}</node>\n"
    text += "</nodes>\n<edges>\n"
    for k, r in enumerate(sorted(sinks._flat(edges).collect(), key=lambda r: (r["source"].encode(), r["target"].encode()))):
        text += f"<edge id=\"{k}\" source={quoteattr(r['source'])} target={quoteattr(r['target'])} weight={quoteattr(r['weight'])}>{_attributes(r, ['year'])}</edge>\n"
    assert (tmp_path / "g.gexf").read_text(newline="") == text + "</edges>\n</graph>\n</gexf>\n"
    assert [p.name for p in tmp_path.iterdir()] == ["g.gexf"]  # no parts, no checksums


def test_json_and_records_are_those_of_a_plain_writer(spark, graph, small, tmp_path):
    edges, nodes = graph
    path = str(tmp_path / "g.json")
    for _ in range(2):  # the second takes the first one's place
        sinks.write_graph_json(edges, nodes, path)
    parts = [[r["value"] for r in sorted(df.collect(), key=lambda r: r["key"].encode())] for df in sinks.graph_json_rows(edges, nodes)]
    text = Path(path).read_text(newline="")
    assert text == '{"options":{"type":"undirected","multi":false,"allowSelfLoops":true},"nodes":[' + ",".join(parts[0]) + '],"edges":[' + ",".join(parts[1]) + "]}"
    assert len(json.loads(text)["edges"]) == edges.count()
    pubs, refs = q.publications(spark, small), q.cited_works(spark, small)
    sinks.write_citation_records(pubs, refs, str(tmp_path / "r.txt"))
    assert (tmp_path / "r.txt").read_text() == "\n\n".join(r["value"] for r in sinks.citation_records(pubs, refs).orderBy("ord").collect())


def test_documents_of_empty_tables(spark, graph, tmp_path):
    edges, nodes = (df.limit(0) for df in graph)
    sinks.write_graph_json(edges, nodes, str(tmp_path / "g.json"))
    assert json.loads((tmp_path / "g.json").read_text())["nodes"] == []
    sinks.write_gexf(edges, nodes, str(tmp_path / "g.gexf"))
    assert "<nodes>\n</nodes>\n<edges>\n</edges>" in (tmp_path / "g.gexf").read_text()


def test_a_document_that_fails_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "d.txt")
    files.write_text(spark, path, "old")
    with pytest.raises(Exception):
        files.write_document(spark, path, ["head", (spark.range(3).select("id", F.raise_error(F.lit("no")).alias("value")), ["id"], "\n", True)])
    assert files.read_text(spark, path) == "old" and [p.name for p in tmp_path.iterdir()] == ["d.txt"]


def test_manifest_digests(spark, small, tmp_path):
    refs = q.cited_works(spark, small)
    refs.repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    own = sorted((tmp_path / "t.parquet").glob("*.parquet"))
    entry = sinks.manifest_entry(spark, f"file://{tmp_path}/t.parquet")
    assert entry == {"path": "t.parquet", "bytes": sum(p.stat().st_size for p in own), "sha256": hashlib.sha256("".join(hashlib.sha256(p.read_bytes()).hexdigest() for p in own).encode()).hexdigest()}
    one = sinks.manifest_entry(spark, str(own[0]))
    assert one["sha256"] == hashlib.sha256(own[0].read_bytes()).hexdigest() and one["path"] == own[0].name


def test_a_run_in_a_folder_that_a_uri_names(spark, tmp_path):
    root = f"file://{tmp_path}/runs"
    c = cfg.with_overrides(cfg.Config(), {"run.name": "a b", "run.start_stage": "curate", "run.stop_stage": "citations", "citations.output_format": "all", "citations.metrics": ["direct"]})
    pubs = spark.createDataFrame([(1, "p1", 2000, ["A"], "t", ["r1"], 0)], "ord long, Bibcode string, Year int, Author array<string>, Title string, References array<string>, topic_id int")
    refs = spark.createDataFrame([(1, "r1", 1990, ["B"], "u")], "ord long, Bibcode string, Year int, Author array<string>, Title string")
    info = spark.createDataFrame([(0, 1, "x")], "Topic int, Count long, Name string")
    ctx = stages.run(spark, c, root, {"dataset": pubs, "dataset_refs": refs, "topic_info": info})
    assert ctx.folder.startswith(root) and not Path("file:").exists()
    held = Path(ctx.folder.removeprefix("file://"))
    assert {p.name for p in held.iterdir()} == {"data", "citations", "config.yaml", "run_summary.yaml"} and (held / "citations/direct/graph.gexf").exists()
    assert stages.plan_variant(ctx.folder, {"citations.output_format": "csv"}).reused == ("curated",)
