"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import os

import duckdb
import pytest

from citeloom import queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{small}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(r[k] for k in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_same_as_sql(spark, duck, small, name):
    df, rel = q.queries()[name](spark, small), duck.sql(q.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_runs(spark, small, name):
    assert q.queries()[name](spark, small).count() > 0


def test_language_id_is_accurate(spark, small):
    docs = q.table(spark, small, "documents").select("doc_id", "lang")
    rows = q.queries()["language_id"](spark, small).join(docs, "doc_id").where("text_lang is not null").collect()
    assert sum(r["lang"] == r["text_lang"] for r in rows) / len(rows) > 0.9


def test_components_are_those_of_numpy(spark, small):
    import numpy as np

    rows = {r["Bibcode"]: r for r in q.queries()["pca_reduction"](spark, small).collect()}
    held = q.vectors(spark, small).orderBy("Bibcode").collect()
    x = np.array([r["embedding"] for r in held], float)
    _, axes = np.linalg.eigh(np.cov(x.T))
    for k in range(5):
        axis = axes[:, -1 - k] * np.sign(axes[np.abs(axes[:, -1 - k]).argmax(), -1 - k])
        assert np.allclose([rows[r["Bibcode"]]["reduced_5d"][k] for r in held], x @ axis, atol=1e-3)
    assert all(r["reduced_2d"] == r["reduced_5d"][:2] for r in rows.values())


def test_clusters_have_their_nearest_centres_and_far_rows_are_noise(spark, small):
    rows = {r["Bibcode"]: r["topic_id"] for r in q.queries()["cluster_documents"](spark, small).collect()}
    assert len(rows) == q.vectors(spark, small).count() and set(rows.values()) == {-1, *range(10)}
    assert 0.02 < sum(t == -1 for t in rows.values()) / len(rows) < 0.08
    again = {r["Bibcode"]: r["topic_id"] for r in q.queries()["cluster_documents"](spark, small).collect()}
    assert rows == again


def _without_repeats(chunks, words=24):
    """Chunks joined word by word, each from the first place where what is left does not end what is there."""
    out = []
    for chunk in chunks:
        own = chunk.split()
        start = max(n for n in range(min(words, len(own), len(out)) + 1) if [w.casefold() for w in out[len(out) - n :]] == [w.casefold() for w in own[:n]])
        out += own[start:]
    return " ".join(out)


def test_overlapping_chunks_are_merged(spark, small):
    texts = {r["doc_id"]: r["text"] or "" for r in q.table(spark, small, "documents").collect()}
    rows = q.queries()["overlapping_chunks_merged"](spark, small).collect()
    assert len(rows) == len(texts) and any(r["chunks"] > 2 for r in rows)
    for r in rows:
        text, at, chunks = texts[r["doc_id"]], 0, []
        while at < len(text):  # the rule of the cuts: after the last paragraph, sentence or blank of the second half
            end = at + 500
            if end < len(text):
                cuts = [(text.rfind(sign, at + 250, end), len(sign)) for sign in ("\n\n", ". ", " ")]
                end = next((c + n for c, n in cuts if c > 0), end)
            chunks.append(text[at:end])
            if end >= len(text):
                break
            at = max(end - 120, at + 1)
        assert r["chunks"] == len(chunks) and r["merged"] == _without_repeats(chunks)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())


def test_nothing_else_imports_the_training_data_package():
    root = os.path.dirname(os.path.abspath(q.__file__))
    for folder, _, names in os.walk(root):
        if "llm" in folder.split(os.sep):
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n)) as text:
                    assert "citeloom.llm" not in text.read(), n


def test_chunks_are_made_and_merged_a_few_rows_at_a_time():
    import pyarrow as pa

    from citeloom.functions import text as ft

    class Values:
        """An array that notes how many of its values become Python objects at a time."""

        def __init__(self, held, seen):
            self.held, self.seen = held, seen

        def __len__(self):
            return len(self.held)

        def slice(self, *place):
            return Values(self.held.slice(*place), self.seen)

        def to_pylist(self):
            self.seen.append(len(self.held))
            return self.held.to_pylist()

    texts = [None if k % 50 == 7 else f"Words of text {k}. " * (k % 40) for k in range(300)]
    seen = []
    cut = ft._sliced(Values(pa.array(texts), seen), lambda t: ft.chunk_text(t or "", 100, 20), pa.list_(pa.string()))
    assert cut.to_pylist() == [ft.chunk_text(t or "", 100, 20) for t in texts] and max(seen) == ft.SLICE and sum(seen) == 300
    assert len(ft._sliced(pa.array([], pa.string()), len, pa.int64())) == 0
