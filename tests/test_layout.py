"""Spectral layouts against the eigenvectors of the whole matrix, and against principal components."""

import numpy as np

from citeloom import queries as q
from citeloom.operators import layout
from citeloom.plans import config as cfg
from citeloom.plans import stages


def _ranks(x):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, -1)
    return np.argsort(np.argsort(d, 1, kind="stable"), 1, kind="stable")


def trustworthiness(x, y, k=10):
    """How far neighbours in y are from being neighbours in x; 1 where all are."""
    n, far, near = len(x), _ranks(x), _ranks(y)
    chosen = (near >= 1) & (near <= k)
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.where(chosen, np.maximum(far - k, 0), 0).sum()


def test_neighbours_on_a_rolled_sheet_are_kept_better_than_by_components(spark):
    rng = np.random.default_rng(1)
    t = np.sort(rng.uniform(1.5 * np.pi, 4 * np.pi, 300))
    x = np.stack([t * np.cos(t), t * np.sin(t), rng.uniform(0, 3, 300)], 1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, embedding array<double>")
    line = sorted((r["k"], r["reduced_1d"]) for r in layout.spectral_layout(df, "k", sizes=(3, 1), rounds=20).collect())
    flat = (x - x.mean(0)) @ np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:1].T
    assert trustworthiness(x, np.array([v for _, v in line])) > trustworthiness(x, flat) + 0.02


def test_query_keeps_neighbours(spark, small):
    """The table's vectors have no sheet to unroll: components are about as good there (0.704 and 0.697 of 1 in five dimensions)."""
    held = {r["Bibcode"]: r["embedding"] for r in q.vectors(spark, small).collect()}
    names = sorted(held)
    x = np.array([held[k] for k in names], float)
    rows = {r["Bibcode"]: r for r in q.queries()["spectral_layout"](spark, small).collect()}
    assert sorted(rows) == names
    y = np.array([rows[k]["reduced_5d"] for k in names], float)
    chance = trustworthiness(x, np.random.default_rng(0).normal(size=y.shape))
    assert trustworthiness(x, y) > max(0.68, chance + 0.1)
    assert np.allclose((y**2).mean(0), 1, atol=1e-3) and ((y**3).sum(0) >= -1e-6).all() and all(r["reduced_2d"] == r["reduced_5d"][:2] for r in rows.values())


def test_leading_vectors_of_the_whole_matrix(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.4, (40, 3)) for c in ((0, 0, 0), (2, 0, 0), (0, 2.5, 0), (2, 2, 2))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, embedding array<double>")
    got = {r["k"]: r["reduced_3d"] for r in layout.spectral_layout(df, "k", sizes=(3,), k=25, rounds=40).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, 1, kind="stable")
    scale = d[np.arange(len(x)), order[:, layout.SCALE - 1]]
    near = np.zeros_like(d, bool)
    near[np.arange(len(x))[:, None], order[:, :25]] = True
    w = np.where(near | near.T, np.exp(-np.where(np.isinf(d), 0, d) ** 2 / (scale[:, None] * scale)), 0)
    np.fill_diagonal(w, 0)
    root = np.sqrt(w.sum(1))
    value, vector = np.linalg.eigh(w / root[:, None] / root)
    want = vector[:, ::-1][:, 1:4] / root[:, None]
    y = np.array([got[i] for i in range(len(x))], float)
    for j in range(3):
        assert abs(np.corrcoef(want[:, j], y[:, j])[0, 1]) > 0.99


def test_rows_without_others_and_empty_tables(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0, float(i * i)]) for i in range(12)], "k int, embedding array<double>")
    assert layout.spectral_layout(df, "k", sizes=(2,), rounds=2).count() == 12


def test_a_second_run_reads_the_cache(spark, tmp_path):
    vectors = spark.createDataFrame([(f"b{i}", f"t{i}", [float(i % 5), float(i % 7), float(i)] * 2) for i in range(60)], "Bibcode string, text_sha256 string, embedding array<float>")
    c = cfg.with_overrides(cfg.Config(), {"topic.reduction": "spectral", "topic.reduction_cache": str(tmp_path / "kept"), "topic.reduction_params": {"rounds": 2}})
    rows = []
    for turn, table in enumerate((vectors, vectors, vectors.where("Bibcode != 'b3'"))):
        ctx = stages.Context(spark, c, str(tmp_path / f"run{turn}"), {"vectors": table})
        stages.reduce(ctx)
        assert ctx.notes["reduction_cached"] == (turn == 1)
        rows.append(sorted(map(str, ctx.tables["reduced"].collect())))
    assert rows[0] == rows[1] and len(rows[2]) == 59


def test_a_round_moves_coordinates_only_and_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.5, (180, 6)) for c in (0, 1, 3)] + [np.ones((60, 6))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k int, embedding array<float>")
    plans, write = [], layout.materialize

    def seen(rows, name, *rest):
        plans.append((name, rows._jdf.queryExecution().executedPlan().toString()))
        return write(rows, name, *rest)

    monkeypatch.setattr(layout, "materialize", seen)
    whole = {r["k"]: r["reduced_3d"] for r in layout.spectral_layout(df, "k", sizes=(3,), rounds=4).collect()}
    rounds = [p for name, p in plans if name == "layout"][-4:]
    assert [p.count("Exchange ") for p in rounds] == [1] * 4
    monkeypatch.setattr(layout, "BLOCK_ROWS", 50)
    cut = {r["k"]: r["reduced_3d"] for r in layout.spectral_layout(df, "k", sizes=(3,), rounds=4).collect()}
    assert sorted(whole) == sorted(cut) == list(range(600))
    assert np.allclose([whole[i] for i in range(600)], [cut[i] for i in range(600)], atol=1e-4)
    sizes = [r["count"] for r in layout._blocks(df.select(df["k"].cast("long").alias("id"), df["embedding"].alias("vector")), 0)[1].groupBy("block").count().collect()]
    assert len(sizes) > 8 and sum(sizes) == 600
