"""Neighbours, density clusters and merge trees against versions with all distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom import queries as q
from citeloom.operators import density, topics
from tests.exact_density import density_cluster


def _planted(noise):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(7, 5)) * 6
    groups = [c + rng.normal(size=(n, 5)) * s for c, n, s in zip(centres, (500, 300, 300, 250, 250, 200, 200), (1, 0.6, 0.8, 0.5, 1, 0.7, 0.4))]
    return np.concatenate([*groups, rng.uniform(-14, 14, (noise, 5))])


def _frame(spark, x):
    return spark.createDataFrame([(f"k{i:05d}", v.tolist()) for i, v in enumerate(x)], "Bibcode string, v array<double>").repartition(5)


def _labels(df, **kw):
    return [t for _, t in sorted((r["Bibcode"], r["topic_id"]) for r in density.cluster_density(df, "Bibcode", "v", **kw).collect())]


def _agreement(got, want):
    pairs, counts = np.unique(np.array([got, want]), axis=1, return_counts=True)
    return sum(counts[pairs[1] == w].max() for w in set(want)) / len(want)


def test_clusters_are_those_of_all_distances(spark, monkeypatch):
    x = _planted(0)
    want = density_cluster(x, 30, 5)
    whole = _labels(_frame(spark, x), min_cluster_size=30, min_samples=5)
    assert len(set(whole) - {-1}) == len(set(want) - {-1}) and _agreement(whole, want.tolist()) >= 0.99
    monkeypatch.setattr(density, "PART_EDGES", 3000)  # merged in ranges of weight, part by part
    assert _labels(_frame(spark, x[::-1])[["Bibcode", "v"]], min_cluster_size=30, min_samples=5) != whole  # other keys, other numbers
    assert _labels(_frame(spark, x), min_cluster_size=30, min_samples=5) == whole


def test_noise_copies_and_missing_vectors(spark):
    x = np.concatenate([_planted(100)[::4], np.zeros((700, 5)) + 30])  # a point with more copies than a bucket holds
    df = _frame(spark, x).unionByName(spark.createDataFrame([("none", None)], "Bibcode string, v array<double>"))
    got = {r["Bibcode"]: r["topic_id"] for r in density.cluster_density(df, "Bibcode", "v", 20, 3).collect()}
    assert len(got) == len(x) + 1 and got["none"] == -1
    copies = {got[f"k{i:05d}"] for i in range(len(x) - 700, len(x))}
    assert len(copies) == 1 and copies != {-1} and sum(t in copies for t in got.values()) == 700
    few = density.cluster_density(df.limit(10), "Bibcode", "v", 20).collect()
    assert len(few) == 10 and {r["topic_id"] for r in few} == {-1}
    assert density.cluster_density(df.limit(0), "Bibcode", "v", 20).count() == 0


def test_condensed_tree_of_ranges_is_that_of_one_pass(spark, monkeypatch):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, 200, 700), rng.integers(0, 200, 700), rng.integers(1, 40, 700)) if a < b]
    df, nodes = spark.createDataFrame(edges, "u long, v long, w double").groupBy("u", "v").agg(F.min("w").alias("w")), spark.range(200)

    def shape():
        members, clusters = density.condensed(nodes, df, 5)
        groups = {}
        for r in members.collect():
            groups.setdefault(r["cluster"], set()).add(r["id"])
        names = {r["cluster"]: r for r in clusters.collect()}
        return sorted((sorted(groups.get(c, ())), sorted(groups.get(r["parent"], ())), r["chosen"], r["birth"]) for c, r in names.items())

    whole = shape()
    monkeypatch.setattr(density, "PART_EDGES", 120)
    assert shape() == whole and len(whole) > 1


def test_close_clusters_stay_one_below_epsilon(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.05, (60, 2)) for c in ((0, 0), (1, 0), (9, 9), (9, 20))])
    assert len(set(_labels(_frame(spark, x), min_cluster_size=15)) - {-1}) == 4
    assert len(set(_labels(_frame(spark, x), min_cluster_size=15, epsilon=2.0)) - {-1}) == 3


def test_neighbours_are_found(spark, small):
    rows = q.queries()["nearest_neighbours"](spark, small).collect()
    held = q.table(spark, small, "embeddings").orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in held], float), [r["vec_id"] for r in held]
    d = density._distances(x, x)
    np.fill_diagonal(d, np.inf)
    true = {(ids[i], ids[j]) for i in range(len(x)) for j in np.argsort(d[i], kind="stable")[:10]}
    assert len(rows) == 10 * len(x) and len(true & {(r["u"], r["v"]) for r in rows}) / len(true) >= 0.9
    place = {name: i for i, name in enumerate(ids)}
    assert all(r["d"] == pytest.approx(d[place[r["u"]], place[r["v"]]]) for r in rows)


def test_buckets_of_one_cell_are_even(spark):
    """Very many equal rows are cut into buckets as others are."""
    points = spark.range(5000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("vector"))
    graph = density.neighbours(points, 3, trees=1, rounds=0)
    assert graph.groupBy("u").count().where("count != 3").count() == 0 and graph.where("d != 0").count() == 0


def brute_layers(means, targets):
    nodes, at = {c: (np.array(v), n) for c, v, n in means}, {c: c for c, _, _ in means}
    yield dict(at)
    for target in targets:
        while len(nodes) > target:
            names = sorted(nodes)
            near = {}
            for a in names:
                near[a] = min((float(np.sqrt(((nodes[a][0] - nodes[b][0]) ** 2).sum())), b) for b in names if b != a)
            pairs = sorted((d, a, b) for a, (d, b) in near.items() if a < b and near[b][1] == a)[: len(nodes) - target]
            for _, a, b in pairs:
                (x, n), (y, m) = nodes.pop(a), nodes.pop(b)
                nodes[a] = ((x * n + y * m) / (n + m), n + m)
                at = {top: a if node == b else node for top, node in at.items()}
        yield dict(at)


def test_layers_are_those_of_merged_centroids(spark, small):
    means = [(r["cluster"], r["centroid"], r["n"]) for r in topics.centroids(q.fine_clusters(spark, small)).collect()]
    got = {}
    for r in q.queries()["layer_tree"](spark, small).collect():
        got.setdefault(r["layer"], []).append((r["cluster_id"], r["top"]))
    assert [len(got[k]) for k in sorted(got)] == [70, 24, 8, 3]
    for layer, at in enumerate(brute_layers(means, [24, 8, 3])):
        groups = {}
        for top, node in at.items():
            groups.setdefault(node, []).append(top)
        assert sorted(got[layer]) == [(k, sorted(groups[node])) for k, node in enumerate(sorted(groups))]


def test_density_query_against_all_distances(spark, small):
    rows = {r["Bibcode"]: r["topic_id"] for r in q.queries()["density_clusters"](spark, small).collect()}
    held = sorted((r["Bibcode"], r["reduced_5d"]) for r in q.reduced_embeddings(spark, small).collect())
    want = density_cluster(np.array([v for _, v in held], float), 15, 3)
    assert _agreement([rows[k] for k, _ in held], want.tolist()) >= 0.95


def test_neighbours_of_neighbours_meet_in_blocks():
    """A block has the lists of its rows once, each vector once, and gives only what a row accepts."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x, lists = rng.normal(size=(30, 6)), {u: sorted(rng.choice([v for v in range(30) if v != u], 4, replace=False).tolist()) for u in range(30)}
    d = density._distances(x, x)
    most = {u: float("inf") if u % 7 == 0 else max(d[u, v] for v in lists[u]) for u in lists}
    links = [(v, u, most[u]) for u in lists for v in lists[u]] + [(u, v, None) for u in lists for v in lists[u]]
    rng.shuffle(links)
    order = rng.permutation(30)
    names = lambda ids: pa.array([int(100 - i) for i in ids], pa.int64())
    got = density._closer(None, pa.table({"via": names(r[0] for r in links), "id": names(r[1] for r in links), "most": pa.array([r[2] for r in links], pa.float64())}),
                          pa.table({"row": names(order), "vector": pa.array(x[order].tolist(), pa.list_(pa.float64()))}))
    want = {(100 - u, 100 - w): d[u, w] for u in lists for v in lists[u] for w in lists[v] if w != u and d[u, w] <= most[u] + 1e-12}
    assert {(r["u"], r["v"]): pytest.approx(r["d"]) for r in got.to_pylist()} == want and got.num_rows == len(want)
