"""Hard negatives against all scores, sorted."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citeloom.llm import hard_negatives as hard

SCHEMA = "id long, label long, vector array<long>, block int, row string, cell int, width int"


def brute_force(rows, every, positives=5, negatives=3):
    out, last = [], hard.NO_ID
    for i, (id_a, label, v) in enumerate(rows):
        if id_a is None or id_a % every:
            continue
        width = max(len(x[2]) for x in rows)
        pad = lambda x: np.array(x + [0] * (width - len(x)), object)
        scores = [(-int(pad(v) @ pad(w)), last if other is None else other, j) for j, (other, _, w) in enumerate(rows)]
        order = sorted(scores)
        for s, p, j in [x for x in order if rows[x[2]][1] == label and x[2] != i][:positives]:
            fits = [x for x in order if rows[x[2]][1] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(id_a, None if p == last else p, k + 1, None if n == last else n, -s, -t) for k, (t, n, _) in enumerate(fits)]
    return sorted(out, key=str)


def _mine(spark, rows, every, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[n] for n in names) for r in hard.mine(df, F.col("id") % every == 0, **kw).collect()), key=str)


@pytest.mark.parametrize("sizes", [(1024, 512, 64), (20, 8, 4)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, n in zip(("CANDIDATES", "ANCHORS", "LEAF"), sizes):
        monkeypatch.setattr(hard, name, n)
    rng = random.Random(len(sizes) + sizes[0])
    middle = [[rng.randrange(-9, 10) for _ in range(6)] for _ in range(4)]
    rows = [(i, rng.randrange(3), [x + rng.randrange(-4, 5) for x in rng.choice(middle)]) for i in range(200)]
    rows += [(500 + i, i % 3, [5, 5, 5, 5, 5, 5]) for i in range(80)]  # very many copies, and ties
    rows += [(None, 1, [9, 9, 9, 9, 9, 9]), (None, 0, [5, 5, 5, 5, 5, 5]), (10, 0, [1, 2, 3]), (10, 0, [1, 2, 3]), (20, 1, []), (30, 99, [1, 1, 1, 1, 1, 1]), (40, 2, [-9] * 6)]
    assert _mine(spark, rows, 10) == brute_force(rows, 10)


def test_large_numbers_are_exact_or_refused(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [2**29 + rng.randrange(99), rng.randrange(2**29)]) for i in range(40)]
    assert _mine(spark, rows, 5) == brute_force(rows, 5)
    with pytest.raises(Exception, match="64 bits"):
        _mine(spark, [(0, 0, [2**40]), (1, 0, [2**40]), (2, 1, [2**39])], 1)


def test_no_rows_without_anchors_positives_or_rows(spark):
    assert _mine(spark, [(1, 0, [1]), (2, 1, [1])], 50) == [] == _mine(spark, [(50, 0, [1]), (2, 1, [1])], 50)
    df = spark.createDataFrame([], SCHEMA)
    assert hard.mine(df, F.col("id") % 2 == 0).count() == 0


def test_usable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [nan, 1.0]), (5, 1, [1.0, None]), (6, 1, [inf, 0.0]), (7, 1, [0.0, -inf]), (None, 2, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = [tuple(r) for r in hard.usable(df, "vec_id", "label", "embedding", 256).collect()]
    assert got == [(1, 1, [128, -1]), (None, 2, [256])]


def test_whole_groups_of_anchors_are_pruned():
    rng = np.random.default_rng(3)

    def packed(points, first):
        import pyarrow as pa

        n = len(points)
        table = pa.table({"block": [0] * n, "row": range(first, first + n), "id": range(first, first + n), "label": [0] * n, "vector": points.tolist(), "width": [points.shape[1]] * n})
        return hard.Packed(hard._pack((pa.scalar(0),), table).to_pylist()[0])

    far = [rng.integers(-9, 9, (200, 4)) + 1000 * np.array(w) for w in ([1, 0, 0, 0], [-1, 0, 0, 0])]
    a, c = packed(far[0], 0), packed(np.concatenate(far), 500)
    least, most = np.full((200, 1), 5e5), np.full((200, 1), np.inf)
    score, ids, _, real = hard.search(a, c, least, most, 3, True)
    assert real.all() and (score > 5e5).all() and set(ids.ravel()) <= set(range(500, 700))
    # balls on the other side have no interval that reaches what the anchors accept
    others = c.centre[:, 0] < -900
    lo, hi = hard.interval(a.centre[0] @ c.centre[others].T, a.norm[0], a.radius[0], c.norm[others], c.radius[others])
    assert others.any() and (hi < 5e5).all()
