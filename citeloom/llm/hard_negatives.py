"""Hard negatives by dual-tree search over integer vectors.

All rows are dealt to blocks by a coarse tree that is fitted on a bounded sample, anchors to blocks of their own.  A block
holds a ball tree of its vectors.  A pair of blocks, and below it a pair of nodes, has an interval of inner products; the
pair is left out with all its anchors where the interval lies beyond what any of them still accepts, and pairs of leaves
are scored exactly.  What an anchor accepts begins with its best rows in the block nearest to its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import materialize

#: Rows of the sample that the coarse tree is fitted on, and its levels at most.
SAMPLE, LEVELS = 8192, 12
#: Rows of a block of candidates, of a block of anchors and of a leaf.
CANDIDATES, ANCHORS, LEAF = 1024, 512, 64
#: Leaves of candidates that a leaf of anchors is scored against at a time.
AT_ONCE = 4
PACKED = "block long, n long, centre array<double>, radius double, row binary, id binary, label binary, width int, vector binary, nodes binary"
FOUND = "anchor long, slot int, score long, row long, id long"
#: The id that stands for a missing one, so that it comes last.
NO_ID = np.iinfo(np.int64).max


def usable(rows: DataFrame, id_column: str, label_column: str, vector_column: str, scale: float) -> DataFrame:
    """(id, label, vector) of the rows with a label and a vector of finite numbers, each as the floor of scale times it."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    kept = rows.where(F.col(label_column).isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("vector"))


def _matrix(column, width: int) -> np.ndarray:
    """The vectors of an Arrow list column; missing components at the end are zero."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(lists.value_lengths())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _split(points: np.ndarray) -> tuple[np.ndarray, float]:
    """The direction between two far points, and the median along it."""
    far = points[((points - points.mean(0)) ** 2).sum(1).argmax()]
    way = points[((points - far) ** 2).sum(1).argmax()] - far
    return way, float(np.median(points @ way))


def coarse_tree(points: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Direction and threshold of each inner node of a full binary tree of so many levels, in heap order."""
    ways, marks = np.zeros((2**levels - 1, points.shape[1])), np.zeros(2**levels - 1)
    held = {0: np.arange(len(points))}
    for node in range(2**levels - 1):
        own = held.pop(node)
        if len(own):
            ways[node], marks[node] = _split(points[own])
        left = points[own] @ ways[node] <= marks[node]
        held[2 * node + 1], held[2 * node + 2] = own[left], own[~left]
    return ways, marks


def cells(points: np.ndarray, ways: np.ndarray, marks: np.ndarray, levels: int) -> np.ndarray:
    """The leaf of the coarse tree that each point falls into, numbered so that neighbours share leading bits."""
    node = np.zeros(len(points), np.int64)
    for _ in range(levels):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", points, ways[node]) > marks[node])
    return node - (2**levels - 1)


def _ball_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of points and the nodes of a ball tree over it: start, end, left child (0 for a leaf, the right one follows), radius, centre."""
    order, nodes, k = np.arange(len(points)), [(0, len(points))], 0
    children = [0]
    while k < len(nodes):
        start, end = nodes[k]
        if end - start > LEAF:
            own = points[order[start:end]]
            way, _ = _split(own)
            order[start:end] = order[start:end][np.argsort(own @ way, kind="stable")]
            children[k] = len(nodes)
            nodes += [(start, (start + end) // 2), ((start + end) // 2, end)]
            children += [0, 0]
        k += 1
    out = np.zeros((len(nodes), 4 + points.shape[1]))
    for k, (start, end) in enumerate(nodes):
        own = points[order[start:end]]
        centre = own.mean(0)
        out[k] = [start, end, children[k], np.sqrt(((own - centre) ** 2).sum(1).max()), *centre]
    return order, out


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    vectors = _matrix(rows.column("vector"), rows.column("width")[0].as_py())
    order, nodes = _ball_tree(vectors.astype(float))
    vectors = vectors[order]
    size = next(w for w in (2, 4, 8) if w == 8 or np.abs(vectors).max(initial=0) < 2 ** (8 * w - 1))
    column = lambda name, kind: rows.column(name).to_numpy()[order].astype(kind).tobytes()
    one = {"block": [key[0].as_py()], "n": [len(order)], "centre": [nodes[0, 4:].tolist()], "radius": [nodes[0, 3]], "row": [column("row", "<i8")], "id": [column("id", "<i8")], "label": [column("label", "<i8")], "width": [size], "vector": [vectors.astype(f"<i{size}").tobytes()], "nodes": [nodes.astype("<f8").tobytes()]}
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(v, t) for v, t in zip(one.values(), kinds)], list(one))


class Packed:
    """A block as arrays."""

    def __init__(self, row: dict):
        self.n, self.block = row["n"], row["block"]
        self.row, self.id, self.label = (np.frombuffer(row[c], "<i8") for c in ("row", "id", "label"))
        self.vectors = np.frombuffer(row["vector"], f"<i{row['width']}").reshape(self.n, -1)
        nodes = np.frombuffer(row["nodes"], "<f8").reshape(-1, 4 + self.vectors.shape[1])
        self.start, self.end, self.child = nodes[:, :3].astype(int).T
        self.radius, self.centre = nodes[:, 3], nodes[:, 4:]
        self.norm = np.sqrt((self.centre**2).sum(1))
        self.largest = float((self.norm + self.radius).max())


def interval(dot, norm_a, radius_a, norm_c, radius_c):
    """Bounds of the inner products of the points of two balls, a little wider than rounding could make them."""
    reach = norm_a * radius_c + norm_c * radius_a + radius_a * radius_c
    slack = 1e-6 * (1 + norm_a * norm_c + reach)
    return dot - reach - slack, dot + reach + slack


def search(a: Packed, c: Packed, least: np.ndarray, most: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, ...]:
    """The first k candidates of each anchor and slot with scores from least to most, both by anchor and slot.

    With `same` candidates have the anchor's label and are other rows, without it another label.  Higher scores come first,
    then smaller ids and rows.  Returns scores (-inf where there are fewer than k), ids and rows, by anchor, slot and place.
    """
    bound = a.largest * c.largest
    if bound >= 2.0**62:
        raise ArithmeticError("inner products go beyond 64 bits")
    kind = float if bound < 2.0**53 else np.int64
    va, vc = a.vectors.astype(kind), c.vectors.astype(kind)
    slots = least.shape[1]
    score = np.full((a.n, slots, k), -np.inf if kind is float else np.iinfo(np.int64).min, kind)
    nothing = score.flat[0]
    ids, rows = np.full((a.n, slots, k), NO_ID), np.full((a.n, slots, k), -1)
    low = least.copy()
    node_low = np.array([low[s:e].min() for s, e in zip(a.start, a.end)])
    node_high = np.array([most[s:e].max() for s, e in zip(a.start, a.end)])
    ia, ic, leaves = np.zeros(1, int), np.zeros(1, int), []
    while len(ia):
        lo, hi = interval(np.einsum("ij,ij->i", a.centre[ia], c.centre[ic]), a.norm[ia], a.radius[ia], c.norm[ic], c.radius[ic])
        kept = (hi >= node_low[ia]) & (lo <= node_high[ia])  # a pair that fails goes with all its anchors
        ia, ic, hi = ia[kept], ic[kept], hi[kept]
        ends = (a.child[ia] == 0) & (c.child[ic] == 0)
        leaves.append((ia[ends], ic[ends], hi[ends]))
        ia, ic = ia[~ends], ic[~ends]
        split_a = (a.child[ia] > 0) & ((c.child[ic] == 0) | (a.radius[ia] >= c.radius[ic]))
        below_a, below_c = a.child[ia[split_a]], c.child[ic[~split_a]]
        ia, ic = np.concatenate([below_a, below_a + 1, ia[~split_a], ia[~split_a]]), np.concatenate([ic[split_a], ic[split_a], below_c, below_c + 1])
    la, lc, lh = (np.concatenate(x) for x in zip(*leaves))
    for node in np.unique(la):
        own = np.flatnonzero(la == node)
        own = own[np.argsort(-lh[own], kind="stable")]
        s, e = a.start[node], a.end[node]
        for at in range(0, len(own), AT_ONCE):
            part = own[at : at + AT_ONCE]
            part = part[lh[part] >= low[s:e].min()]
            if not len(part):
                break
            held = np.concatenate([np.arange(c.start[j], c.end[j]) for j in lc[part]])
            scores = va[s:e] @ vc[held].T
            fits = a.label[s:e, None] == c.label[held]
            fits = fits & (a.row[s:e, None] != c.row[held]) if same else ~fits
            for slot in range(slots):
                good = fits & (scores >= low[s:e, slot, None]) & (scores <= most[s:e, slot, None])
                some, which = np.flatnonzero(good.any(1)), np.flatnonzero(good.any(0))
                if not len(some):
                    continue
                place = s + some
                new = np.where(good[np.ix_(some, which)], scores[np.ix_(some, which)], nothing)
                all_s = np.concatenate([score[place, slot], new], 1)
                all_i = np.concatenate([ids[place, slot], np.broadcast_to(c.id[held[which]], new.shape)], 1)
                all_r = np.concatenate([rows[place, slot], np.broadcast_to(c.row[held[which]], new.shape)], 1)
                first = np.lexsort((all_r, all_i, -all_s if kind is float else ~all_s), axis=1)[:, :k]
                for target, source in ((score, all_s), (ids, all_i), (rows, all_r)):
                    target[place, slot] = np.take_along_axis(source, first, 1)
                low[place, slot] = np.maximum(low[place, slot], score[place, slot, k - 1].astype(float))
    return score, ids, rows, score > nothing


def _packed(rows: DataFrame, cell: Column, size: int, name: str) -> DataFrame:
    """rows(row, id, label, vector, width, cell) in blocks of about so many rows of a cell."""
    rows = rows.withColumn("cell", cell)
    sizes = F.broadcast(rows.groupBy("cell").agg(F.ceil(F.count("*") / size).alias("slices")))  # 2^LEVELS rows at most
    dealt = rows.join(sizes, "cell").withColumn("block", F.col("cell") * F.lit(1 << 40) + F.pmod(F.xxhash64("row"), F.col("slices")))
    return materialize(dealt.select("block", "row", "id", "label", "vector", "width").groupBy("block").applyInArrow(_pack, PACKED), name)


def _pairs(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """(a, c, dot, lo, hi): the blocks of the query set against the blocks of all rows, with the intervals of their inner products."""
    side = lambda df, name: df.select(F.col("block").alias(name), F.col("centre").alias(f"{name}_centre"), F.col("radius").alias(f"{name}_radius"), F.sqrt(_dot("centre", "centre")).alias(f"{name}_norm"))
    rows = side(anchors, "a").crossJoin(side(candidates, "c")).withColumn("dot", _dot("a_centre", "c_centre"))
    lo, hi = interval(F.col("dot"), F.col("a_norm"), F.col("a_radius"), F.col("c_norm"), F.col("c_radius"))
    return rows.select("a", "c", "dot", lo.alias("lo"), hi.alias("hi"))


def _dot(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _met(pairs: DataFrame, anchors: DataFrame, candidates: DataFrame, wanted: DataFrame) -> DataFrame:
    """A row for each pair of blocks, with both blocks and what the anchors accept."""
    side = lambda df, name: df.select(F.col("block").alias(name), F.struct(*df.columns).alias(f"{name}_block"))
    return pairs.select("a", "c").join(side(anchors, "a"), "a").join(wanted.withColumnRenamed("block", "a"), "a").join(side(candidates, "c"), "c").repartition("a", "c").select("a_block", "c_block", "least", "most")


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, which hold blocks each."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _searched(met: DataFrame, k: int, same: bool, thresholds: bool) -> DataFrame:
    """The first k of each anchor and slot in each pair of blocks; with thresholds, the k-th scores of a block's anchors instead."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _one_by_one(batch):
                a, c = Packed(r["a_block"]), Packed(r["c_block"])
                least, most = (np.frombuffer(r[x], "<f8").reshape(a.n, -1) for x in ("least", "most"))
                score, ids, rows, real = search(a, c, least, most, k, same)
                if thresholds:
                    low = np.maximum(least, np.where(real[:, :, -1], score[:, :, -1].astype(float), -np.inf))
                    yield pa.RecordBatch.from_arrays([pa.array([a.block]), pa.array([low.astype("<f8").tobytes()]), pa.array([most.astype("<f8").tobytes()]), pa.array([float(low.min())]), pa.array([float(most.max())])], ["block", "least", "most", "low", "high"])
                else:
                    i, slot, place = np.nonzero(real)
                    yield pa.RecordBatch.from_arrays([pa.array(a.row[i]), pa.array(slot.astype(np.int32)), pa.array(score[i, slot, place].astype(np.int64)), pa.array(rows[i, slot, place]), pa.array(ids[i, slot, place])], ["anchor", "slot", "score", "row", "id"])

    return met.mapInArrow(over, "block long, least binary, most binary, low double, high double" if thresholds else FOUND)


def _best(anchors: DataFrame, candidates: DataFrame, pairs: DataFrame, wanted: DataFrame, k: int, same: bool, name: str) -> DataFrame:
    """(anchor, slot, rank, score, row, id): the first k of each anchor and slot among all candidates."""
    near = pairs.groupBy("a").agg(F.max_by("c", F.struct("dot", "c")).alias("c"))
    wanted = materialize(_searched(_met(near, anchors, candidates, wanted), k, same, True), f"{name}-accepted")
    bounds = wanted.select(F.col("block").alias("a"), "low", "high")
    open_pairs = pairs.join(bounds, "a").where("hi >= low and lo <= high")
    found = _searched(_met(open_pairs, anchors, candidates, wanted.select("block", "least", "most")), k, same, False)
    first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    return materialize(found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k), name)


def _accepted(blocks: DataFrame, slots: int, least_per_cent: int, most_per_cent: int) -> DataFrame:
    """(block, least, most): shares of the scores in blocks(block, n, row, scores), nothing where one is missing, and anything where all are."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _one_by_one(batch):
                least, most = np.full((r["n"], slots), np.inf), np.full((r["n"], slots), -np.inf)
                if r["scores"] is None:
                    least, most = most, least
                else:
                    place = {row: i for i, row in enumerate(np.frombuffer(r["row"], "<i8").tolist())}
                    for x in r["scores"]:  # whole numbers, so that no rounding decides
                        at = place[x["anchor"]], x["slot"]
                        least[at], most[at] = -(-least_per_cent * x["score"] // 100), most_per_cent * x["score"] // 100
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]]), pa.array([least.astype("<f8").tobytes()]), pa.array([most.astype("<f8").tobytes()])], ["block", "least", "most"])

    return blocks.select("block", "n", "row", "scores").mapInArrow(over, "block long, least binary, most binary")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least_per_cent: int = 50, most_per_cent: int = 95) -> DataFrame:
    """Hard negatives of rows(id, label, vector of integers): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products; higher ones come first, ties by smaller id, a missing id last.  An anchor's positives
    are its first other rows of the same label.  For each anchor and positive the first rows of other labels follow whose
    score is from least_per_cent to most_per_cent of the positive's.  Rows that repeat an id are rows of their own, as
    anchors and as candidates; a vector that is shorter than others has zeros at its end.  Rows without anchors, empty
    tables and anchors without positives or negatives give no rows.  Scores beyond 64 bits raise an error; further columns
    are not read.
    """
    spark = rows.sparkSession
    given = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asked"))
    held = materialize(given.withColumns({"row": F.monotonically_increasing_id(), "width": F.size("vector"), "id": F.coalesce("id", F.lit(int(NO_ID)))}), "negatives-rows")
    n, asked, width = held.agg(F.count("*"), F.count(F.when(F.col("asked"), 1)), F.coalesce(F.max("width"), F.lit(0))).first()
    levels = min(LEVELS, max(0, int(np.ceil(np.log2(max(n, 1) / CANDIDATES)))))
    shift = levels - min(levels, max(0, int(np.ceil(np.log2(max(asked, 1) / ANCHORS)))))
    sample = held.select("vector").orderBy(F.xxhash64("id", "row")).limit(SAMPLE).toArrow()
    tree = spark.sparkContext.broadcast(coarse_tree(_matrix(sample.column("vector"), width).astype(float), levels))  # 2^LEVELS directions at most

    @F.pandas_udf("long")
    def cell(vectors: pd.Series) -> pd.Series:
        return pd.Series(cells(_matrix(pa.array(vectors, pa.list_(pa.int64())), width).astype(float), *tree.value, levels))

    dealt = materialize(held.withColumns({"cell": cell("vector"), "width": F.lit(width)}), "negatives-cells")
    candidates = _packed(dealt.drop("asked"), F.col("cell"), CANDIDATES, "negatives-candidates")
    anchors = _packed(dealt.where("asked").drop("asked"), F.shiftright("cell", shift), ANCHORS, "negatives-anchors")
    pairs = materialize(_pairs(anchors, candidates), "negatives-pairs")

    anything = anchors.select("block", "n", "row", F.lit(None).cast("array<struct<anchor:long,slot:int,score:long>>").alias("scores"))
    first = _best(anchors, candidates, pairs, _accepted(anything, 1, 0, 0), positives, True, "negatives-positives")
    blocks = anchors.select("block", "row").mapInArrow(_members, "block long, anchor long")
    # at most ANCHORS times the positives in a block, give or take the spread of its hash
    known = blocks.join(first, "anchor").groupBy("block").agg(F.collect_list(F.struct("anchor", (F.col("rank") - 1).alias("slot"), "score")).alias("scores"))
    within = _accepted(anchors.select("block", "n", "row").join(known, "block"), positives, least_per_cent, most_per_cent)
    second = _best(anchors, candidates, pairs, within, negatives, False, "negatives-found")
    names = dealt.where("asked").select(F.col("row").alias("anchor"), _real("id").alias("anchor_id"))
    positive = first.select("anchor", (F.col("rank") - 1).alias("slot"), _real("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = second.select("anchor", "slot", "rank", _real("id").alias("negative_id"), F.col("score").alias("negative_score")).join(positive, ["anchor", "slot"]).join(names, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _real(column: str) -> Column:
    return F.when(F.col(column) != int(NO_ID), F.col(column))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(rows, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own)], ["block", "anchor"])
