"""Spectral layouts: coordinates that keep neighbours, by block power iteration over the table of a neighbour graph.

Edges are written once, in blocks of rows of near cells.  Vectors of one round are a table of rows; a round sends each row's
coordinates once to each block that holds a neighbour of it, and adds them up there.  Only the products of the coordinates
with each other, a square of a few numbers, reach the driver.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.operators import density
from citeloom.operators.providers import reduce_dimensions
from citeloom.plans.written import materialize, numbered, table_path

#: The neighbour whose distance is the scale of a row.
SCALE = 7
#: About the rows of a block of edges, and levels of the first tree that cut blocks of tables of fewer rows.
BLOCK_ROWS, LEVELS = 1 << 17, 4


def _blocks(points: DataFrame, seed: int) -> tuple[DataFrame | None, DataFrame, int]:
    """The cells of points, (id, block) with blocks of about BLOCK_ROWS rows of near cells, and the number of blocks."""
    n = points.count()
    if n <= density.BUCKET:
        return None, points.select("id", F.lit(0).cast("long").alias("block")), 1
    celled, levels = density._celled(points, density.TREES, seed)
    deep = min(levels, max(0, min(LEVELS, math.ceil(math.log2(n / (16 * density.BUCKET)))), math.ceil(math.log2(n / BLOCK_ROWS))))
    nodes = celled.where("tree = 0").select("id", F.shiftright("cell", levels - deep).alias("_node"))
    # equal rows share a cell, however many they are
    sizes = materialize(nodes.groupBy("_node").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("_subs")), "blocks")  # 2^deep rows
    rows = nodes.join(F.broadcast(sizes), "_node").select("id", (F.col("_node") * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("_subs"))).alias("block"))
    return celled, rows, int(sizes.agg(F.sum("_subs")).first()[0])


def _packed(rows: pa.Table) -> pa.Table:
    """Of the edges (block, u, v, w, to) of a block a row for each u: its degree, the blocks that need it, and its neighbours with their weights."""
    block, u, v, w, to = (rows.column(c).to_numpy() for c in ("block", "u", "v", "w", "to"))
    order = np.lexsort((-w, v, u))
    order = order[np.r_[True, (np.diff(u[order]) != 0) | (np.diff(v[order]) != 0)]]
    block, u, v, w, to = block[0], u[order], v[order], w[order], to[order]
    first = np.flatnonzero(np.r_[True, np.diff(u) != 0])
    # its own block is among those that need a row
    pairs = np.unique(np.stack([np.r_[u, u[first]], np.r_[to, np.full(len(first), block)]], 1), axis=0)
    ends = lambda starts, n: pa.array(np.r_[starts, n], pa.int32())
    needed = ends(np.flatnonzero(np.r_[True, np.diff(pairs[:, 0]) != 0]), len(pairs))
    near = ends(first, len(u))
    columns = [np.full(len(first), block), u[first], np.add.reduceat(w, first), pa.ListArray.from_arrays(needed, pairs[:, 1]), pa.ListArray.from_arrays(near, v), pa.ListArray.from_arrays(near, w)]
    return pa.table([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["block", "id", "degree", "to", "near", "w"])


def affinity(points: DataFrame, k: int, seed: int = 0) -> tuple[DataFrame, int]:
    """(block, id, degree, to, near, w) and the number of blocks.

    near and w are the neighbours of a row, by either's list, and exp(-d^2 / (scale of one * scale of the other)); degree is
    the sum of w, and `to` are the blocks that hold a neighbour or the row.
    """
    celled, blocks, n = _blocks(points, seed)
    graph = density.neighbours(points, k, seed=seed, celled=celled)
    order = Window.partitionBy("u").orderBy("d", "v")
    scale = graph.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= SCALE).groupBy(F.col("u").alias("id")).agg(F.greatest(F.max("d"), F.lit(1e-12)).alias("scale"))
    ends = materialize(blocks.join(scale, "id", "left"), "scales")
    side = lambda name: ends.select(F.col("id").alias(name), F.col("scale").alias(f"_{name}"), F.col("block").alias(f"_at_{name}"))
    rows = graph.join(side("u"), "u").join(side("v"), "v").withColumn("w", F.exp(-F.col("d") * F.col("d") / (F.col("_u") * F.col("_v"))))
    way = lambda a, b: F.struct(F.col(f"_at_{a}").alias("block"), F.col(a).alias("u"), F.col(b).alias("v"), "w", F.col(f"_at_{b}").alias("to"))
    both = rows.select(F.inline(F.array(way("u", "v"), way("v", "u"))))
    return both.repartition(n, "block").groupBy("block").applyInArrow(_packed, "block long, id long, degree double, to array<long>, near array<long>, w array<double>"), n


def _step(m: int, shift: np.ndarray, turn: np.ndarray, kept: bool):
    """A function that gives the rows of a block the mean of their own coordinates and what their edges bring.

    Coordinates come as they were written; what makes them orthonormal, (z - shift) times turn, is done here.  kept: the rows'
    own orthonormal coordinates are returned too.
    """

    def over(sent: pa.Table, rows: pa.Table) -> pa.Table:
        ids = sent.column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        z = (np.stack([sent.column(f"z{i}").to_numpy()[order] for i in range(m)], 1) - shift) @ turn
        near, w = rows.column("near").combine_chunks(), rows.column("w").combine_chunks()
        first = near.offsets.to_numpy()[:-1] - near.offsets[0].as_py()
        at, w = np.searchsorted(ids, near.flatten().to_numpy()), w.flatten().to_numpy()
        degree, own = rows.column("degree").to_numpy(), z[np.searchsorted(ids, rows.column("id").to_numpy())]
        least = np.where(degree > 0, degree, 1.0)
        columns = {f"z{i}": (own[:, i] + (np.add.reduceat(w * z[at, i], first) if len(first) else 0.0) / least) / 2 for i in range(m)}
        columns |= {f"x{i}": own[:, i] for i in range(m)} if kept else {}
        return pa.table({"id": rows.column("id"), "degree": rows.column("degree"), "to": rows.column("to"), **columns})

    return over


def _products(rows: DataFrame, left: list[Column], right: list[Column]) -> np.ndarray:
    """The products of two lists of coordinates, summed over all rows by their share of the degrees."""
    sums = rows.agg(*(F.sum(F.col("share") * a * b) for a in left for b in right)).first()
    return np.array([x or 0.0 for x in sums]).reshape(len(left), len(right))


def _turned(columns: list[Column], matrix: np.ndarray) -> list[Column]:
    """Coordinates times a matrix, as expressions."""
    return [sum((c * float(matrix[i, j]) for i, c in enumerate(columns)), F.lit(0.0)) for j in range(matrix.shape[1])]


def spectral_layout(df: DataFrame, key: str, vector: str = "embedding", sizes: tuple[int, ...] = (5, 2), k: int = 15, rounds: int = 10, seed: int = 0) -> DataFrame:
    """(key, reduced_<size>d...) of the leading eigenvectors of the neighbour graph's normalised matrix.

    The iteration starts from principal components.  The trivial eigenvector is left out; each coordinate has a mean square
    of one and a sign by which its cubes add up to no less than zero.  Keys must not repeat, vectors must have one length,
    and a row without neighbours has zeros.
    """
    spark, m = df.sparkSession, max(sizes)
    start = reduce_dimensions(df, key, vector, (m,)).select(F.col(key).alias("_k"), F.col(f"reduced_{m}d").alias("start"))
    # numbers of single precision stay so while they move
    own = F.col(vector) if df.schema[vector].dataType.simpleString() == "array<float>" else F.transform(vector, lambda x: x.cast("double"))
    rows = df.select(F.col(key).alias("key"), own.alias("vector"))
    points = numbered(rows.join(start, rows["key"] == start["_k"]).drop("_k"), ["key"])
    n = points.count()
    if not n:
        return df.select(key, *(F.lit(None).cast("array<float>").alias(f"reduced_{s}d") for s in sizes))
    packed, blocks = affinity(points.select("id", "vector"), k, seed)
    name = f"citeloom_layout_{uuid.uuid4().hex}"
    z = [f"z{i}" for i in range(m)]
    columns = lambda names: ", ".join(f"{c} double" for c in names)
    try:
        # the table stays bucketed by block, so edges do not move again
        packed.write.format("parquet").option("compression", "zstd").option("path", table_path(spark, "affinity")).bucketBy(blocks, "block").saveAsTable(name)
        edges = spark.table(name)
        total = edges.agg(F.sum("degree")).first()[0] or 1.0
        share = F.col("degree") / F.lit(float(total))

        # coordinates are held over the roots of the shares: along edges they are means, and the trivial eigenvector is constant
        held = edges.select("id", "degree", "to").join(points.select("id", "start"), "id")
        state = held.select("id", "degree", "to", *(F.when(share > 0, F.get("start", F.lit(i)).cast("double") / F.sqrt(share)).otherwise(0.0).alias(c) for i, c in enumerate(z)))
        state = materialize(state, "layout").withColumn("share", share)

        def orthonormal(held: DataFrame) -> tuple[np.ndarray, np.ndarray]:
            """The trivial part of held, and what makes the rest orthonormal."""
            shift = _products(held, list(map(F.col, z)), [F.lit(1.0)]).ravel()
            rest = [F.col(c) - float(shift[i]) for i, c in enumerate(z)]
            square = _products(held, rest, rest)
            return shift, np.linalg.inv(np.linalg.cholesky(square + 1e-12 * (1 + np.trace(square)) * np.eye(m))).T

        def along(held: DataFrame, shift: np.ndarray, turn: np.ndarray, kept: bool = False) -> DataFrame:
            sent = held.select(F.explode("to").alias("block"), "id", *z)
            fields = f"id long, degree double, to array<long>, {columns(z + [f'x{i}' for i in range(m)] * kept)}"
            return sent.groupBy("block").cogroup(edges.groupBy("block")).applyInArrow(_step(m, shift, turn, kept), fields)

        for _ in range(rounds):
            state = materialize(along(state, *orthonormal(state)), "layout").withColumn("share", share)
        shift, turn = orthonormal(state)
        p = _products(along(state, shift, turn, kept=True).withColumn("share", share), [F.col(f"x{i}") for i in range(m)], list(map(F.col, z)))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    value, vectors = np.linalg.eigh((p + p.T) / 2)
    best = _turned([F.col(c) - float(shift[i]) for i, c in enumerate(z)], turn @ vectors[:, np.argsort(-value)])
    even = state.select("id", *(F.when(F.col("share") > 0, x).otherwise(0.0).alias(c) for c, x in zip(z, best)))
    sums = even.agg(*(F.sum(F.pow(c, F.lit(e))) for e in (2, 3) for c in z)).first()
    factor = [float((1 if (sums[m + i] or 0) >= 0 else -1) * np.sqrt(n / max(sums[i] or 0.0, 1e-300))) for i in range(m)]
    named = points.select("id", "key").join(even, "id", "left")
    return named.select(F.col("key").alias(key), *(F.array(*((F.coalesce(z[i], F.lit(0.0)) * factor[i]).cast("float") for i in range(s))).alias(f"reduced_{s}d") for s in sizes))
