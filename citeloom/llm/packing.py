"""Best-fit packing by length patterns.

Pieces of documents are packed into sequences of a fixed capacity.  Only the histogram of piece lengths, one count for
each possible length, reaches the driver.  There patterns of up to three lengths that fill a sequence are enumerated, and
repeat counts are fitted to the histogram by non-negative least squares; they are rounded down, so that no pattern asks
for a piece that does not exist, and what remains is packed best-fit, largest first, still by counts.  The plan says for
each length which ranks go to which sequences; pieces learn their ranks from counts per chunk of documents.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.bpe import compile_pattern, encoder, read_ranks
from citeloom.llm.byte_bpe import texts_of
from citeloom.llm.common import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Gradient steps of each round of the fit.
STEPS = 250
#: Rows of a chunk within which pieces are ranked by a window.
CHUNK_ROWS = 20_000
#: Texts of more characters are searched for very long words, which need the linear encoder.
LONG_TEXT, LONG_WORD = 20_000, 5_000
#: White space that may be one match of a pattern; other long matches are in a run without white space.
LONG_SPACE = re.compile(r"\s{%d}" % (LONG_WORD - 1))


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizers file, which the library cuts out of a text before anything else, and their ids."""
    with open(path, encoding="utf-8") as held:
        added = json.load(held)["added_tokens"]
    if odd := [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]:
        raise ValueError(f"added tokens that are not found as they stand: {odd}")
    return {t["content"]: t["id"] for t in added}


def long_runs(text: str) -> bool:
    """Whether a text has a run so long that it may hold a very long word; only then it is worth cutting by the pattern."""
    return max(map(len, text.split()), default=0) >= LONG_WORD - 1 or LONG_SPACE.search(text) is not None


def token_ids(vocabulary: str, pattern: str, added: dict[str, int] | None = None):
    """A function from a text to its ids, by tiktoken; texts with very long words go through the linear encoder.

    Added tokens in a text have their own ids, and what is between them is encoded by itself.
    """
    import tiktoken

    ranks = read_ranks(vocabulary)
    plain = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def plain_ids(text: str) -> np.ndarray:
        if len(text) > LONG_TEXT and long_runs(text) and max(map(len, compile_pattern(pattern).findall(text)), default=0) > LONG_WORD:
            return np.frombuffer(encoder(vocabulary, pattern)[1].encode(text), "<u4")
        return np.frombuffer(array("I", plain.encode_ordinary(text)), np.uint32)  # ten times faster than from the list

    if not added:
        return plain_ids
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def ids(text: str) -> np.ndarray:
        parts = cut.split(text)
        if len(parts) == 1:
            return plain_ids(text)
        return np.concatenate([np.array([added[part]], "<u4") if k % 2 else plain_ids(part) for k, part in enumerate(parts)])

    return ids


def pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int, end_id: int, added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the ids of each text and the end id, cut so that only the first piece is short."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(vocabulary, pattern, added)
        for batch in batches:
            rows: list[tuple] = []
            ids_of = batch.column(0)
            for i, text in texts_of(batch):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                cut = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                doc = ids_of[i].as_py()
                rows += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cut, cut[1:]))]
                if len(rows) > 20_000:
                    yield _piece_batch(rows)
                    rows = []
            yield _piece_batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(over, PIECES)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to three of the given lengths, descending and padded with 0, that fill the capacity exactly."""
    held = np.zeros(capacity + 1, bool)
    held[lengths] = True
    found = [np.array([[capacity, 0, 0]])] if held[capacity] else []
    for a in lengths[::-1]:
        rest = capacity - a
        if 0 < rest <= a and held[rest]:
            found.append(np.array([[a, rest, 0]]))
        b = np.arange(min(a, rest - 1), (rest - 1) // 2, -1) if rest > 1 else np.zeros(0, int)
        b = b[(b > 0) & (rest - b <= b)]
        b = b[held[b] & held[rest - b] & (rest - b > 0)]
        if len(b):
            found.append(np.stack([np.full(len(b), a), b, rest - b], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit_repeats(table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative repeat counts x of the patterns that minimise |A x - counts|, by accelerated projected gradients.

    After a first round over all patterns only the most repeated ones stay, so that few repeats are lost to rounding.
    """
    x = np.zeros(len(table))
    for most in (len(table), 2 * len(counts)):
        at = np.argsort(-x, kind="stable")[:most]
        x[at] = _project(table[at], counts, x[at])
        rest = np.ones(len(x), bool)
        rest[at] = False
        x[rest] = 0
    return x


def _project(table: np.ndarray, counts: np.ndarray, x: np.ndarray) -> np.ndarray:
    def product(values: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(table[:, k], values, len(counts)) for k in range(3))
        out[0] = 0  # the padding
        return out

    probe = np.ones(len(table))
    for _ in range(20):  # the largest eigenvalue bounds the step
        probe = product(probe)[table].sum(1)
        top = float(np.linalg.norm(probe))
        probe /= top
    point, momentum = x.copy(), 1.0
    for _ in range(STEPS):
        moved = np.maximum(0, point - (product(point) - counts)[table].sum(1) / (1.01 * top))
        following = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        point = moved + (momentum - 1) / following * (moved - x)
        x, momentum = moved, following
    return x


def best_fit(counts: np.ndarray, capacity: int) -> Counter:
    """Pack counts of lengths best-fit, largest first, all pieces of one length at a time: contents and how often."""
    open_bins: dict[int, Counter] = defaultdict(Counter)
    for length in range(len(counts) - 1, 0, -1):
        left = int(counts[length])
        space = length
        while left and space <= capacity:
            bins = open_bins.get(space)
            if not bins:
                space += 1
                continue
            contents, n = next(iter(bins.items()))
            fit = space // length
            if left >= fit:
                take, more = min(n, left // fit), fit
            else:
                take, more = 1, left
            bins[contents] -= take
            if not bins[contents]:
                del bins[contents]
            open_bins[space - more * length][contents + (length,) * more] += take
            left -= take * more
        fit = capacity // length
        if left >= fit:
            open_bins[capacity - fit * length][(length,) * fit] += left // fit
            left %= fit
        if left:
            open_bins[capacity - left * length][(length,) * left] += 1
    packed: Counter = Counter()
    for bins in open_bins.values():
        packed.update(bins)
    return packed


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together they hold every piece of the histogram once."""
    counts = counts.astype(np.int64)
    table = patterns(np.flatnonzero(counts), capacity)
    left, chosen = counts.copy(), []
    if len(table):
        # a pattern is repeated a whole number of times, and never beyond what is left of its lengths
        repeats = np.floor(fit_repeats(table, counts.astype(float)) + 1e-6).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            if repeats[k] <= 0:
                break
            need = Counter(int(v) for v in table[k] if v)
            times = min([int(repeats[k]), *(int(left[v]) // n for v, n in need.items())])
            if times > 0:
                chosen.append((tuple(int(v) for v in table[k] if v), times))
                for v, n in need.items():
                    left[v] -= n * times
    return chosen + sorted(best_fit(left, capacity).items())


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset), in ascending order of ranks."""
    used, table, sequence = Counter(), defaultdict(list), 0
    for contents, times in chosen:
        offset = 0
        for length in contents:
            table[length].append((used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in table.items()}


def _ranked(rows: DataFrame) -> DataFrame:
    """rows with rank, from 0 and without gaps within each length."""
    total = rows.count()
    chunks = max(8, -(-total // CHUNK_ROWS))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)))
    sizes = rows.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece")
    ranked = rows.withColumn("place", F.row_number().over(within) - 1)
    return ranked.join(sizes, ["length", "chunk"]).withColumn("rank", F.col("base") + F.col("place")).drop("chunk", "base", "place")


def pack(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024, end_id: int = 2, added: dict[str, int] | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Where a text holds one of the added tokens, it has that token's id; without any, all text is encoded as it stands.
    A null or empty text is one piece that holds the end id only.  Rows repeated under one id are packed each; a null id
    stays null.  Pieces of equal length are interchangeable, so ties need no rule.  An empty table gives no rows, and
    further columns are not read.
    """
    rows = materialize(pieces(docs, vocabulary, pattern, capacity, end_id, added), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in rows.groupBy("length").count().collect():  # one row for each length up to the capacity
        counts[length] = n
    table = slots(plan(counts, capacity))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length):
                at, own = np.flatnonzero(length == v), table[int(v)]
                k = np.searchsorted(own[:, 0], rank[at], "right") - 1
                sequence[at] = own[k, 1] + rank[at] - own[k, 0]
                offset[at] = own[k, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = _ranked(rows).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(over, PIECES + ", sequence_id long, offset long")
