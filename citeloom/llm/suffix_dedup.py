"""Suffix-array dedup: removes each byte that a string of WIDTH bytes covers which also starts earlier in the corpus.

Every WIDTH-byte window has an anchor, the k-gram with the least hash in it, the leftmost of equals.  Equal windows have
equal anchors at equal places, so repeats can be looked for anchor by anchor.  Texts are dealt once to blocks, in a
bucketed table, and stay there; only what concerns anchors moves, in plain rows that are dealt by the anchors' hashes, so
that what moves grows with the input, whatever the number of blocks:

1. blocks send a row for each distinct anchor: its context (the bytes that the anchor's windows cover), if it has but one
   in the block; a window over the rows of an anchor says whether other blocks have it and whether contexts differ;
2. blocks send the distinct contexts of repeated anchors with the first place of each, and their bytes where contexts
   differ; a bucket of anchors sorts the suffixes of differing contexts by linear grouping (suffix_array), over symbols
   of eight bytes cut from the anchor on, and tells for the first place of each context which windows start earlier;
3. blocks remove the bytes and hash the rest.

Copies within a block are merged before anything moves, so an anchor sends one row for each block and context at most.
An anchor with very many contexts (HOT_CONTEXTS), as beside a line that very many documents share, is split by the bytes
beside it: each of its windows is a key of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import textvec as tv
from citeloom.llm.common import delete, materialize, scratch, table_path
from citeloom.llm.suffix_array import prefix_classes, suffix_array

WIDTH, GRAM = 100, 32
REACH = WIDTH - GRAM + 1
#: Bytes of text in a block, at most so many blocks of that size, the bytes to which blocks grow beyond it, and positions
#: that one pass over a long text covers.
BLOCK_BYTES, MANY_BLOCKS, MOST_BLOCK_BYTES, PASS = 4 << 20, 50_000, 32 << 20, 1 << 21
#: An anchor with more contexts than this is compared window by window.
HOT_CONTEXTS = 4096
#: About the bytes of text whose anchors go to one bucket.
BUCKET_BYTES = 4 << 20
#: Bytes of a symbol of the suffix array.
SYMBOL = 8
_POSITION = 24


class Runs(NamedTuple):
    """Runs of windows with one anchor: row, first and last window, anchor (all from the row's start), hashes."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray
    context: np.ndarray


_KINDS = (np.int64,) * 4 + (np.uint64,) * 2


def segments(raw: np.ndarray, at: np.ndarray) -> Runs:
    """The segments of all rows, in the order of rows and places."""
    parts = [_segments(*part) for part in _passes(raw, at)]
    return Runs(*(np.concatenate(x) for x in zip(*parts))) if parts else Runs(*(np.zeros(0, d) for d in _KINDS))


def _passes(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, starts in their rows, bytes, offsets); long rows are cut into overlapping parts, others go together."""
    n, i = len(at) - 1, 0
    while i < n:
        if at[i + 1] - at[i] > PASS:
            for start in range(0, int(at[i + 1] - at[i]) - WIDTH + 1, PASS - WIDTH + 1):
                a, b = at[i] + start, min(at[i] + start + PASS, at[i + 1])
                yield np.array([i]), np.array([start]), raw[a:b], np.array([0, b - a])
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(at, at[i] + PASS, "right")) - 1)
        yield np.arange(i, j), np.zeros(j - i, np.int64), raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def _segments(rows: np.ndarray, starts: np.ndarray, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(raw)
    if n < WIDTH:
        return tuple(np.zeros(0, d) for d in _KINDS)
    up, down = tv._powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(tv._BYTE_KEYS[raw] * up[:n], out=sums[1:])
    gram = tv.mix((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    keep = np.uint64((1 << 64) - (1 << _POSITION))
    least = (gram & keep) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < REACH:
        least = np.minimum(least[: len(least) - (REACH - span)], least[REACH - span :])
    windows = n - WIDTH + 1
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, at[:-1], 1)
    np.add.at(change, np.maximum(at[:-1], at[1:] - WIDTH + 1), -1)
    valid = np.cumsum(change[:windows]) > 0
    edge = valid.copy()
    edge[1:] &= (least[1:windows] != least[: windows - 1]) | ~valid[:-1]
    first = np.flatnonzero(edge)
    stop = valid.copy()
    stop[:-1] &= edge[1:] | ~valid[1:]
    last = np.flatnonzero(stop)
    anchor = (least[first] & np.uint64((1 << _POSITION) - 1)).astype(np.int64)
    own = gram[anchor]
    end = last + WIDTH
    context = (sums[end] - sums[first]) * down[first]
    context = tv.mix(tv.mix(context) + (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    row = np.searchsorted(at, first, "right") - 1
    shift = starts[row] - at[row]
    return rows[row], first + shift, last + shift, anchor + shift, own, context


class Block:
    """The rows of a block in the order of the corpus, and the segments of their texts."""

    def __init__(self, table: pa.Table):
        # rows without id stand first; ties keep the order of their texts
        self.table = table = table.sort_by([("has_id", "ascending"), ("place", "ascending"), ("text", "ascending")])
        self.raw, self.at = tv.text_bytes(table.column("text"))
        self.has_id, self.ids = table.column("has_id").to_numpy(), table.column("place").to_numpy()
        self.seg = segments(self.raw, self.at)
        self.grams, self.of_gram, self.times = np.unique(self.seg.gram, return_inverse=True, return_counts=True)
        self.order = np.lexsort((self.seg.context, self.seg.gram))
        gram, context = self.seg.gram[self.order], self.seg.context[self.order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
        self.contexts = np.bincount(self.of_gram[self.order][fresh], minlength=len(self.grams))

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, one of its contexts, how many contexts) of each distinct anchor."""
        first = np.searchsorted(self.seg.gram[self.order], self.grams)
        return self.grams, self.seg.context[self.order][first], self.contexts

    def candidates(self, found: pa.Table) -> tuple[Runs, np.ndarray]:
        """(segments of repeated anchors, those of hot ones cut into windows; whether contexts of their anchors differ)."""
        kind, gram = found.column("kind").to_numpy(), found.column("gram").to_numpy().view(np.uint64)
        flags = np.zeros(len(self.grams), np.int64)
        flags[np.searchsorted(self.grams, gram[kind > 0])] = kind[kind > 0]
        repeated = (self.times > 1) | (flags > 0)
        mixed = (self.contexts > 1) | (flags & _MIXED > 0)
        hot = (self.contexts > HOT_CONTEXTS) | (flags & _HOT > 0)
        own = repeated[self.of_gram]
        runs, of = Runs(*(x[own] for x in self.seg)), self.of_gram[own]
        cut = hot[of]
        if not cut.any():
            return runs, mixed[of]
        whole, split = Runs(*(x[~cut] for x in runs)), Runs(*(x[cut] for x in runs))
        times = split.last - split.first + 1
        of_window = np.repeat(np.arange(len(times)), times)
        first = split.first[of_window] + np.arange(len(of_window)) - np.repeat(np.cumsum(times) - times, times)
        key, keys = np.empty(len(of_window), np.uint64), tv.salt(WIDTH, 53)
        for k in range(0, len(of_window), 20_000):
            start = self.at[split.row[of_window[k : k + 20_000]]] + first[k : k + 20_000]
            key[k : k + 20_000] = tv.mix((tv._BYTE_KEYS[self.raw[start[:, None] + np.arange(WIDTH)]] * keys).sum(1, dtype=np.uint64))
        single = Runs(split.row[of_window], first, first, split.anchor[of_window], key, tv.mix(key ^ split.gram[of_window]))
        both = Runs(*(np.concatenate(x) for x in zip(whole, single)))
        order = np.lexsort((both.first, both.row))  # the order of places
        return Runs(*(x[order] for x in both)), np.concatenate((mixed[of][~cut], np.zeros(len(first), bool)))[order]

    def leads(self, runs: Runs) -> np.ndarray:
        """The first segment of each distinct context, in the order of anchors and contexts."""
        order = np.lexsort((np.arange(len(runs.gram)), runs.context, runs.gram))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (runs.gram[order[1:]] != runs.gram[order[:-1]]) | (runs.context[order[1:]] != runs.context[order[:-1]])
        return order[fresh]


#: What the other blocks say of an anchor: they have it, its contexts differ, it is hot.
_SHARED, _MIXED, _HOT = 1, 2, 4
_ANCHORS = "block long, gram long, context long, contexts long"
_CONTEXTS = "block long, gram long, context long, doc long, place long, shape int, text binary"
#: Answers to blocks: kind is 0 for a context that is first in the block, with a mask of its windows that start earlier,
#: and else what others say of an anchor.
_FOUND = "block long, kind int, gram long, context long, mask binary"


def _send_anchors(table: pa.Table) -> pa.Table:
    gram, context, contexts = Block(table).anchors()
    return pa.table({"block": pa.array(np.full(len(gram), table.column("block")[0].as_py())), "gram": pa.array(gram.view(np.int64)), "context": pa.array(context.view(np.int64)), "contexts": pa.array(contexts)})


def _shared_anchors(anchors: DataFrame) -> DataFrame:
    """Answers about anchors that several blocks have."""
    every = Window.partitionBy("gram")
    rows = anchors.withColumns({
        "n": F.count("*").over(every), "all": F.sum("contexts").over(every), "low": F.min("context").over(every), "high": F.max("context").over(every), "most": F.max("contexts").over(every)})
    mixed = F.when((F.col("low") != F.col("high")) | (F.col("most") > 1), _MIXED).otherwise(0)
    kind = F.lit(_SHARED) + mixed + F.when(F.col("all") > HOT_CONTEXTS, _HOT).otherwise(0)
    return rows.where("n > 1").select("block", kind.cast("int").alias("kind"), "gram", F.lit(None).cast("long").alias("context"), F.lit(None).cast("binary").alias("mask"))


def _send_contexts(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
    names = [c.split()[0] for c in _CONTEXTS.split(", ")]
    if not table.num_rows:
        return pa.table([pa.array([], t) for t in (*[pa.int64()] * 5, pa.int32(), pa.binary())], names)
    block = Block(table)
    seg, mixed = block.candidates(found)
    lead = block.leads(seg)
    row, first = seg.row[lead], seg.first[lead]
    start, size = block.at[row] + first, seg.last[lead] - first + WIDTH
    texts = [block.raw[s : s + z].tobytes() if m else None for s, z, m in zip(start.tolist(), size.tolist(), mixed[lead].tolist())]
    shape = seg.anchor[lead] - first | seg.last[lead] - first << 8 | block.has_id[row].astype(np.int64) << 16
    columns = [np.full(len(lead), key[0].as_py()), seg.gram[lead].view(np.int64), seg.context[lead].view(np.int64), block.ids[row], row << np.int64(40) | first, shape.astype(np.int32)]
    return pa.table([*map(pa.array, columns), pa.array(texts, pa.binary())], names)


def earlier_windows(raw: np.ndarray, start: np.ndarray, lead: np.ndarray, extra: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each context and window whether an equal window is in a context of lower rank; a row of REACH flags each.

    Contexts begin at `start` in raw, have their anchors `lead` bytes on and `extra` windows beside the first; those of
    different anchors never have equal windows, so all are sorted together.
    """
    n = len(start)
    out = np.zeros((n, REACH), bool)
    if not n:
        return out
    pre = lead % SYMBOL
    count = (extra + WIDTH - pre) // SYMBOL
    base = np.concatenate(([0], np.cumsum(count + 1)))[:-1]
    total = int((count + 1).sum())
    owner = np.repeat(np.arange(n), count)
    inside = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(count)))[:-1], count)
    at = start[owner] + pre[owner] + SYMBOL * inside
    value = np.zeros(len(owner), np.uint64)
    for k in range(SYMBOL):
        value = value << np.uint64(8) | raw[at + k].astype(np.uint64)
    symbols = np.ones(total + 1, np.int64)
    symbols[base[owner] + inside] = np.unique(value, return_inverse=True)[1] + 2
    symbols[-1] = 0
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    short, long = (WIDTH - SYMBOL + 1) // SYMBOL, WIDTH // SYMBOL
    classes = dict(zip((short, long), prefix_classes(symbols, order, (short, long))))
    who = np.repeat(np.arange(n), extra + 1)
    window = np.arange(len(who)) - np.repeat(np.concatenate(([0], np.cumsum(extra + 1)))[:-1], extra + 1)
    head = (pre[who] - window) % SYMBOL
    whole = (WIDTH - head) // SYMBOL
    tail = WIDTH - head - SYMBOL * whole
    symbol_at = base[who] + (window + head - pre[who]) // SYMBOL
    middle = np.where(whole == short, classes[short][symbol_at], classes[long][symbol_at])
    begin, finish = start[who] + window, start[who] + window + WIDTH
    left, right = np.zeros(len(who), np.uint64), np.zeros(len(who), np.uint64)
    for k in range(SYMBOL - 1):
        has = head > k
        left[has] = left[has] << np.uint64(8) | raw[begin[has] + k].astype(np.uint64)
        has = tail > k
        right[has] = right[has] << np.uint64(8) | raw[finish[has] - 1 - k].astype(np.uint64)
    place = rank[who]
    sort = np.lexsort((place, right, left, middle, head))
    fresh = np.ones(len(sort), bool)
    fresh[1:] = False
    for key in (head, middle, left, right):
        fresh[1:] |= key[sort[1:]] != key[sort[:-1]]
    least = place[sort][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    late = np.empty(len(sort), bool)
    late[sort] = place[sort] > least
    out[who, window] = late
    return out


def _compare_contexts(table: pa.Table) -> pa.Table:
    """Answers about contexts that are first in their blocks, with masks of windows that start earlier in other contexts."""
    block, gram, context, doc, place, shape = (table.column(c).to_numpy() for c in ("block", "gram", "context", "doc", "place", "shape"))
    lead, extra, has_id = (shape & 255).astype(np.int64), (shape >> 8 & 255).astype(np.int64), shape >> 16
    raw, at = tv.text_bytes(table.column("text"))
    order = np.lexsort((place, doc, has_id, context, gram))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (gram[order[1:]] != gram[order[:-1]]) | (context[order[1:]] != context[order[:-1]])
    firsts = order[fresh]  # the first place of each distinct context
    _, of, many = np.unique(gram[firsts], return_inverse=True, return_counts=True)
    mixed = firsts[many[of] > 1]
    masks = np.zeros((len(gram), REACH), bool)
    rank = np.empty(len(mixed), np.int64)
    rank[np.lexsort((place[mixed], doc[mixed], has_id[mixed]))] = np.arange(len(mixed))
    masks[mixed] = earlier_windows(raw, at[:-1][mixed], lead[mixed], extra[mixed], rank)
    own = np.sort(firsts)
    packed = [x.tobytes() if has else None for x, has in zip(np.packbits(masks[own], axis=1), masks[own].any(1).tolist())]
    columns = [block[own], np.zeros(len(own), np.int32), gram[own], context[own]]
    return pa.table([*map(pa.array, columns), pa.array(packed, pa.binary())], ["block", "kind", "gram", "context", "mask"])


def _answers(runs: Runs, lead: np.ndarray, found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(whether each lead is the first place of its context, its mask)."""
    rows = found.filter(pa.array(found.column("kind").to_numpy() == 0))
    gram, context = (np.concatenate((own, rows.column(c).to_numpy().view(np.uint64))) for c, own in (("gram", runs.gram[lead]), ("context", runs.context[lead])))
    late = np.arange(len(gram)) >= len(lead)
    order = np.lexsort((late, context, gram))
    at = np.flatnonzero(late[order])  # an answer stands behind its lead
    whose, answer = order[at - 1], order[at] - len(lead)
    first, masks = np.zeros(len(lead), bool), np.zeros((len(lead), REACH), bool)
    first[whose] = True
    has = np.asarray(rows.column("mask").is_valid())[answer]
    packed = np.frombuffer(b"".join(rows.column("mask").take(pa.array(answer[has])).to_pylist()), np.uint8).reshape(-1, -(-REACH // 8))
    masks[whose[has]] = np.unpackbits(packed, axis=1, count=REACH).astype(bool)
    return first, masks


def _remove(with_kept: bool):
    def over(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(table)
        seg, _ = block.candidates(found)
        lead = block.leads(seg)
        first, masks = _answers(seg, lead, found)
        base = block.at[seg.row]
        change = np.zeros(len(block.raw) + 1, np.int32)
        gone = np.ones(len(seg.row), bool)
        gone[lead[first]] = False
        np.add.at(change, base[gone] + seg.first[gone], 1)
        np.add.at(change, base[gone] + seg.last[gone] + WIDTH, -1)
        which, window = np.nonzero(masks)
        begin = base[lead[which]] + seg.first[lead[which]] + window
        np.add.at(change, begin, 1)
        np.add.at(change, begin + WIDTH, -1)
        removed = np.cumsum(change[:-1], dtype=np.int32) > 0
        del change
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        starts = block.at[:-1][block.at[:-1] < len(removed)]
        opens[starts] = removed[starts]
        counts = [np.diff(np.searchsorted(np.flatnonzero(x), block.at)) for x in (removed, opens)]
        kept = [block.raw[a:b][~removed[a:b]].tobytes() for a, b in zip(block.at[:-1].tolist(), block.at[1:].tolist())]
        columns = {
            "doc_id": block.table.column("doc_id"), "n_bytes": pa.array(np.diff(block.at)), "n_removed": pa.array(counts[0]), "n_spans": pa.array(counts[1]),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        if with_kept:
            columns["kept"] = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
            columns["extra"] = block.table.column("extra")
        return pa.table(columns)

    return over


def remove_repeats(docs: DataFrame, keep: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with keep also kept and extra.

    Texts are taken as UTF-8 bytes, nulls as empty.  Texts shorter than WIDTH lose nothing.  A string starts earlier in a
    document of smaller id, or earlier in the same one.  Rows without id stand first, in the order of hashes of their
    texts; rows repeated under one id are separate documents in the order of their texts, so all but the first lose what
    they share.  kept is the rest as text, without characters that lost only some of their bytes; extra holds the other
    columns of docs, whatever their names.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       *([F.struct(F.lit(1).alias("_one"), *(F.col(f"`{c}`") for c in others)).alias("extra")] if keep else []))
    rows = rows.withColumns({"has_id": F.col("doc_id").isNotNull().cast("int"), "place": F.coalesce("doc_id", F.xxhash64("text"))})
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // max(BLOCK_BYTES, min(MOST_BLOCK_BYTES, total // MANY_BLOCKS))))
    buckets = max(1, -(-total // BUCKET_BYTES))
    name, result, limit = f"citeloom_blocks_{uuid.uuid4().hex}", table_path(spark, "suffix-out"), "spark.sql.sources.bucketing.maxBuckets"
    held = spark.conf.get(limit)
    spark.conf.set(limit, str(max(int(held), blocks)))
    path = table_path(spark, "suffix-blocks")
    try:
        with scratch(spark):
            rows = rows.withColumn("block", F.pmod(F.xxhash64("has_id", "place"), F.lit(blocks)).cast("long"))
            rows.repartition(blocks, "block").write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(blocks, "block").saveAsTable(name)
            # the table stays bucketed by block, so texts do not move again
            table = spark.table(name)
            texts = table.select("block", "doc_id", "text", "has_id", "place")
            shared = materialize(_shared_anchors(texts.groupBy("block").applyInArrow(_send_anchors, _ANCHORS)), "suffix-anchors")
            contexts = texts.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_contexts, _CONTEXTS)
            contexts = contexts.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)))
            compared = materialize(contexts.groupBy("bucket").applyInArrow(_compare_contexts, _FOUND), "suffix-contexts")
            schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
            if keep:
                schema += f", kept string, extra {table.schema['extra'].dataType.simpleString()}"
            found = shared.union(compared)
            out = (table if keep else texts).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_remove(keep), schema)
            return materialize(out, "suffix-out", result)
    finally:
        spark.conf.set(limit, held)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, path)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated bytes removed from its texts; n_chars, if docs has it, is the new number of code points.

    Rows without id, repeated rows and null texts are as in remove_repeats; a null text comes back empty, and a text of
    which all bytes go stays as an empty one, so no row is lost.
    """
    rows = remove_repeats(docs, keep=True)
    columns = {c: F.col("extra").getField(c) for c in docs.columns if c not in ("doc_id", "text")}
    columns |= {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(columns[c].alias(c) for c in docs.columns))
