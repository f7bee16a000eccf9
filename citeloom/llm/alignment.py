"""Alignment of two tokenizers over the same texts.

A dangling-suffix transducer reads both token sequences of a text: its state is the side that leads and the bytes by which
it leads.  The other side's next token either shortens these bytes or takes the lead; an empty state closes a group.
Transitions are remembered by state and token.  Very long texts are read in parts, cut before a blank that both tokenizers
start a token with.

Links of a corpus are counted in blocks of documents: a block sends each pair of ids once, with the number of its documents
that hold it, and gets back the pair's count in the corpus.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.bpe import read_ranks
from citeloom.llm.common import materialize
from citeloom.llm.packing import token_ids

#: Tokens of both vocabularies begin at a blank that follows no blank and is followed by no white space.
BORDER = re.compile(r"(?<! )(?= \S)")
#: Characters after which a text is cut at the next border.
PART = 100_000
#: Characters of a stretch that the piece model encodes at a time, from one border to another: its time grows faster than a text.
STRETCH = 300
#: Transitions that a task remembers.
STEPS_KEPT = 500_000
#: Links of a group above which they are counted by distinct ids.
MANY_LINKS = 4096
#: Documents and bytes of text of a block.
BLOCK_DOCUMENTS, BLOCK_BYTES = 2_000, 8 << 20
ALIGNED = "block long, doc_id long, dictionary boolean, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, times binary"
#: Codes of a pair are the A id times this and the B id.
WIDTH = 1 << 32


class Transducer:
    """Groups of two token sequences with equal bytes; tokens are given by id, their bytes by a table for each side.

    States are numbers: 0 where no side leads, positive ones where A leads and negative ones where B does.
    """

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.width = max(len(bytes_a), len(bytes_b))
        place = {own: i for i, own in enumerate(bytes_b) if own}
        #: For each token of A the token of B with its bytes, or -1.
        self.twin = [place.get(own, -1) for own in bytes_a]
        self._forget()

    def _forget(self) -> None:
        self.residuals: list[bytes] = [b""]
        self.numbers: dict[tuple[bool, bytes], int] = {}
        self.after_a: dict[int, int] = {}
        self.after_b: dict[int, int] = {}

    def _state(self, a_leads: bool, residual: bytes) -> int:
        if not residual:
            return 0
        number = self.numbers.get((a_leads, residual))
        if number is None:
            number = len(self.residuals) if a_leads else -len(self.residuals)
            self.residuals.append(residual)
            self.numbers[a_leads, residual] = number
        return number

    def _after_a(self, state: int, token: int) -> int:
        own, residual = self.bytes_a[token], self.residuals[-state]
        after = self._state(False, residual[len(own) :]) if len(own) < len(residual) else self._state(True, own[len(residual) :])
        self.after_a[state * self.width - token] = after
        return after

    def _after_b(self, state: int, token: int) -> int:
        own, residual = self.bytes_b[token], self.residuals[state]
        after = self._state(True, residual[len(own) :]) if len(own) < len(residual) else self._state(False, own[len(residual) :])
        self.after_b[state * self.width + token] = after
        return after

    def ends(self, ids_a: list[int], ids_b: list[int]) -> np.ndarray:
        """Where each group ends in both sequences, a row for each; the sequences must stand for the same bytes."""
        if len(self.after_a) + len(self.after_b) > STEPS_KEPT:
            self._forget()
        after_a, after_b, twin, width = self.after_a, self.after_b, self.twin, self.width
        ends, i, j, n = [], 0, 0, len(ids_a)
        add = ends.append
        while i < n:
            token = ids_a[i]
            i += 1
            if twin[token] == ids_b[j]:  # to the empty state in two steps
                j += 1
                add(i << 32 | j)
                continue
            try:
                state = after_a[-token]
            except KeyError:
                state = self._after_a(0, token)
            while state:
                if state > 0:
                    token = ids_b[j]
                    j += 1
                    try:
                        state = after_b[state * width + token]
                    except KeyError:
                        state = self._after_b(state, token)
                else:
                    token = ids_a[i]
                    i += 1
                    try:
                        state = after_a[state * width - token]
                    except KeyError:
                        state = self._after_a(state, token)
            add(i << 32 | j)
        both = np.frombuffer(array("q", ends), np.int64)
        return np.stack([both >> 32, both & 0xFFFFFFFF], 1)


def _links(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of ids that share a group, and how often they do."""
    n, m = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    few = np.flatnonzero(n * m <= MANY_LINKS)
    first_a, first_b, wide, each = (ends_a - n)[few], (ends_b - m)[few], m[few], (n * m)[few]
    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    wide = np.repeat(wide, each)
    parts = [np.unique(a[np.repeat(first_a, each) + place // wide] * WIDTH + b[np.repeat(first_b, each) + place % wide], return_counts=True)]
    for k in np.flatnonzero(n * m > MANY_LINKS):
        (own_a, often_a), (own_b, often_b) = np.unique(a[ends_a[k] - n[k] : ends_a[k]], return_counts=True), np.unique(b[ends_b[k] - m[k] : ends_b[k]], return_counts=True)
        parts.append(((own_a[:, None] * WIDTH + own_b).ravel(), (often_a[:, None] * often_b).ravel()))
    return _added(parts)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, place, np.concatenate([t for _, t in parts]))
    return pairs, total


class Aligner:
    """Groups and links of texts, for a byte-level vocabulary A and a piece model B that adds a blank."""

    def __init__(self, ranks: str, pattern: str, model: str):
        import sentencepiece

        held = read_ranks(ranks)
        bytes_a = [b""] * (max(held.values()) + 1)
        for token, rank in held.items():
            bytes_a[rank] = token
        if any(bytes([x]) not in held for x in range(256)):
            raise ValueError("the rank file lacks a byte")
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("the model has pieces across blanks, so a long text can't be cut before one")
        bytes_b = [bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        self.encode_a, self.bytes_a, self.bytes_b, self.transducer = token_ids(ranks, pattern), bytes_a, bytes_b, Transducer(bytes_a, bytes_b)
        #: Each id as text with what may follow it, filled up with zero bytes.
        self.shown = np.array([f"{i}{mark}" for i in range(max(len(bytes_a), len(bytes_b))) for mark in ",|;"], "S")

    def _parts(self, text: str, most: int = PART) -> Iterator[str]:
        start = 0
        while len(text) - start > 2 * most and (cut := BORDER.search(text, start + most)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def _show(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
        """The ids of each group, A's before B's, with a mark after each."""
        codes = np.empty(len(a) + len(b), np.int64)
        n, m = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        codes[np.arange(len(a)) + np.repeat(ends_b - m, n)] = 3 * a
        codes[np.arange(len(b)) + np.repeat(ends_a, m)] = 3 * b
        codes[ends_a + ends_b - m - 1] += 1
        codes[ends_a + ends_b - 1] += 2
        return self.shown[codes].tobytes().translate(None, b"\0").decode()

    def text(self, text: str) -> tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]:
        """Counts, groups as text, and the sorted pairs with how often they are linked; all empty where bytes differ."""
        nothing = (0, 0, 0, 0), "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text or "▁" in text:  # B's sign for a blank stands for other bytes than its own
            return nothing
        counts, shown, links = np.zeros(4, np.int64), [], []
        for part in self._parts(" " + text):
            a, ids_b = self.encode_a(part).astype(np.int64), [i for own in self._parts(part, STRETCH) for i in self.pieces.encode(own[1:])]
            if b"".join(map(self.bytes_b.__getitem__, ids_b)) != part.encode():  # A has a token for each byte, so its tokens always match
                return nothing
            b = np.frombuffer(array("q", ids_b), np.int64)
            ends_a, ends_b = self.transducer.ends(a.tolist(), ids_b).T
            links.append(_links(a, b, ends_a, ends_b))
            shown.append(self._show(a, b, ends_a, ends_b))
            counts += len(a), len(b), len(ends_a), links[-1][1].sum()
        return tuple(counts.tolist()), "".join(shown)[:-1], *_added(links)


@lru_cache(maxsize=2)
def aligner(ranks: str, pattern: str, model: str) -> Aligner:
    """One for each pair of vocabularies in a worker."""
    return Aligner(ranks, pattern, model)


def _blocks(docs: DataFrame, ranks: str, pattern: str, model: str, id_column: str, text_column: str) -> DataFrame:
    """A row for each document, and for each block of documents its pairs in order and how many of its documents hold each."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        own = aligner(ranks, pattern, model)
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py() or ""
                held.append((batch.column(0)[k].as_py(), *own.text(text)))
                size += len(text)
                if len(held) >= BLOCK_DOCUMENTS or size >= BLOCK_BYTES:
                    yield _block(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _block(number, held)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(over, ALIGNED)


def _block(number: int, held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(x[3]) for x in held]
    pairs, place = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True)
    places = np.split(place.astype("<u4"), np.cumsum(sizes)[:-1])
    columns = {
        "block": pa.array([number] * (len(held) + 1), pa.int64()), "doc_id": pa.array([x[0] for x in held] + [None], pa.int64()),
        "dictionary": pa.array([False] * len(held) + [True]),
        **{name: pa.array([x[1][i] for x in held] + [0], pa.int64()) for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
        "groups": pa.array([x[2] for x in held] + [""], pa.string()),
        "links": pa.array([p.tobytes() for p in places] + [pairs.astype("<i8").tobytes()], pa.binary()),
        "times": pa.array([x[4].astype("<u4").tobytes() for x in held] + [np.bincount(place, minlength=len(pairs)).astype("<u4").tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def align_tokens(docs: DataFrame, ranks: str, pattern: str, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, groups.

    A blank and the text are encoded by the rank file (A) and the text by the piece model (B, which adds the blank), both
    without special tokens.  `groups` lists the ids between byte offsets where tokens of both end, as `a1,a2|b1;a3|b2,b3`;
    links are the pairs of an A and a B token of one group.  Null and empty texts, and those whose tokens stand for other
    bytes than the blank and the text, have no tokens: zeros and an empty string.  Ids of documents may be null or repeat;
    further columns are not read.
    """
    rows = _blocks(docs, ranks, pattern, model, id_column, text_column).where("not dictionary")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, links, times in zip(*(batch.column(k) for k in range(3))):
            pairs, n = np.frombuffer(links.as_py(), "<i8"), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
            for k in range(0, len(pairs), 50_000):
                own = pairs[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block.as_py())), pa.array(own), pa.array(n[k : k + 50_000])], ["block", "pair", "n"])


def _scored(_, docs: pa.Table, counted: pa.Table) -> pa.Table:
    """The documents of a block, with its pairs' counts in the order of the block's dictionary."""
    order = np.argsort(counted.column("pair").to_numpy())
    count, best = counted.column("count").to_numpy()[order], counted.column("best").to_numpy()[order]
    sums, bests = [], []
    for links, times in zip(docs.column("links"), docs.column("times")):
        at, n = np.frombuffer(links.as_py(), "<u4"), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
        sums.append(int((count[at] * n).sum()))
        bests.append(int(n[count[at] == best[at]].sum()))
    out = docs.drop_columns(["block", "links", "times"])
    return out.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def link_statistics(docs: DataFrame, ranks: str, pattern: str, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    The count of a pair of ids is the number of rows of docs in which it is linked; n_best counts a row's links whose count
    is the highest of their A id, ties included, and count_sum adds the counts of its links.  groups_sha256 is empty for
    rows without tokens.  Other cases are as in align_tokens.
    """
    rows = _blocks(docs, ranks, pattern, model, id_column, text_column)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    held = materialize(rows.select("block", "doc_id", "dictionary", "n_a", "n_b", "n_groups", "n_links", digest, "links", "times"), "aligned")
    entries = held.where("dictionary").select("block", "links", "times").mapInArrow(_entries, "block long, pair long, n long")
    entries = materialize(entries, "link-entries")
    totals = materialize(entries.groupBy("pair").agg(F.sum("n").alias("count")), "link-totals")
    side = F.shiftright("pair", 32).alias("a")
    best = totals.groupBy(side).agg(F.max("count").alias("best"))  # a row for each id of the vocabulary at most
    counted = entries.select("block", "pair").join(totals, "pair").withColumn("a", side).join(F.broadcast(best), "a").select("block", "pair", "count", "best")
    own = held.where("not dictionary").drop("dictionary")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return own.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_scored, schema)
