"""Exact dedup: a cuckoo-filter index over digests of normalised texts.

Texts are equal when identical after deleting every ASCII white-space character.  Each scan task keeps a cuckoo index of
the digests that it holds, so that copies collapse before anything moves; the survivors are dealt by digest, and one
index for each partition settles the global winner.  A group of copies therefore sends one row per scan task at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import keep_rows, materialize, own_text
from citeloom.llm.textvec import SPACES


class CuckooIndex:
    """A cuckoo filter of live digests in front of the records that it stands for.

    The filter holds one 16-bit tag for each live digest in one of two buckets of four slots.  A lookup whose tag is in
    neither bucket is a certain miss; a hit is verified against the records of its bucket, which are filed under the
    digest's first bucket, by the whole digest.  Where an insertion finds no place after many evictions, the filter
    doubles and is filled again from the stored digests.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 1024):
        self.size = 0
        self.resizes = 0
        self._shape(buckets)
        self.records: dict[int, dict[bytes, list]] = {}

    def _shape(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.tags: list[list[int]] = [[] for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return tag, first, first ^ (tag * 0x5BD1E995 & self.mask)

    def get(self, digest: bytes) -> list | None:
        tag, first, second = self._places(digest)
        if tag not in self.tags[first] and tag not in self.tags[second]:
            return None
        return self.records.get(first, {}).get(digest)

    def _place(self, digest: bytes) -> bool:
        tag, first, second = self._places(digest)
        for at in (first, second):
            if len(self.tags[at]) < self.SLOTS:
                self.tags[at].append(tag)
                return True
        at = second
        for kick in range(self.KICKS):
            tag, self.tags[at][kick % self.SLOTS] = self.tags[at][kick % self.SLOTS], tag
            at ^= tag * 0x5BD1E995 & self.mask
            if len(self.tags[at]) < self.SLOTS:
                self.tags[at].append(tag)
                return True
        return False

    def insert(self, digest: bytes, record: list) -> None:
        """Add a digest that is not live."""
        self.records.setdefault(self._places(digest)[1], {})[digest] = record
        self.size += 1
        if not self._place(digest):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        """Remove a live digest; False if there is none."""
        tag, first, second = self._places(digest)
        if self.get(digest) is None:
            return False
        del self.records[first][digest]
        self.size -= 1
        self.tags[first if tag in self.tags[first] else second].remove(tag)
        return True

    def _resize(self) -> None:
        stored = list(self.items())
        while True:
            self.resizes += 1
            self._shape(2 * (self.mask + 1))
            if all(self._place(digest) for digest, _ in stored):
                break
        self.records = {}
        for digest, record in stored:
            self.records.setdefault(self._places(digest)[1], {})[digest] = record

    def items(self) -> Iterator[tuple[bytes, list]]:
        for bucket in self.records.values():
            yield from bucket.items()


DIGESTS = "doc_id long, own long, n_chars long, digest binary"
GROUPS = "digest binary, keep_chars long, keep_id long, keep_own long, group_size long"
#: Digests of one index, both of those that a scan task holds at a time and, about, of those dealt to one partition.
INDEX_DIGESTS = 250_000
#: A text with at least so many copies, and a thousandth of all rows, is hot; so there are a thousand hot ones at most.
HOT_COPIES, HOT_SHARE = 5_000, 1_000


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, own, code points of the text and SHA-256 of the text without ASCII white space."""
    for batch in batches:
        column = batch.column(2).cast(pa.large_binary())
        digests, sizes = [], []
        for i in range(len(column)):
            raw = column[i].as_py() or b""
            sizes.append(len(raw) if raw.isascii() else len(raw.decode("utf-8", "replace")))
            digests.append(hashlib.sha256(raw.translate(None, SPACES)).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "own", "n_chars", "digest"])


def _better(row: tuple, record: list) -> bool:
    """More code points, then the smaller id, a missing one last, then the smaller hash of the text as it stands."""
    rank = lambda chars, doc, own: (chars, doc is not None, -(doc or 0), -own)
    return rank(*row) > rank(*record[:3])


def _collapse(rows: Iterator[tuple[bytes, int, int | None, int, int]], flush: bool) -> Iterator[pa.RecordBatch]:
    """(digest, chars, doc, own, size) summed by digest; with flush the index is emptied whenever it is full."""
    index = CuckooIndex()
    for digest, *row, size in rows:
        held = index.get(digest)
        if held is None:
            if flush and index.size >= INDEX_DIGESTS:
                yield from _out(index)
                index = CuckooIndex()
            index.insert(digest, [*row, size])
        elif _better(row, held):
            index.delete(digest)
            index.insert(digest, [*row, held[3] + size])
        else:
            held[3] += size
    yield from _out(index)


def _out(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
    chunk = []
    for digest, record in index.items():
        chunk.append((digest, *record))
        if len(chunk) == 20_000:
            yield _batch(chunk)
            chunk = []
    yield _batch(chunk)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.binary(), *([pa.int64()] * 4)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "keep_chars", "keep_id", "keep_own", "group_size"])


def _collapse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collapse(((d, c, i, o, 1) for b in batches for i, o, c, d in zip(*(b.column(k).to_pylist() for k in range(4)))), flush=True)


def _collapse_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collapse((row for b in batches for row in zip(*(b.column(k).to_pylist() for k in range(5)))), flush=False)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_chars, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id.  A null text counts as empty, so all
    empty and white-space texts are one group.  A null id is kept only where its group has no other id of that length;
    rows repeated under one id are all counted, and all of them are kept if that id is.  Empty tables give no rows;
    further columns of docs are not read.
    """
    rows = _judged(docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")))
    return rows.select("doc_id", "n_chars", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, own, n_chars, digest of each row and the keep_id, keep_own and group_size of its group.

    The rows of hot texts meet their groups, a thousand at most, where they are; no task gets all copies of a text.
    """
    spark = docs.sparkSession
    rows = materialize(docs.select("doc_id", own_text(docs).alias("own"), "text").mapInArrow(_digests, DIGESTS), "exact-digests")
    total = rows.count()
    # as many partitions as the digests need, and as the cluster can use for few of them
    parts = max(-(-total // INDEX_DIGESTS), min(spark.sparkContext.defaultParallelism, -(-total // 20_000)), 1)
    groups = materialize(rows.mapInArrow(_collapse_rows, GROUPS).repartition(parts, "digest").mapInArrow(_collapse_groups, GROUPS).drop("keep_chars"), "exact-groups")
    hot = F.broadcast(groups.where(F.col("group_size") >= max(HOT_COPIES, total // HOT_SHARE)))
    few = rows.join(hot.select("digest"), "digest", "left_anti").join(groups, "digest")
    return few.unionByName(rows.join(hot, "digest"))


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """One row of docs for each text, with all its columns: the row that exact_dedup keeps.

    A row goes by its id and text, so another text under the same id stays, and rows without id are copies like others.
    Of rows of one text with one id and as many code points, that with the smallest hash of its text stays; of rows that
    repeat id and text one stays, with the other columns of any of them.
    """
    judged = _judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("own").eqNullSafe(F.col("keep_own"))
    return keep_rows(docs, judged.select("doc_id", "own", kept.alias("kept"), F.lit(True).alias("single")))
