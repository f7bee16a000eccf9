"""Byte-level BPE encoding of a text column and decoding back to the same bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.bpe import encoder


def texts_of(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[int, str]]:
    """(row, text) without building the whole batch's strings at once; null is empty."""
    values = batch.column(column)
    for i in range(len(values)):
        yield i, values[i].as_py() or ""


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers in a binary).

    The ids are those of byte-pair merges in rank order within each match of the pattern, without special tokens.  A null
    or empty text has no ids.  Ids of documents may be null or repeat; further columns are not read.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, texts = encoder(vocabulary, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [texts.encode(text) for _, text in texts_of(part)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(over, "doc_id long, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The columns of encode_texts and the bytes that its ids stand for, null for null."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, _ = encoder(vocabulary, pattern)
        for batch in batches:
            out = [None if x is None else exact.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(over, "doc_id long, n_tokens long, ids binary, decoded binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Digests of the ids and of what they decode to: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode_ids(encode_texts(docs, vocabulary, pattern), vocabulary, pattern)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def sha256(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()
