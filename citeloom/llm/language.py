"""Language identification of spans: per-word scores, narrowed by script, joined by Viterbi with a switching penalty.

A word's score under a language is the sum of the log probabilities of its bytes given the two before them, from counts
of a labelled sample.  Languages that never showed a word's script in training are no candidates for the word.  The best
sequence of labels of a text pays a penalty for each switch; a text's language is the one that labels most of its letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import textvec as tv
from citeloom.llm.common import held_out

BITS = 16
#: The model is fitted on at most so many labelled rows, those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
#: The languages that are learnt: those of most rows of the sample, then by name.  With the fixed size of a table it bounds
#: the model, and what the driver gets, at 64 MB.
MOST_LANGUAGES = 256
PENALTY = 12.0
SLICE = 4 << 20
#: Scripts by the first byte of a UTF-8 character (ranges of lead bytes); 1 is Latin, 0 none.
SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew_arabic", "indic_thai", "kana_cjk_marks", "han", "hangul", "other")
_LEADS = ((0x41, 0x5B, 1), (0x61, 0x7B, 1), (0xC3, 0xCE, 1), (0xCE, 0xD0, 2), (0xD0, 0xD5, 3), (0xD5, 0xD6, 9), (0xD6, 0xDF, 4), (0xE0, 0xE1, 5), (0xE1, 0xE2, 9), (0xE3, 0xE4, 6), (0xE4, 0xEA, 7), (0xEA, 0xEE, 8))
_SCRIPT = np.zeros(256, np.int8)
for _lo, _hi, _code in _LEADS:
    _SCRIPT[_lo:_hi] = _code
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII_LETTER = np.zeros(256, np.int64)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[65:91] = _LETTER[97:123] = 1
_LETTER[0xC2:] = 1


def _grams(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """At each byte the hash of it and of the two bytes before it, white space being one sign and rows starting with it."""
    low = _LOWER[raw]
    low[tv.lookup(tv.SPACES)[raw]] = 32
    one = np.concatenate((np.array([32], np.uint8), low[:-1]))
    two = np.concatenate((np.array([32, 32], np.uint8), low[:-2]))[: len(low)]
    starts = at[:-1][at[:-1] < len(raw)]
    one[starts], two[starts] = 32, 32
    two[starts[starts + 1 < len(raw)] + 1] = 32
    word = low.astype(np.uint32) | one.astype(np.uint32) << np.uint32(8) | two.astype(np.uint32) << np.uint32(16)
    return (word * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


@dataclass
class LanguageModel:
    names: list[str]
    #: log probabilities, one row for each language
    table: np.ndarray
    #: whether a language showed a script
    uses: np.ndarray

    def word_scores(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores by word and language, row, letters) of each word."""
        _, row, start, end = tv.words(raw, at, lower=False)
        if not len(row):
            return np.zeros((0, len(self.names)), np.float32), row, np.zeros(0, np.int64)
        gram = _grams(raw, at)
        spans = np.column_stack((start, end)).ravel()
        if spans[-1] == len(raw):
            spans = spans[:-1]
        score = np.stack([np.add.reduceat(t[gram], spans)[::2] for t in self.table], 1)
        letters = np.add.reduceat(_LETTER[raw], spans)[::2]
        script = np.maximum.reduceat(_SCRIPT[raw], spans)[::2]
        allowed = self.uses[:, script].T
        allowed[~allowed.any(1)] = True
        score[~allowed] -= 1000.0
        score[letters == 0] = 0  # numbers and signs follow their neighbours
        return score, row, letters


def viterbi(score: np.ndarray, row: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The label of each word on the best path of its row; all rows advance together, longest first."""
    label = np.zeros(len(row), np.int64)
    if not len(row):
        return label
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    size = np.diff(np.append(first, len(row)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    alive = np.searchsorted(-size, -np.arange(size[0] + 1), "left")  # rows with more than t words
    back = np.zeros(score.shape, np.int16)
    own = np.arange(score.shape[1], dtype=np.int16)
    current = np.zeros(len(first), np.int64)
    value = score[first].astype(np.float64)
    for t in range(1, size[0] + 1):
        n = alive[t]
        if n < len(value):  # the rows that ended before t
            current[n : len(value)] = value[n:].argmax(1)
            value = value[:n]
        if n:
            best = value.argmax(1)
            top = (value[np.arange(n), best] - penalty)[:, None]
            at = first[:n] + t
            back[at] = np.where(value < top, best[:, None], own)
            value = np.maximum(value, top) + score[at]
    for t in range(size[0] - 1, -1, -1):
        n = alive[t]
        at = first[:n] + t
        label[at] = current[:n]
        if t:
            current[:n] = back[at, current[:n]]
    return label


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, languages: int = MOST_LANGUAGES) -> LanguageModel:
    """Count byte trigrams and scripts by language over labelled rows outside the held-out fold.

    Values of lang beyond the number of languages are not learnt, so a column of very many values can't fill the driver.
    """
    size = (1 << BITS) + 16

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, j, raw, at in tv.slices(batch.column(1)):
                gram, script = _grams(raw, at), _SCRIPT[raw]
                for k in range(i, j):
                    a, b = at[k - i], at[k - i + 1]
                    held = counts.setdefault(names[k], np.zeros(size, np.uint32))
                    held[: 1 << BITS] += np.bincount(gram[a:b], minlength=1 << BITS).astype(np.uint32)
                    held[1 << BITS :] += np.bincount(script[a:b], minlength=16).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([x.tobytes() for x in counts.values()], pa.binary())], ["lang", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums.setdefault(name, np.zeros(size, np.uint64))[:] += np.frombuffer(counts, np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([x.astype(np.float32).tobytes() for x in sums.values()], pa.binary())], ["lang", "counts"])

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    sample = known.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # the sample has a fixed bound, so it may be sent to every executor
    rows = known.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").join(F.broadcast(sample), "doc_id", "left_semi").select("lang", "text")
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()  # a bounded number of names
    rows = rows.where(F.col("lang").isin([r["lang"] for r in most]))
    sums = rows.mapInArrow(over, "lang string, counts binary").repartition("lang").mapInArrow(total, "lang string, counts binary")
    return fit({r["lang"]: np.frombuffer(r["counts"], np.float32).astype(np.float64) for r in sums.collect()})  # a table for each of a bounded number


def fit(counts: dict[str, np.ndarray]) -> LanguageModel:
    names = sorted(counts)
    table = np.zeros((len(names), 1 << BITS), np.float32)
    uses = np.zeros((len(names), 16), bool)
    for k, name in enumerate(names):
        gram, script = counts[name][: 1 << BITS], counts[name][1 << BITS :]
        table[k] = np.log((gram + 0.5) / (gram.sum() + 0.5 * (1 << BITS)))
        uses[k] = script > 0.001 * max(1.0, script[1:].sum())
        uses[k, 0] = True
    return LanguageModel(names, table, uses)


def label_spans(docs: DataFrame, model: LanguageModel, penalty: float = PENALTY) -> DataFrame:
    """One row for each row of docs: doc_id, lang_pred, score, spans (lang, words) in order of the text.

    lang_pred is `und`, with score 0 and no spans, where the text is null or has no letter, or where the model knows no
    language; score is the share of the text's letters in spans of lang_pred.  Ties go to the first language by name.
    Ids may be null or repeat; further columns are not read.
    """
    spans_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model.names
        for batch in batches:
            for i, j, raw, at in tv.slices(batch.column(1), SLICE):
                n = j - i
                pred, share, spans = ["und"] * n, np.zeros(n), [[] for _ in range(n)]
                if names:
                    score, row, letters = model.word_scores(raw, at)
                    label = viterbi(score, row, penalty)
                    mass = np.bincount(row * len(names) + label, letters, n * len(names)).reshape(n, len(names))
                    total, best = mass.sum(1), mass.argmax(1)
                    ascii_letters = np.diff(np.concatenate(([0], np.cumsum(_ASCII_LETTER[raw])))[at])
                    for k in np.flatnonzero((ascii_letters == 0) & (total > 0)):  # signs beyond ASCII may be no letters
                        if not any(map(str.isalpha, raw[at[k] : at[k + 1]].tobytes().decode("utf-8", "replace"))):
                            total[k] = 0
                    share = np.where(total > 0, mass.max(1) / np.maximum(total, 1), 0.0)
                    pred = [names[b] if t > 0 else "und" for b, t in zip(best, total)]
                    edge = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (label[1:] != label[:-1])))) if len(row) else np.zeros(0, int)
                    for a, b in zip(edge, np.append(edge[1:], len(row))):
                        if total[row[a]] > 0:
                            spans[row[a]].append({"lang": names[label[a]], "words": int(b - a)})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(pred), pa.array(share), pa.array(spans, spans_type)], ["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(over, "doc_id long, lang_pred string, score double, spans array<struct<lang:string,words:long>>")
