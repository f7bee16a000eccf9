"""Quality classifier: a linear support vector model over n-gram indicators scaled by class log-count ratios.

An indicator says that an n-gram occurs in a text: words, pairs of words, and runs of up to three word shapes.  A shape
keeps punctuation, writes each run of letters or digits as one sign, and marks a word that repeats the one before it.
Indicators are scaled by the log ratio of their smoothed frequencies in the two classes, rows are normalised, and the
hinge loss is minimised by dual coordinate descent.  Margins of held-back folds of the sample calibrate the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm import textvec as tv
from citeloom.llm.common import held_out, materialize

BITS = 18
#: The model is fitted on at most so many labelled rows, those with the smallest hashes of their ids.
SAMPLE_ROWS = 8000
#: And of these on as many, in that order, as have distinct n-grams of so many bytes (four each): what the task that fits it gets.
SAMPLE_BYTES = 64 << 20
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


def features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row) of the distinct n-grams of each row."""
    n = len(at) - 1
    hashed, row, start, end = tv.words(raw, at, lower=False)
    shape = _SHAPE[raw]
    keep = np.ones(len(shape), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | ~np.isin(shape[1:], (97, 65, 48))
    keep[start] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    shapes, _, _, _ = tv.words(shape[keep], before[at], lower=False)
    again = np.zeros(len(hashed), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
    shapes = tv.mix(shapes + again.astype(np.uint64))
    grams, rows = [hashed, shapes + np.uint64(1)], [row, row]
    for source, size, tag in ((hashed, 2, 2), (shapes, 2, 3), (shapes, 3, 4)):
        if len(source) >= size:
            whole = row[: len(row) - size + 1] == row[size - 1 :]
            keys = tv.salt(size, 30 + tag)
            grams.append(sum(source[k : len(source) - size + 1 + k] * keys[k] for k in range(size))[whole] + np.uint64(tag))
            rows.append(row[: len(row) - size + 1][whole])
    feature = (tv.mix(np.concatenate(grams)) >> np.uint64(64 - BITS)).astype(np.int64)
    both = np.concatenate(rows) << np.int64(BITS) | feature
    both.sort()
    both = both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both
    return both & ((1 << BITS) - 1), both >> np.int64(BITS)


@dataclass
class QualityModel:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float
    #: False where the labels had no two classes to tell apart, and all scores are one constant.
    learnt: bool = True

    def margins(self, feature: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        value = np.bincount(row, self.weight[feature] * self.ratio[feature], n)
        norm = np.sqrt(np.bincount(row, self.ratio[feature].astype(float) ** 2, n))
        return value / np.maximum(norm, 1e-9) + self.bias

    def scores(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], label: np.ndarray, smooth: float = 1.0, least: int = 3) -> np.ndarray:
    counts = np.full((2, 1 << BITS), smooth)
    for x, y in zip(rows, label):
        counts[int(y), x] += 1
    rare = counts.sum(0) < 2 * smooth + least
    sizes = np.bincount(label.astype(int), minlength=2) + 2 * smooth
    ratio = np.log(counts[1] / sizes[1]) - np.log(counts[0] / sizes[0])
    ratio[rare] = 0
    return ratio


def dual_descent(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, cost: float = 1.0, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the hinge loss, one dual variable in [0, cost] at a time."""
    sign = np.where(label > 0, 1.0, -1.0)
    values = [ratio[x] / max(np.sqrt((ratio[x] ** 2).sum()), 1e-9) for x in rows]
    square = np.array([(v * v).sum() + 1.0 for v in values])
    weight, bias, dual = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = sign[i] * (weight[x] @ v + bias) - 1
            new = min(max(dual[i] - gradient / square[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                most = max(most, abs(new - dual[i]))
                dual[i] = new
                weight[x] += step * v
                bias += step
        if most < 1e-3:
            break
    return weight, bias


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with the usual smoothed targets, by Newton steps."""
    pos, neg = int((label > 0).sum()), int((label <= 0).sum())
    target = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = p * (1 - p)
        hessian = np.array([[(h * margin * margin).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], label: np.ndarray) -> QualityModel:
    if not len(rows) or label.min() == label.max():  # nothing to tell apart: a constant score
        share = 0.5 if not len(rows) else float(label.max())
        return QualityModel(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 0.0, 30.0 * (2 * share - 1), learnt=False)
    margin = np.zeros(len(rows))
    fold = np.arange(len(rows)) % 3
    for k in range(3):
        inside = np.flatnonzero(fold != k)
        if label[inside].min() == label[inside].max():
            continue
        own = [rows[i] for i in inside]
        ratio = log_count_ratios(own, label[inside])
        weight, bias = dual_descent(own, label[inside], ratio)
        for i in np.flatnonzero(fold == k):
            v = ratio[rows[i]]
            margin[i] = weight[rows[i]] @ v / max(np.sqrt((v * v).sum()), 1e-9) + bias
    slope, shift = _calibrate(margin, label)
    ratio = log_count_ratios(rows, label)
    weight, bias = dual_descent(rows, label, ratio)
    return QualityModel(ratio.astype(np.float32), weight.astype(np.float32), float(bias), max(slope, 0.0), shift)


MODEL = "ratio binary, weight binary, bias double, slope double, shift double, learnt boolean"


def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows (doc_id, quality, features) of a task, in one row."""
    held = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    label = np.array([y for _, y, _ in held])
    model = fit([np.frombuffer(x, "<u4").astype(np.int64) for _, _, x in held], label)
    row = {"ratio": model.ratio.tobytes(), "weight": model.weight.tobytes(), "bias": model.bias, "slope": model.slope, "shift": model.shift, "learnt": model.learnt}
    yield pa.RecordBatch.from_pylist([row], pa.schema([("ratio", pa.binary()), ("weight", pa.binary()), ("bias", pa.float64()), ("slope", pa.float64()), ("shift", pa.float64()), ("learnt", pa.bool_())]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> QualityModel:
    """Fit on labelled rows outside the held-out fold; their distinct features, of a bounded size, go to one task, and the model to the driver.

    Of several labels of an id the lowest counts; rows that repeat an id are learnt each.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, raw, at in tv.slices(batch.column(2)):
                feature, row = features(raw, at)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                packed = [feature[cut[k] : cut[k + 1]].astype("<u4").tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(packed, pa.binary())], ["doc_id", "quality", "features"])

    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample has a fixed bound, so it may be sent to every executor
    rows = text.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text").mapInArrow(over, "doc_id long, quality int, features binary")
    rows = materialize(rows.withColumn("name", F.xxhash64("features")), "quality-features")
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "name").rowsBetween(Window.unboundedPreceding, 0)
    sizes = rows.groupBy("doc_id", "name").agg(F.sum(F.octet_length("features")).alias("bytes"))  # a few bytes for each row of the sample
    within = sizes.withColumn("bytes", F.sum("bytes").over(before)).where(F.col("bytes") <= sample_bytes).select("doc_id", "name")
    held = rows.join(F.broadcast(within), ["doc_id", "name"], "left_semi").select("doc_id", "quality", "features")
    row = held.repartition(1).mapInArrow(fitted, MODEL).first()  # none if no row is labelled
    if row is None:
        return fit([], np.zeros(0))
    return QualityModel(np.frombuffer(row["ratio"], np.float32), np.frombuffer(row["weight"], np.float32), row["bias"], row["slope"], row["shift"], row["learnt"])


def score_quality(docs: DataFrame, model: QualityModel, cutoff: float = 0.7) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted (1 if score >= cutoff).

    A null or empty text has no n-grams and gets the score of the bias alone.  Ids may be null or repeat; further
    columns are not read.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0)]
            for i, j, raw, at in tv.slices(batch.column(1)):
                found.append(model.scores(model.margins(*features(raw, at), j - i)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(over, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cutoff: float = 0.7) -> DataFrame:
    """The rows of docs that the classifier accepts, with all their columns; no row moves.

    Each row is judged by its own text, so rows that repeat an id or a text, and rows without id, stay or go each; a null
    text is judged as an empty one, by the bias alone.  An empty table gives no rows.
    Where nothing could be learnt, as the labels outside the held-out fold lack one class or both, all rows stay.
    """
    model, text = train(docs, labels), docs.columns.index("text")
    if not model.learnt:
        return docs

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(model.margins(*features(raw, at), j - i)) for i, j, raw, at in tv.slices(batch.column(text))]
            keep = pa.array(np.concatenate(found) >= cutoff if found else np.zeros(0, bool))
            yield batch.filter(keep)

    return docs.mapInArrow(over, docs.schema)
