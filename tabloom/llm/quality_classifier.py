"""Quality classifier: ordinal regression with cumulative logits on hashed text.

A grade y in 0 .. K-1 has P(y > j) = sigmoid(score - threshold_j): one weight vector for all
grades, and ordered thresholds. The score of a text is the sum of the weights of its hashed
features, each counted once: its words (runs of letters, digits and characters beyond ASCII, in
lower case), how many there are, how often they repeat, how dense each punctuation character is,
and how long the lines are.

The model is fitted on at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of their
key; that bound is a parameter. All documents are scored where they are, with the weights sent
out (``DIMENSION`` numbers). The expected grade is the sum of the tail probabilities, and
P(y >= top grade) selects documents.

Defined cases: missing labels and labels without a document are left out; repeated labels all
count; a missing or empty text, or one without any feature, has grade and probability 0 and is
not kept; without labelled rows grade and probability are missing and every document is kept;
with a single grade all texts get it. Only the key and the results are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import bytetext, text
from tabloom.plans.catalog import Catalog

CATALOG = Catalog()

DIMENSION = 1 << 18
TRAIN_ROWS = 20_000
KEEP_FROM = 0.6
EPOCHS = 100
LEAST_Z = 5.0
_BATCH = 256
_RATE = 0.02
_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 48) & (_BYTES < 58)) | ((_BYTES >= 97) & (_BYTES < 123)) | (_BYTES >= 128)
_LOWER = np.where((_BYTES >= 65) & (_BYTES < 91), _BYTES + 32, _BYTES).astype(np.uint8)
_MARK = ~_LETTER & (_BYTES > 32) & (_BYTES < 127)


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk: first and last row, and row (from ``first``) and slot of every distinct feature."""
    for words in bytetext.chunks(column, ~_LETTER, _LOWER):
        slots = (words.hashes(5) % np.uint64(DIMENSION)).astype(np.int64)
        both, times = np.unique(words.rows() * DIMENSION + slots, return_counts=True)
        parts = [both]
        for row, name in _form(words, both // DIMENSION, times):
            named = bytetext.mix(name.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
            parts.append(row * DIMENSION + (named % np.uint64(DIMENSION)).astype(np.int64))
        both = np.unique(np.concatenate(parts))
        yield words.first, words.last, both // DIMENSION, both % DIMENSION


def _form(words: bytetext.Words, row_of: np.ndarray, times: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and names of features of form, from the words' rows and how often each distinct one occurs."""
    n = words.last - words.first
    count = np.diff(words.bounds)
    rows = np.flatnonzero(count)
    distinct, most = np.bincount(row_of, minlength=n)[rows], np.zeros(n, np.int64)
    np.maximum.at(most, row_of, times)
    total = count[rows]
    yield rows, 20 * distinct // total
    yield rows, 100 + 20 * most[rows] // total
    yield rows, 200 + np.log2(total).astype(np.int64)
    data = words.data[:-8]
    at = np.flatnonzero(_MARK[data] | ((data == 10) & np.repeat(count > 0, np.diff(words.offsets))))
    both, found = np.unique((np.searchsorted(words.offsets, at, "right") - 1) * 256 + data[at], return_counts=True)
    row, mark = both // 256, both % 256
    density = np.round(2 * np.log2(found / np.maximum(count[row], 1))).astype(np.int64)
    yield row, mark * 1000 + density + 500  # per mark; line feeds tell how long lines are


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(y > j) for every threshold j, one row per score."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def telling(rows: list[np.ndarray], grades: np.ndarray, least: float = LEAST_Z) -> np.ndarray:
    """Which slots go with a grade more than chance explains (normal score of a count at any threshold)."""
    flat, owner = np.concatenate(rows), np.repeat(grades, [len(r) for r in rows])
    n = np.bincount(flat, minlength=DIMENSION)
    found = np.zeros(DIMENSION, bool)
    for j in range(int(grades.max())):
        p = (grades > j).mean()
        above = np.bincount(flat, owner > j, DIMENSION)
        found |= np.abs(above - n * p) >= least * np.sqrt(n * p * (1 - p) + 1e-9)
    return found & (n >= 5)


def fit(rows: list[np.ndarray], grades: np.ndarray, *, epochs: int = EPOCHS, seed: int = 3) -> Model:
    """Maximum likelihood with a small penalty, by gradient steps over mini-batches.

    ``rows`` hold feature slots. Only telling slots get a weight: most words are rare, and
    together they would explain the training rows by heart.
    """
    top = int(grades.max())
    share = np.array([(grades > j).mean() for j in range(top)]).clip(1e-3, 1 - 1e-3)
    thresholds = np.log(1 - share) - np.log(share)
    weights = np.zeros(DIMENSION)
    if not top:
        return Model(weights, thresholds)
    used = telling(rows, grades)
    rows = [r[used[r]] for r in rows]
    order = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = _RATE * 0.5 * (1 + np.cos(np.pi * epoch / epochs))  # falls to nothing, so the end is settled
        shuffled = order.permutation(len(rows))
        for start in range(0, len(rows), _BATCH):
            batch = shuffled[start : start + _BATCH]
            slots = np.concatenate([rows[i] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
            by_score, by_threshold = _slopes(np.bincount(owner, weights[slots], len(batch)), thresholds, grades[batch])
            step = np.bincount(slots, by_score[owner], DIMENSION)
            weights += rate * (step - weights * (len(batch) / len(rows)))
            thresholds = np.sort(thresholds + 0.15 * rate * by_threshold)
    return Model(weights, thresholds)


def _slopes(score: np.ndarray, thresholds: np.ndarray, grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the log likelihood by each score and by each threshold (summed)."""
    tails = _sigmoid(score[:, None] - thresholds[None, :])
    n = len(score)
    upper = np.column_stack((np.ones(n), tails))[np.arange(n), grades]  # P(y >= grade)
    lower = np.column_stack((tails, np.zeros(n)))[np.arange(n), grades]  # P(y > grade)
    mass = np.maximum(upper - lower, 1e-9)
    up, low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
    by_threshold = np.zeros(len(thresholds))
    np.add.at(by_threshold, grades[grades > 0] - 1, -up[grades > 0])
    below = grades < len(thresholds)
    np.add.at(by_threshold, grades[below], low[below])
    return up - low, by_threshold


def training_rows(docs: DataFrame, graded: DataFrame, *, body: str, bound: int) -> DataFrame:
    """``key``, ``grade`` and packed feature slots of the chosen labelled rows.

    Fewer keys than the bound are sent to the documents, not the other way round.
    """
    total = graded.count()
    chosen = graded.filter(text.unit_hash(11, F.col("key")) * F.lit(float(max(total, 1))) < F.lit(float(bound)))
    joined = docs.select(F.col("key"), F.col(body).alias("body")).join(F.broadcast(chosen), "key")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, row, slot in features(batch.column(1)):
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                packed = [slot[a:b].astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                own = [batch.column(i).slice(first, last - first) for i in (0, 2)]
                yield pa.record_batch([*own, pa.array(packed, pa.binary())], ["key", "grade", "slots"])

    return joined.select("key", "body", "grade").mapInArrow(task, "key long, grade int, slots binary")


def score(docs: DataFrame, model: Model, *, body: str, keep_from: float = KEEP_FROM) -> DataFrame:
    """``key``, ``expected_grade``, ``p_top`` and ``kept``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for first, last, row, slot in features(batch.column(1)):
                n = last - first
                has = np.bincount(row, minlength=n) > 0
                tails = own.tails(np.bincount(row, own.weights[slot], n))
                expected = np.where(has, tails.sum(axis=1), 0.0)
                top = np.where(has, tails[:, -1] if tails.shape[1] else 1.0, 0.0)
                arrays = [pa.array(expected), pa.array(top), pa.array(top >= keep_from)]
                yield pa.record_batch(
                    [batch.column(0).slice(first, n), *arrays], ["key", "expected_grade", "p_top", "kept"]
                )

    narrow = docs.select("key", F.col(body).alias("body"))
    return narrow.mapInArrow(task, "key long, expected_grade double, p_top double, kept boolean")


def classify(
    docs: DataFrame,
    graded: DataFrame,
    *,
    key: str = "doc_id",
    body: str = "text",
    grade: str = "grade",
    bound: int = TRAIN_ROWS,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """``key``, ``expected_grade``, ``p_top`` and ``kept``, one row per row of ``docs``."""
    text.bound_batches(docs.sparkSession)
    keyed = docs.select(F.col(key).cast("long").alias("key"), F.col(body).alias(body))
    labels = graded.select(F.col(key).cast("long").alias("key"), F.col(grade).cast("int").alias("grade")).dropna()
    rows = training_rows(keyed, labels, body=body, bound=bound).collect()  # bounded by ``bound``
    if not rows:
        empty = [F.lit(None).cast("double").alias(c) for c in ("expected_grade", "p_top")]
        return keyed.select(F.col("key").alias(key), *empty, F.lit(True).alias("kept"))
    rows.sort(key=lambda r: (r["key"], r["grade"], bytes(r["slots"])))
    slots = [np.frombuffer(r["slots"], "<u4").astype(np.int64) for r in rows]
    model = fit(slots, np.array([r["grade"] for r in rows]))
    return score(keyed, model, body=body, keep_from=keep_from).withColumnRenamed("key", key)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the two given labels: 0 poor, 1 good but toxic, 2 good."""
    return labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))


@CATALOG.query()
def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = text.table(spark, folder, "documents").select("doc_id", "text")
    return classify(docs, ratings(text.table(spark, folder, "labels")))
