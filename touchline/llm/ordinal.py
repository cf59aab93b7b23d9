"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are made from the labels: 0 toxic, 1 of low quality, 2 good. One weight vector over hashed text is shared by all grades;
with increasing thresholds ``t1 < t2``, ``P(grade <= j) = logistic(t - score)``. A document gets its expected grade and the tail
probabilities; it is kept if ``P(grade >= 2)`` reaches ``CUTOFF``.

Features of a text: the distinct lower-cased words (runs of letters, digits and non-ASCII), hashed into ``BUCKETS`` (presence, so one insult
counts in a long text too), and a few counts per word (upper case, symbols, digits, table bars, repeats, lines), scaled by
``SHARE_SCALE`` and at most 1 each before that. Only words whose documents' mean grade lies ``MIN_DEVIATION`` standard errors off
that of the sample have a weight; the many others would add up to a bonus for long texts.

The model is fitted on the driver from at most ``SAMPLE`` labelled documents, those with the smallest hash of ``doc_id``; each sends its set
of buckets (at most ``BUCKETS`` bits). All documents are scored in one pass without a shuffle. Labels with a null are left out, labels of one
document count once, at their worst. Without labels of two grades at least there is no model: grades and probabilities are null and
every document is kept. A null or empty text has no features and gets the grade of the thresholds alone.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import Words, in_chunks, runs

BITS = 18
BUCKETS = 1 << BITS
SHARE_SCALE = 4.0
SAMPLE = 12_000
CUTOFF = 0.5
STEPS = 250
RATE = 0.05
PENALTY = 1e-4
MIN_DEVIATION = 4.0

_BYTES = np.arange(256)
_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
#: Bytes counted per word: upper case, digits, symbols, table bars, line breaks.
_COUNTED = [
    np.isin(_BYTES, np.frombuffer(kind, np.uint8))
    for kind in (string.ascii_uppercase.encode(), string.digits.encode(), b"#*$%&<>!@^~=+_/", b"|", b"\n")
]


def alphanumeric(data: np.ndarray, offsets: np.ndarray, rows: slice) -> Words:
    return runs(data, offsets, rows, _WORD)


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all documents, distinct within each; where each document's begin; its shares."""
    buckets = (words.hashes(lower=True) >> np.uint64(64 - BITS)).astype(np.int32)
    first, offsets = words.first, words.offsets
    counts = np.diff(first)
    totals = []
    for kind in _COUNTED:
        sums = np.concatenate([[0], np.cumsum(kind[words.data], dtype=np.int64)])
        totals.append(sums[offsets[1:]] - sums[offsets[:-1]])
    sets = [np.unique(buckets[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    shares = np.minimum(np.stack([*totals, counts - sizes], axis=1) / np.maximum(counts, 1)[:, None], 1.0)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.int32)
    return flat, begins, shares * SHARE_SCALE


class Model(NamedTuple):
    weights: np.ndarray
    share_weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, flat: np.ndarray, begins: np.ndarray, shares: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[flat], dtype=np.float64)])
        return sums[begins[1:]] - sums[begins[:-1]] + shares @ self.share_weights

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= j)`` for j = 1, 2."""
        return logistic(scores[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit(flat: np.ndarray, begins: np.ndarray, shares: np.ndarray, grades: np.ndarray) -> Model | None:
    """Full-batch Adam on the penalised likelihood; the thresholds stay ordered by a log gap."""
    if len(np.unique(grades)) < 2:
        return None
    rows = np.repeat(np.arange(len(grades)), np.diff(begins))
    seen = np.bincount(flat, minlength=BUCKETS)
    mean_grade = np.bincount(flat, grades[rows], minlength=BUCKETS) / np.maximum(seen, 1)
    telling = np.abs(mean_grade - grades.mean()) * np.sqrt(seen) >= MIN_DEVIATION * grades.std()
    rows, flat = rows[telling[flat]], flat[telling[flat]]
    used, column = np.unique(flat, return_inverse=True)
    # One vector of all parameters: words, shares, first threshold, log gap.
    theta = np.zeros(len(used) + shares.shape[1] + 2)
    theta[-2] = -1.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        words, share, t1, gap = theta[: len(used)], theta[len(used) : -2], theta[-2], np.exp(theta[-1])
        score = np.bincount(rows, words[column], minlength=len(grades)) + shares @ share
        above1, above2 = logistic(score - t1), logistic(score - t1 - gap)
        d1, d2 = above1 * (1 - above1), above2 * (1 - above2)
        share_of = np.maximum(np.choose(grades, [1 - above1, above1 - above2, above2]), 1e-12)
        # Derivatives of the log-likelihood along the score, seen through either threshold.
        by1 = np.choose(grades, [-d1, d1, np.zeros_like(d1)]) / share_of
        by2 = np.choose(grades, [np.zeros_like(d2), -d2, d2]) / share_of
        slope = by1 + by2
        gradient = np.concatenate([np.bincount(column, slope[rows], minlength=len(used)), slope @ shares, [-slope.sum(), -by2.sum() * gap]])
        gradient = gradient / len(grades)
        gradient[: -2] -= PENALTY * theta[:-2]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[used] = theta[: len(used)]
    return Model(weights, theta[len(used) : -2], np.array([theta[-2], theta[-2] + np.exp(theta[-1])]))


def graded(labels: DataFrame) -> DataFrame:
    """``labelled, grade``, one row per document."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    worst = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    return worst.select(F.col("doc_id").alias("labelled"), grade.alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits the model on the bounded sample."""
    chosen = graded(labels).orderBy(F.xxhash64("labelled"), "labelled").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    one = texts.groupBy("labelled").agg(F.min("text").alias("text"), F.first("grade").alias("grade"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in in_chunks(batch.column("text"), alphanumeric):
                flat, begins, shares = features(words)
                grades = batch.column("grade").slice(words.rows.start, words.rows.stop - words.rows.start)
                sets = [flat[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([grades, pa.array(sets, pa.binary()), pa.array(list(shares), pa.list_(pa.float64()))], ["grade", "buckets", "shares"])

    rows = one.select("labelled", "text", "grade").mapInArrow(task, "grade int, buckets binary, shares array<double>").collect()
    if not rows:
        return None
    sets = [np.frombuffer(row["buckets"], dtype=np.int32) for row in rows]
    begins = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return fit(np.concatenate(sets), begins, np.array([row["shares"] for row in rows]), np.array([row["grade"] for row in rows]))


def scored(docs: DataFrame, model: Model | None, cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id, expected_grade, p_at_least_1, p_at_least_2, kept`` for every document."""
    names = ["doc_id", "expected_grade", "p_at_least_1", "p_at_least_2", "kept"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in in_chunks(batch.column("text"), alphanumeric):
                ids = batch.column("doc_id").slice(words.rows.start, words.rows.stop - words.rows.start)
                if model is None:
                    columns = [pa.nulls(len(ids), pa.float64())] * 3 + [pa.array([True] * len(ids))]
                else:
                    tails = model.tails(model.scores(*features(words)))
                    columns = [pa.array(c) for c in (tails.sum(axis=1), tails[:, 0], tails[:, 1], tails[:, 1] >= cutoff)]
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    schema = "doc_id long, expected_grade double, p_at_least_1 double, p_at_least_2 double, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(task, schema)
