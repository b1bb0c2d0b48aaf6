"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades 0..K-1 share one weight vector over hashed text features; K-1 ordered thresholds turn a
document's score s into P(grade > k) = sigmoid(s - threshold[k]). The expected grade is the sum of
these, and the tail probability P(grade >= top) selects documents.

Features (each counted once per document, in ``2 ** bits`` buckets): words with A-Z lower-cased, the
last two bytes of words as written, and steps of the share of words that equal the one before.

The model is fitted on a bounded sample: ``sample_rows`` rated documents, the smallest by a hash of
the id. Scoring covers every row and whole texts.

Defined results: null or empty text has no features (its score is the intercept). Ratings that are
null are left out; several ratings of one document: the lowest grade. Without ratings, or with one
grade only, every document gets the top grade with probability 1. Repeated rows give equal
results; an empty table gives no rows; ``score`` reads two columns, ``keep_good`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.llm.batches import LOWER, combine, hash_words, slices, text_bytes, word_spans


# A feature says that at least 0.5 ** k of the words equal the word before them.
REPEATS = (1, 2, 3, 4, 5, 6)
SLICE = 1 << 20  # bytes of text whose features are made at once


@dataclass
class OrdinalModel:
    """Weights (2 ** bits), ordered thresholds, and the grades 0..len(thresholds)."""

    bits: int
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score (rows) and threshold (columns)."""
        return 1.0 / (1.0 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -500, 500)))


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) pairs of a text column, each once, ordered by row and bucket."""
    data, offsets = text_bytes(column)
    starts, ends, bounds = word_spans(data, offsets)
    rows = np.repeat(np.arange(len(column)), np.diff(bounds))
    words = hash_words(LOWER[data], starts, ends)
    tails = combine([hash_words(data, np.maximum(starts, ends - 2), ends), np.full(len(starts), 7, np.uint64)])
    again = np.bincount(rows[1:][(words[1:] == words[:-1]) & (rows[1:] == rows[:-1])], minlength=len(column))
    share = again / np.maximum(np.diff(bounds), 1)
    often = [np.flatnonzero(share >= 0.5**k) for k in REPEATS]
    shift = np.uint64(64 - bits)
    keys = np.concatenate([words >> shift, tails >> shift, np.repeat(REPEATS, [len(o) for o in often]).astype(np.uint64)]).astype(np.int64)
    at = np.concatenate([rows, rows, *often])
    pairs = np.unique(at << bits | keys)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def scores_of(column: pa.Array, model: OrdinalModel) -> np.ndarray:
    """Score of each row: the mean-free sum of its features' weights."""
    rows, buckets = features(column, model.bits)
    return np.bincount(rows, weights=model.weights[buckets], minlength=len(column))


def fit_ordinal(rows: np.ndarray, buckets: np.ndarray, grades: np.ndarray, bits: int, steps: int = 2000, rate: float = 0.05,
                l2: float = 5e-6, least_rows: int = 5, least_z: float = 4.0) -> OrdinalModel:
    """Full-batch fit of the cumulative-link likelihood (Adam). Only buckets found in ``least_rows``
    documents, and whose mean grade is ``least_z`` standard errors below the overall mean, get a weight,
    and weights are at most 0: features are evidence against a document, so that long clean texts
    cannot make up for bad passages and texts without evidence are judged alike at any length."""
    n, k = len(grades), int(grades.max(initial=0)) if len(grades) else 0
    present = len(np.unique(grades))
    if present < 2:
        return OrdinalModel(bits, np.zeros(1 << bits), np.full(max(k, 1), -np.inf))
    seen = np.bincount(buckets, minlength=1 << bits)
    total = np.bincount(buckets, weights=grades[rows], minlength=1 << bits)
    z = (total - seen * grades.mean()) / (grades.std() * np.sqrt(np.maximum(seen, 1)))
    used = (seen >= least_rows) & (z <= -least_z)
    live = used[buckets]
    rows, buckets = rows[live], buckets[live]
    columns, index = np.unique(buckets, return_inverse=True)
    above = (grades[:, None] > np.arange(k)[None, :]).astype(float)
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    # thresholds: the first, then positive gaps (softplus), so they stay ordered
    theta = -np.log(share / (1 - share))
    gaps = np.log(np.expm1(np.maximum(np.diff(theta), 1e-3)))
    params = np.concatenate([np.zeros(len(columns)), theta[:1], gaps])
    first, second = np.zeros_like(params), np.zeros_like(params)
    m = len(columns)
    for step in range(1, steps + 1):
        w, t0, g = params[:m], params[m], params[m + 1:]
        theta = t0 + np.concatenate([[0.0], np.cumsum(np.logaddexp(0, g))])
        score = np.bincount(rows, weights=w[index], minlength=n)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -40, 40)))
        # P(grade = j) = tail[j - 1] - tail[j]; gradient of its log through both bounds
        upper = np.concatenate([np.ones((n, 1)), tail], axis=1)
        lower = np.concatenate([tail, np.zeros((n, 1))], axis=1)
        pick = np.arange(n)
        high, low = upper[pick, grades], lower[pick, grades]
        p = np.maximum(high - low, 1e-9)
        dhigh, dlow = high * (1 - high) / p, low * (1 - low) / p
        dscore = (dhigh - dlow) / n
        dtheta = np.zeros(k)
        np.add.at(dtheta, grades[grades > 0] - 1, -dhigh[grades > 0] / n)
        np.add.at(dtheta, grades[grades < k], dlow[grades < k] / n)
        gw = np.bincount(index, weights=dscore[rows], minlength=m) - l2 * w
        ggap = np.array([dtheta[j + 1:].sum() for j in range(len(g))]) / (1 + np.exp(-g))
        grad = np.concatenate([gw, [dtheta.sum()], ggap])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        params += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        np.minimum(params[:m], 0.0, out=params[:m])
    weights = np.zeros(1 << bits)
    weights[columns] = params[:m]
    theta = params[m] + np.concatenate([[0.0], np.cumsum(np.logaddexp(0, params[m + 1:]))])
    return OrdinalModel(bits, weights, theta)


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 10_000,
        bits: int = 18) -> OrdinalModel:
    """Fit on a bounded sample of ``ratings`` (``id_col``, grade int from 0)."""
    rated = (
        ratings.select(F.col(id_col).cast("long").alias("id"), F.col("grade").cast("int").alias("grade")).dropna()
        .groupBy("id").agg(F.min("grade").alias("grade"))
        .orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # at most sample_rows ids and grades are broadcast
    sample = texts.join(F.broadcast(rated), "id").select("id", "grade", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE):
            rows, buckets = features(batch.column("text"), bits)
            at = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("grade"), pa.ListArray.from_arrays(pa.array(at), pa.array(buckets.astype(np.int32)))],
                names=["id", "grade", "buckets"])

    found = sample.mapInArrow(run, "id long, grade int, buckets array<int>").dropDuplicates(["id"]).toArrow().sort_by("id")
    # the driver holds the sample once, four bytes a number
    sizes = pc.list_value_length(found["buckets"]).to_numpy()
    grades = found["grade"].to_numpy().astype(np.int64)
    buckets = pc.list_flatten(found["buckets"]).to_numpy()
    del found
    pa.default_memory_pool().release_unused()
    return fit_ordinal(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), buckets, grades, bits)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
          least_tail: float = 0.7) -> DataFrame:
    """Per document: doc_id, expected_grade, tail_probability (of the top grade), kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE):
            tails = shared.value.tails(scores_of(batch.column("text"), shared.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= least_tail)],
                names=["doc_id", "expected_grade", "tail_probability", "kept"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def keep_good(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least_tail: float = 0.7) -> DataFrame:
    """The rows that are likely of the top grade, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE):
            tails = shared.value.tails(scores_of(batch.column(text_col), shared.value))
            yield batch.filter(pa.array(tails[:, -1] >= least_tail))

    return docs.mapInArrow(run, docs.schema)
