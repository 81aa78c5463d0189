"""Quality classifier: ordinal cumulative-link regression on hashed text.

Ratings are graded 0 (toxic), 1 (low quality), 2 (good). One weight vector
over hashed words and binned text statistics is shared by all grades, with
ordered thresholds: P(grade >= k) = sigmoid(score - threshold[k]). The model
gives each document its expected grade and its tail probability
P(grade >= 2), which selects.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as h

BUCKETS = 1 << 21
#: Upper bounds of the bins of each statistic, a share of bytes or words.
BINS = np.array([0.002, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7])
STATS = 4
SIZE = BUCKETS + STATS * (len(BINS) + 1)

_UPPER = np.zeros(256, dtype=np.int32)
_UPPER[0x41:0x5B] = 1
_SYMBOL = np.zeros(256, dtype=np.int32)
_SYMBOL[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-()?"]] = 1


def _share(counts: np.ndarray, offsets: np.ndarray, of: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(of, 1)


def feature_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, row bounds, words per row): the distinct features of each row of a chunk."""
    starts, ends, bounds = h.word_spans(data, offsets, h.PUNCT)
    words = h.span_hashes(h.prefix(h.BYTE_WORDS[h.LOWER[data]]), starts, ends)
    n_words = np.diff(bounds)
    rows = np.repeat(np.arange(len(n_words)), n_words)
    again = np.zeros(len(words), dtype=np.int32)
    again[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    size = np.diff(offsets)
    stats = (_share(_UPPER[data], offsets, size), _share(_SYMBOL[data], offsets, size),
             _share((data == 0x7C).astype(np.int32), offsets, size), _share(again, bounds, n_words))
    keys = [rows * SIZE + (words >> np.uint64(40)).astype(np.int64) % BUCKETS]
    for k, share in enumerate(stats):
        bins = np.searchsorted(BINS, share, side="right")
        keys.append(np.arange(len(size)) * SIZE + BUCKETS + k * (len(BINS) + 1) + bins)
    keys = np.unique(np.concatenate(keys))
    at = keys // SIZE
    return keys - at * SIZE, np.searchsorted(at, np.arange(len(offsets))), n_words


def _mapped(docs: DataFrame, schema: str, arrow: pa.Schema, make, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in h.text_chunks(batch.column(2)):
                own = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)]
                yield pa.RecordBatch.from_arrays(own + make(*feature_sets(data, offsets)), schema=arrow)
    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights and ordered thresholds; ``known`` is false without ratings."""

    weights: np.ndarray
    thresholds: np.ndarray
    known: bool = True

    def tails(self, score: np.ndarray) -> np.ndarray:
        """rows x grades above 0: P(grade >= k)."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -500, 500)
        return 1.0 / (1.0 + np.exp(-z)) if self.known else np.ones(z.shape)


#: Shrinkages that an inner fold chooses from; every how many-th row is in that fold.
SHRINKAGES, INNER = (2.0, 0.5, 0.1), 4


def evident_features(features: np.ndarray, bounds: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """The features that get a weight: all statistics' bins, and words whose rows' grades are evidence.

    One rule for frequent and rare words: the sum of a word's rows' grades lies
    further from the mean grade's than the largest of so many words would by
    chance, sqrt(2 log words) standard errors.
    """
    seen = np.bincount(features, minlength=SIZE)
    off = np.bincount(features, weights=np.repeat(grades - grades.mean(), np.diff(bounds)), minlength=SIZE)
    spread = np.sqrt(np.maximum(seen * grades.var(), 1e-12))
    evident = np.abs(off) / spread > np.sqrt(2 * np.log(max(np.count_nonzero(seen), 2)))
    evident[BUCKETS:] = seen[BUCKETS:] > 0
    return np.flatnonzero(evident)


def fit_ordinal(features: np.ndarray, bounds: np.ndarray, grades: np.ndarray, n_grades: int = 3,
                l2: float = 0.1, steps: int = 150, rate: float = 0.03) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam; thresholds stay ordered by construction.

    Words are shrunk by ``l2``, the few bins of the statistics by 1.
    """
    n = len(grades)
    weights = np.zeros(SIZE, dtype=np.float64)
    if not n:
        return OrdinalModel(weights, np.zeros(n_grades - 1), known=False)
    used = evident_features(features, bounds, grades)
    number = np.full(SIZE, -1, dtype=np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
    cols = number[features]
    rows, cols = rows[cols >= 0], cols[cols >= 0]
    w = np.zeros(len(used))
    shrink = np.where(used < BUCKETS, l2, 1.0) / n
    pace = rate * np.concatenate([np.where(used < BUCKETS, 1.0, 10.0), np.full(n_grades - 1, 3.0)])
    # thresholds: the first, then logs of the gaps; from the smoothed shares
    share = np.array([(np.sum(grades < k) + 1) / (n + 2) for k in range(1, n_grades)])
    base = np.log(share / (1 - share))
    theta = np.concatenate([base[:1], np.log(np.maximum(np.diff(base), 0.1))])
    p = np.concatenate([w, theta])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, theta = p[:len(used)], p[len(used):]
        cuts = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        score = np.bincount(rows, weights=w[cols], minlength=n)
        below = 1.0 / (1.0 + np.exp(np.clip(score[:, None] - cuts[None, :], -30, 30)))  # P(grade < k)
        full = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        slope = full * (1 - full)
        at = np.arange(n)
        own = np.maximum(full[at, grades + 1] - full[at, grades], 1e-12)
        d_score = (slope[at, grades + 1] - slope[at, grades]) / own / n
        d_cut = np.zeros(n_grades + 1)
        np.add.at(d_cut, grades + 1, -slope[at, grades + 1] / own / n)
        np.add.at(d_cut, grades, slope[at, grades] / own / n)
        d_cut = d_cut[1:-1]
        tail = np.cumsum(d_cut[::-1])[::-1]
        d_theta = np.concatenate([tail[:1], tail[1:] * np.exp(theta[1:])])
        d_w = np.bincount(cols, weights=d_score[rows], minlength=len(used)) + shrink * w
        g = np.concatenate([d_w, d_theta])
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        p = p - pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
    weights[used] = p[:len(used)]
    theta = p[len(used):]
    return OrdinalModel(weights, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])))


def log_loss(model: OrdinalModel, features: np.ndarray, bounds: np.ndarray, grades: np.ndarray) -> float:
    """Mean negative log likelihood of the grades."""
    total = np.concatenate([[0.0], np.cumsum(model.weights[features])])
    tails = model.tails(total[bounds[1:]] - total[bounds[:-1]])
    full = np.concatenate([np.ones((len(grades), 1)), tails, np.zeros((len(grades), 1))], axis=1)
    at = np.arange(len(grades))
    return float(-np.log(np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)).mean())


def fit_chosen(features: np.ndarray, bounds: np.ndarray, grades: np.ndarray) -> OrdinalModel:
    """``fit_ordinal`` with the shrinkage under which every INNER-th row is likeliest, held out from the others."""
    inner = np.arange(len(grades)) % INNER == 0
    if inner.all() or not inner.any():
        return fit_ordinal(features, bounds, grades)
    parts = []
    for rows in (~inner, inner):
        sizes = np.diff(bounds)
        parts.append((features[np.repeat(rows, sizes)], np.concatenate([[0], np.cumsum(sizes[rows])]), grades[rows]))
    losses = [log_loss(fit_ordinal(*parts[0], l2=l2), *parts[1]) for l2 in SHRINKAGES]
    return fit_ordinal(features, bounds, grades, l2=SHRINKAGES[int(np.argmin(losses))])


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic 0, low quality 1, good 2; a document rated twice keeps its lower grade."""
    grade = (F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2))
    return labels.select("doc_id", grade.alias("grade")).dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000,
          doc_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on at most ``sample_rows`` rated documents, drawn by a hash of the id.

    ``sample_rows`` is the documented bound of what the driver sees: that many
    sets of feature numbers. More ratings than that don't change its size.
    """
    rated = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(rated), "doc_id").select("doc_id", "grade", "text")
    ints = pa.list_(pa.int32())
    found = _mapped(rows, "doc_id bigint, grade int, features array<int>",
                    pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("features", ints)]),
                    lambda f, bounds, _: [h.list_array(f.astype(np.int32), bounds, pa.int32())], text_col)
    got = found.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).toArrow().combine_chunks()
    grades = got.column("grade").to_numpy().astype(np.int64)
    lists = got.column("features")
    sizes = np.array([0, *np.cumsum(lists.combine_chunks().value_lengths().to_numpy())]) if len(grades) else np.zeros(1, int)
    values = lists.combine_chunks().flatten().to_numpy() if len(grades) else np.zeros(0, dtype=np.int32)
    return fit_chosen(values.astype(np.int64), sizes, grades)


def classify(docs: DataFrame, model: OrdinalModel, min_tail: float = 0.5,
             doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, expected_grade, tail_probability (P(grade >= 2)), kept; a row per input row.

    The whole text counts. A null or wordless text has nothing to learn from:
    expected grade 0, tail 0, not kept. A model without ratings keeps every
    text that has words, with tail 1. Repeated rows get equal results; other
    columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.known))

    def make(features, bounds, n_words):
        weights, thresholds, known = held.value
        total = np.concatenate([[0.0], np.cumsum(weights[features], dtype=np.float64)])
        score = np.round(total[bounds[1:]] - total[bounds[:-1]], 5)
        tails = OrdinalModel(weights, thresholds, known).tails(score) * (n_words > 0)[:, None]
        return [pa.array(np.round(tails.sum(axis=1), 6)), pa.array(np.round(tails[:, -1], 6)),
                pa.array((tails[:, -1] >= min_tail) & (n_words > 0))]
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    return _mapped(rows, "doc_id bigint, text_hash bigint, expected_grade double, tail_probability double, kept boolean",
                   pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("expected_grade", pa.float64()),
                              ("tail_probability", pa.float64()), ("kept", pa.bool_())]), make, text_col)
