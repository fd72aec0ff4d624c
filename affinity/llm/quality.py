"""Quality: logistic regression on hashed word n-grams, learnt by follow-the-regularised-leader.

Tokens are runs of letters and digits (A-Z folded) and runs of other signs; n-grams are single
tokens and pairs of neighbours, and a token equal to its predecessor gives one common pair
("said again") whatever the token. Each n-gram is hashed into one of ``2**BITS`` buckets; its
value is ``log2(1 + occurrences in the whole text)``. Learning is per-coordinate FTRL-proximal,
one text at a time, over the buckets seen in at least ``MIN_TEXTS`` texts of the sample; the
L1 term leaves few non-zero weights, which the tasks get as sorted arrays. A score is the
logistic of the sparse dot product with them.

The model is learnt from a bounded sample (``sample_bound`` labelled texts).

Defined cases: a null or empty text has the score of the bias; a row that occurs twice is scored
twice; null labels, and labels without a text, teach nothing; without labels all scores are 0.5.
Columns other than ``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.sampling import collect_features, fold_of, labelled_sample
from affinity.llm.stage import written
from affinity.llm.words import WHITE, Slice, mix, prefix_sums, rows_of, runs, slices, stretch_hashes

FOLDS, HELD_OUT = 4, 2
SAMPLE_BOUND = 10_000
BITS = 24
MIN_TEXTS = 5
THRESHOLD = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SIGN = ~_LETTER & ~WHITE


def grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Rows and buckets of all n-grams of a slice, one entry per occurrence."""
    letters, signs = (runs(kind[part.data], part.offsets) for kind in (_LETTER, _SIGN))
    begin, end = (np.concatenate(pair) for pair in zip(letters, signs, strict=True))
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    token = stretch_hashes(prefix_sums(part.data, fold=True), begin, end)
    row = rows_of(begin, part.offsets)
    near = row[1:] == row[:-1]
    pair = mix(token[:-1] * np.uint64(0x9FB21C651E98DF25) + token[1:])
    pair[token[:-1] == token[1:]] = 1 << 40
    shift = np.uint64(64 - BITS)
    return (np.concatenate([row, row[1:][near]]),
            (np.concatenate([token, pair[near]]) >> shift).astype(np.int64))


def counted(row: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and numbers of occurrences, ordered by row and bucket."""
    key, times = np.unique((row << BITS) | bucket, return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), times


@dataclass
class SparseLogistic:
    """Buckets with a weight in ascending order, the weights, the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        """One bit per bucket: whether it has a weight."""
        bits = np.zeros(1 << BITS, bool)
        bits[self.buckets] = True
        return np.packbits(bits)

    def values(self, part: Slice, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, places in ``buckets`` and values of the n-grams of a slice that have a weight."""
        row, bucket = grams(part)
        known = (table[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1
        row, bucket, times = counted(row[known], bucket[known])
        return row, np.searchsorted(self.buckets, bucket), np.log2(1.0 + times)

    def scores(self, part: Slice, table: np.ndarray) -> np.ndarray:
        row, place, value = self.values(part, table)
        z = self.bias + np.bincount(row, self.weights[place] * value, part.n_rows)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def frequent_buckets(sample: DataFrame) -> np.ndarray:
    """Buckets that at least ``MIN_TEXTS`` texts of the sample have, in ascending order."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                _, bucket, _ = counted(*grams(part))
                found, times = np.unique(bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times)], ["bucket", "n"])

    found = (sample.select("text").mapInArrow(count, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TEXTS)
             .select("bucket").toArrow())
    return np.sort(found.column("bucket").to_numpy())


def fit(places: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int,
        epochs: int = 4, alpha: float = 0.1, beta: float = 1.0, l1: float = 1.0,
        l2: float = 1.0, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights and bias by per-coordinate FTRL-proximal steps, one text after another."""
    z, n = np.zeros(size), np.zeros(size)
    bias_z, bias_n, bias = 0.0, 0.0, 0.0

    def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2) * (np.abs(z) > l1)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            at, x = places[i], values[i]
            z_at, n_at = z[at], n[at]
            w = weights_of(z_at, n_at)
            p = 1 / (1 + np.exp(-np.clip(bias + w @ x, -40, 40)))
            g = (p - y[i]) * x
            z[at] = z_at + g - (np.sqrt(n_at + g * g) - np.sqrt(n_at)) / alpha * w
            n[at] = n_at + g * g
            g = p - y[i]
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
            bias = -bias_z * alpha / (beta + np.sqrt(bias_n))
    return weights_of(z, n), float(bias)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS,
          held_out: int = HELD_OUT, sample_bound: int = SAMPLE_BOUND) -> SparseLogistic:
    """Learn from at most ``sample_bound`` labelled texts outside the held-out fold."""
    sample = written(labelled_sample(documents, labels, label, folds, held_out, sample_bound))
    model = SparseLogistic(frequent_buckets(sample), np.zeros(0), 0.0)

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for part in slices(batch.column("text")):
            row, place, value = model.values(part, table)
            ends = pa.array(np.searchsorted(row, np.arange(part.n_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[part.start:part.stop], batch.column("y")[part.start:part.stop],
                 pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(value.astype(np.float32)))],
                ["doc_id", "y", "places", "values"])

    found = collect_features(sample, extract, "doc_id long, y int, places array<int>, values array<float>")
    y = found.column("y").to_numpy().astype(float)
    if not len(y):
        return SparseLogistic(np.zeros(0, np.int64), np.zeros(0), 0.0)
    places, values = ([chunk.values.to_numpy()[chunk.offsets[i].as_py():chunk.offsets[i + 1].as_py()].astype(kind)
                       for chunk in found.column(name).chunks for i in range(len(chunk))]
                      for name, kind in (("places", np.int64), ("values", np.float64)))
    weights, bias = fit(places, values, y, len(model.buckets))
    kept = np.flatnonzero(weights)
    return SparseLogistic(model.buckets[kept], weights[kept], bias)


def score(documents: DataFrame, model: SparseLogistic) -> DataFrame:
    """``doc_id, score`` of every row from its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for part in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[part.start:part.stop], pa.array(model.scores(part, table))],
                    ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def quality(documents: DataFrame, labels: DataFrame, **training: int) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` for every row."""
    scored = score(documents, train(documents, labels, **training))
    folds, held_out = training.get("folds", FOLDS), training.get("held_out", HELD_OUT)
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id", folds) == held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
