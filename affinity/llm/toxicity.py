"""Toxicity: a factorization machine over hashed terms.

Terms are folded words and their first four, five and six bytes, hashed into ``2**BITS`` buckets. The
score is the logistic of ``bias + sum w_i + sum_{i<j} <v_i, v_j>`` over the distinct terms of the whole
text, so a pair of terms (an insult and a group) can weigh more, or less, than the two apart. The
pair sum is computed as ``((sum v)^2 - sum v^2) / 2``, linear in the number of terms.

The model is learnt from a bounded sample (``sample_bound`` labelled texts) in three steps:

* **Weights.** Buckets whose document shares differ between the labels, by ``LEAST_Z`` standard errors
  or more, have a weight of their own; it is fitted with no pairs. This is all that a term can say alone.
* **Pairs.** What the weights leave unexplained of each text, its residual, is summed over all pairs of
  terms, centred, that the text has, whatever their weights: a symmetric matrix, never formed, whose
  leading eigenvectors are the factors that gain most. They come from subspace iteration, two sparse
  products per step. A text counts the same whatever its length, so an eigenvalue is a number of
  texts' residuals; it must be ``LEAST_SUPPORT`` or more, and beyond what the same residuals give when
  dealt to the texts at random. A pair whose terms say nothing alone stands out as any other.
* **Both** are then fitted together, factors where their eigenvectors are.

Counts come from Spark; the weights and factors are fitted on the driver and sent to the tasks.

Defined cases: a null or empty text has the score of the bias alone; a row that occurs twice is
scored twice; labels that are null, and labels without a text, teach nothing; without labels, or
with one class only, all rows have the share of that class (0.5 without any) as score. Columns
other than ``doc_id`` and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.sampling import collect_features, fold_of, labelled_sample
from affinity.llm.stage import written
from affinity.llm.whole_rows import filter_by_text
from affinity.llm.words import Slice, prefix_sums, rows_of, runs, slices, stretch_hashes

FOLDS, HELD_OUT = 3, 1
SAMPLE_BOUND = 20_000
BITS = 24
N_FACTORS = 4
MIN_TEXTS = 5
#: Steps of the subspace iteration, and how far an eigenvalue must be beyond chance.
SUBSPACE_STEPS, BEYOND_CHANCE, LEAST_SUPPORT = 8, 1.25, 5.0
#: Entries of the sample that the driver works on at a time.
PART_ENTRIES = 1 << 20
#: Texts that are added to a term's count where its part in a pair is scaled by that count.
SMOOTH = 10.0
LEAST_Z = 4.0
LEAST_BIAS = -3.0
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(part: Slice, prefixes: tuple[int, ...] = PREFIXES) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word beginnings of a slice, with their rows."""
    begin, end = runs(_INSIDE[part.data], part.offsets)
    sums = prefix_sums(part.data, fold=True)
    row = rows_of(begin, part.offsets)
    hashes, rows = [stretch_hashes(sums, begin, end)], [row]
    for size in prefixes:
        longer = end - begin > size
        cut = begin[longer]
        hashes.append(stretch_hashes(sums, cut, cut + size) ^ np.uint64(size * 0x1F3D5B79))
        rows.append(row[longer])
    return np.concatenate(hashes) >> np.uint64(64 - BITS), np.concatenate(rows)


def distinct_terms(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, term) once, ordered by row."""
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
    return row[new], term[new]


@dataclass
class FactorizationMachine:
    """Kept buckets in ascending order, their weights and factors; the bias."""

    kept: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def scores(self, row: np.ndarray, index: np.ndarray, n_rows: int) -> np.ndarray:
        """Scores of rows given their distinct kept terms as indexes into ``kept``."""
        z = np.full(n_rows, self.bias) + np.bincount(row, self.weights[index], n_rows)
        for f in self.factors.T:
            v = f[index]
            z += 0.5 * (np.bincount(row, v, n_rows) ** 2 - np.bincount(row, v * v, n_rows))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))

    def find(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows and indexes of the distinct kept buckets among hashed terms."""
        if not len(self.kept) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.kept, hashes)
        at[at == len(self.kept)] = 0
        hit = self.kept[at] == hashes
        return distinct_terms(row[hit], at[hit])


def frequent_terms(sample: DataFrame) -> tuple[np.ndarray, ...]:
    """Buckets that at least ``MIN_TEXTS`` texts have, ascending: texts and positive texts that do, whether a word is one."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for part in slices(batch.column("text")):
                hashes, row = terms(part)
                words = np.unique(terms(part, ())[0])
                row, hashes = distinct_terms(row, hashes)
                found, place = np.unique(hashes, return_inverse=True)
                pos = np.bincount(place, y[part.start:part.stop][row], len(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(np.bincount(place, minlength=len(found))),
                     pa.array(pos.astype(np.int64)), pa.array(np.isin(found, words).astype(np.int32))],
                    ["term", "n", "pos", "word"])

    found = (sample.select("y", "text").mapInArrow(count, "term long, n long, pos long, word int")
             .groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"), F.max("word").alias("word"))
             .where(F.col("n") >= MIN_TEXTS).toArrow().sort_by("term"))
    term, n, pos, word = (found.column(c).to_numpy() for c in ("term", "n", "pos", "word"))
    return term.view(np.uint64), n, pos, word == 1


@dataclass
class Texts:
    """The sampled texts as sparse rows of ones: indexes of terms, where each row's begin, and labels."""

    index: np.ndarray
    starts: np.ndarray
    y: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)

    def parts(self) -> Iterator[tuple[slice, Texts]]:
        """The texts in parts of about ``PART_ENTRIES`` terms, which bounds what is worked on at once."""
        first = 0
        while first < len(self.y):
            end = int(np.searchsorted(self.starts, self.starts[first] + PART_ENTRIES, "right")) - 1
            rows = slice(first, min(len(self.y), max(end, first + 1)))
            low, high = self.starts[rows.start], self.starts[rows.stop]
            yield rows, Texts(self.index[low:high], self.starts[rows.start:rows.stop + 1] - low, self.y[rows])
            first = rows.stop

    def times(self, v: np.ndarray) -> np.ndarray:
        """The sums of ``v``'s rows over the terms of each text."""
        out = np.zeros((len(self.y), v.shape[1]))
        for rows, part in self.parts():
            some = part.sizes > 0
            if some.any():
                out[rows][some] = np.add.reduceat(v[part.index], part.starts[:-1][some], axis=0)
        return out

    def back(self, u: np.ndarray, size: int) -> np.ndarray:
        """The sums of ``u``'s rows over the texts of each term."""
        out = np.zeros((size, u.shape[1]))
        for rows, part in self.parts():
            for f in range(u.shape[1]):
                out[:, f] += np.bincount(part.index, np.repeat(u[rows, f], part.sizes), size)
        return out

    def only(self, chosen: np.ndarray, size: int) -> list[np.ndarray]:
        """Per text the places within ``chosen`` of its terms that are among them."""
        place = np.full(size, -1, np.int32)
        place[chosen] = np.arange(len(chosen))
        out = []
        for _, part in self.parts():
            found = place[part.index]
            ends = np.append(0, np.cumsum(found >= 0))[part.starts]
            out += np.split(found[found >= 0], ends[1:-1])
        return out


def pair_factors(texts: Texts, residual: np.ndarray, size: int, n_factors: int, seed: int = 3) -> np.ndarray:
    """Factors of the terms, ``size`` rows, that explain most of the residuals by pairs; zero columns for none.

    A column is an eigenvector of the sums of residuals over pairs, each side scaled by the fourth root of
    the term's texts, and each text by the square of its own length. Entries of less than a tenth of its
    largest are zero, and its length is such that the pair sums it gives the texts vary by one half.
    """
    n = np.bincount(texts.index, minlength=size)
    scale = (n + SMOOTH) ** -0.25
    length = np.maximum(texts.times((scale ** 2)[:, None])[:, 0], 1e-9)
    mean = n[:, None] / max(len(texts.y), 1)

    def spectrum(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r = (r - r.mean()) / length
        own = texts.back(r[:, None], size)

        def apply(q: np.ndarray) -> np.ndarray:
            scaled = scale[:, None] * q
            centred = (texts.back(r[:, None] * texts.times(scaled), size)
                       - own * (mean.T @ scaled) - mean * (own.T @ scaled) + r.sum() * mean * (mean.T @ scaled))
            return scale[:, None] * (centred - own * scaled)

        rng = np.random.default_rng(seed)
        q, shift = np.linalg.qr(rng.normal(size=(size, min(n_factors, size))))[0], 0.0
        for _ in range(SUBSPACE_STEPS):
            found = apply(q)
            small = q.T @ found
            shift = max(shift, -float(np.linalg.eigvalsh((small + small.T) / 2).min()))  # so that the largest lead
            q = np.linalg.qr(found + shift * q)[0]
        small = q.T @ apply(q)
        values, turn = np.linalg.eigh((small + small.T) / 2)
        return values[::-1], (q @ turn)[:, ::-1]

    factors = np.zeros((size, n_factors))
    if size < 2 or not len(residual):
        return factors
    values, vectors = spectrum(residual)
    if values[0] < LEAST_SUPPORT:
        return factors
    chance = spectrum(np.random.default_rng(seed + 1).permutation(residual))[0][0]
    for f in np.flatnonzero(values >= max(BEYOND_CHANCE * chance, LEAST_SUPPORT)):
        v = vectors[:, f]
        v = np.where(np.abs(v) >= 0.1 * np.abs(v).max(), v * scale, 0.0)[:, None]
        spread = float((0.5 * (texts.times(v) ** 2 - texts.times(v * v))).std())
        factors[:, f] = v[:, 0] * np.sqrt(0.5 / max(spread, 1e-12))
    return factors


def fit(indexes: list[np.ndarray], y: np.ndarray, n_terms: int, n_factors: int = N_FACTORS,
        epochs: int = 30, rate: float = 0.05, decay: float = 1e-5, pair_decay: float = 1e-3,
        batch: int = 256, seed: int = 7, factors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, factors and bias by adaptive gradient steps on the logistic loss.

    The bias is held at ``LEAST_BIAS`` or above: where texts without kept terms are nearly all of
    one class it would fall without end, and terms that mostly come together would then each
    weigh too little to reject a text alone. Given ``factors`` are where the factors start, and
    those that are zero stay so; without any they start at random, and rest for the first half of the
    epochs: what a term says by itself is then in its weight, and they learn what is left for pairs.
    """
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = rng.normal(0, 0.02, (n_terms, n_factors)) if factors is None else factors.copy()
    model = [np.zeros(n_terms), start, np.array([np.log(share / (1 - share))])]
    live = start != 0
    n_factors = start.shape[1]
    first, second = [np.zeros_like(m) for m in model], [np.zeros_like(m) for m in model]
    step = 0
    for epoch in range(epochs):
        pairs = float(factors is not None or epoch >= epochs // 2)
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            sizes = np.array([len(indexes[r]) for r in rows])
            index = np.concatenate([indexes[r] for r in rows]) if sizes.sum() else np.zeros(0, int)
            row = np.repeat(np.arange(len(rows)), sizes)
            w, v, b = model
            z = b[0] + np.bincount(row, w[index], len(rows))
            if live.any():
                sums = np.stack([np.bincount(row, v[index, f], len(rows)) for f in range(n_factors)], 1)
                z += 0.5 * ((sums ** 2).sum(1) - np.bincount(row, (v[index] ** 2).sum(1), len(rows)))
            slope = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows]) / len(rows)
            grads = [np.bincount(index, slope[row], n_terms) + decay * w, np.zeros_like(v),
                     np.array([slope.sum()])]
            if live.any():
                grads[1] = pairs * live * (pair_decay * v + np.stack([np.bincount(
                    index, slope[row] * (sums[row, f] - v[index, f]), n_terms) for f in range(n_factors)], 1))
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model[k] = model[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            model[2] = np.maximum(model[2], LEAST_BIAS)
    return model[0], model[1], float(model[2][0])


def strong_terms(n: np.ndarray, pos: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Whether each term's share of texts differs enough between the labels."""
    share = n / (n_pos + n_neg)
    gap = np.abs(pos / n_pos - (n - pos) / n_neg)
    return gap / np.sqrt((share * (1 - share) + 1e-9) * (1 / n_pos + 1 / n_neg)) >= LEAST_Z


def learn(texts: Texts, strong: np.ndarray, n_factors: int) -> tuple[np.ndarray, ...]:
    """Places of the terms that the model keeps, their weights and factors, and the bias."""
    size, y, alone = len(strong), texts.y, np.flatnonzero(strong)
    none = np.zeros((len(alone), n_factors))
    lists = texts.only(alone, size)
    weights, _, bias = fit(lists, y, len(alone), n_factors, factors=none)
    linear = FactorizationMachine(np.zeros(0, np.uint64), weights, none, bias)
    row, index = np.repeat(np.arange(len(y)), [len(x) for x in lists]), np.concatenate(lists).astype(np.int64)
    factors = pair_factors(texts, y - linear.scores(row, index, len(y)), size, n_factors)
    paired = (factors != 0).any(1)
    if not paired.any():
        return alone, weights, none, bias
    kept = np.flatnonzero(strong | paired)
    return kept, *fit(texts.only(kept, size), y, len(kept), n_factors, factors=factors[kept])


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS,
          held_out: int = HELD_OUT, sample_bound: int = SAMPLE_BOUND,
          n_factors: int = N_FACTORS) -> FactorizationMachine:
    """Learn from at most ``sample_bound`` labelled texts outside the held-out fold."""
    sample = written(labelled_sample(documents, labels, label, folds, held_out, sample_bound))
    counts = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    every = FactorizationMachine(np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, n_factors)), 0.0)
    if not n_pos or not n_neg:
        every.bias = 40.0 if n_pos else -40.0 if n_neg else 0.0
        return every
    found, n, pos, word = frequent_terms(sample)
    strong = strong_terms(n, pos, n_pos, n_neg)
    # Words pair, and beginnings of words have weights only.
    every.kept, strong = found[word | strong], strong[word | strong]

    def extract(part_of: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in slices(part_of.column("text")):
            row, index = every.find(*terms(part))
            ends = np.searchsorted(row, np.arange(part.n_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part_of.column("doc_id")[part.start:part.stop], part_of.column("y")[part.start:part.stop],
                 pa.ListArray.from_arrays(ends.astype(np.int32), index.astype(np.int32))],
                ["doc_id", "y", "terms"])

    table = collect_features(sample, extract, "doc_id long, y int, terms array<int>")
    sizes = np.concatenate([pc.list_value_length(x).to_numpy() for x in table.column("terms").chunks])
    texts = Texts(np.concatenate([x.flatten().to_numpy() for x in table.column("terms").chunks]),
                  np.append(0, np.cumsum(sizes, dtype=np.int64)), table.column("y").to_numpy().astype(float))
    del table
    kept, weights, factors, bias = learn(texts, strong, n_factors)
    return FactorizationMachine(every.kept[kept], weights, factors, bias)


def score(documents: DataFrame, model: FactorizationMachine) -> DataFrame:
    """``doc_id, score`` of every row from its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                hashes, row = terms(part)
                found = model.scores(*model.find(hashes, row), part.n_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[part.start:part.stop], pa.array(found)],
                    ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity(documents: DataFrame, labels: DataFrame, **training: int) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` for every row."""
    scored = score(documents, train(documents, labels, **training))
    folds, held_out = training.get("folds", FOLDS), training.get("held_out", HELD_OUT)
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id", folds) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame, **training: int) -> DataFrame:
    """The rows of ``documents``, all columns, whose own text scores below the threshold."""
    model = train(documents, labels, **training)

    def keep(part: Slice) -> np.ndarray:
        hashes, row = terms(part)
        return model.scores(*model.find(hashes, row), part.n_rows) < THRESHOLD

    return filter_by_text(documents, keep)
