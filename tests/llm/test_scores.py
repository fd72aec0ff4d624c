"""Toxicity and quality scores: the models' sums by brute force, held-out accuracy, defined cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from affinity.llm import quality, toxicity
from affinity.llm.sampling import labelled_sample
from affinity.llm.words import Slice, shingles, slices, stretch_hashes, prefix_sums, words

DATA = "/root/testdata/sf0.1"


def part_of(*texts) -> Slice:
    return next(slices(pa.array(texts, pa.string())))


def test_words_and_shingles_of_null_empty_and_short_texts():
    texts = ["a bb  a", None, "", " \t", "x", "é ü é ü é ü é", "one two three four five six"]
    part = part_of(*texts)
    found = words(part)
    assert np.bincount(found.row, minlength=7).tolist() == [3, 0, 0, 0, 1, 7, 6]
    assert found.hashes[0] == found.hashes[2] != found.hashes[1]
    shingle, row = shingles(found, 7)
    assert np.bincount(row, minlength=7).tolist() == [1, 0, 0, 0, 1, 3, 2]
    assert shingle[row == 5][0] == shingle[row == 5][2]
    a, b = words(part_of("Ab c"), fold=True).hashes, words(part_of("q aB"), fold=True).hashes
    assert a[0] == b[1]


def test_slices_are_bounded_and_whole():
    texts = ["x" * n for n in (5, 30, 7, 100, 0, 3)]
    got = [(p.start, p.stop, len(p.data)) for p in slices(pa.array(texts), 40)]
    assert got == [(0, 2, 35), (2, 3, 7), (3, 4, 100), (4, 6, 3)]
    assert list(slices(pa.array([], pa.string()))) == []


def test_equal_stretches_have_equal_hashes():
    data = np.frombuffer(b"hello world, hello word", np.uint8)
    sums = prefix_sums(data)
    at = np.array([0, 13, 6, 19])
    h = stretch_hashes(sums, at, at + np.array([5, 5, 3, 3]))
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]


def test_factorization_machine_sums_all_pairs():
    rng = np.random.default_rng(1)
    model = toxicity.FactorizationMachine(np.arange(20, dtype=np.uint64), rng.normal(0, 0.3, 20),
                                          rng.normal(0, 0.3, (20, 4)), -0.2)
    sets = [[], [3], [1, 5, 9], list(range(20))]
    row = np.concatenate([[k] * len(s) for k, s in enumerate(sets)]).astype(int)
    got = model.scores(row, np.concatenate(sets).astype(int), len(sets))
    for s, p in zip(sets, got, strict=True):
        z = -0.2 + sum(model.weights[i] for i in s) + sum(
            model.factors[i] @ model.factors[j] for i in s for j in s if i < j)
        assert abs(p - 1 / (1 + np.exp(-z))) < 1e-9


def test_factors_learn_what_weights_cannot():
    """Either term alone is harmless, both together are not."""
    rng = np.random.default_rng(2)
    sets, y = [], []
    for _ in range(3000):
        s = np.flatnonzero(rng.random(6) < 0.4)
        sets.append(s)
        y.append(float(0 in s and 1 in s))
    model = toxicity.FactorizationMachine(np.arange(6, dtype=np.uint64), *toxicity.fit(sets, np.array(y), 6, epochs=60))
    row, index = np.array([0, 1, 2, 2]), np.array([0, 1, 0, 1])
    alone, other, both = model.scores(row, index, 3)
    assert both > 0.7 > 0.3 > max(alone, other)


def test_ftrl_score_is_the_sparse_dot_product():
    texts = ["good words here", "bad!! bad!! ***", "", None]
    part = part_of(*texts)
    row, bucket, times = quality.counted(*quality.grams(part))
    kept = np.unique(bucket)
    model = quality.SparseLogistic(kept, np.random.default_rng(0).normal(size=len(kept)), 0.3)
    got = model.scores(part, model.table())
    for k in range(4):
        mine = row == k
        z = 0.3 + (model.weights[np.searchsorted(kept, bucket[mine])] * np.log2(1 + times[mine])).sum()
        assert abs(got[k] - 1 / (1 + np.exp(-z))) < 1e-9


@pytest.mark.parametrize("module, query, label, remainder, folds",
                         [(toxicity, toxicity.toxicity, "toxic", 1, 3), (quality, quality.quality, "quality", 2, 4)])
def test_held_out_accuracy(spark, module, query, label, remainder, folds):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = query(docs, labels)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == remainder) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r[label] for r in held) / len(held)
    assert right > 0.97 and all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("query", [toxicity.toxicity, quality.quality])
def test_labels_of_the_held_out_fold_and_other_columns_do_not_matter(spark, query):
    rows = [(k, ("idiot *** " if k % 2 else "nice words ") * 3, f"s{k}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = [(k, 1 - k % 2, k % 2) for k in range(200)]
    remainder, folds = (1, 3) if query is toxicity.toxicity else (2, 4)
    turned = [(k, 1 - q, 1 - t) if zlib.crc32(str(k).encode()) % folds == remainder else (k, q, t) for k, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a = query(docs, spark.createDataFrame(labels, schema)).orderBy("doc_id").collect()
    b = query(docs.drop("source"), spark.createDataFrame(turned, schema)).orderBy("doc_id").collect()
    assert a == b and {r.predicted for r in a} == {0, 1}


@pytest.mark.parametrize("query", [toxicity.toxicity, quality.quality])
def test_nulls_repeats_empty_tables_and_one_class(spark, query):
    schema = "doc_id long, quality int, toxic int"
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (2, "a b", 1), (2, "a b", 1),
                                  (3, "long " * 100_000, 1)], "doc_id long, text string, y int")
    none = spark.createDataFrame([], schema)
    out = query(docs, none).collect()
    assert len(out) == 5 and {r.score for r in out} == {0.5} and not any(r.held_out for r in out if r.doc_id is None)
    assert query(docs.limit(0), none).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (2, None, None), (3, 1, 0), (3, 1, 0), (99, 0, 1)], schema)
    assert query(docs, odd).count() == 5


def test_sample_is_bounded_and_does_not_depend_on_order(spark):
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)] + [(0, 1)], "doc_id long, toxic int")
    a = labelled_sample(docs, labels, "toxic", 3, 1, 20).orderBy("doc_id").collect()
    b = labelled_sample(docs, labels.orderBy("toxic"), "toxic", 3, 1, 20).orderBy("doc_id").collect()
    assert a == b and len(a) == 20 and all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in a)


def test_one_id_on_many_rows_is_one_text(spark):
    """The bound is one of rows: what goes to the driver does not grow with the rows of an id."""
    rows = [(3, f"text {k:05}") for k in range(5000)] + [(k, None if k == 9 else "t") for k in range(4, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(3, 30)] * 3, "doc_id long, toxic int")
    got = labelled_sample(docs, labels, "toxic", 3, 1, 10).collect()
    assert len(got) == len({r.doc_id for r in got}) == 10
    every = {r.doc_id: r.text for r in labelled_sample(docs, labels, "toxic", 3, 1, 100).collect()}
    assert every.get(3, "text 00000") == "text 00000" and len(every) <= 27


def pair_corpus(n, seed, vocabulary=300, length=20):
    """Texts that are labelled 1 if they have one of two words, and not both: each says nothing alone."""
    rng = np.random.default_rng(seed)
    rows, y = [], []
    for k in range(n):
        words = [f"word{v:04d}" for v in rng.integers(0, vocabulary, length)]
        a, b = rng.random(2) < 0.5
        for there, word in ((a, "villagers"), (b, "vermin")):
            if there:
                words.insert(int(rng.integers(len(words))), word)
        rows.append((k, " ".join(words)))
        y.append((k, int(a != b)))
    return rows, y


def test_train_learns_a_pair_whose_terms_say_nothing_alone(spark):
    rows, y = pair_corpus(4000, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(y, "doc_id long, toxic int")
    scored = toxicity.toxicity(docs, labels).where("held_out").collect()
    right = sum(r.predicted == y[r.doc_id][1] for r in scored) / len(scored)
    assert len(scored) > 1000 and right > 0.95


def test_random_labels_give_no_factors():
    """Residuals that no pair explains: the eigenvalues are not beyond chance."""
    rng = np.random.default_rng(4)
    index = np.concatenate([np.sort(rng.choice(60, 20, replace=False)) for _ in range(1500)])
    texts = toxicity.Texts(index, np.arange(0, len(index) + 1, 20), (rng.random(1500) < 0.3).astype(float))
    residual = texts.y - texts.y.mean()
    assert not toxicity.pair_factors(texts, residual, 60, 4).any()
    has = np.array([[t in index[20 * k:20 * k + 20] for t in (5, 9)] for k in range(1500)])
    pair = has[:, 0] == has[:, 1]
    found = toxicity.pair_factors(texts, residual + pair - pair.mean(), 60, 4)
    assert set(np.flatnonzero((np.abs(found) > 0.5 * np.abs(found).max()).any(1))) == {5, 9}


def test_sparse_products():
    rng = np.random.default_rng(5)
    dense = rng.random((30, 12)) < 0.3
    dense[7] = dense[29] = False
    texts = toxicity.Texts(np.nonzero(dense)[1], np.append(0, np.cumsum(dense.sum(1))), np.zeros(30))
    v, u = rng.normal(size=(12, 3)), rng.normal(size=(30, 2))
    assert np.allclose(texts.times(v), dense @ v) and np.allclose(texts.back(u, 12), dense.T @ u)
    chosen = np.array([2, 5, 11])
    assert [x.tolist() for x in texts.only(chosen, 12)] == [np.flatnonzero(row[chosen]).tolist() for row in dense]


def test_gradient_steps_against_plain_ones():
    """One epoch of one batch: the step of each parameter is the sign of its plain gradient, times the rate."""
    rng = np.random.default_rng(6)
    sets = [np.flatnonzero(rng.random(8) < 0.5) for _ in range(40)]
    y = (rng.random(40) < 0.4).astype(float)
    start = rng.normal(0, 0.3, (8, 2))
    w, v, b = toxicity.fit(sets, y, 8, epochs=1, rate=0.01, decay=0.0, pair_decay=0.0, factors=start)
    bias = np.log(y.mean() / (1 - y.mean()))
    grad_w, grad_v, grad_b = np.zeros(8), np.zeros((8, 2)), 0.0
    for s, label in zip(sets, y, strict=True):
        z = bias + sum(start[i] @ start[j] for i in s for j in s if i < j)
        slope = (1 / (1 + np.exp(-z)) - label) / 40
        grad_b += slope
        for i in s:
            grad_w[i] += slope
            grad_v[i] += slope * sum(start[j] for j in s if j != i)
    assert np.allclose(w, -0.01 * np.sign(grad_w), atol=1e-5) and np.allclose(v, start - 0.01 * np.sign(grad_v), atol=1e-5)
    assert abs(b - (bias - 0.01 * np.sign(grad_b))) < 1e-5


def test_ftrl_against_plain_steps():
    """Follow the regularised leader, one coordinate at a time, in the order that the seed gives."""
    rng = np.random.default_rng(7)
    places = [np.flatnonzero(rng.random(6) < 0.5) for _ in range(50)]
    values = [rng.random(len(p)) + 0.5 for p in places]
    y = (rng.random(50) < 0.5).astype(float)
    got, bias = quality.fit(places, values, y, 6, epochs=2, l1=0.2, seed=3)
    z, n = [0.0] * 7, [0.0] * 7

    def weight(j):
        l1, l2 = (0.0, 0.0) if j == 6 else (0.2, 1.0)
        return 0.0 if abs(z[j]) <= l1 else -(z[j] - np.sign(z[j]) * l1) / ((1.0 + np.sqrt(n[j])) / 0.1 + l2)

    order = np.random.default_rng(3)
    for _ in range(2):
        for i in order.permutation(50):
            x = dict(zip(places[i].tolist(), values[i].tolist(), strict=True)) | {6: 1.0}
            w = {j: weight(j) for j in x}
            p = 1 / (1 + np.exp(-sum(w[j] * x[j] for j in x)))
            for j in x:
                g = (p - y[i]) * x[j]
                z[j] += g - (np.sqrt(n[j] + g * g) - np.sqrt(n[j])) / 0.1 * w[j]
                n[j] += g * g
    assert np.allclose(got, [weight(j) for j in range(6)]) and np.isclose(bias, weight(6))


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr("affinity.llm.sampling.SAMPLE_BYTES", 1000)
    docs = spark.createDataFrame([(k, "x" * 100) for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, toxic int")
    assert labelled_sample(docs, labels, "toxic", 3, 1, 40).count() == 10
