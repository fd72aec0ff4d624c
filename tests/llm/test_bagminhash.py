"""Near-duplicate classes against brute force; signatures against weighted Jaccard."""

import random
from collections import Counter

import numpy as np
import pytest

from affinity.llm.bagminhash import bag_minhash, keep_one, near_duplicates


def bag(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similarity(a, b):
    whole = sum((a | b).values())
    return sum((a & b).values()) / whole if whole else 1.0


def brute(docs, threshold=0.8):
    bags = [bag(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if label[i] != label[j] and similarity(bags[i], bags[j]) >= threshold - 1e-12:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(docs, label, strict=True):
        if d is not None:
            least[x] = min(least.get(x, d), d)
    return sorted(((d, least.get(x)) for (d, _), x in zip(docs, label, strict=True)), key=str)


def found(spark, docs):
    out = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    return sorted(((r.doc_id, r.class_id) for r in out.collect()), key=str)


def corpus(seed, n_groups=25):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    docs = []
    passage = rng.choices(vocabulary, k=40)
    for _ in range(n_groups):
        base = rng.choices(vocabulary, k=rng.choice([4, 40, 150, 600]))
        if rng.random() < 0.4:
            base[len(base) // 2:len(base) // 2] = passage
        for _ in range(rng.choice([1, 2, 4, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["new"], [copy[at]] * 3])
            docs.append((len(docs), " ".join(copy)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_brute_force(spark, seed):
    docs = corpus(seed)
    assert found(spark, docs) == brute(docs)


def test_nulls_empty_and_repeated_rows(spark):
    docs = [(3, None), (2, ""), (5, " \n"), (7, "a b"), (7, "a b"), (8, "A  b"), (None, "a b"), (9, "a c"),
            (None, "only this one text has no id")]
    assert found(spark, docs) == brute(docs)
    assert found(spark, []) == []


def test_keep_one_of_each_class(spark):
    docs = spark.createDataFrame(
        [(1, "x y z", 1), (2, "X y  z", 2), (3, "other", 3), (3, "other", 4), (4, None, 5), (5, "", 6)],
        "doc_id long, text string, `node_0.x` int")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    assert keep_one(docs.limit(0)).count() == 0


def test_keep_one_of_classes_with_one_smallest_id(spark):
    """Texts without ids, and different texts of one id, are classes of their own."""
    rows = [(None, "first text without id"), (None, "second text without id"), (None, "Second  text without id"),
            (7, "one text of seven"), (7, "quite another one"), (9, "Quite another  one"), (9, "nine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = keep_one(docs).collect()
    wanted = [(7, "one text of seven"), (7, "quite another one"), (9, "nine"), (None, "Second  text without id"),
              (None, "first text without id")]
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(wanted, key=str)
    out = near_duplicates(docs).collect()
    assert len(out) == 7 and len({r.class_key for r in out}) == 5


def test_signatures_are_unbiased():
    rng = np.random.default_rng(5)
    size, wanted, got = 128, [], []
    for _ in range(60):
        n = int(rng.integers(5, 400))
        shingle = np.unique(rng.integers(1, 2**62, n).astype(np.uint64))
        a = rng.integers(1, 12, len(shingle))
        b = np.where(rng.random(len(shingle)) < 0.5, a, rng.integers(1, 12, len(shingle)))
        row = np.repeat([0, 1], len(shingle))
        signs = bag_minhash(row, np.tile(shingle, 2), np.concatenate([a, b]), 2, size)
        wanted.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        got.append((signs[0] == signs[1]).mean())
    error = np.array(got) - np.array(wanted)
    assert abs(error.mean()) < 0.02 and np.abs(error).max() < 0.22


def test_one_shingle_many_times():
    signs = bag_minhash(np.array([0, 1, 2]), np.array([7, 7, 7], np.uint64), np.array([1000, 1000, 900]), 3)
    assert (signs[0] == signs[1]).all() and 0.75 < (signs[0] == signs[2]).mean() < 1
