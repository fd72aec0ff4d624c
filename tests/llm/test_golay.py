"""Fingerprints against single hashes, the code's properties, and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from affinity.llm import golay


def plain_fingerprint(text):
    data = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)] if words else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_labels(prints):
    label = {p: p for p in prints}
    todo = list(label)
    for i, p in enumerate(todo):
        for q in todo[:i]:
            if (p ^ q).bit_count() <= 3 and label[p] != label[q]:
                old, new = label[p], label[q]
                label = {k: new if v == old else v for k, v in label.items()}
    return label


def plain(docs):
    prints = [plain_fingerprint(t) for _, t in docs]
    label = plain_labels(prints)
    least = {}
    for (d, _), p in zip(docs, prints, strict=True):
        if d is not None:
            least[label[p]] = min(d, least.get(label[p], d))
    return sorted([(d, f"{p:016x}", least.get(label[p])) for (d, _), p in zip(docs, prints, strict=True)], key=str)


def found(spark, docs):
    out = golay.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    return sorted([tuple(r) for r in out.collect()], key=str)


def test_nearest_codewords():
    """A perfect code of distance 7: one codeword within 3 bits, five at 4 where that one is at 3."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    near = golay.codewords(words)
    low, high, _ = golay._code()
    by_index = {}
    for word in range(1 << 12):
        top = word << 11
        rest = int(low[top & 0xFFF] ^ high[top >> 12])
        by_index[word] = top | rest  # the remainder fills the low 11 bits
    assert min(by_index[w].bit_count() for w in by_index if w) == 7
    codes = np.array([by_index[w] for w in range(1 << 12)])
    for word, indices in zip(words, near, strict=True):
        away = np.bitwise_count(codes ^ word)
        assert away[indices[0]] == away.min() <= 3 and (away <= 3).sum() == 1
        others = set(indices[1:]) - {-1}
        assert others == (set(np.flatnonzero(away == 4)) if away.min() == 3 else set())


def test_all_near_pairs_share_a_key():
    rng = random.Random(2)
    pairs = []
    for _ in range(4000):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(1, 3)):
            b ^= 1 << k
        pairs.append((a, b))
    nodes = np.array(pairs, np.uint64).view(np.int64)
    key, node = golay.keys(nodes.ravel())
    listed = {}
    for k, n in zip(key.tolist(), node.tolist(), strict=True):
        listed.setdefault(n, set()).add(k)
    assert all(listed[a] & listed[b] for a, b in nodes.tolist())
    assert max(map(len, listed.values())) <= 77


def test_fingerprints_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["", " \n", "a", "A b", "a B c", "É ü\v鼠 a\x00b c x"]
    texts += [" ".join(rng.choices(["x", "Yy", "zürich", "w" * 50], k=n)) for n in (3, 4, 254, 255, 256, 257, 258, 3000)]
    for piece in (1 << 20, 7):
        monkeypatch.setattr(golay, "PIECE", piece)
        assert [golay.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def corpus(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(40):
        base = rng.choices([f"w{i}" for i in range(500)], k=rng.choice([2, 5, 40, 400]))
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(["new", "other", base[0].upper()])
            docs.append((rng.randrange(10_000), " ".join(copy)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_all_pairs(spark, seed):
    docs = corpus(seed)
    wanted = plain(docs)
    assert len({c for *_, c in wanted}) < len({p for _, p, _ in wanted})  # some links between different prints
    assert found(spark, docs) == wanted


def test_nulls_empty_repeated_and_other_columns(spark):
    docs = [(3, None), (2, ""), (5, " \n"), (7, "a b"), (7, "A  b"), (None, "a b"), (None, "without an id at all"), (9, "x")]
    assert found(spark, docs) == plain(docs)
    assert found(spark, []) == []
    wide = (spark.createDataFrame(docs, "doc_id long, text string").withColumn("node", F.lit("n"))
            .withColumn("a.b", F.lit(1)).withColumn("component_id", F.lit(0)))
    assert golay.near_duplicates(wide).columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted([tuple(r) for r in golay.near_duplicates(wide).collect()], key=str) == plain(docs)


def test_full_buckets_are_cut_into_cells(spark, monkeypatch):
    """Thousands of different prints with one exact segment; chains through them are not lost."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 2500:
        p = centre
        for k in rng.sample(range(21, 64), rng.randint(1, 9)):
            p ^= 1 << k
        prints.add(p)
    nodes = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    monkeypatch.setattr(golay, "CELL", 100)
    rows = golay.links(spark.createDataFrame([(n,) for n in nodes], "node long")).collect()
    assert len(rows) == len({(r.a, r.b) for r in rows})
    low = {n: n for n in nodes}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for r in rows:
        low[root(r.a)] = root(r.b)
    wanted = plain_labels_fast(nodes)
    groups = {}
    for n in nodes:
        groups.setdefault(root(n), set()).add(n)
    assert sorted(map(sorted, groups.values())) == wanted


def plain_labels_fast(nodes):
    values = np.array(nodes, np.int64).view(np.uint64)
    label = np.arange(len(values))
    while True:
        new = label.copy()
        for i in range(len(values)):
            new[i] = label[np.bitwise_count(values ^ values[i]) <= 3].min()
        if (new == label).all():
            break
        label = new
    groups = {}
    for n, x in zip(nodes, label.tolist(), strict=True):
        groups.setdefault(x, []).append(n)
    return sorted(sorted(g) for g in groups.values())
