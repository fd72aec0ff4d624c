"""Removed bytes against brute force over all 400-byte strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from affinity.llm.suffix_dedup import LENGTH, deduplicate, digests, sliding_minimum


def brute(docs):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i:i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for (d, _), t in zip(docs, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - LENGTH + 1):
            if seen[t[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, docs, **more):
    rows = digests(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), **more).collect()
    return sorted((tuple(r) for r in rows), key=str)


def corpus(seed):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    shared = [noise(rng.choice([150, 330, 399, 400, 401, 450, 700, 1500])) for _ in range(12)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            piece = rng.choice(shared)
            if rng.random() < 0.4:
                a = rng.randrange(len(piece))
                piece = piece[a:a + rng.randint(200, 900)]
            if rng.random() < 0.3:
                at = rng.randrange(len(piece) + 1)
                piece = piece[:at] + "X" + piece[at:]
            parts.append(piece)
            parts.append(noise(rng.choice([0, 0, 1, 7, 300])))
        docs.append((len(docs), "".join(parts)))
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    docs = corpus(seed)
    wanted = brute(docs)
    assert sum(w[2] for w in wanted) > 5_000
    assert found(spark, docs) == wanted


def test_number_of_batches_does_not_matter(spark):
    docs = corpus(4)[:25]
    wanted = brute(docs)
    assert found(spark, docs, batches=1) == wanted
    assert found(spark, docs, batches=7) == wanted


def test_periods_and_repeats_within_one_text(spark):
    docs = [(1, "a" * 1200), (2, "ab" * 500 + "c"), (3, "x" * 399), (4, "y" * 400), (5, "z" * 401),
            (6, "".join(f"{i:05d}" for i in range(200)) * 2)]
    assert found(spark, docs) == brute(docs)


def test_nulls_repeated_rows_and_ids_used_twice(spark):
    text = "".join(f"{i:05d}" for i in range(150))
    docs = [(1, None), (2, ""), (None, text), (3, text[:500]), (3, "q" + text[100:]), (4, "only"), (4, "only"),
            (5, "".join(chr(200 + i) for i in range(300))), (None, None)]
    assert found(spark, docs) == brute(docs)
    assert found(spark, []) == []


def test_kept_bytes_and_spans(spark):
    text = "".join(f"{i:05d}" for i in range(100))
    docs = spark.createDataFrame([(1, "head " + text + " tail", 9), (2, text, 9)], "doc_id long, text string, key int")
    got = {r.doc_id: r for r in deduplicate(docs).collect()}
    assert bytes(got[1].kept) == b"head  tail" and [tuple(s) for s in got[1].spans] == [(5, 505)]
    assert bytes(got[2].kept) == b"" and [tuple(s) for s in got[2].spans] == [(0, 500)]


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("affinity.llm.suffix_dedup.PIECE_BYTES", 1000)
    docs = [(d, t * 4) for d, t in corpus(5)[:20]]
    wanted = brute(docs)
    import pyarrow as pa
    from affinity.llm import suffix_dedup as s
    pieces = list(s.pieces(pa.array(["x" * 10_000, "y" * 100])))
    assert max(len(p.data) for _, _, p in pieces) <= 1000 + LENGTH
    assert found(spark, docs) == wanted


def test_sliding_minimum():
    rng = np.random.default_rng(0)
    for n in (5, 6, 17, 100):
        x = rng.integers(0, 1000, n).astype(np.uint64)
        assert (sliding_minimum(x, 5) == [x[i:i + 5].min() for i in range(n - 4)]).all()


def test_index_merges_and_scans_once_per_batch(spark, monkeypatch):
    from affinity.llm import suffix_dedup as s
    rng, sizes, plain = random.Random(6), [], s.written
    batches = [[(p := rng.randrange(150), p * 10 + rng.randrange(1 + p % 4)) for _ in range(40)] for _ in range(7)]
    monkeypatch.setattr(s, "written", lambda df: (sizes.append(df.columns), plain(df))[1])
    index = s.SuffixIndex()
    for k, batch in enumerate(batches, 1):
        index.add(spark.createDataFrame(batch, "prefix long, context long"))
        assert [level is not None for level in index.levels] == [bool(k >> i & 1) for i in range(k.bit_length())]
        assert len(sizes) == 2 * k
    n = Counter(x for batch in batches for x in batch)
    places, kinds = Counter(), Counter(p for p, _ in n)
    for (p, _), many in n.items():
        places[p] += many
    assert sorted(map(tuple, index.repeats().collect())) == sorted(
        (p, c, many > 1, kinds[p] > 1) for (p, c), many in n.items() if places[p] > 1)


def test_number_of_jobs(spark):
    docs = corpus(7)
    spark.sparkContext.setJobGroup("suffixes", "count the jobs")
    try:
        got = found(spark, docs)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == brute(docs)
    # Each one has tasks for every partition, however small the table is; there were 91.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("suffixes")) <= 70
