"""Containment search against brute force, for items and documents of all sizes."""

import random

import pyarrow as pa
import pytest

from affinity.llm.containment import (bin_load, contained_items, distinct, drop_contaminated, exact_size, item_blocks,
                                      item_search, signature)
from affinity.llm.words import slices, words


def brute(docs, items, threshold=0.8):
    def shingles(text, size):
        w = [x for x in (text or "").translate(FOLD).replace("\t", " ").replace("\n", " ").split(" ") if x]
        return len(w), {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}

    out = []
    for d, text in docs:
        for i, item in items:
            n = shingles(item, 1)[0]
            if n:
                size = min(5, n)
                wanted, there = shingles(item, size)[1], shingles(text, size)[1]
                shared = len(wanted & there)
                if shared >= threshold * len(wanted) - 1e-9:
                    out.append((d, i, len(wanted), shared))
    return sorted(out, key=str)


FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(spark, docs, items, **more):
    out = contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string"), **more)
    return sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in out.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for k in range(40)]
    docs = []
    for k in range(120):
        w = rng.choices(vocabulary, k=rng.choice([3, 30, 300, 6000]))
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(items)[1].split(" ")
            if rng.random() < 0.6:
                passage[rng.randrange(len(passage))] = "changed"
            if rng.random() < 0.3:
                passage = passage[:len(passage) // 2] + ["cut"] * 9 + passage[len(passage) // 2:]
            at = rng.randint(0, len(w))
            w[at:at] = [x.upper() for x in passage] if rng.random() < 0.2 else passage
        docs.append((k, " ".join(w) if rng.random() < 0.8 else "\n".join(w)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = corpus(seed)
    wanted = brute(docs, items)
    assert len(wanted) > 60
    assert found(spark, docs, items) == wanted


def test_blocks_give_the_same(spark):
    docs, items = corpus(3)
    assert found(spark, docs, items, block_bytes=2000) == brute(docs, items)


def test_nulls_repeats_ties_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"),
            (None, "One two"), (5, " \n\t ")]
    items = [(7, "one two three four five six"), (7, "one two three four five six"), (8, None), (9, ""),
             (10, "two three"), (None, "one two")]
    assert found(spark, docs, items) == sorted(
        [(3, 7, 2, 2)] * 4 + [(3, 10, 1, 1), (3, None, 1, 1)] * 2 + [(None, None, 1, 1)], key=str)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_items_without_an_id_contaminate(spark):
    docs = spark.createDataFrame([(1, "some words that a test item has"), (2, "clean words")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "words that a test item")], "item_id long, text string")
    assert [r.doc_id for r in drop_contaminated(docs, items).collect()] == [2]


def test_a_short_item_leaves_the_load_of_the_others():
    """Items are partitioned by size: the long ones keep their bins, the short one has none."""
    long = [(k, " ".join(f"w{k}x{i}" for i in range(60))) for k in range(30)]
    (only,) = item_blocks(long, 0.8)
    blocks = item_blocks([*long, (99, "six words are a short item")], 0.8)
    assert {b.load: len(b.item_ids) for b in blocks} == {only.load: 30, 0.0: 1} and only.load > 0
    shingle, row = distinct(*exact_size(words(next(slices(pa.array([" ".join(t for _, t in long)]))), fold=True), 5))
    assert signature(shingle, row, 1, only.load).sum() < len(shingle)


def test_repeated_items_are_spread_over_the_blocks(spark):
    items = spark.createDataFrame([(1, "the same item of some words " * 3)] * 64, "item_id long, text string")
    sizes = [sum(len(b.item_ids) for b in read()) for read in item_search(items, 0.8, 1024)]
    assert sum(sizes) == 64 and max(sizes) <= 16 and len(sizes) > 8
    docs = [(1, "here is the same item of some words " + "the same item of some words " * 3)]
    assert len(found(spark, docs, [tuple(r) for r in items.collect()], block_bytes=1024)) == 64


def test_drop_keeps_clean_rows_and_all_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, "x"), (2, "clean", 2, "y"), (2, "clean", 3, None),
                                  (None, None, 4, "z"), (None, "A b c d e", 5, "q")], "doc_id long, text string, item_id int, `n.s` string")
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.item_id for r in kept.collect()) == [2, 3, 4]


def test_load_of_bins():
    assert bin_load(48) == 1.0 and bin_load(1) == 0.0
    assert bin_load(5) in (0.125, 0.0625)
