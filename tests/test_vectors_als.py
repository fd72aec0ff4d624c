import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import als, stats, vectors


def brute(v, threshold):
    norms = np.linalg.norm(v, axis=1)
    out = {}
    for i in range(len(v)):
        for j in range(len(v)):
            if i != j and norms[i] and norms[j]:
                s = v[i] @ v[j] / (norms[i] * norms[j])
                if s > threshold:
                    out[i, j] = s
    return out


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_dense_pairs_for_any_blocks(spark, blocks):
    v = np.random.default_rng(1).normal(size=(60, 5))
    v[7] = 0.0
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)],
                                  "product_id long, features array<double>")
    rows = vectors.dense_cosine_pairs(items, 0.4, blocks=blocks).collect()
    got = {(r.product_id, r.rec_id): r.sim for r in rows}
    expected = brute(v, 0.4)
    assert len(rows) == len(got) and got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_block_count_bounds():
    assert vectors.block_count(10, 8) == 1
    assert vectors.block_count(10**9, 8) >= 10**9 // vectors.MAX_BLOCK_ROWS
    assert vectors.block_count(100_000, 8000) > vectors.block_count(100_000, 8)


@pytest.fixture
def blocks_of_taste(ratings):
    rng = np.random.default_rng(3)
    data = []
    for u in range(24):
        for p in range(12):
            if rng.random() < 0.7:
                data.append((u, p, 5.0 if (u + p) % 2 else 1.0, u * 100 + p, u * 100 + p))
    return ratings(data)


def test_als_lists(spark, blocks_of_taste):
    model = als.als_train(blocks_of_taste)
    lists = {}
    for r in als.als_user_recs(model, 4).collect():
        lists.setdefault(r.user_id, []).append((r["rank"], r.score))
    assert len(lists) == 24
    for recs in lists.values():
        recs.sort()
        assert [r for r, _ in recs] == list(range(1, len(recs) + 1)) and len(recs) <= 4
        scores = [s for _, s in recs]
        assert scores == sorted(scores, reverse=True) and min(scores) > 0
    sims = {(r.product_id, r.rec_id): r.sim for r in als.als_product_recs(model).collect()}
    assert sims and all(s > 0.4 and p != q and (q, p) in sims for (p, q), s in sims.items())


def test_als_lists_without_rated_products(blocks_of_taste):
    model = als.als_train(blocks_of_taste)
    rated = {(r.user_id, r.product_id) for r in blocks_of_taste.collect()}
    expected = {}
    for r in als.als_user_recs(model, 12).collect():
        if (r.user_id, r.product_id) not in rated:
            expected.setdefault(r.user_id, []).append((-r.score, r.product_id))
    got = {}
    for r in als.als_user_recs_unseen(model, blocks_of_taste, 2).collect():
        got.setdefault(r.user_id, {})[r["rank"]] = r.product_id
    assert got == {u: {i + 1: p for i, (_, p) in enumerate(sorted(recs)[:2])}
                   for u, recs in expected.items()}


def test_als_beats_the_mean(blocks_of_taste):
    model = als.als_train(blocks_of_taste)
    fitted = als.eval_rmse(als.als_predict(model, blocks_of_taste)).first()
    means = als.eval_rmse(als.product_mean_predict(blocks_of_taste, blocks_of_taste)).first()
    assert fitted.rows == blocks_of_taste.count() and fitted.rmse < means.rmse


def test_rmse_counts_each_row_once(ratings):
    train = ratings([(1, 1, 2.0, 0, 0)])
    test = ratings([(1, 1, 5.0, 0, 1), (1, 1, 5.0, 0, 2), (1, 9, 1.0, 0, 3)])
    got = als.eval_rmse(als.product_mean_predict(train, test)).first()
    assert (got.rmse, got.rows) == (3.0, 2)


def test_split_is_stable_and_whole(blocks_of_taste):
    train, test = als.train_test_split(blocks_of_taste)
    again, _ = als.train_test_split(blocks_of_taste.repartition(3))
    assert train.count() + test.count() == blocks_of_taste.count()
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    first, second = als.random_train_test_split(blocks_of_taste)
    assert first.count() + second.count() == blocks_of_taste.count()


def test_grid_is_sorted(blocks_of_taste):
    grid = als.als_grid_search(blocks_of_taste, (2, 3), (0.1, 1.0), iterations=2)
    errors = [r.rmse for r in grid.collect()]
    assert len(errors) == 4 and errors == sorted(errors)
    assert als.best_of_grid(grid).first().rmse == errors[0]


def test_statistics(ratings):
    df = ratings([(1, 1, 5.0, 1395676800, 0), (2, 1, 2.0, 1398355200, 1),
                  (1, 2, 4.0, 1395676800, 2)])
    assert [tuple(r) for r in stats.rate_more_products(df).collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in stats.average_products(df).collect()] == [(1, 3.5), (2, 4.0)]
    assert [tuple(r) for r in stats.rate_more_recently(df).collect()] == [
        (1, 1, 201404), (1, 1, 201403), (2, 1, 201403)]
    assert stats.attach_product_counts(df).agg(F.sum("count")).first()[0] == 5


@pytest.mark.parametrize("vectors_", [[[1.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0, 1.0]],
                                      [[1.0, 0.0], [1.0]], [[1.0, None], [1.0, 0.0]]])
def test_mixed_lengths_and_nulls_are_refused(spark, vectors_):
    df = spark.createDataFrame(list(enumerate(vectors_)), "product_id long, features array<double>")
    with pytest.raises(ValueError, match="one length"):
        vectors.dense_cosine_pairs(df)


@pytest.mark.parametrize("blocks", [1, 3])
def test_best_k_of_the_cells_are_the_best_k(spark, blocks):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 1.0, 2.0]) for _ in range(4)]) for i in range(150)]
    df = spark.createDataFrame(rows, "product_id long, features array<double>")
    whole = vectors.ranked_pairs(vectors.dense_cosine_pairs(df, 0.3, blocks=blocks), k=4)
    best = vectors.dense_cosine_pairs(df, 0.3, blocks=blocks, k=4)
    key = ["product_id", "rank", "rec_id"]
    assert sorted(map(tuple, vectors.ranked_pairs(best, k=4).select(key).collect())) == sorted(
        map(tuple, whole.select(key).collect()))
    assert best.count() < vectors.dense_cosine_pairs(df, 0.3, blocks=blocks).count()


def clustered(n, d, clusters, spread, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    return centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, d)) / np.sqrt(d)


@pytest.mark.parametrize("k", [None, 3])
@pytest.mark.parametrize("kind", ["random", "clustered", "copies"])
def test_skipped_blocks_lose_nothing(spark, kind, k):
    rng = np.random.default_rng(6)
    v = {"random": rng.normal(size=(300, 6)), "clustered": clustered(300, 12, 9, 0.3),
         "copies": np.repeat(rng.normal(size=(30, 6)), 10, axis=0)}[kind]
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)],
                                  "product_id long, features array<double>")
    lists = {}
    for (i, j), s in brute(v, 0.4).items():
        lists.setdefault(i, []).append((-round(s, 9), j))
    wanted = {(i, r + 1, j) for i, rest in lists.items() for r, (_, j) in enumerate(sorted(rest)[:k])}
    pairs = vectors.dense_cosine_pairs(items, 0.4, blocks=9, k=k)
    got = vectors.ranked_pairs(pairs, k=k).select("product_id", "rank", "rec_id").collect()
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)


def test_far_blocks_are_not_shipped(spark, monkeypatch):
    """Rows that cells receive, against one copy per block; a k-th best cuts them further."""
    sent = []
    whole = vectors._cell_hits

    def noted(cells, *args):
        sent.append(cells.count())
        return whole(cells, *args)

    monkeypatch.setattr(vectors, "_cell_hits", noted)

    def rows_sent(v, k):
        sent.clear()
        items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)],
                                      "product_id long, features array<double>")
        vectors.dense_cosine_pairs(items, 0.4, blocks=16, k=k).count()
        return sum(sent)

    near = clustered(2000, 24, 16, 0.2)
    assert rows_sent(near, None) < 2000 * 16 * 0.5
    assert rows_sent(near, 5) < 2 * 2000 + 2000 * 16 * 0.1
    few_dims = np.random.default_rng(7).normal(size=(2000, 3))
    assert rows_sent(few_dims, 5) < rows_sent(few_dims, None) * 0.7 < 2000 * 16 * 0.7


def test_vectors_without_direction(spark):
    schema = "product_id long, features array<double>"
    assert vectors.dense_cosine_pairs(spark.createDataFrame([], schema)).count() == 0
    assert vectors.dense_cosine_pairs(spark.createDataFrame([(1, [0.0]), (2, [0.0])], schema)).count() == 0
