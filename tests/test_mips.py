"""Best products per user against all scores, and what the blocks spare."""

import numpy as np
import pytest

from affinity.operators import als, mips
from affinity.session import cut_lineage


def table(spark, ids, vectors):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)],
                                 "id int, features array<float>")


def plain(users, products, k, rated=()):
    out = {}
    for u, x in users.items():
        scores = [(-float(np.float32(x).astype(float) @ np.float32(y).astype(float)), p)
                  for p, y in products.items() if (u, p) not in rated]
        for r, (s, p) in enumerate(sorted(scores)[:k]):
            if s < 0:
                out[u, r + 1, p] = -s
    return out


def lists(df):
    rows = df.collect()
    got = {(r.user_id, r["rank"], r.product_id): r.score for r in rows}
    assert len(got) == len(rows)
    return got


def factors(seed, users=120, products=260, d=4):
    rng = np.random.default_rng(seed)
    lengths = rng.pareto(1.5, products) + 0.05
    return ({int(u): x for u, x in enumerate(rng.normal(size=(users, d)))},
            {int(p): x * n for p, (x, n) in enumerate(zip(rng.normal(size=(products, d)), lengths))})


@pytest.mark.parametrize("user_block, product_block", [(8192, 4096), (30, 20), (50, 7)])
def test_all_scores(spark, user_block, product_block):
    users, products = factors(1)
    got = lists(mips.best_products(table(spark, users, users.values()), table(spark, products, products.values()), 5,
                                   user_block=user_block, product_block=product_block))
    assert got == pytest.approx(plain(users, products, 5))


@pytest.mark.parametrize("product_block", [4096, 25])
def test_rated_products_are_masked(spark, product_block):
    """A user who has rated nearly everything still holds k entries; unknown and repeated pairs are fine."""
    users, products = factors(2)
    rng = np.random.default_rng(3)
    rated = {(0, p) for p in range(250)} | {(int(u), int(p)) for u, p in rng.integers(0, 120, (300, 2))}
    pairs = [*rated, (0, 1), (999, 1), (1, 999)]
    df = cut_lineage(spark.createDataFrame(pairs, "user_id long, product_id long"))
    got = lists(mips.best_products(table(spark, users, users.values()), table(spark, products, products.values()), 4,
                                   df, 40, product_block))
    assert got == pytest.approx(plain(users, products, 4, rated))


def test_ties_zero_vectors_and_empty_tables(spark):
    users = {1: [1.0, 0.0], 2: [0.0, 0.0], 3: [-1.0, -1.0]}
    products = {p: [1.0, 0.0] for p in range(20)} | {90: [0.0, 0.0], 91: [0.0, -2.0]}
    both = [table(spark, t, t.values()) for t in (users, products)]
    for block in (4096, 3, 1):
        got = lists(mips.best_products(*both, 3, product_block=block))
        assert got == {(1, 1, 0): 1.0, (1, 2, 1): 1.0, (1, 3, 2): 1.0, (3, 1, 91): 2.0}
    assert mips.best_products(both[0].limit(0), both[1], 3).count() == 0
    assert mips.best_products(both[0], both[1].limit(0), 3).count() == 0


def test_short_blocks_are_not_scored(spark, monkeypatch):
    """Pairs that are scored, against users times products: most products are too short for anybody."""
    users, products = factors(4, 200, 2000)
    scored = []
    whole = mips._scored

    def noted(vectors, *args):
        keys = ["ub", "pb", "part", "seeks"]
        sizes = {tuple(r)[:4]: r["count"] for r in vectors.groupBy(*keys).count().collect()}
        scored.append(sum(n * sizes.get((*cell, False), 0) for (*cell, seeks), n in sizes.items() if seeks))
        return whole(vectors, *args)

    monkeypatch.setattr(mips, "_scored", noted)
    got = lists(mips.best_products(table(spark, users, users.values()), table(spark, products, products.values()), 5,
                                   user_block=100, product_block=50))
    assert got == pytest.approx(plain(users, products, 5))
    assert sum(scored) < 0.4 * 200 * 2000


def test_equal_to_the_models_own_lists(ratings):
    rng = np.random.default_rng(5)
    df = ratings([(u, p, float(rng.integers(1, 6)), 0, 0) for u in range(30) for p in range(20) if rng.random() < 0.5])
    model = als.als_train(df)
    own = {(r.user_id, i + 1): x.rating for r in model.recommendForAllUsers(6).collect()
           for i, x in enumerate(r.recommendations) if x.rating > 0}
    got = {(r.user_id, r["rank"]): r.score for r in als.als_user_recs(model, 6).collect()}
    assert got == pytest.approx(own, rel=1e-4)
