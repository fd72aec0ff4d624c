import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from affinity.operators import itemcf, realtime, topk, upserts
from affinity.session import cut_lineage


def sims_of(spark, pairs):
    return spark.createDataFrame([(a, b, s) for (a, b), s in pairs.items()],
                                 "product_id long, rec_id long, sim double")


def score(spark, sims, recent, **options):
    candidates = spark.createDataFrame([(1, 100)], "user_id long, product_id long")
    recents = spark.createDataFrame([(1, p, s) for p, s in recent],
                                    "user_id long, product_id long, score double")
    got = realtime.realtime_scores(candidates, recents, sims_of(spark, sims), **options).collect()
    return [round(r.score, 9) for r in got]


def test_golden_scores(spark):
    sims = {(100, 1): 0.5, (100, 2): 0.8, (100, 3): 0.4}
    recent = [(1, 4.0), (2, 2.0), (3, 5.0)]
    assert score(spark, sims, recent) == [1.8]
    many = {(100, p): 0.5 for p in range(10)}
    assert score(spark, many, [(p, 5.0) for p in range(10)]) == [3.5]
    low = [(p, 1.0) for p in range(10)]
    assert score(spark, many, low) == [1.5]
    assert score(spark, many, low, dec_sign=-1) == [-0.5]
    assert score(spark, {(100, 3): 0.4}, recent) == []


def brute(data, sims, n=20):
    by_user = defaultdict(list)
    for u, p, s, t, e in data:
        by_user[u].append((t, e, s, p))
    out = {}
    for u, events in by_user.items():
        events.sort(reverse=True)
        rated = {p for *_, p in events}
        near = sorted((-round(s, 9), q) for (p, q), s in sims.items() if p == events[0][3])
        candidates = [q for _, q in near if q not in rated][:n]
        for c in candidates:
            hits = [(sims[c, p], s) for _, _, s, p in events[:21] if sims.get((c, p), 0) > 0.4]
            if hits:
                likes = sum(s > 3 for _, s in hits)
                out[u, c] = (sum(a * b for a, b in hits) / len(hits)
                             + math.log10(max(likes, 1)) + math.log10(max(len(hits) - likes, 1)))
    return out


@pytest.mark.parametrize("n", [3, 20])
def test_whole_flow_equals_brute_force(spark, ratings, n):
    rng = random.Random(n)
    data = [(u, rng.randrange(40), float(rng.randint(1, 5)), rng.randrange(50), e)
            for e, u in enumerate([0] * 60 + [rng.randrange(1, 12) for _ in range(120)])]
    df = ratings(data)
    pairs = cut_lineage(realtime.ranked_sims(itemcf.itemcf_pairs(df)))
    sims = {(r.product_id, r.rec_id): r.sim for r in pairs.collect()}
    recent, rated = realtime.realtime_inputs(df)
    candidates = realtime.realtime_candidates(realtime.newest_rating(recent), pairs, rated, n)
    got = {(r.user_id, r.product_id): r.score
           for r in realtime.realtime_scores(candidates, recent, pairs).collect()}
    expected = brute(data, sims, n)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_queue_sizes_and_order(ratings):
    df = ratings([(1, p, 1.0, p // 2, p) for p in range(45)] + [(2, 7, 2.0, 0, 99)])
    queue = topk.recent_ratings_queue(df).where("user_id = 1").orderBy("rank").collect()
    assert [r.product_id for r in queue] == list(range(44, 4, -1))
    assert topk.recent_ratings_topn(df).where("user_id = 1").count() == 21


def test_ranked_lists_round_trip(spark):
    flat = spark.createDataFrame(
        [(k, r, 100 - r, 1.0 / r) for k in (1, 2) for r in range(1, 6)],
        "user_id long, rank int, product_id long, score double")
    lists = topk.ranked_lists(flat, "user_id", 3)
    assert {len(r.recs) for r in lists.collect()} == {3}
    back = topk.flatten_lists(lists, "user_id")
    assert {tuple(r) for r in back.collect()} == {
        tuple(r) for r in flat.where("rank <= 3").collect()}


def test_upsert_newest_wins_and_is_idempotent(ratings):
    base = ratings([(1, 1, 3.0, 10, 1), (1, 2, 4.0, 10, 2)])
    changes = ratings([(1, 1, 5.0, 20, 3), (2, 1, 1.0, 5, 4)])
    once = upserts.ratings_upsert(base, changes)
    assert {(r.user_id, r.product_id, r.score) for r in once.collect()} == {
        (1, 1, 5.0), (1, 2, 4.0), (2, 1, 1.0)}
    twice = upserts.ratings_upsert(once, changes)
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def test_users_first_registration_wins(spark):
    regs = spark.createDataFrame([("abc", 20), ("abc", 10), ("Aa", 1), ("BB", 2)],
                                 "username string, ts long")
    users = upserts.user_dim(regs)
    assert {(r.username, r.user_id, r.ts, r.first) for r in users.collect()} == {
        ("abc", 96354, 10, True), ("Aa", 2112, 1, True), ("BB", 2112, 2, True)}
    assert [tuple(r) for r in upserts.user_id_collisions(users).collect()] == [
        (2112, 2, "Aa", "BB")]
    changes = spark.createDataFrame([(96354, 1, 1, False, ["a"]), (96354, 2, 2, False, ["b"])],
                                    "user_id long, ts long, event_id long, first boolean, "
                                    "pref_genres array<string>")
    got = {r.username: (r.first, r.pref_genres)
           for r in upserts.user_profile_upsert(users, changes).collect()}
    assert got == {"abc": (False, ["b"]), "Aa": (True, []), "BB": (True, [])}


def test_group_limit_is_planned_before_the_shuffle(ratings):
    df = topk.recent_ratings_queue(ratings([(1, 1, 1.0, 1, 1)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial", plan.index("WindowGroupLimit"))
    assert "Exchange" in plan[:partial] and "Final" in plan


def test_not_yet_rated(spark):
    pairs = lambda *p: spark.createDataFrame(list(p), "user_id long, product_id long")
    got = realtime.not_yet_rated(pairs((1, 1), (1, 2), (2, 1)), pairs((1, 1)))
    assert {tuple(r) for r in got.select("user_id", "product_id").collect()} == {(1, 2), (2, 1)}
    liked = realtime.like_dislike_split(
        spark.createDataFrame([(1, 1.0, s) for s in (3.0, 3.5, 5.0)],
                              "user_id long, likeness double, score double"), ["user_id"])
    assert [(r.likes, r.dislikes) for r in liked.select(F.col("likes"), "dislikes").collect()] == [
        (2, 1)]


def test_lists_keep_what_they_are_given(spark):
    flat = spark.createDataFrame([(1, r, r * 10, 1.0 / r) for r in range(1, 31)],
                                 "user_id long, rank int, product_id long, score double")
    assert topk.flatten_lists(topk.ranked_lists(flat, "user_id"), "user_id").count() == 30


def test_deep_lists_and_pair_sims_equal_all_pairs(spark):
    rng = random.Random(12)
    data = sorted({(u, rng.randrange(25), float(rng.randint(1, 5)), rng.randrange(1000), k)
                   for u in range(40) for k in range(rng.randint(1, 12))})
    ratings = spark.createDataFrame(data, "user_id long, product_id long, score double, ts long, event_id long")
    recent, rated = realtime.realtime_inputs(ratings)
    current = realtime.newest_rating(recent)
    sims = realtime.ranked_sims(itemcf.itemcf_pairs(ratings))
    lists = realtime.deep_lists(ratings, cut_lineage(realtime.list_depths(current, rated, 4)))
    wanted = realtime.realtime_candidates(current, sims, rated, 4)
    got = realtime.realtime_candidates(current, lists, rated, 4)
    key = ["user_id", "rank", "product_id"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, wanted.select(key).collect()))
    keys = cut_lineage(realtime.scoring_keys(got, recent))
    some = {(r.product_id, r.rec_id): round(r.sim, 12)
            for r in itemcf.pair_sims(itemcf.user_items(ratings), keys).collect()}
    all_ = {(r.product_id, r.rec_id): round(r.sim, 12) for r in sims.collect()}
    asked = {(r.product_id, r.rec_id) for r in keys.collect()}
    assert some == {k: v for k, v in all_.items() if k in asked} and some


def test_candidates_in_parts_are_all_there_once(spark, monkeypatch):
    monkeypatch.setattr(realtime, "LEAST_PART", 10)
    monkeypatch.setattr(realtime, "PART_PAIRS", 0)
    candidates = spark.createDataFrame([(u, p) for u in range(5) for p in range(20)], "user_id long, product_id long")
    recent = spark.createDataFrame([(u, p) for u in range(5) for p in (100, 101)], "user_id long, product_id long")
    parts = realtime.candidate_parts(candidates, recent, recent)
    rows = [tuple(r) for part in parts for r in part.collect()]
    assert len(parts) == 20 and sorted(rows) == sorted(tuple(r) for r in candidates.collect())
