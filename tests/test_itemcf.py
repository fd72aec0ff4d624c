import math
import random
from collections import Counter, defaultdict

import pytest

from affinity.operators import itemcf, realtime, topk
from affinity.operators.tiles import row_products
from affinity.session import cut_lineage


def brute(data, k=None):
    """Similarity the long way: every pair of rating rows of a user."""
    by_user = defaultdict(list)
    for u, p, *_ in data:
        by_user[u].append(p)
    n = Counter(p for _, p, *_ in data)
    co = Counter()
    for items in by_user.values():
        for p in items:
            for q in items:
                if p != q:
                    co[p, q] += 1
    lists = defaultdict(list)
    for (p, q), c in co.items():
        lists[p].append((-(float(c) * c / n[q]), q, c / math.sqrt(n[p] * n[q])))
    return {(p, i + 1, q): s for p, rest in lists.items()
            for i, (_, q, s) in enumerate(sorted(rest)[:k])}


def flat(df):
    return {(r.product_id, r["rank"], r.rec_id): r.sim for r in df.collect()}


def skewed(seed, users=30, items=60, hot=(0, 1)):
    rng = random.Random(seed)
    out, event = [], 0
    for u in range(users):
        mine = (rng.choices(range(items), k=items) + rng.sample(range(items), items // 2)
                if u in hot else rng.sample(range(items), rng.randint(1, 6)))
        for p in mine:
            out.append((u, p, 3.0, 0, event))
            event += 1
    return out


def test_golden_cooccurrence(ratings):
    data = [(1, 1, 5.0, 0, 0), (1, 2, 5.0, 0, 1), (2, 1, 5.0, 0, 2), (2, 2, 5.0, 0, 3),
            (3, 1, 5.0, 0, 4)]
    got = {(r.product_id, r.rec_id): (r.co_count, r.count1, r.count2, round(r.sim, 6))
           for r in itemcf.itemcf_pairs(ratings(data)).collect()}
    assert got == {(1, 2): (2, 3, 2, 0.816497), (2, 1): (2, 2, 3, 0.816497)}


def test_duplicate_rows_count(ratings):
    data = [(1, 1, 5.0, 0, 0), (1, 1, 4.0, 1, 1), (1, 2, 5.0, 0, 2)]
    got = {(r.product_id, r.rec_id): (r.co_count, round(r.sim, 6))
           for r in itemcf.itemcf_pairs(ratings(data)).collect()}
    assert got == {(1, 2): (2, 1.414214), (2, 1): (2, 1.414214)}
    once = {(r.product_id, r.rec_id): r.sim
            for r in itemcf.itemcf_pairs(ratings(data), dedup=True).collect()}
    assert once == {(1, 2): 1.0, (2, 1): 1.0}


@pytest.mark.parametrize("cell", [3, 1024])
def test_pairs_do_not_depend_on_the_cells(ratings, cell):
    data = skewed(1)
    rows = itemcf.user_items(ratings(data))
    got = {(r.a, r.b): r.co for r in itemcf.pair_counts(rows, cell).collect()}
    co = Counter()
    for u in {d[0] for d in data}:
        items = [d[1] for d in data if d[0] == u]
        for p in items:
            for q in items:
                if p < q:
                    co[p, q] += 1
    assert got == dict(co)


@pytest.mark.parametrize("seed, hot", [(2, (0,)), (3, (0, 1, 2)), (4, tuple(range(12)))])
def test_heavy_users_give_the_same_lists(ratings, seed, hot):
    data = skewed(seed, hot=hot)
    df = ratings(data)
    expected = brute(data, 5)
    rows = itemcf.user_items(df)
    assert {r.user_id for r in itemcf.heavy_users(rows, min_items=20).collect()} == set(hot)
    got = flat(itemcf.itemcf_topk(df, 5, min_heavy_items=20, cell_items=8))
    assert got.keys() == expected.keys()
    assert all(got[key] == pytest.approx(expected[key]) for key in got)
    assert flat(itemcf.itemcf_topk(df, 5)).keys() == expected.keys()


def test_which_users_are_heavy_only_moves_work(ratings):
    data = skewed(5, hot=(0, 1, 2, 3))
    rows = itemcf.user_items(ratings(data))
    some = itemcf.heavy_users(rows, min_items=20).where("user_id in (0, 2)")
    assert some.count() == 2
    got = flat(itemcf._top(itemcf._with_heavy(rows, some, 4, 16), 4))
    assert got.keys() == brute(data, 4).keys()


def test_four_hundred_wide_users_form_no_pairs_of_their_products(ratings, monkeypatch):
    rng = random.Random(9)
    tastes = [[(p, rng.randint(1, 5)) for p in range(60) if rng.random() < 0.7] for _ in range(3)]
    data = [(u, p, float(x), 0, 0) for u in range(400) for p, x in tastes[u % 3]]
    data += [(1000 + u, rng.randrange(60), 1.0, 0, 0) for u in range(300)]
    paired = []
    whole = itemcf.pair_counts

    def noted(rows, *args):
        paired.append(rows)
        return whole(rows, *args)

    monkeypatch.setattr(itemcf, "pair_counts", noted)
    got = flat(itemcf.itemcf_topk(ratings(data), 6, min_heavy_items=20))
    assert got.keys() == brute(data, 6).keys()
    widest = [rows.groupBy("user_id").count().agg({"count": "max"}).first()[0] or 0 for rows in paired]
    assert sorted(widest)[0] < 20  # light users' own products
    assert sorted(widest)[-1] <= 8  # profiles: at most one per set of tastes


def test_light_pairs_are_joined_once_after_aggregation(ratings):
    data = skewed(5, hot=(0, 1))
    rows = itemcf.user_items(ratings(data))
    plan = itemcf._with_heavy(rows, itemcf.heavy_users(rows, 20), 4, 16)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    above = text.split("sum(co")[0]
    assert above.count("Join LeftOuter") == 1


def test_only_heavy_users(ratings):
    data = [(u, p, 1.0, 0, 0) for u in (1, 2) for p in range(30) if (p + u) % 3]
    got = flat(itemcf.itemcf_topk(ratings(data), 4, min_heavy_items=5, cell_items=4))
    assert got.keys() == brute(data, 4).keys()


def test_lists_have_no_gaps_no_self_and_are_symmetric(ratings):
    df = ratings(skewed(6))
    pairs = {(r.product_id, r.rec_id): r.sim for r in itemcf.itemcf_pairs(df).collect()}
    assert all(pairs[q, p] == s and p != q for (p, q), s in pairs.items())
    ranks = defaultdict(list)
    for p, rank, _ in flat(itemcf.itemcf_topk(df, 7)):
        ranks[p].append(rank)
    assert all(sorted(r) == list(range(1, len(r) + 1)) and len(r) <= 7 for r in ranks.values())


def test_nested_lists_keep_the_order(ratings):
    df = ratings(skewed(7))
    nested = {r.product_id: [x.product_id for x in r.recs]
              for r in itemcf.itemcf_lists(df, 5).collect()}
    expected = defaultdict(list)
    for p, _, q in sorted(flat(itemcf.itemcf_topk(df, 5))):
        expected[p].append(q)
    assert nested == dict(expected)


@pytest.mark.parametrize("users, items", [(3, 40), (60, 6)])
def test_pair_sims_by_either_way(ratings, users, items):
    rng = random.Random(users)
    data = [(u, rng.randrange(50), 1.0, 0, 0) for u in range(users) for _ in range(items)]
    df = ratings(data)
    every = {(r.product_id, r.rec_id): r.sim for r in itemcf.itemcf_pairs(df).collect()}
    for share in (0.05, 1.0):
        asked = [k for k in sorted(every) if rng.random() < share] + [(1000, 1)]
        keys = df.sparkSession.createDataFrame(asked, "product_id long, rec_id long")
        got = {(r.product_id, r.rec_id): r.sim
               for r in itemcf.pair_sims(itemcf.user_items(df), keys).collect()}
        assert got == pytest.approx({k: every[k] for k in asked if k in every})


@pytest.mark.parametrize("seed, hot", [(2, ()), (3, (0, 1, 2)), (4, tuple(range(12)))])
def test_every_list_has_its_own_depth(ratings, seed, hot):
    """One deep list, some shallow ones, and no rows of the products without a list."""
    data = skewed(seed, hot=hot)
    rows = itemcf.user_items(ratings(data))
    depths = {p: 40 if p == 7 else 1 + p % 4 for p in range(0, 60, 2)} | {7: 40, 999: 5}
    table = cut_lineage(rows.sparkSession.createDataFrame(list(depths.items()), "product_id long, depth long"))
    got = flat(itemcf.lists_to_depth(rows, table, min_heavy_items=20, cell_items=8))
    wanted = {key: s for key, s in brute(data).items() if key[1] <= depths.get(key[0], 0)}
    assert got == pytest.approx(wanted)
    without = cut_lineage(table.where("product_id <> 7"))
    others = flat(itemcf.lists_to_depth(rows, without, min_heavy_items=20, cell_items=8))
    assert others == pytest.approx({key: s for key, s in wanted.items() if key[0] != 7})


def test_a_deep_list_adds_no_rows_to_the_others(ratings, monkeypatch):
    """A user with nearly all ratings makes one list as deep; what is ranked for the others stays."""
    rng = random.Random(8)
    data = [(0, p, 1.0, 0, 0) for p in range(1500)]
    data += [(u, rng.randrange(1500), 1.0, 0, 0) for u in range(1, 200) for _ in range(4)]
    df = ratings(data)
    rows = itemcf.user_items(df)
    counted = []

    def ranked(counts, *args):
        out = cut_lineage(topk.topk_to_depth(counts, *args))
        counted.append({r.a: r["count"] for r in out.groupBy("a").count().collect()})
        return out

    monkeypatch.setattr(itemcf, "topk_to_depth", ranked)
    rated = cut_lineage(rows.select("user_id", "product_id"))
    current = rated.groupBy("user_id").agg({"product_id": "min"}).toDF("user_id", "product_id")
    depths = cut_lineage(realtime.list_depths(current, rated))
    itemcf.lists_to_depth(rows, depths, min_heavy_items=1000).count()
    own = {r.product_id: r.depth for r in depths.collect()}
    assert max(own.values()) == 1520 and sorted(own.values())[-2] <= 24 + 4
    assert all(n <= own[a] for found in counted for a, n in found.items())
    assert counted[-1][0] == 1499


@pytest.mark.parametrize("hot", [(), (0, 1)])
def test_lists_owners_come_before_the_sums(ratings, hot):
    rows = itemcf.user_items(ratings(skewed(5, hot=hot)))
    depths = cut_lineage(rows.select("product_id").distinct().limit(5).selectExpr("product_id", "3L as depth"))
    plan = itemcf.lists_to_depth(rows, depths, min_heavy_items=20)._jdf.queryExecution().optimizedPlan().toString()
    last_sum = plan[plan.rindex("sum(co"):]
    assert "depth" in last_sum and "Join Inner, (product_id" in last_sum


@pytest.mark.parametrize("tiles, blocks", [(1, 1), (3, 1), (4, 3)])
def test_row_products(spark, tiles, blocks):
    rng = random.Random(tiles)
    entries = {(rng.randrange(40), rng.randrange(25)): rng.randint(1, 9) for _ in range(300)}
    wanted = Counter()
    for (i, u), n in entries.items():
        for (j, v), m in entries.items():
            if u == v:
                wanted[i, j] += n * m
    df = spark.createDataFrame([(i, u, n) for (i, u), n in entries.items()], "item long, col long, n long")
    got = row_products(df, tiles, blocks).collect()
    assert {(r.a, r.b): r.co for r in got} == dict(wanted) and len(got) == len(wanted)
    large = df.withColumn("n", df.n * 10**8)
    assert {(r.a, r.b): r.co for r in row_products(large, tiles, blocks).collect()} == {
        k: v * 10**16 for k, v in wanted.items()}


def test_wide_users_of_different_taste_sum_cells_not_pairs(ratings, monkeypatch):
    """400 users of random taste: all products are profiles, and cells are far fewer than pairs."""
    rng = random.Random(10)
    data = [(u, p, 1.0, 0, 0) for u in range(400) for p in rng.sample(range(150), 60)]
    data += [(1000 + u, rng.randrange(150), 1.0, 0, 0) for u in range(100) for _ in range(3)]
    cells = []
    whole = itemcf.row_products

    def noted(*args):
        out = cut_lineage(whole(*args))
        cells.append(out.count())
        return out

    monkeypatch.setattr(itemcf, "row_products", noted)
    got = flat(itemcf.itemcf_topk(ratings(data), 6, min_heavy_items=20))
    wanted = brute(data, 6)
    assert got == pytest.approx(wanted)
    assert cells == [150 * 150] and 400 * 60 * 60 > 60 * cells[0]


@pytest.mark.parametrize("cell", [8, 1024])
def test_rounds_and_cells_give_the_same_lists(ratings, monkeypatch, cell):
    """Owners in rounds, products in cells and users too wide for a list change no row; null users pair nothing."""
    data = [*skewed(6), (None, 1, 1.0, 0, 900), (None, 2, 1.0, 0, 901)]
    wanted = brute([row for row in data if row[0] is not None], 5)
    plain = flat(itemcf.itemcf_topk(ratings(data), 5, min_heavy_items=1000))
    rounds, write = [], itemcf.cut_lineage
    monkeypatch.setattr(itemcf, "cut_lineage", lambda df: rounds.append(df.columns) or write(df))
    monkeypatch.setattr(itemcf, "LEAST_ROUND", 200)
    monkeypatch.setattr(itemcf, "ROUND_PAIRS", 1)
    monkeypatch.setattr(itemcf, "CELL_PAIRS", 50)
    got = flat(itemcf.itemcf_topk(ratings(data), 5, min_heavy_items=1000, cell_items=cell))
    assert got == pytest.approx(plain) and {k[::2] for k in got} and len(got) == len(wanted)
    assert sum("rank" in columns for columns in rounds) > 3


def test_similarities_below_the_least_are_left_out(ratings):
    df = ratings(skewed(7))
    every = {(r.product_id, r.rec_id): r.sim for r in itemcf.itemcf_pairs(df).collect()}
    keys = df.sparkSession.createDataFrame(list(every), "product_id long, rec_id long")
    got = {(r.product_id, r.rec_id): r.sim for r in itemcf.pair_sims(itemcf.user_items(df), keys, 0.3).collect()}
    assert got == pytest.approx({k: s for k, s in every.items() if s > 0.3})


def test_written_stages_leave_no_shuffle_files(ratings):
    df = ratings(skewed(8))
    blocks = df.sparkSession._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return sum(name.startswith("shuffle_") for name in
                   (blocks.getAllFiles().apply(i).getName() for i in range(blocks.getAllFiles().size())))

    before = files()
    cut_lineage(df.groupBy("product_id").count())
    assert files() <= before


def test_a_round_meets_its_own_keys_only(ratings, monkeypatch):
    """Repeated keys, owners in rounds and products in cells: the same as all pairs, and no round reads all keys."""
    df = ratings(skewed(9))
    every = {(r.product_id, r.rec_id): r.sim for r in itemcf.itemcf_pairs(df).collect()}
    keys = df.sparkSession.createDataFrame([*every, *list(every)[::2], (1000, 1)], "product_id long, rec_id long")
    rows = itemcf.user_items(df)
    monkeypatch.setattr(itemcf, "LOOKUP_PAIRS", 1000)
    plans, write = [], itemcf.cut_lineage

    def noted(made):
        if made.columns == ["product_id", "rec_id", "sim"]:
            plans.append(made._jdf.queryExecution().optimizedPlan().toString())
        return write(made)

    monkeypatch.setattr(itemcf, "cut_lineage", noted)
    monkeypatch.setattr(itemcf, "LEAST_ROUND", 200)
    monkeypatch.setattr(itemcf, "ROUND_PAIRS", 1)
    monkeypatch.setattr(itemcf, "CELL_PAIRS", 50)
    for least in (0.0, 0.3):
        got = [tuple(r) for r in itemcf.pair_sims(rows, keys, least).collect()]
        assert {r[:2]: r[2] for r in got} == pytest.approx({k: s for k, s in every.items() if s > least})
        assert len(got) == len({r[:2] for r in got})
    assert len(plans) > 6
    assert all("pmod(xxhash64(product_id" in plan for plan in plans)


def test_repeated_keys_are_looked_up_once(ratings):
    df = ratings(skewed(10))
    every = {(r.product_id, r.rec_id): r.sim for r in itemcf.itemcf_pairs(df).collect()}
    asked = sorted(every)[:3]
    keys = df.sparkSession.createDataFrame(asked * 3, "product_id long, rec_id long")
    got = [tuple(r) for r in itemcf.pair_sims(itemcf.user_items(df), keys).collect()]
    assert len(got) == 3 and {r[:2]: r[2] for r in got} == pytest.approx({k: every[k] for k in asked})


@pytest.mark.parametrize("spread", [(1, 0), (1 << 33, -5), (1 << 58, -(1 << 62)), (-3, 0)])
def test_lists_of_large_and_negative_products(ratings, monkeypatch, spread):
    times, plus = spread
    data = [(u, p * times + plus, *rest) for u, p, *rest in skewed(11) if p < 30]
    monkeypatch.setattr(itemcf, "LEAST_ROUND", 200)
    monkeypatch.setattr(itemcf, "CELL_PAIRS", 100)
    for cell in (8, 1024):
        assert flat(itemcf.itemcf_topk(ratings(data), 5, min_heavy_items=1000, cell_items=cell)) == pytest.approx(brute(data, 5))
