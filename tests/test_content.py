import math
import random
from collections import Counter, defaultdict

import pytest

from affinity.operators import content
from affinity.operators.pairs import meeting_pairs, owner_pairs
from affinity.session import cut_lineage


def products(spark, tags):
    return spark.createDataFrame(
        [(i, f"p{i}", "", "", t) for i, t in enumerate(tags)],
        "product_id long, name string, image_url string, categories string, tags string")


def brute(tags, threshold=0.4):
    bags = [t.lower().replace("|", " ").split() for t in tags]
    df = Counter(t for b in bags for t in set(b))
    vec = [{t: c * math.log((len(bags) + 1) / (df[t] + 1)) for t, c in Counter(b).items()}
           for b in bags]
    norm = [math.sqrt(sum(w * w for w in v.values())) for v in vec]
    out = {}
    for i, a in enumerate(vec):
        for j, b in enumerate(vec):
            if i != j and norm[i] and norm[j]:
                s = sum(w * b.get(t, 0.0) for t, w in a.items()) / (norm[i] * norm[j])
                if s > threshold:
                    out[i, j] = s
    return out


def random_tags(seed, n=80):
    """Every third product is a copy of one bag; one tag is nearly everywhere."""
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(14)]
    return ["common|W1|W2" if i % 3 == 0 else
            "|".join(["common"] + rng.choices(words, k=rng.randint(1, 4))) for i in range(n)]


def test_idf_and_zero_vectors(spark):
    bags = content.content_tokens(products(spark, ["all|rare", "all", "all"]))
    weights = {(r.product_id, r.term): round(r.weight, 6)
               for r in content.content_tfidf(bags).collect()}
    assert weights == {(0, "all"): 0.0, (1, "all"): 0.0, (2, "all"): 0.0, (0, "rare"): 0.693147}
    assert content.content_pairs(bags).count() == 0
    assert content.content_topk(bags).count() == 0


def test_tokens(spark):
    got = [r.tokens for r in content.content_tokens(
        products(spark, ["Good|Mouse", "a  b ", "", None])).orderBy("product_id").collect()]
    assert got == [["good", "mouse"], ["a", "", "b"], [""], [""]]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("threshold", [0.2, 0.4, 0.8])
def test_expanded_pairs_equal_all_pairs(spark, seed, threshold):
    tags = random_tags(seed)
    bags = content.content_tokens(products(spark, tags))
    profiles = content.tag_profiles(bags)
    pairs = content.content_pairs(bags, threshold)
    rows = content.expand_pairs(pairs, content.profile_members(bags, profiles)).collect()
    got = {(r.product_id, r.rec_id): r.sim for r in rows}
    expected = brute(tags, threshold)
    assert len(rows) == len(got) and got.keys() == expected.keys()
    assert all(got[key] == pytest.approx(expected[key], abs=1e-9) for key in got)


def test_pairs_do_not_depend_on_the_cells(spark, monkeypatch):
    bags = content.content_tokens(products(spark, random_tags(4)))
    whole = {tuple(r)[:4] for r in content.content_pairs(bags).collect()}
    monkeypatch.setattr(content, "CELL_PROFILES", 3)
    assert {tuple(r)[:4] for r in content.content_pairs(bags).collect()} == whole


@pytest.mark.parametrize("k", [1, 4, 50])
def test_topk_equals_sorted_pairs(spark, k):
    tags = random_tags(5)
    lists = defaultdict(list)
    for (i, j), s in brute(tags).items():
        lists[i].append((-round(s, 9), j))
    expected = {(i, r + 1, j) for i, rest in lists.items()
                for r, (_, j) in enumerate(sorted(rest)[:k])}
    bags = content.content_tokens(products(spark, tags))
    got = [(r.product_id, r["rank"], r.rec_id) for r in content.content_topk(bags, k).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_hashed_bags_keep_counts(spark):
    tags = ["red|red|ball", "blue|ball"]
    bags = {r.product_id: Counter(Counter(r.tokens).values()) for r in
            content.hashed_bags(products(spark, tags)).collect()}
    assert bags == {0: Counter({2: 1, 1: 1}), 1: Counter({1: 2})}
    all_tokens = {t for r in content.hashed_bags(products(spark, tags)).collect()
                  for t in r.tokens}
    assert all(0 <= int(t) < 800 for t in all_tokens)


def random_bags(spark, seed, products=120, words=40, longest=8):
    rng = random.Random(seed)
    rows = [(p, [f"t{int(rng.paretovariate(0.7)) % words}" for _ in range(rng.randint(0, longest))]) for p in range(products)]
    return spark.createDataFrame(rows, "product_id long, tokens array<string>")


@pytest.mark.parametrize("seed, words", [(1, 40), (2, 400), (3, 6)])
def test_lists_by_either_way_are_the_first_of_all_pairs(spark, seed, words, monkeypatch):
    bags = random_bags(spark, seed, words=words)
    vectors = content.unit_vectors(content.tag_profiles(bags))
    every = {}
    for r in content.profile_pairs(vectors, 0.3).collect():
        every.setdefault(r.a, []).append((-round(r.sim * 1e9), r.b))
        every.setdefault(r.b, []).append((-round(r.sim * 1e9), r.a))
    for profile in [r.profile for r in vectors.where("place = 1").collect()]:
        every.setdefault(profile, []).append((-10**9, profile))
    wanted = {a: [b for _, b in sorted(rest)[:5]] for a, rest in every.items()}

    def lists(df):
        out = {}
        for r in df.collect():
            out.setdefault(r.a, []).append((-round(r.sim * 1e9), r.b))
        return {a: [b for _, b in sorted(rest)] for a, rest in out.items()}

    assert lists(content.nearest_profiles(vectors, 5, 0.3)) == wanted
    for cells in (0, 10**9):
        monkeypatch.setattr(content, "CELLS_PER_PAIR", cells)
        assert lists(content.list_neighbours(vectors, 5, 0.3)) == wanted
    monkeypatch.setattr(content, "tiles_for", lambda *args: 4)
    assert lists(content.list_neighbours(vectors, 5, 0.3)) == wanted


def test_bounds_rise_with_the_lists(spark, monkeypatch):
    """Pairs that are looked up, against those above the threshold alone: a k-th best closes most terms."""
    bags = random_bags(spark, 5, products=600, words=3000, longest=12)
    vectors = content.unit_vectors(content.tag_profiles(bags))
    looked_up = []
    whole = content.possible_neighbours

    def noted(*args):
        out = cut_lineage(whole(*args))
        looked_up.append(out.count())
        return out

    monkeypatch.setattr(content, "possible_neighbours", noted)
    content.nearest_profiles(vectors, 4, 0.05)
    postings = cut_lineage(content._postings(vectors, 0.05))
    every = owner_pairs(postings, "term", "profile").where(
        "w_a * w_b + rest_a * rest_b > 0.05").selectExpr("least(profile_a, profile_b)", "greatest(profile_a, profile_b)")
    assert sum(looked_up) * 3 < 2 * every.distinct().count()


@pytest.mark.parametrize("cell", [2, 1000])
def test_meeting_pairs(spark, cell):
    left = cut_lineage(spark.createDataFrame([(k % 3, k) for k in range(30)], "key long, x long"))
    right = cut_lineage(spark.createDataFrame([(k % 4, k) for k in range(20)], "key long, y long"))
    got = sorted((r.x, r.y) for r in meeting_pairs(left, right, "key", cell).collect())
    assert got == sorted((x, y) for x in range(30) for y in range(20) if x % 3 == y % 4)


def test_products_of_one_file_are_hashed_by_several_tasks(spark):
    one = products(spark, [f"red|t{i}|t{i}" for i in range(50)]).coalesce(1)
    assert content.content_hashed_tf(one).rdd.getNumPartitions() > 1
    assert "vector_to_array" not in content.hashed_bags(one)._jdf.queryExecution().toString()
    assert {len(r.tokens) for r in content.hashed_bags(one).collect()} == {3}
