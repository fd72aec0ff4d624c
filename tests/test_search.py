"""Search through the index against the scan, and what a pattern must contain."""

import random

import pytest
from pyspark.sql import functions as F

from affinity.operators import search
from affinity.session import cut_lineage, scratch_dir
from affinity.sources import tables

WORDS = ["ring", "string", "bolt", "gear nut", "Ring.", "springy", "a+b", "鼠标垫", "x", "", "rin", "go ring ring"]


@pytest.fixture(scope="module")
def shop(spark):
    rng = random.Random(3)
    rows = [(k, None if k % 50 == 7 else " ".join(rng.choices(WORDS, k=rng.randint(1, 4)))) for k in range(400)]
    products = cut_lineage(spark.createDataFrame(rows, "product_id long, name string"))
    path = tables.write_layout(search.name_index(products), scratch_dir(spark, "index"), "gram")
    return products, spark.read.parquet(path)


@pytest.mark.parametrize("pattern, wanted", [
    ("ring", ["ring"]), ("^ring$", ["ring"]), ("str[ai]ng", ["str", "ng"]), ("(gear) nut", ["gear", " nut"]), ("a|ring", []),
    ("(?:ring)?x", []), ("(?i)ring", []), (r"\Qring\E", []), ("r(ing)+s", ["r", "ing", "s"]), ("ring*", ["rin"]),
    ("r.ng.{3}bolt", ["r", "ng", "bolt"]), (r"Ring\.", ["Ring."]), ("[", []), (r"\p{L}ring", []), ("鼠标垫", ["鼠标垫"]),
    ("(ring){0,2}", []), ("(ring){2}", ["ring"]), ("x(?=ring)", []), (r"\1ring", []), ("", [])])
def test_literals(pattern, wanted):
    assert search.literals(pattern) == wanted


@pytest.mark.parametrize("pattern", ["ring", "^string", r"Ring\.", "g ring", "rin|bolt", "(spr|st)ing", "gear n.t", "r",
                                     "鼠标垫", "bolt.*ring", "nothing like it", "(?i)RING", r"a\+b", "ring ring ring"])
def test_index_gives_what_the_scan_gives(shop, pattern):
    products, index = shop
    scan = products.where(F.regexp_like("name", F.lit(pattern)))
    got = search.matching(products, index, pattern)
    assert sorted(r.product_id for r in got.collect()) == sorted(r.product_id for r in scan.collect())


def test_names_that_are_read(shop):
    products, index = shop
    some = search.candidates(index, "gear nut")
    hits = products.where("name like '%gear nut%'").count()
    assert 0 < hits == some.count() < products.count() / 2
    assert search.candidates(index, "no such name").isEmpty() and search.candidates(index, "r.n") is None
    assert search.matching(products.limit(0), index.limit(0), "ring").count() == 0


def test_random_patterns(shop):
    products, index = shop
    rng = random.Random(4)
    names = [r.name for r in products.where("length(name) > 6").collect()]
    for _ in range(8):
        name = rng.choice(names)
        at = rng.randrange(len(name) - 5)
        pattern = "".join(rng.choice([c, c, c, ".", f"{c}+"]) if c.isalnum() else rf"\{c}" if c in ".+" else c
                          for c in name[at:at + rng.randint(3, 8)])
        scan = products.where(F.regexp_like("name", F.lit(pattern))).count()
        assert search.matching(products, index, pattern).count() == scan >= 1
