"""Connected components against union-find."""

import random

import pytest

from affinity.llm.components import components


def plain(edges):
    low = {}
    for a, b in edges:
        low.setdefault(a, a), low.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("edges", [
    [], [(1, 2)], [(1, 1), (3, 2), (2, 3), (3, 2)], [(k, k + 1) for k in range(60)],
    [(0, k) for k in range(1, 90)] + [(200, k) for k in range(89, 150)]])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == plain(edges) and len(got) == len(plain(edges))


def test_random_graphs_and_early_stop(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    df = spark.createDataFrame(edges, "a long, b long")
    wanted = plain(edges)
    assert {r.node: r.label for r in components(df).collect()} == wanted
    early = {r.node: r.label for r in components(df, rounds=1).collect()}
    assert early.keys() == wanted.keys() and all(wanted[early[n]] == wanted[n] for n in wanted)
