"""Distances along next-page links: chains, rings, shared targets."""

import pytest

from crawlfold.operators import frontier


def distances(spark, edges, seeds, salts=4):
    e = spark.createDataFrame(edges, "url string, next_url string")
    s = spark.createDataFrame([(x,) for x in seeds], "url string")
    return {r["url"]: r["depth"] for r in frontier.depth(e, s, salts).collect()}


def by_walking(edges, seeds):
    following, found = dict(edges), {}
    for s in seeds:
        at, d = s, 0
        while at is not None and found.get(at, d + 1) > d:
            found[at] = d
            at, d = following.get(at), d + 1
    return found


@pytest.mark.parametrize("edges,seeds", [
    ([(f"a{i}", f"a{i+1}") for i in range(37)], ["a0"]),
    ([(f"r{i}", f"r{(i+1) % 11}") for i in range(11)], ["r3", "r9"]),
    ([("x", "x")], ["x"]),
    ([(f"m{i}", "hub") for i in range(40)] + [("hub", "h1"), ("h1", "h2"), ("h2", "m0")], ["m5", "m7"]),
    ([("a", "b"), ("c", "d")], ["a", "lonely"]),
])
def test_distances(spark, edges, seeds):
    assert distances(spark, edges, seeds) == by_walking(edges, seeds)


def test_a_page_stored_twice_counts_once(spark):
    assert distances(spark, [("a", "b"), ("a", "b"), ("b", "c")], ["a"]) == {"a": 0, "b": 1, "c": 2}
