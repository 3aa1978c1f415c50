"""Connected components against union-find, hubs included."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import components
from tidemark.llm.common import prepare


def plain_components(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for pair in pairs for x in pair if root(x) != x}


def graphs():
    rng = random.Random(3)
    star = [(7000, i) for i in range(1, 3000)]  # a hub above all its neighbours
    low = [(0, i) for i in range(10_000, 12_000)]
    chain = [(i, i + 1) for i in range(20_000, 20_040)]
    return {
        "hubs": star + low + chain + [(2999, 5), (11_999, 20_000), (8, 8)],
        "no hub": chain + [(b, a) for a, b in chain],
        "random": [(rng.randrange(600), rng.randrange(600)) for _ in range(500)] + [(rng.randrange(600), -5) for _ in range(150)] * 2,
        "none": [(4, 4)],
    }


@pytest.mark.parametrize("name", list(graphs()))
@pytest.mark.parametrize("hub_edges, most_hubs", [(100, 10_000), (2, 3), (10**9, 10_000)])
def test_components_are_those_of_union_find(spark, monkeypatch, name, hub_edges, most_hubs):
    if name != "hubs" and hub_edges == 100:
        pytest.skip("nothing here has so many edges")
    prepare(spark)
    monkeypatch.setattr(components, "HUB_EDGES", hub_edges)
    monkeypatch.setattr(components, "MOST_HUBS", most_hubs)
    pairs = graphs()[name]
    got = components.components(spark.createDataFrame(pairs, "a long, b long").repartition(5)).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == plain_components(pairs)
