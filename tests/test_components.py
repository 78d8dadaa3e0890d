"""Components by contraction: against brute force, on long chains, and when numbers clash."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import graphs


def _want(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {x: root(x) for x in list(up)}


def _got(spark, edges, kind="string"):
    return {r["node"]: r["component"] for r in graphs.connected_components(spark.createDataFrame(edges, f"src {kind}, dst {kind}")).collect()}


def test_a_chain_shrinks_from_round_to_round(spark, monkeypatch):
    """A chain in the order of its nodes, with single nodes and many small groups: all that is stored is a few times its rows."""
    n, rng = 3000, random.Random(2)
    edges = [(f"A{i:05d}", f"A{i + 1:05d}") for i in range(n)] + [(f"B{i:05d}", f"B{i:05d}") for i in range(50)] + [(f"C{rng.randrange(400):05d}", f"C{rng.randrange(400):05d}") for _ in range(200)]
    sizes, keep = [], graphs.stored

    def counted(df, name):
        out = keep(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(graphs, "stored", counted)
    assert _got(spark, edges) == _want(edges)
    assert sum(sizes) <= 10 * len(edges)


@pytest.mark.parametrize("edges", [[(5, 5)], [(1, 9), (9, 4), (3, 3), (7, 8), (8, 7)]])
def test_small_components_of_numbers(spark, edges):
    assert _got(spark, edges, "long") == _want(edges)


def test_clashing_numbers_are_made_anew(spark, monkeypatch):
    keep, seeds = graphs._number, []

    def number(c, seed):
        seeds.append(seed)
        return F.length(c).cast("long") if seed == 0 else keep(c, seed)

    monkeypatch.setattr(graphs, "_number", number)
    assert _got(spark, [("a", "b"), ("c", "c")]) == {"a": "a", "b": "a", "c": "c"}
    assert max(seeds) == 1


def test_links_of_mega_components_are_made_once(spark, monkeypatch):
    from tidewatch.plans import registry, tables

    made, one = [], tables.connected_components
    monkeypatch.setattr(tables, "connected_components", lambda *a: made.append(a) or one(*a))
    tables.forget(spark)
    for name in ("mega_network_clusters", "mega_component_split"):
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").columns
    assert len(made) == 1
    tables.forget(spark)
