"""Hierarchies against plain walks; rings; odd ids."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import hierarchy as h
from millrace.operators import skew
from millrace.operators.hierarchy import descendants_of, endless_nodes, hierarchy


def plain(pairs):
    """id -> (root, depth, path) and the endless ids, by walking up."""
    parent = {}
    for i, p in pairs:
        if i is not None and i.strip():
            k = i.strip().lower()
            q = p.strip().lower() if p else None
            parent[k] = max(filter(None, (parent.get(k), q)), default=None)
    out, endless = {}, set()
    for k in parent:
        path, at = [k], k
        while parent[at] in parent:
            at = parent[at]
            if at in path:
                endless.add(k)
                break
            path.append(at)
        else:
            out[k] = (path[-1], len(path) - 1, path[::-1])
    return out, endless


def compare(spark, pairs):
    tree = hierarchy(spark, spark.createDataFrame([(a, b, 1, "x") for a, b in pairs], "id string, parent_run_id string, depth int, path string"), "id", "parent_run_id").cache()
    want, endless = plain(pairs)
    got = {r.id: r for r in tree.collect()}
    assert got.keys() == want.keys() | endless
    for k, (root, depth, path) in want.items():
        r = got[k]
        assert (r.root, r.depth, r.path, r.endless) == (root, depth, path, False)
        below = {x for x, (_, _, p) in want.items() if k in p and x != k}
        assert r.descendants == len(below)
        assert below == {x.id for x in got.values() if x.root == r.root and r.pos is not None and r.pos < x.pos <= r.last}
    assert {k for k, r in got.items() if r.endless} == endless
    for root in {r.root for r in got.values()} - {None}:
        places = sorted(r.pos for r in got.values() if r.root == root)
        assert places == list(range(len(places)))
    return tree


@pytest.mark.parametrize("seed", [1])
def test_random_forests_with_rings(spark, seed):
    r = random.Random(seed)
    n = 60
    pairs = [(f"n{i}", None if r.random() < 0.08 else f"n{r.randrange(max(1, i)) if r.random() < 0.95 else r.randrange(n)}") for i in range(n)]
    compare(spark, pairs)


def test_ways_to_write_ids_and_no_parent(spark):
    pairs = [("A ", ""), ("b", " a"), ("B", "A"), ("c", "null"), ("d", "never-came"), ("e", "E"), (None, "a"), (" ", "a"), ("f", "e"), ("b", None)]
    tree = compare(spark, pairs)
    assert rows(tree.where("endless"), "id") == [("e",), ("f",)]
    assert rows(descendants_of(tree, spark.createDataFrame([("a",)], "id string")), "descendant") == [("b",)]


def test_descendants_by_blocks_and_hot_parents(spark, monkeypatch):
    """Blocks of three positions and parents hot from two children on give the same."""
    for name in ("look_up",):
        monkeypatch.setattr(h, name, lambda *a, f=skew.look_up: f(*a, hot_rows=2))
    monkeypatch.setattr(h, "BLOCK", 3)
    monkeypatch.setattr(h, "SIBLING_GROUP", 4)
    pairs = [(f"w{i}", "top" if i < 30 else f"w{i % 7}") for i in range(45)] + [("top", None), ("x", "y"), ("y", "x"), ("z", "x")]
    tree = compare(spark, pairs)
    want = sorted((a, k) for k, (_, _, path) in plain(pairs)[0].items() for a in path[:-1])
    assert rows(descendants_of(tree), "id", "descendant") == want
    assert rows(endless_nodes(spark, spark.createDataFrame(pairs, "id string, parent_run_id string"), "id", "parent_run_id")) == [("x",), ("y",), ("z",)]


def test_long_chain_and_wide_star(spark):
    """Labels of a chain and of a star: the rounds follow the logarithm of the depth."""
    n = 3000
    i = F.col("id")
    chain = spark.range(n).select(F.concat(F.lit("c"), i).alias("id"), F.when(i > 0, F.concat(F.lit("c"), i - 1)).alias("up"))
    star = spark.range(n).select(F.concat(F.lit("s"), i).alias("id"), F.when(i > 0, F.lit("s0")).alias("up"))
    tree = hierarchy(spark, chain.unionByName(star), "id", "up", paths=False)
    got = tree.groupBy("root").agg(F.max("depth"), F.sum("descendants"), F.max("last"), F.count_distinct("pos"))
    assert rows(got) == [("c0", n - 1, n * (n - 1) // 2, n - 1, n), ("s0", 1, n - 1, n - 1, n)]


def test_empty(spark):
    assert hierarchy(spark, spark.createDataFrame([], "id string, parent_run_id string"), "id", "parent_run_id").count() == 0
