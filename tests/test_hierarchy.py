import random
import re

import pytest

from mlframe.operators import graph
from mlframe.operators.graph import rollup

VERTICES, EDGES = "id long, reading double", "src long, dst long"


def _rounds(spark, monkeypatch, tmp_dir, v, e):
    """(totals or None for a cycle, rounds written)"""
    import os
    monkeypatch.setattr(graph, "scratch_dir", lambda spark, name: tmp_dir)
    try:
        got = {r["id"]: r["total"] for r in rollup(v, e).collect()}
    except ValueError:
        got = None
    return got, len([f for f in os.listdir(tmp_dir) if re.match(r"round=\d+$", f)])


def test_a_cycle_is_found_after_its_longest_tail(spark, monkeypatch, tmp_dir):
    ring = [(i, (i + 1) % 12) for i in range(12)] + [(20, 21), (21, 0)]
    v = spark.createDataFrame([(i, 1.0) for i in [*range(12), 20, 21]], VERTICES)
    got, rounds = _rounds(spark, monkeypatch, tmp_dir, v, spark.createDataFrame(ring, EDGES))
    assert got is None and rounds == 3


def test_self_loop(spark):
    with pytest.raises(ValueError):
        rollup(spark.createDataFrame([(1, 0.0)], VERTICES), spark.createDataFrame([(1, 1)], EDGES))


def test_wide_tree_takes_rounds_by_depth(spark, monkeypatch, tmp_dir):
    v = spark.createDataFrame([(i, 1.0) for i in range(401)], VERTICES)
    e = spark.createDataFrame([(i, 400) for i in range(400)], EDGES)
    got, rounds = _rounds(spark, monkeypatch, tmp_dir, v, e)
    assert got[400] == 401.0 and rounds == 2


def test_random_graph_against_recursion(spark):
    g = random.Random(3)
    edges = [(a, b) for a in range(40) for b in range(a + 1, 40) if g.random() < 0.08]
    edges += edges[:2] + [(99, 39), (38, 77), (None, 5)]  # repeated edges, ends that are no vertices, no source
    own = {i: g.choice([-2.0, 0.0, 1.0, None, 3.0]) for i in range(40)}
    children = {}
    for a, b in edges:
        children.setdefault(b, []).append(a)

    def total(i):
        return (own.get(i) or 0.0) + sum(total(c) for c in children.get(i, []) if c is not None)
    want = {i: total(i) for i in range(40)} | ({77: total(77)} if total(77) else {})
    v, e = spark.createDataFrame(list(own.items()), VERTICES), spark.createDataFrame(edges, EDGES)
    assert {r["id"]: r["total"] for r in rollup(v, e).collect()} == want


def test_no_edges_and_null_id(spark):
    v = spark.createDataFrame([(1, 2.0), (None, 3.0), (None, 4.0)], VERTICES)
    assert {r["id"]: r["total"] for r in rollup(v, spark.createDataFrame([], EDGES)).collect()} == {1: 2.0, None: 7.0}
    assert rollup(v.limit(0), spark.createDataFrame([], EDGES)).collect() == []
