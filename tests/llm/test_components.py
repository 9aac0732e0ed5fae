from __future__ import annotations

import random

from tidemark.llm import components as module
from tidemark.llm.components import components


def test_chains_stars_and_loops(spark):
    edges = [(n, n + 1) for n in range(30)] + [(100, n) for n in range(101, 120)] + [(200, 200), (None, 3), (201, 200)]
    random.Random(2).shuffle(edges)
    found = {row.node: row.root for row in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {found[n] for n in range(31)} == {found[0]} and {found[n] for n in range(100, 120)} == {found[100]}
    assert len({found[0], found[100], found[200]}) == 3 and found[200] == found[201] and len(found) == 53


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_rising_chain_takes_few_rounds(spark, monkeypatch):
    written = []

    def counted(frame, name):
        written.append(name)
        return settled(frame, name)

    settled = module.settled
    monkeypatch.setattr(module, "settled", counted)
    found = components(spark.range(1000).selectExpr("id as a", "id + 1 as b")).collect()
    assert len(found) == 1001 and {row.root for row in found} == {0}
    assert written.count("hooks") <= 15


def test_random_graphs_equal_union_find(spark):
    for seed in range(3):
        draw = random.Random(seed)
        edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
        parent = {n: n for edge in edges for n in edge if edge[0] != edge[1]}

        def top(n):
            while parent[n] != n:
                n = parent[n]
            return n

        for a, b in edges:
            if a != b:
                parent[top(a)] = top(b)
        found = {row.node: row.root for row in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
        assert found.keys() == parent.keys()
        assert len(set(found.values())) == len({top(n) for n in parent})
        assert all(top(node) == top(root) for node, root in found.items())
