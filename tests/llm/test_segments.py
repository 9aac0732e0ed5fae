from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as arrays

import __spark_entry__ as contract
from tidemark.llm import segments as operator
from tidemark.llm.segments import best_products, best_scaled_products
from tools.check_oracle import compare, tables

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector string, score int, n int"
LONG = (-(1 << 63), (1 << 63) - 1)


def frame(spark, pairs, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in pairs], SCHEMA.replace("float", kind))


def plain(pairs, k=5, every=50, factor=256):
    kept = [(i, v) for i, v in pairs if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    whole = {(i, tuple(int(np.floor(factor * np.float64(x))) for x in v)) for i, v in kept}
    result = {}
    for i in sorted({i for i, _ in whole if i % every == 0}):
        asked = min(v for j, v in whole if j == i)
        scored = [(sum(a * b for a, b in zip(asked, v)), j) for j, v in whole if j != i and len(v) == len(asked)]
        scored = [(min(max(score, LONG[0]), LONG[1]), j) for score, j in scored]
        if scored:
            result[i] = [(j, score) for score, j in sorted(scored, key=lambda row: (-row[0], row[1]))][:k]
    return result


def found(result):
    rows = {}
    for row in result.orderBy("query_id", "rank").collect():
        rows.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(rows[row.query_id])
    return rows


def scaled(frame, k=5):
    return found(best_scaled_products(frame, every=50, k=k, factor=256))


def vectors():
    draw = np.random.default_rng(12)
    points = [(n, np.float32(np.round(draw.normal(size=8), 1)).tolist()) for n in range(900)]
    points += [(n, [0.5] * 8) for n in range(900, 1300)]
    odd = [[0.0] * 8, None, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [], []]
    points += [(50 * (40 + n), v) for n, v in enumerate(odd)] + [(7000, [2.0, 1.0]), (7001, [3.0])]
    return points + [points[0], points[5], (50, [0.25] * 8), (None, [1.0] * 8)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_all_pairs(spark, monkeypatch, small):
    """Also with several blocks of queries, few seeds and many small steps."""
    if small:
        for name, value in {"QUERY_VALUES": 64, "SEED_VALUES": 64, "_QUERIES": 3, "_ROWS": 50, "_PAIRS": 500}.items():
            monkeypatch.setattr(operator, name, value)
    assert scaled(frame(spark, vectors())) == plain(vectors())


def test_clustered_vectors_leave_few_pairs(spark, monkeypatch):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(30, 16)) * np.repeat([4, 1], 8)
    points = [(n, (centres[n % 30] + draw.normal(size=16) / 20).tolist()) for n in range(3000)]
    assert scaled(frame(spark, points, "double")) == plain(points)


def test_levels_bound_products_from_above():
    draw = np.random.default_rng(3)
    points = np.floor(256 * draw.normal(size=(40, 13)))
    exact = points @ points.T
    levels = [level @ level.T for level in operator._levels(points)]
    assert len(levels) == 3
    for coarse, fine in zip(levels, [*levels[1:], exact]):
        assert (coarse >= exact - 1e-6).all() and coarse.mean() > fine.mean()


numbers = st.integers(-4, 4).map(float)


@given(st.integers(1, 9).flatmap(lambda d: arrays.arrays(float, st.tuples(st.integers(1, 60), st.just(d)), elements=numbers)))
@settings(max_examples=100, deadline=None)
def test_search_in_parts(points):
    ids = np.arange(len(points)) * 5
    search = operator._Search.start(ids[::7], points[::7], 4, True)
    for part in np.array_split(np.arange(len(points)), 3):
        search.visit(ids[part], points[part])
    for n, i in enumerate(ids[::7]):
        scores = points @ points[n * 7]
        order = [m for m in np.lexsort((ids, -scores)) if ids[m] != i][:4]
        kept = search.best.filled[n]
        assert list(zip(search.best.ids[n][kept], search.best.scores[n][kept])) == [(ids[m], scores[m]) for m in order]


def test_products_beyond_doubles_are_exact(spark):
    draw = np.random.default_rng(4)
    points = [(n, (draw.integers(-(1 << 29), 1 << 29, size=4) / 256).tolist()) for n in range(200)]
    points += [(1000, [1e17] * 4), (1001, [-1e17] * 4), (1002, [1e300] * 4)]
    assert scaled(frame(spark, points[:200], "double")) == plain(points[:200])
    assert scaled(frame(spark, points, "double")).keys() == {0, 50, 100, 150, 1000}


def test_few_and_none(spark):
    assert scaled(frame(spark, [])) == {}
    assert scaled(frame(spark, [(0, [1.0] * 8)])) == {}
    few = [(0, [1.0] * 8), (3, [1.0, 2.0] * 4), (50, [0.0] * 8)]
    assert scaled(frame(spark, few)) == plain(few)


def test_queries_of_their_own(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (2, [3, -1]), (3, [0, 5])], "vec_id bigint, vector array<bigint>")
    asked = spark.createDataFrame([(2, [1, 1]), (9, [0, 1])], "vec_id bigint, vector array<bigint>")
    assert found(best_products(rows, asked, 2)) == {2: [(3, 5), (1, 3)], 9: [(3, 5), (1, 2)]}


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, tables(sf), "op12_exact_top_k", sf) == []
    assert "op12_exact_top_k" in contract.oracle_sql()
