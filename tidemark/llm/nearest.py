"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised on its own, so a few centroids per half make very many cells. A query
takes the pairs of centroids by the sum of their distances from it, with a heap, until their cells hold
enough vectors; these are compared exactly. Spark brings together the queries and the rows of one centroid of
the first half; where these are many they are cut into blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import renamed, settled

# Vectors of one centroid that a task compares at once.
BLOCK_ROWS = 4096
# Queries whose cells a task looks up.
QUERIES_A_TASK = 16
_ROUNDS = 12


@dataclass(frozen=True)
class MultiIndex:
    """Centroids of both halves and the number of vectors in each cell."""

    halves: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances from the centroids of the first and of the second half."""
        cut = self.halves[0].shape[1]
        return _squared(vectors[:, :cut], self.halves[0]), _squared(vectors[:, cut:], self.halves[1])

    def traverse(self, first: np.ndarray, second: np.ndarray, enough: int) -> dict[int, list[int]]:
        """Cells that hold vectors, by the sum of both distances, until ``enough`` vectors are met.

        The heap holds the next pair of each centroid of the first half that has been reached.
        """
        rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
        near, far = np.sort(first).tolist(), np.sort(second).tolist()
        sizes = self.sizes
        heap = [(near[0] + far[0], 0, 0)]
        cells, met = {}, 0
        while heap and met < enough:
            _, i, j = heap[0]
            size = int(sizes[rows[i], columns[j]])
            if size:
                cells.setdefault(rows[i], []).append(columns[j])
                met += size
            if j + 1 < len(columns):
                heapq.heapreplace(heap, (near[i] + far[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
            if j == 0 and i + 1 < len(rows):
                heapq.heappush(heap, (near[i + 1] + far[0], i + 1, 0))
        return cells


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)


def _centres(points: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's algorithm from centres drawn far apart."""
    draw = np.random.default_rng(64)
    centres = points[[0]]
    gap = _squared(points, centres)[:, 0]
    for _ in range(1, k):
        far = np.maximum(gap, 0)
        if not far.sum():
            break
        centres = np.vstack([centres, points[draw.choice(len(points), p=far / far.sum())]])
        gap = np.minimum(gap, _squared(points, centres[-1:])[:, 0])
    for _ in range(_ROUNDS):
        near = _squared(points, centres).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def usable(embeddings: DataFrame) -> DataFrame:
    """Rows (vec_id, vector) with an id and a vector of finite numbers, not all zero, in double precision."""
    rows = renamed(embeddings, {"vec_id": "vec_id", "embedding": "embedding"}).where("vec_id is not null")
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vector is not null").where(finite).where(F.exists("vector", lambda x: x != 0))


def build(vectors: DataFrame, sample: int, per_cell: int, most: int) -> tuple[dict[int, MultiIndex], DataFrame]:
    """An index for each number of components, and all rows with their cell.

    ``sample`` bounds the rows that the centroids are fitted to. A number of components so rare that the sample
    holds none of it has one cell, which is compared whole.
    """
    counts = {row["n"]: row["count"] for row in vectors.groupBy(F.size("vector").alias("n")).count().collect()}
    place = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30)) / (1 << 30)
    chosen = vectors.where(place < max(sample, 100) / max(1, sum(counts.values())))
    drawn = chosen.orderBy(place, "vec_id").limit(2 * sample).toPandas()["vector"]
    indexes = {}
    for n, rows in counts.items():
        own = [vector for vector in drawn if len(vector) == n]
        points = np.stack(own) if own else np.zeros((1, n))
        k = min(most, max(2, round((rows / per_cell) ** 0.5)))
        halves = _centres(points[:, : n // 2], k), _centres(points[:, n // 2 :], k)
        indexes[n] = MultiIndex(halves, np.zeros((len(halves[0]), len(halves[1])), np.int64))
    shared = vectors.sparkSession.sparkContext.broadcast(indexes)

    def place_in_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, part in batch.groupby(batch["vector"].map(len)):
                first, second = shared.value[n].distances(np.stack(part["vector"]))
                yield part.assign(n=n, first=first.argmin(axis=1), second=second.argmin(axis=1))

    kind = vectors.schema["vec_id"].dataType.simpleString()
    columns = f"vec_id {kind}, vector array<double>, n int, first int, second int"
    placed = settled(vectors.mapInPandas(place_in_cells, columns), "cells")
    sizes = placed.groupBy("n", "first", "second").count().toPandas()
    for n, cells in sizes.groupby("n"):
        indexes[n].sizes[cells["first"], cells["second"]] = cells["count"]
    return indexes, placed


def nearest(
    embeddings: DataFrame,
    every: int = 100,
    k: int = 10,
    share: float = 0.45,
    least: int = 300,
    sample: int = 20_000,
    per_cell: int = 1,
    most: int = 256,
) -> DataFrame:
    """The ``k`` nearest rows found for each query: query_id, rank from 1, vec_id and score, the Euclidean distance.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another vec_id; ties
    go to the smaller vec_id. A query reads cells until they hold ``share`` of all vectors, and ``least`` of them; vectors
    without any clusters need so large a share for a recall of 0.9. Vectors that are NULL,
    zero (empty ones too), or hold NULL or non-finite components take no part, nor do rows without an id. Vectors are near only to
    those with as many components. Rows that repeat an id and a vector count once; of several vectors of one id the
    least is its query. Halves have at most ``most`` centroids, so the cell sizes that the driver collects are
    bounded for each number of components.
    """
    vectors = usable(embeddings)
    indexes, placed = build(vectors, sample, per_cell, most)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if not indexes:
        none = vectors.where(F.lit(False))
        return none.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    shared = vectors.sparkSession.sparkContext.broadcast(indexes)
    total = sum(int(index.sizes.sum()) for index in indexes.values())

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, part in batch.groupby(batch["vector"].map(len)):
                known = shared.value[n]
                enough = max(least, round(share * int(known.sizes.sum())))
                first, second = known.distances(np.stack(part["vector"]))
                for query, vector, a, b in zip(part["vec_id"], part["vector"], first, second):
                    cells = known.traverse(a, b, enough)
                    yield pd.DataFrame(
                        {"vec_id": query, "vector": [vector] * len(cells), "n": n, "first": cells.keys(), "seconds": cells.values()}
                    )

    queries = placed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    # A fixed number of tasks: the queries are few and small, their ways through the cells are not.
    queries = queries.repartition(max(1, min(10_000, total // every // QUERIES_A_TASK)))
    routed = queries.mapInPandas(route, f"vec_id {kind}, vector array<double>, n int, first int, seconds array<int>")
    large = [
        (n, first, blocks)
        for n, index in indexes.items()
        for first, blocks in enumerate((-(-index.sizes.sum(axis=1) // BLOCK_ROWS)).tolist())
        if blocks > 1
    ]
    sizes = F.broadcast(placed.sparkSession.createDataFrame(large, "n int, first int, blocks bigint"))

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Each row of a large centroid is in one block of its kind and meets all blocks of the other kind."""
        blocks = F.coalesce("blocks", F.lit(1))
        return (
            frame.join(sizes, ["n", "first"], "left")
            .withColumn(own, F.pmod(F.xxhash64("vec_id"), blocks))
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
            .drop("blocks")
            .groupBy("n", "first", "row_block", "query_block")
        )

    def compare(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": asked["vec_id"][:0], "vec_id": held["vec_id"][:0], "score": np.empty(0)})
        all_ids, all_points, cell = held["vec_id"].to_numpy(), np.stack(held["vector"]), held["second"].to_numpy()
        found = []
        for query, vector, seconds in zip(asked["vec_id"], asked["vector"], asked["seconds"]):
            chosen = np.isin(cell, seconds) & (all_ids != query)
            ids = all_ids[chosen]
            score = np.sqrt(((all_points[chosen] - vector) ** 2).sum(axis=1))
            order = np.lexsort((ids, score))
            new = np.ones(len(order), bool)
            new[1:] = (ids[order][1:] != ids[order][:-1]) | (score[order][1:] != score[order][:-1])
            order = order[new][:k]
            found.append(pd.DataFrame({"query_id": query, "vec_id": ids[order], "score": score[order]}))
        return pd.concat(found)

    asked, held = dealt(routed, "query_block", "row_block"), dealt(placed, "row_block", "query_block")
    pairs = asked.cogroup(held).applyInPandas(compare, f"query_id {kind}, vec_id {kind}, score double")
    best = pairs.groupBy("query_id").agg(
        F.slice(F.sort_array(F.collect_set(F.struct("score", "vec_id"))), 1, k).alias("best")
    )
    return best.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "one.vec_id", "one.score"
    )
