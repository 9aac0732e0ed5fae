"""Exact best inner products by multi-resolution segment statistics.

A level cuts vectors into segments and keeps the mean and the deviation of each, both times the root of its length.
The distance between two vectors is at least the distance between these statistics, and they keep
the vector's length; so the product of the statistics bounds the product of the vectors from above. Levels go from
one segment to two components a segment. A pair whose bound falls below the query's k-th best score so far
is left out; what survives all levels is multiplied out exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import renamed, settled

# Components of all queries that go to every task at once: 32 MB.
QUERY_VALUES = 1 << 22
# Components of the rows that give queries their first bounds: at most 1 MB.
SEED_VALUES = 1 << 17
# Queries and rows that are looked at together, and what a task gets.
_QUERIES, _ROWS = 256, 4096
_PAIRS = 1 << 23
# Share of pairs alive up to which a level looks at them one by one.
_FEW = 0.05
# Integers up to here are exact in double precision.
_EXACT = 1 << 53
_LONG = (-(1 << 63), (1 << 63) - 1)
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _levels(points: np.ndarray) -> list[np.ndarray]:
    """Statistics of all levels, coarse to fine."""
    size = points.shape[1]
    levels, segments = [], 1
    while segments * 2 <= size:
        starts = np.arange(segments) * size // segments
        length = np.diff(np.r_[starts, size])
        sums = np.add.reduceat(points, starts, axis=1)
        squares = np.add.reduceat(points * points, starts, axis=1)
        spread = np.sqrt(np.maximum(length * squares - sums * sums, 0) / length)
        levels.append(np.hstack([sums / np.sqrt(length), spread]))
        segments *= 2
    return levels


@dataclass
class _Best:
    """The ``k`` best rows of each query so far, by score, then id; ``bound`` is what a row has to reach."""

    ids: np.ndarray
    scores: np.ndarray
    filled: np.ndarray
    bound: np.ndarray

    @classmethod
    def none(cls, queries: int, k: int, kind: type) -> _Best:
        empty = np.zeros((queries, k), np.int64), np.zeros((queries, k), kind)
        return cls(*empty, np.zeros((queries, k), bool), np.full(queries, -np.inf))

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in scored pairs; ``query`` says which query each belongs to."""
        touched = np.unique(query)
        held = self.filled[touched]
        k = held.shape[1]
        owner = np.r_[np.repeat(touched, k)[held.ravel()], query]
        ids = np.r_[self.ids[touched][held], ids]
        scores = np.r_[self.scores[touched][held], scores]
        order = np.lexsort((ids, -scores, owner))
        owner = owner[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = rank < k
        place = owner[kept], rank[kept]
        self.ids[place], self.scores[place], self.filled[place] = ids[order][kept], scores[order][kept], True
        full = touched[self.filled[touched, -1]]
        # Not above the score itself, where that has more digits than a double.
        last = np.nextafter(self.scores[full, -1].astype(float), -np.inf)
        self.bound[full] = np.maximum(self.bound[full], last)


@dataclass
class _Search:
    """Queries of one dimension with what they have found."""

    ids: np.ndarray
    points: np.ndarray
    best: _Best

    @classmethod
    def start(cls, ids: np.ndarray, points: np.ndarray, k: int, exact: bool) -> _Search:
        return cls(ids, points, _Best.none(len(ids), k, float if exact else object))

    def visit(self, ids: np.ndarray, points: np.ndarray) -> None:
        """Compare the rows ``points`` with all queries."""
        rows = points.astype(float)
        row_levels = _levels(rows)
        longest = np.sqrt((rows**2).sum(axis=1).max(initial=0))
        for low in range(0, len(self.ids), _QUERIES):
            part = slice(low, low + _QUERIES)
            asked = self.points[part].astype(float)
            other = self.ids[part][:, None] != ids
            # Rounding must not cost a row its place.
            least = self.best.bound[part] - 1e-6 * (np.sqrt((asked**2).sum(axis=1)) * longest + 1)
            query, row = self._survivors(_levels(asked), row_levels, least, other, asked, rows)
            step = max(1, QUERY_VALUES // max(points.shape[1], 1))
            for at in range(0, len(query), step):
                self._score(query[at : at + step] + low, row[at : at + step], ids, points)

    def _survivors(
        self,
        asked: list[np.ndarray],
        held: list[np.ndarray],
        least: np.ndarray,
        alive: np.ndarray,
        points: np.ndarray,
        rows: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) of those alive whose bound reaches ``least`` on every level."""
        for level, (ours, theirs) in enumerate(zip(asked, held)):
            if not alive.size or alive.mean() <= _FEW:
                query, row = np.nonzero(alive)
                for ours, theirs in zip(asked[level:], held[level:]):
                    kept = np.einsum("ij,ij->i", ours[query], theirs[row]) >= least[query]
                    query, row = query[kept], row[kept]
                return query, row
            alive = alive & (ours @ theirs.T >= least[:, None])
        k = self.best.ids.shape[1]
        if alive.shape[1] > k and alive.mean() > _FEW:
            # So many are left that multiplying all is cheapest; only the best of these rows can count.
            product = np.where(alive, points @ rows.T, -np.inf)
            last = np.partition(product, -k, axis=1)[:, -k]
            alive &= product >= (last - 1e-6 * np.abs(last))[:, None]
        return np.nonzero(alive)

    def _score(self, query: np.ndarray, row: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        if self.best.scores.dtype == object:
            products = (self.points[query].astype(object) * points[row].astype(object)).sum(axis=1)
            scores = np.array([min(max(int(score), _LONG[0]), _LONG[1]) for score in products], object)
        else:
            scores = np.einsum("ij,ij->i", self.points[query].astype(float), points[row].astype(float))
        reached = scores >= self.best.bound[query]
        self.best.add(query[reached], ids[row[reached]], scores[reached])


def _arrays(batch: pa.RecordBatch | pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of ``size`` components."""
    flat = batch.column("vector").combine_chunks() if isinstance(batch, pa.Table) else batch.column("vector")
    return batch.column("vec_id").to_numpy(zero_copy_only=False), flat.flatten().to_numpy().reshape(len(flat), size)


def finite_vectors(embeddings: DataFrame) -> DataFrame:
    """Rows (vec_id, vector) with an id and a vector of finite numbers, in double precision."""
    rows = renamed(embeddings, {"vec_id": "vec_id", "embedding": "embedding"}).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vec_id is not null and vector is not null").where(finite)


def scaled(vectors: DataFrame, factor: int) -> DataFrame:
    """Vectors of whole numbers: ``factor`` times each component, rounded down."""
    whole = F.transform("vector", lambda x: F.floor(F.lit(float(factor)) * x).cast("bigint"))
    return vectors.select("vec_id", whole.alias("vector"))


def best_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each query: query_id, rank, vec_id, score.

    Both have columns vec_id and vector, an array of whole numbers; neither may be NULL. A query's own row, by id, is no
    candidate; equal scores go to the smaller id. Vectors are compared with those of the same dimension, empty ones
    included. Each row is a candidate, an id with several vectors several times; repeated query ids should have been
    made one. Scores beyond a long are shown as its ends, and any of them may be named. A query without candidates has no row.

    Queries go to all tasks in blocks of bounded size, one pass over the rows each, and rows are never shuffled by value,
    so equal vectors do no harm. A task returns at most ``k`` rows per query, and only those that
    reach the query's k-th best score among a bounded sample of the rows. That sample decides no result.
    """
    held = settled(vectors, "vectors")
    asked = settled(queries.select("vec_id", "vector"), "asked")
    sizes = {row["n"]: row for row in _sizes(held).collect()}
    found = []
    for row in _sizes(asked).collect():
        if row["n"] in sizes:
            found += _of_dimension(held, asked, row["n"], sizes[row["n"]], row, k)
    if not found:
        return _ranked(vectors.sparkSession.createDataFrame([], _FOUND), k)
    return _ranked(reduce(DataFrame.union, found), k)


def _sizes(vectors: DataFrame) -> DataFrame:
    """Dimensions with the number of rows and the largest component."""
    size = F.size("vector").alias("n")
    largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("largest")
    return vectors.groupBy(size).agg(F.count(F.lit(1)).alias("rows"), largest)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _of_dimension(held: DataFrame, asked: DataFrame, size: int, rows: dict, queries: dict, k: int) -> list[DataFrame]:
    """Best rows of the queries of one dimension, from each task; a settled frame per block of queries."""
    spark = held.sparkSession
    exact = (rows["largest"] or 0) * (queries["largest"] or 0) * size < _EXACT
    blocks = -(-queries["rows"] * max(size, 1) // QUERY_VALUES)
    tasks = 1 + min(rows["rows"] // _ROWS, rows["rows"] * queries["rows"] // blocks // _PAIRS)
    own = held.where(F.size("vector") == size).repartition(tasks, "vec_id", "vector")
    order = F.xxhash64("vec_id", "vector")
    seeds = SEED_VALUES // max(size, 1)
    share = F.pmod(order, F.lit(1 << 30)) < int(min(1, 2 * seeds / rows["rows"]) * (1 << 30))
    seed = _arrays(held.where(F.size("vector") == size).where(share).orderBy(order).limit(seeds).toArrow(), size)
    found = []
    for block in range(blocks):
        chosen = asked.where(F.size("vector") == size).where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast((*_arrays(chosen.toArrow(), size), *seed))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, points, *first = shared.value
            bounds = _Search.start(ids, points, k, exact)
            bounds.visit(*first)
            here = _Search.start(ids, points, k, exact)
            here.best.bound = bounds.best.bound
            for batch in batches:
                others, vectors = _arrays(batch, size)
                for at in range(0, len(others), _ROWS):
                    here.visit(others[at : at + _ROWS], vectors[at : at + _ROWS])
            best = here.best
            places = np.nonzero(best.filled)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[places[0]], pa.int64()),
                    pa.array(best.ids[places], pa.int64()),
                    pa.array([int(score) for score in best.scores[places]], pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

        found.append(settled(own.mapInArrow(search, _FOUND), "best"))
        shared.unpersist()
    return found


def best_scaled_products(embeddings: DataFrame, every: int, k: int, factor: int) -> DataFrame:
    """Best products of each row whose id is divisible by ``every`` with all others, components scaled to whole numbers.

    Vectors that are NULL or hold NULL or non-finite components take no part, nor rows without an id. Rows that
    repeat an id and a vector count once; of several vectors of one id the least asks.
    """
    vectors = settled(scaled(finite_vectors(embeddings), factor).distinct(), "scaled")
    asking = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return best_products(vectors, asking, k)
