"""Ranked search for the terms of items, by presence masks.

A mask says which of an item's terms a document holds. The postings of the terms are bitmaps over the documents of
a block; laid over each other they give every document its mask and so group the documents. No
document of a group can score more than the sum of the best its terms score anywhere in the block, so
the groups are evaluated by falling maximum until the next one cannot reach the item's k-th best score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import renamed, settled

# Bytes of items that go to every task at once; more of them take more passes.
ITEM_BYTES = 1 << 22
_SALTS = 64
# Runs of digits, ASCII letters and all that is not ASCII; A-Z become a-z.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or bytes([b]).isalnum() else 32 for b in range(256))
_NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass(frozen=True)
class _Weighed:
    """An item's distinct terms, and for each its weight times its occurrences in the item."""

    terms: np.ndarray
    weights: np.ndarray


@dataclass(frozen=True)
class _Block:
    """Postings of a block of documents: by term, documents in order and what the term adds to their scores."""

    ids: np.ndarray
    bounds: np.ndarray
    documents: np.ndarray
    impacts: np.ndarray
    best: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, terms: int, norm: tuple[int, int]) -> _Block:
        """``norm`` holds the number of documents with terms and the number of all their terms."""
        count, total = norm
        held = [np.frombuffer(part, np.int32) for part in batch.column("terms").to_pylist()]
        times = np.concatenate([np.frombuffer(part, np.int32) for part in batch.column("times").to_pylist()])
        term = np.concatenate(held)
        owner = np.repeat(np.arange(len(held)), [len(part) for part in held])
        length = batch.column("n").to_numpy()
        m = 100 - 75 + 75 * length * count // max(total, 1)
        times = times.astype(np.int64)
        impact = 1_000_000_000 * times // (1000 * times + 8 * m[owner])
        order = np.argsort(term, kind="stable")
        bounds = np.searchsorted(term[order], np.arange(terms + 1))
        best = np.zeros(terms, np.int64)
        np.maximum.at(best, term, impact)
        ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
        return cls(ids, bounds, owner[order], impact[order], best)

    def of_term(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.bounds[term], self.bounds[term + 1])
        return self.documents[own], self.impacts[own]

    def groups(self, item: _Weighed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents ordered by mask, where each group of them begins, and the most a document of each group scores."""
        words = np.zeros((len(self.ids), -(-len(item.terms) // 64)), np.uint64)
        for bit, term in enumerate(item.terms):
            words[self.of_term(term)[0], bit // 64] |= np.uint64(1 << bit % 64)
        order = np.lexsort(words.T)
        order = order[words[order].any(axis=1)]
        sorted_words = words[order]
        new = np.r_[True, (sorted_words[1:] != sorted_words[:-1]).any(axis=1)] if len(order) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        shifts = np.arange(64, dtype=np.uint64)
        bits = (sorted_words[begin][:, :, None] >> shifts & np.uint64(1)).reshape(len(begin), -1)
        most = bits[:, : len(item.terms)].astype(np.int64) @ (item.weights * self.best[item.terms])
        return order, np.r_[begin, len(order)], most

    def scores(self, item: _Weighed, chosen: np.ndarray) -> np.ndarray:
        """Scores of the documents ``chosen``, which are in order."""
        score = np.zeros(len(chosen), np.int64)
        for term, weight in zip(item.terms, item.weights):
            documents, impacts = self.of_term(term)
            if len(documents):
                at = np.minimum(np.searchsorted(documents, chosen), len(documents) - 1)
                score += np.where(documents[at] == chosen, weight * impacts[at], 0)
        return score

    def search(self, item: _Weighed, best: np.ndarray, k: int) -> np.ndarray:
        """``best``, rows (score, id) by rank, with what this block adds to them."""
        least = best[k - 1, 0] if len(best) == k else 1
        if (item.weights * self.best[item.terms]).sum() < least:
            return best
        order, bounds, most = self.groups(item)
        falling = np.argsort(-most, kind="stable")
        size = np.cumsum(np.diff(bounds)[falling])
        at, step = 0, 4 * k
        # An equal score can still have the smaller id.
        while at < len(falling) and most[falling[at]] >= least:
            done = size[at - 1] if at else 0
            end = int(np.searchsorted(size, done + step)) + 1
            part = falling[at:end]
            part = part[most[part] >= least]
            chosen = np.sort(np.concatenate([order[bounds[g] : bounds[g + 1]] for g in part]))
            score = self.scores(item, chosen)
            kept = score >= least
            rows = np.vstack([best, np.column_stack([score[kept], self.ids[chosen[kept]]])])
            best = rows[np.lexsort((rows[:, 1], -rows[:, 0]))][:k]
            least = best[k - 1, 0] if len(best) == k else 1
            at, step = end, 2 * step
        return best


def ranked_documents(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank from 1, doc_id and score, a whole number above 0.

    Terms are maximal runs of digits, ASCII letters and characters beyond ASCII, only A-Z lower-cased. With N documents that
    have terms, L terms in all of them, n terms in this one, df documents that hold a term and tf occurrences in this one, a
    term adds floor(1000 ln((2N+2) / (2df+1))) * (10^9 tf div (1000 tf + 8 m)) to the score for each of its occurrences in
    the item, where m = 25 + 75 n N div L. Equal scores go by doc_id, NULL last.

    NULL and empty texts have no terms; such documents count for nothing and such items have no rows. Every row of
    ``documents`` is a document, also where ids or texts repeat. Items that repeat an id and a text are one; texts that
    share an id are ranked each on their own. Ids of documents are whole numbers, those of items of any type.
    Items go to the tasks in blocks of bounded size, one pass over the documents each. A task returns at most ``k``
    rows per item, and these are merged in two steps.
    """
    texts = renamed(documents, {"doc_id": "doc_id", "text": "text"}).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )
    asked = settled(renamed(items, {"item_id": "item_id", "text": "text"}).where("text is not null").distinct(), "items")
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    found = None
    for block in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        part = _found(texts, chosen, k)
        found = part if found is None else found.union(part)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    item = ["item_id", "text_key"]
    first = F.row_number().over(Window.partitionBy(*item, "salt").orderBy(*order))
    salted = found.withColumn("at", first).where(F.col("at") <= k)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*item).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _found(texts: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The best documents of each task for each of these items, under item_id, text_key and salt."""
    spark = texts.sparkSession
    asked = items.withColumn("text_key", F.xxhash64("text")).toArrow()
    counted = [Counter(terms(text.encode())) for text in asked.column("text").to_pylist()]
    numbers = {term: number for number, term in enumerate(dict.fromkeys(term for item in counted for term in item))}
    vocabulary = spark.sparkContext.broadcast(numbers)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            lengths, held, times = [], [], []
            for text in batch.column("text"):
                own = terms(text.as_py())
                known = Counter(map(number, own))
                known.pop(None, None)
                lengths.append(len(own))
                held.append(np.fromiter(known.keys(), np.int32, len(known)).tobytes())
                times.append(np.fromiter(known.values(), np.int32, len(known)).tobytes())
            columns = [pa.array(lengths, pa.int64()), pa.array(held, pa.binary()), pa.array(times, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n", "terms", "times"])

    matches = settled(texts.mapInArrow(match, "doc_id bigint, n bigint, terms binary, times binary"), "matches")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(vocabulary.value), np.int64)
        for batch in batches:
            for held in batch.column("terms").to_pylist():
                seen[np.frombuffer(held, np.int32)] += 1
        term = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(seen[term])], names=["term", "df"])

    total = matches.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    norm = total["documents"], total["terms"] or 0
    frequency = matches.mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = np.zeros(len(numbers), np.int64)
    for row in frequency:
        weights[row["term"]] = math.floor(1000 * math.log((2 * norm[0] + 2) / (2 * row["df"] + 1)))
    # Terms that no document holds, or all of them, add nothing.
    weighed = []
    for item in counted:
        own = np.array([numbers[term] for term in item], np.int64)
        value = weights[own] * np.array(list(item.values()), np.int64)
        weighed.append(_Weighed(own[value > 0], value[value > 0]))
    shared = spark.sparkContext.broadcast(weighed)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        best = [np.empty((0, 2), np.int64) for _ in known]
        for batch in batches:
            if batch.num_rows:
                block = _Block.of(batch, len(vocabulary.value), norm)
                best = [block.search(item, rows, k) for item, rows in zip(known, best)]
        item = np.repeat(np.arange(len(best)), np.array([len(rows) for rows in best], np.int64))
        rows = np.vstack([np.empty((0, 2), np.int64), *best])
        ids = pa.array(rows[:, 1], mask=rows[:, 1] == _NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(item), ids, pa.array(rows[:, 0])], names=["item", "doc_id", "score"])

    found = matches.mapInArrow(search, "item bigint, doc_id bigint, score bigint").withColumn(
        "salt", F.spark_partition_id() % _SALTS
    )
    names = spark.createDataFrame(
        [(number, *row) for number, row in enumerate(zip(*[asked.column(c).to_pylist() for c in ("item_id", "text_key")]))],
        f"item bigint, item_id {items.schema['item_id'].dataType.simpleString()}, text_key bigint",
    )
    return found.join(F.broadcast(names), "item").select("item_id", "text_key", "salt", "doc_id", "score")
