"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Terms are character n-grams within and at the ends of words that the labels show to matter. The examples
are ordered so that like ones stand together and cut into blocks; for every term the index keeps its
postings by block and its greatest weight in each block. A query adds up these weights to a bound for every
block and reads blocks from the highest bound down, until no block can hold one of its nearest any more.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import id_remainder, renamed, settled

GRAM_LENGTHS = (4, 5, 6)
BLOCK = 64
_NO_LETTERS = re.compile(r"[\W\d_]+")
_EVIDENCE = 3
# Cosine mass that speaks against the label: a few far neighbours say little.
_DOUBT = 3.0
# Blocks that a query reads before it looks at its bounds again; then twice as many each time.
_FIRST_BLOCKS = 2
# Chi-square that none of some hundred thousand n-grams reaches by chance.
_SURE = 30.0
_ROWS = 100_000


def _letters(text: str) -> str:
    return f" {_NO_LETTERS.sub(' ', text.lower())} "


def _grams(text: str) -> set[str]:
    line = _letters(text)
    return {line[at : at + n] for n in GRAM_LENGTHS for at in range(len(line) - n + 1)}


class TermVectors:
    """TF-IDF vectors of unit length over chosen terms."""

    def __init__(self, terms: list[str], idf: np.ndarray) -> None:
        self.terms, self.idf = terms, idf
        self._automaton = None

    def __getstate__(self):
        return {"terms": self.terms, "idf": self.idf, "_automaton": None}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a text in ascending order and their weights."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for number, term in enumerate(self.terms):
                self._automaton.add_word(term, number)
            if self.terms:
                self._automaton.make_automaton()
        met = Counter(number for _, number in self._automaton.iter(_letters(text))) if self.terms else {}
        term = np.array(sorted(met), np.int64)
        weight = (1 + np.log(np.array([met[number] for number in term.tolist()], float))) * self.idf[term]
        return term, weight / np.sqrt((weight**2).sum()) if len(term) else weight


@dataclass(frozen=True)
class BlockMaxIndex:
    """Postings of the examples by term and block: entries ``first[t, b]`` to ``first[t, b + 1]``."""

    ids: np.ndarray
    labels: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    first: np.ndarray
    bound: np.ndarray

    @staticmethod
    def build(ids: list, labels: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        """The index and the order of the examples in it: like ones, with the same heaviest term, side by side."""
        heaviest = [int(term[weight.argmax()]) if len(term) else terms for term, weight in vectors]
        order = sorted(range(len(ids)), key=lambda n: (heaviest[n], labels[n], ids[n]))
        vectors = [vectors[n] for n in order]
        example = np.repeat(np.arange(len(order)), [len(term) for term, _ in vectors])
        term = np.concatenate([term for term, _ in vectors] or [np.empty(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([weight for _, weight in vectors] or [np.empty(0)])
        by_term = np.lexsort((example, term))
        example, term, weight = example[by_term], term[by_term], weight[by_term]
        blocks = -(-len(order) // BLOCK)
        cell = term * (blocks + 1) + example // BLOCK
        first = np.searchsorted(cell, np.arange(terms * (blocks + 1))).reshape(terms, blocks + 1)
        bound = np.zeros((terms, blocks))
        np.maximum.at(bound, (term, example // BLOCK), weight)
        return BlockMaxIndex(np.array(ids)[order], np.array(labels)[order], example, weight, first, bound), order

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of greatest cosine above 0 and their cosines; ties go to the earlier example."""
        best, score = np.empty(0, np.int64), np.empty(0)
        if not len(term):
            return best, score
        bounds = weight @ self.bound[term]
        blocks = np.argsort(-bounds, kind="stable")
        blocks = blocks[bounds[blocks] > 0]
        at, many = 0, _FIRST_BLOCKS
        # A bound is a sum in another order than a score, so it may be lower by rounding.
        while at < len(blocks) and not (len(score) == k and bounds[blocks[at]] < score[-1] - 1e-9):
            read, at, many = blocks[at : at + many], at + many, many * 2
            scores = self._scores(term, weight, read)
            found = np.flatnonzero(scores)
            found = found[found != but]
            best, score = np.r_[best, found], np.r_[score, scores[found]]
            order = np.lexsort((best, -score))[:k]
            best, score = best[order], score[order]
        return best, score

    def _scores(self, term: np.ndarray, weight: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The cosines of the examples in some blocks, from the postings of the query's terms there."""
        lo = self.first[term][:, blocks].ravel()
        sizes = self.first[term][:, blocks + 1].ravel() - lo
        stops = np.cumsum(sizes)
        posting = np.repeat(lo - (stops - sizes), sizes) + np.arange(stops[-1])
        heavy = np.repeat(np.repeat(weight, len(blocks)), sizes)
        return np.bincount(self.example[posting], heavy * self.weight[posting], len(self.ids))


@dataclass(frozen=True)
class ToxicityModel:
    """Votes of the nearest examples and the share of toxic examples that had such a vote."""

    vectors: TermVectors
    index: BlockMaxIndex
    neighbours: int
    base: float
    votes: np.ndarray
    shares: np.ndarray

    def score(self, text: str) -> tuple[float, np.ndarray, np.ndarray]:
        found, cosine = self.index.nearest(*self.vectors(text), self.neighbours)
        if not len(found):
            return self.base, found, cosine
        return float(np.interp(_vote(self.index.labels[found], cosine), self.votes, self.shares)), found, cosine


def _vote(labels: np.ndarray, cosine: np.ndarray) -> float:
    return float((labels * cosine).sum() / (cosine.sum() + _DOUBT))


def train(
    texts: DataFrame, labels: DataFrame, examples: int = 12_000, terms: int = 1500, neighbours: int = 15
) -> ToxicityModel | None:
    """Fit to the texts (doc_id, text) that have a label (doc_id, toxic); None if there are none.

    ``examples`` is the bound of the sample: about so many labels chosen by a hash of the id. Their texts are
    read whole. Terms are the n-grams with the strongest positive link to the label by chi-square.
    """
    total = labels.count()
    if not total:
        return None
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / (1 << 30)
    chosen_labels = settled(labels.where(place < examples / total), "example-labels")
    sample = settled(texts.join(F.broadcast(chosen_labels), "doc_id"), "examples")
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if not sizes:
        return None
    chosen, idf = _terms(sample, sizes.get(1, 0), sizes.get(0, 0), terms)
    vectors = TermVectors(chosen, idf)
    rows = sample.mapInPandas(
        _vectorised(vectors), "doc_id bigint, toxic int, term array<bigint>, weight array<double>"
    ).toPandas()
    known = [(np.asarray(t, np.int64), np.asarray(w, float)) for t, w in zip(rows["term"], rows["weight"])]
    index, order = BlockMaxIndex.build(rows["doc_id"].tolist(), rows["toxic"].tolist(), known, len(chosen))
    return _calibrated(vectors, index, [known[n] for n in order], neighbours)


def _vectorised(vectors: TermVectors):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [vectors(text) for text in batch["text"]]
            yield batch[["doc_id", "toxic"]].assign(term=[t for t, _ in pairs], weight=[w for _, w in pairs])

    return run


def _document_counts(rows: DataFrame, only: frozenset[str] | None) -> pd.DataFrame:
    """In how many texts each n-gram occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                met.update(_grams(text) if only is None else _grams(text) & only)
        grams = list(met)
        for at in range(0, len(grams), _ROWS):
            part = grams[at : at + _ROWS]
            yield pd.DataFrame({"gram": part, "n": [met[gram] for gram in part]})

    counted = rows.mapInPandas(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= _least(rows) if only is None else F.lit(True)).toPandas()


def _least(rows: DataFrame) -> int:
    return max(2, rows.count() // 200)


def _terms(sample: DataFrame, toxic: int, clean: int, most: int) -> tuple[list[str], np.ndarray]:
    """The n-grams most typical of toxic examples, and their inverse document frequencies."""
    if not toxic or not clean:
        return [], np.empty(0)
    with_label = _document_counts(sample.where("toxic = 1"), None)
    if not len(with_label):
        return [], np.empty(0)
    without = _document_counts(sample.where("toxic = 0"), frozenset(with_label["gram"]))
    both = with_label.merge(without, on="gram", how="left", suffixes=("_1", "_0")).fillna({"n_0": 0})
    a, b = both["n_1"].to_numpy(float), both["n_0"].to_numpy(float)
    n = toxic + clean
    determinant = a * (clean - b) - b * (toxic - a)
    margin = (a + b) * (n - a - b) * toxic * clean
    both["chi"] = np.where(margin > 0, n * determinant**2 / np.maximum(margin, 1), 0.0)
    both["idf"] = np.log(n / (a + b))
    strong = (a / toxic > 3 * b / clean) & (both["chi"] > _SURE)
    best = both[strong].sort_values(["chi", "gram"], ascending=[False, True]).head(most)
    return best["gram"].tolist(), best["idf"].to_numpy(float)


def _calibrated(vectors: TermVectors, index: BlockMaxIndex, known: list, neighbours: int) -> ToxicityModel:
    """Every example is scored by the others; votes are then mapped to shares of toxic examples, in order."""
    votes, labels, alone = [], [], []
    for at, label in enumerate(index.labels.tolist()):
        found, cosine = index.nearest(*known[at], neighbours, but=at)
        if len(found):
            votes.append(_vote(index.labels[found], cosine))
            labels.append(label)
        else:
            alone.append(label)
    base = (sum(alone) + 0.5) / (len(alone) + 1) if alone else float(index.labels.mean())
    order = np.argsort(votes, kind="stable")
    return ToxicityModel(vectors, index, neighbours, base, *_isotonic(np.array(votes)[order], np.array(labels)[order]))


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points of a rising curve from votes to shares."""
    pools: list[list[float]] = []
    for vote, label in zip(x.tolist(), y.tolist()):
        pools.append([label, 1, vote, vote])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, n, _, high = pools.pop()
            pools[-1] = [pools[-1][0] + total, pools[-1][1] + n, pools[-1][2], high]
    if not pools:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    points = [(edge, total / n) for total, n, low, high in pools for edge in (low, high)]
    return np.array([p for p, _ in points]), np.array([s for _, s in points])


def scored(documents: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``documents`` with score, predicted and evidence, the nearest examples with label and cosine.

    NULL and empty texts, and texts without any term, get the share of toxic examples among those without;
    score is 0 if nothing was learnt. Texts are read whole.
    """
    kind = "struct<score:double,evidence:array<struct<doc_id:bigint,toxic:int,cosine:double>>>"
    if model is None:
        found = documents.withColumn("_found", F.lit(None).cast(kind))
    else:
        shared = documents.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf(kind)
        def score(texts: pd.Series) -> pd.DataFrame:
            known = shared.value
            rows = []
            for text in texts:
                value, near, cosine = known.score(text)
                near, cosine = near[:_EVIDENCE], cosine[:_EVIDENCE]
                ids, labels = known.index.ids[near].tolist(), known.index.labels[near].tolist()
                evidence = [{"doc_id": i, "toxic": y, "cosine": c} for i, y, c in zip(ids, labels, cosine.tolist())]
                rows.append((value, evidence))
            return pd.DataFrame(rows, columns=["score", "evidence"])

        found = documents.withColumn("_found", score(F.coalesce("text", F.lit(""))))
    value = F.coalesce("_found.score", F.lit(0.0))
    return found.select(
        *[F.col(f"`{name}`") for name in documents.columns if name not in ("score", "predicted", "evidence")],
        value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"),
        F.col("_found.evidence").alias("evidence"),
    )


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, **bounds: int) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row; trained on labels that are not held out.

    A row is held out if crc32 of its id as text, modulo ``folds``, is ``held_fold``. Labels with a NULL id or
    value teach nothing; of several labels of an id the highest counts, of several texts of an id each.
    """
    rows = renamed(documents, {"doc_id": "doc_id", "text": "text"}).withColumn(
        "held_out", id_remainder(F.col("doc_id"), folds) == held_fold
    )
    known = (
        renamed(labels, {"doc_id": "doc_id", "toxic": "toxic"})
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    texts = rows.where("not held_out and text is not null").select("doc_id", "text")
    model = train(texts, known.where(id_remainder(F.col("doc_id"), folds) != held_fold), **bounds)
    return scored(rows.select("doc_id", "held_out", "text"), model).drop("text")
