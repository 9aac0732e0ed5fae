"""Periodic runs of words: the same words over and over, found by an online diagonal DP.

A diagonal is a lag between equal words: while every next word equals the one a lag before it, the diagonal's
match length grows by one; where it does not, the diagonal ends, and if it is long enough it is a run. A run of
``times`` periods and ``least`` words matches itself over many words at once, so a word counts as an
earlier occurrence of another only where the ``reach`` words up to it agree as well. With a reach no shorter than
the lag, the nearest such occurrence is the only one that can be a run of smallest period, so every word has at
most one active diagonal per reach. Reaches double until no text holds two places alike, which keeps the diagonals
sparse and the work on a text of n words at n log n, however often they repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import renamed

# Bytes of text that a task looks at together; a longer text is looked at alone.
_TOGETHER = 1 << 22
_PARTS = ("start", "length", "period")
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 for keys that occur more than once, -1 for the others."""
    codes = pd.factorize(keys)[0]
    several = np.bincount(codes) > 1 if len(codes) else np.zeros(0, bool)
    return np.where(several, np.cumsum(several) - 1, -1)[codes]


def _longer(ranks: np.ndarray, place: np.ndarray, reach: int, step: int) -> np.ndarray:
    """Ranks of the last ``reach + step`` words up to each, from those of the last ``reach``; step <= reach."""
    longer = np.full(len(ranks), -1)
    ends = np.flatnonzero((ranks >= 0) & (place >= reach + step - 1))
    ends = ends[ranks[ends - step] >= 0]
    if len(ends):
        longer[ends] = _ranks(ranks[ends - step] * (ranks.max() + 1) + ranks[ends])
    return longer


def _diagonals(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word and lag of every diagonal that nearest earlier occurrences keep active."""
    at = np.flatnonzero(ranks >= 0)
    order = np.argsort(ranks[at], kind="stable")
    lag = np.zeros(len(at), np.int64)
    same = ranks[at[order[1:]]] == ranks[at[order[:-1]]]
    lag[order[1:]] = np.where(same, at[order[1:]] - at[order[:-1]], 0)
    # A diagonal grows from word to word as long as the lag stays; it ends before the first that differs.
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])]) if len(at) else at
    last = np.r_[new[1:], len(at)] - 1 if len(at) else at
    return at[new], at[last], lag[new]


def word_runs(words: np.ndarray, place: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (start, length, period) of all runs among texts laid end to end, by start, then period.

    ``words`` are numbers that differ between texts too, ``place`` says where in its text each word stands.
    A run is a stretch with smallest period q and at least ``least`` and ``times * q`` words, at its longest.
    """
    # Any run matches itself over this many words, whatever its period.
    base = max(1, least * (times - 1) // times)
    ranks, reach = _ranks(words), 1
    while reach < base and (ranks >= 0).any():
        step = min(reach, base - reach)
        ranks, reach = _longer(ranks, place, reach, step), reach + step
    found, shorter = [np.empty((0, 3), np.int64)], 0
    while (ranks >= 0).any():
        first, last, lag = _diagonals(ranks)
        start = first - reach + 1 - lag
        length = last - start + 1
        kept = (lag > shorter) & (lag <= reach) & (length >= np.maximum(least, times * lag))
        found.append(np.column_stack([start, length, lag])[kept])
        shorter = reach
        if shorter * times >= place.max() + 1:
            break
        ranks, reach = _longer(ranks, place, reach, reach), 2 * reach
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _searched(texts: list[bytes], least: int, times: int) -> Iterator[tuple[int, list[dict], bytes]]:
    """Number of words, runs and collapsed text of each text."""
    split = [text.split() for text in texts]
    counts = np.array([len(words) for words in split], np.int64)
    begin = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    codes = pd.factorize(np.array([word for words in split for word in words], object))[0].astype(np.int64)
    place = np.arange(len(owner)) - begin[owner]
    runs = word_runs(owner * (codes.max(initial=0) + 1) + codes, place, least, times)
    # How many runs a word is in behind their first period.
    change = np.zeros(len(owner) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    bounds = np.searchsorted(runs[:, 0], np.r_[begin, len(owner)])
    for n, words in enumerate(split):
        own = runs[bounds[n] : bounds[n + 1]]
        if len(own):
            words = [words[i] for i in np.flatnonzero(kept[begin[n] : begin[n] + counts[n]])]
        listed = [
            {"start": start - int(begin[n]), "length": length, "period": period}
            for start, length, period in own.tolist()
        ]
        yield int(counts[n]), listed, b" ".join(words)


def _together(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Neighbouring texts of bounded size."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > _TOGETHER:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def periodic_runs(documents: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start word, length, period) and collapsed text.

    Words are what ASCII white space separates, numbered from 0. A run is a longest stretch of words with smallest
    period q that has at least ``least`` and ``times * q`` words; runs are listed by start, then period. The
    collapsed text joins by one space the words that no run holds behind its first q words. NULL and empty
    texts have no words; ids are passed on as they are, NULL or repeated, and each row stands for itself. No
    row is shuffled; a very long text takes one task n log n steps, whatever it repeats.
    """
    if times < 3 or least < 1:
        raise ValueError("a run has at least three periods and one word")
    texts = renamed(documents, {"doc_id": "doc_id", "text": "text"}).select(
        "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            at = 0
            for part in _together(batch.column("text").to_pylist()):
                counts, listed, collapsed = zip(*_searched(part, least, times))
                ids = batch.column("doc_id").slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(counts, pa.int64()), pa.array(listed, runs), pa.array(collapsed, pa.binary())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(search, f"doc_id {kind}, n_words bigint, runs {_RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text, with repeats planted in a tenth of the texts, chosen by crc32 of the decimal id.

    With h that checksum, g = h div 10 and n words: if h mod 10 is 0, word i >= a becomes word a + (i - a) mod p,
    where a = g mod n and p = 1 + (n - a) div (3 + g mod 8). Texts without words and rows without an id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    texts = renamed(documents, {"doc_id": "doc_id", "text": "text"}).withColumn("g", F.floor(h / 10))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    split = texts.withColumn("words", F.when(chosen, words))
    n = F.size("words")
    sized = split.withColumn("a", F.when(n > 0, F.col("g") % n))
    planted = sized.withColumn("p", F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    def word(own, i):
        return F.when(i < F.col("a"), own).otherwise(
            F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        )

    text = F.when(F.col("a").isNotNull(), F.array_join(F.transform("words", word), " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The runs of each document as numbers and digests, with the run that repeats its period most often.

    Of equally often repeated ones the first counts; without a run its columns are NULL.
    """
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
    line = F.transform(
        "runs", lambda run: F.concat(F.concat_ws(",", *[run[part].cast("string") for part in _PARTS]), F.lit("\n"))
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"best.{part}").alias(part) for part in _PARTS],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
