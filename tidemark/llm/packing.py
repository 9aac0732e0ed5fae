"""Packing documents into token sequences of fixed capacity by exact complements.

Only lengths matter to a plan, and there are at most ``capacity`` of them however large the corpus, so the
plan is made from the number of pieces of each length. Spark tokenises, counts, ranks the pieces of each
length and gives every rank its place.
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache, cached_property
from pathlib import Path

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.tables import in_small_batches, renamed, settled

END_ID = 2
# Tokens of a stretch of text are kept for the next time it occurs, up to so many stretches of so many characters a
# worker: some 30 MB, which the worker holds as long as it lives, also in other stages.
CACHED_STRETCHES = 1 << 17
CACHED_LENGTH = 64
_ID_BYTES = 4
# White space before a space would be one token across a cut at that space.
_NO_CUT = regex.compile(r"\s ")

Pattern = tuple[tuple[int, ...], int]


class _Stretches(dict):
    """Token ids, as bytes, of stretches of text that the vocabulary's pattern never crosses.

    Half of what is kept has been met since the other half was full, so that frequent stretches stay.
    """

    def __init__(self, ranks: str, pattern: str) -> None:
        pairs = (line.split() for line in Path(ranks).read_bytes().splitlines())
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        ids = self.earlier.get(stretch)
        if ids is None:
            ids = array("I", self.encode.encode_ordinary(stretch)).tobytes()
        if len(stretch) <= CACHED_LENGTH:
            if len(self) >= CACHED_STRETCHES // 2:
                self.earlier = dict(self)
                self.clear()
            self[stretch] = ids
        return ids


def special_tokens(vocabulary: str) -> tuple[str, ...]:
    """The tokens of a tokenizer file that stand for themselves wherever a text holds them."""
    return tuple(token["content"] for token in json.loads(Path(vocabulary).read_bytes())["added_tokens"])


class TextTokens:
    """Token ids of a text as little-endian 32-bit numbers, equal to what the tokenizer file gives.

    The pattern of a byte-level vocabulary takes a space to the word behind it, so a text may be cut before
    a single space. Texts that hold white space before a space or a special token are encoded whole. The
    tokenizer file is read when the first text with one of its ``special`` tokens comes.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, special: tuple[str, ...] | None = None) -> None:
        self.vocabulary = vocabulary
        self.special = special_tokens(vocabulary) if special is None else special
        self.stretches = _Stretches(ranks, pattern)

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.vocabulary)

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if _NO_CUT.search(text):
            return array("I", self.stretches.encode.encode_ordinary(text)).tobytes()
        head, *rest = text.split(" ")
        known = self.stretches
        return b"".join([known[head] if head else b"", *[known[" " + word] for word in rest]])


@cache
def _tokens(vocabulary: str, ranks: str, pattern: str, special: tuple[str, ...]) -> TextTokens:
    return TextTokens(vocabulary, ranks, pattern, special)


def pieces(documents: DataFrame, vocabulary: str, ranks: str, pattern: str, capacity: int) -> DataFrame:
    """One row per piece of a document: its ids are tokens of the text and the end id.

    Documents longer than ``capacity`` are cut from their end, so only the first piece may be shorter.
    ``chunk`` and ``nth`` number the pieces of one length within the task that made them.
    """
    special = special_tokens(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = _tokens(vocabulary, ranks, pattern, special), array("I", [END_ID]).tobytes()
        chunk, met = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text) + end
                total = len(ids) // _ID_BYTES
                cuts = [0, *range(total % capacity or capacity, total + 1, capacity)]
                for n, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    crc = zlib.crc32(ids[start * _ID_BYTES : stop * _ID_BYTES])
                    rows.append((doc, n, start, stop - start, crc, chunk, met[stop - start]))
                    met[stop - start] += 1
            yield pd.DataFrame(rows, columns=columns)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "nth"]
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return in_small_batches(texts).mapInPandas(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, chunk int, nth bigint"
    )


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns of lengths and how often each is used; together they use every piece once.

    The longest length left opens a sequence. Its gap is filled exactly by one, two or three lengths if
    their sums can do so under the counts that are left; else the longest length that fits is added and
    the search goes on. A pattern is repeated as long as its lengths last.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    patterns: list[Pattern] = []
    while left.any():
        lengths = [int(np.flatnonzero(left)[-1])]
        left[lengths[0]] -= 1
        while (gap := capacity - sum(lengths)) > 0:
            filling = _exact(left, gap)
            if filling:
                for length in filling:
                    left[length] -= 1
                lengths += filling
                break
            fitting = np.flatnonzero(left[: gap + 1])
            if not len(fitting):
                break
            lengths.append(int(fitting[-1]))
            left[lengths[-1]] -= 1
        more = min(int(left[length]) // times for length, times in Counter(lengths).items())
        for length in lengths:
            left[length] -= more
        patterns.append((tuple(lengths), more + 1))
    return patterns


def _exact(left: np.ndarray, gap: int) -> list[int]:
    """One to three lengths at hand that add up to ``gap``; fewer first, then with the longest."""
    if left[gap]:
        return [gap]
    pair = _pair(left, gap, gap)
    if pair:
        return pair
    for longest in np.flatnonzero(left[:gap])[::-1].tolist():
        if 3 * longest < gap:
            break
        left[longest] -= 1
        rest = _pair(left, gap - longest, longest)
        left[longest] += 1
        if rest:
            return [longest, *rest]
    return []


def _pair(left: np.ndarray, gap: int, most: int) -> list[int]:
    """Two lengths of at most ``most`` that add up to ``gap``."""
    high = np.arange((gap + 1) // 2, min(gap - 1, most) + 1)
    low = gap - high
    fits = (left[high] > 0) & (left[low] > (high == low))
    if not fits.any():
        return []
    best = int(high[np.flatnonzero(fits)[-1]])
    return [best, gap - best]


def _places(patterns: list[Pattern], capacity: int) -> dict[str, np.ndarray]:
    """By length and rank: the first rank of a run of places, its sequence and its offset there."""
    met: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, met[length], sequence, offset))
            met[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    return {"rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3], "first": first}


def pack(documents: DataFrame, vocabulary: str, ranks: str, pattern: str, capacity: int = 1024) -> DataFrame:
    """One row per piece of a document, with its sequence and its offset there, without gaps from 0.

    NULL and empty texts are one piece that holds the end id alone. Very long texts are tokenised whole and
    cut. Repeated rows and ids are packed once each, as rows; NULL ids stay NULL. No rows, no sequences.
    """
    documents = renamed(documents, {"doc_id": "doc_id", "text": "text"})
    cut = settled(pieces(documents, vocabulary, ranks, pattern, capacity), "pieces")
    made = settled(cut.groupBy("chunk", "length").agg((F.max("nth") + 1).alias("made")), "made")
    histogram = made.groupBy("length").agg(F.sum("made").alias("count")).collect()
    patterns = plan({row["length"]: row["count"] for row in histogram}, capacity)
    places = documents.sparkSession.sparkContext.broadcast(_places(patterns, capacity))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        known = places.value
        size, number = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        row = np.empty(len(size), np.int64)
        for one in np.unique(size):
            first, last = known["first"][one], known["first"][one + 1]
            own = size == one
            row[own] = first + np.searchsorted(known["rank"][first:last], number[own], side="right") - 1
        return pd.DataFrame(
            {"sequence_id": known["sequence"][row] + number - known["rank"][row], "offset": known["offset"][row]}
        )

    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = made.select("chunk", "length", F.coalesce(F.sum("made").over(before), F.lit(0)).alias("earlier"))
    ranked = cut.join(earlier, ["chunk", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))
    return ranked.withColumn("place", place("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"
    )
