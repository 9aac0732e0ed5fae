"""Removal of byte strings that occur more than once, by a depth-limited radix sort of suffixes.

Two equal strings of ``length`` bytes agree on everything inside them, so also on their anchor: the place in
their first ``reach`` bytes where a hash of eight bytes is least. It is enough to order the suffixes that
start at anchors, and to order them only as far as the strings reach. The passes go from the most significant
digit down, and each takes only the groups that the pass before left with several members:

1. the ``length - reach + 1`` bytes from the anchor on, which all strings with that anchor hold;
2. all bytes of all strings with that anchor. Equal ones are repeats, however many strings they stand for;
3. the strings themselves, one by one, of anchors that passed the first digit and not the second. These
   lie at the edges of what repeats.

Digits are compared by fingerprints of 64 bits. A string counts as repeated if the first digit and the
string agree, 128 bits in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import discard, renamed, settled

_GRAM = 8
_STRETCH = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
TEXT = ("text_key", "n_bytes")


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, and a random number for each byte."""
    up, down = np.full(size + 1, _BASE, np.uint64), np.full(size + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down), np.random.default_rng(400).integers(0, 1 << 64, 256, np.uint64)


class _Stretch:
    """Bytes whose substrings have fingerprints that do not depend on where they stand."""

    def __init__(self, content: bytes) -> None:
        self.bytes = np.frombuffer(content, np.uint8)
        size = 1 << max(16, (len(content) - 1).bit_length())
        up, self.down, numbers = _powers(size)
        self.sums = np.zeros(len(content) + 1, np.uint64)
        np.cumsum(numbers[self.bytes] * up[: len(content)], out=self.sums[1:])

    def fingerprint(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def anchors(self, reach: int) -> np.ndarray:
        """For each place the anchor of the string that starts there; the last ``reach - 1`` have none."""
        padded = np.concatenate([self.bytes, np.zeros(_GRAM, np.uint8)])
        grams = np.lib.stride_tricks.sliding_window_view(padded, _GRAM)[: len(self.bytes)]
        mixed = np.ascontiguousarray(grams).view("<u8").ravel() * np.uint64(_BASE)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _SPREAD
        # The place in the low half: of equal hashes the first is the least.
        least = (mixed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(mixed), dtype=np.uint64)
        seen = 1
        while seen < reach:
            step = min(seen, reach - seen)
            least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
            seen += step
        return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _stretches(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Owners, offsets and sizes of parts of texts, and the parts joined. Parts of a long text overlap."""
    owners, offsets, parts, size = [], [], [], 0
    for n, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), _STRETCH):
            part = text[at : at + _STRETCH + length - 1]
            owners.append(n)
            offsets.append(at)
            parts.append(part)
            size += len(part)
            if size >= _STRETCH:
                yield np.array(owners), np.array(offsets), np.array([*map(len, parts)]), b"".join(parts)
                owners, offsets, parts, size = [], [], [], 0
    if owners:
        yield np.array(owners), np.array(offsets), np.array([*map(len, parts)]), b"".join(parts)


def _starts(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places in joined parts where a string starts that lies in one part: part, place in it, place."""
    strings = sizes - length + 1
    part = np.repeat(np.arange(len(sizes)), strings)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
    return part, place, begin[part] + place


def anchors_of(texts: list[bytes], length: int, reach: int) -> Iterator[dict[str, np.ndarray]]:
    """Every anchor with the starts ``lo`` to ``hi`` of the strings it stands for, and its two digits."""
    for owners, offsets, sizes, content in _stretches(texts, length):
        stretch = _Stretch(content)
        part, place, start = _starts(sizes, length)
        anchor = stretch.anchors(reach)[start]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
        last = np.r_[new[1:], len(start)] - 1
        lo, hi, at = start[new], start[last], anchor[new]
        first = stretch.fingerprint(at, at + (length - reach + 1))
        layout = ((at - lo) * reach + (hi - lo)).astype(np.uint64)
        whole = stretch.fingerprint(lo, hi + length) + layout * _SPREAD
        shift = offsets[part[new]]
        yield {
            "owner": owners[part[new]],
            "lo": place[new] + shift,
            "hi": place[last] + shift,
            "first": first.view(np.int64),
            "whole": whole.view(np.int64),
        }


def _anchors(texts: DataFrame, length: int, reach: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for found in anchors_of(batch["text"].tolist(), length, reach):
                owner = found.pop("owner")
                keys = {name: batch[name].to_numpy()[owner] for name in TEXT}
                yield pd.DataFrame(keys | found)

    return texts.mapInPandas(run, "text_key bigint, n_bytes bigint, lo bigint, hi bigint, first bigint, whole bigint")


def _strings(wanted: DataFrame, length: int) -> DataFrame:
    """A row for every string of the wanted anchors; ``place`` tells two strings at different places apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = batch["wanted"].map(len).to_numpy()
            owner = np.repeat(np.arange(len(batch)), runs)
            lo, hi, first, open_ = (
                np.concatenate([np.array([one[name] for one in each]) for each in batch["wanted"]])
                for name in ("lo", "hi", "first", "open")
            )
            texts, keys = batch["text"].tolist(), batch["text_key"].to_numpy(np.int64)
            cuts = [texts[n][a : b + length] for n, a, b in zip(owner, lo, hi)]
            for cut, _, sizes, content in _stretches(cuts, length):
                part, place, start = _starts(sizes, length)
                row = cut[part]
                string = _Stretch(content).fingerprint(start, start + length).view(np.int64)
                at = lo[row] + place
                yield pd.DataFrame(
                    {
                        "text_key": keys[owner[row]],
                        "n_bytes": batch["n_bytes"].to_numpy()[owner[row]],
                        "at": at,
                        "first": first[row],
                        "string": string,
                        "place": (keys[owner[row]].view(np.uint64) + at.astype(np.uint64) * _SPREAD).view(np.int64),
                        "open": open_[row],
                    }
                )

    return wanted.mapInPandas(
        run, "text_key bigint, n_bytes bigint, at bigint, first bigint, string bigint, place bigint, open boolean"
    )


def repeated_spans(texts: DataFrame, length: int, reach: int) -> DataFrame:
    """Starts ``lo`` to ``hi`` of strings that occur elsewhere too, for texts (text_key, n_bytes, text)."""
    anchors = settled(_anchors(texts, length, reach), "anchors")
    several = F.min("whole") != F.max("whole")
    digits = settled(
        anchors.groupBy("first").agg(F.count(F.lit(1)).alias("n"), several.alias("several")).where("n > 1").drop("n"),
        "first-digits",
    )
    left = settled(anchors.join(digits, "first"), "second-pass")
    discard(anchors)
    classes = settled(
        left.where("several")
        .groupBy("first", "whole")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.min_by(name, F.xxhash64(*TEXT, "lo")).alias(name) for name in (*TEXT, "lo", "hi")],
        ),
        "second-digits",
    )
    twice = classes.where("n > 1").select("first", "whole")
    whole = left.where("not several").unionByName(left.where("several").join(twice, ["first", "whole"], "left_semi"))
    wanted = classes.groupBy(*TEXT).agg(
        F.collect_list(F.struct("lo", "hi", "first", (F.col("n") == 1).alias("open"))).alias("wanted")
    )
    # Settled sides are joined by plain shuffles, of which Spark can split a text that very many rows share.
    strings = settled(_strings(texts.join(settled(wanted, "wanted"), [*TEXT]), length), "third-pass")
    equal = settled(
        strings.groupBy("first", "string")
        .agg(F.min("place").alias("least"), F.max("place").alias("most"))
        .where("least <> most")
        .select("first", "string"),
        "third-digits",
    )
    edges = settled(
        strings.where("open").join(equal, ["first", "string"], "left_semi").select(*TEXT, "at"), "edges"
    )
    discard(strings)
    return whole.select(*TEXT, "lo", "hi").union(edges.select(*TEXT, "at", "at"))


def without_repeats(documents: DataFrame, length: int = 400, reach: int = 128) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept, the bytes that are left.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in this or any other
    document; all strings are judged on the input. Strings never cross documents. NULL texts count as empty,
    nothing is removed from texts shorter than ``length``, repeated rows lose all their bytes if they are as
    long as that, NULL ids are kept. Very long texts are searched in parts that overlap.
    """
    if not 0 < reach <= length - _GRAM + 1:
        raise ValueError(f"reach must be positive and leave {_GRAM} bytes of a string")
    texts = renamed(documents, {"doc_id": "doc_id", "text": "text"}).select(
        "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )
    texts = texts.withColumns({"text_key": F.xxhash64("text"), "n_bytes": F.octet_length("text").cast("bigint")})
    spans = repeated_spans(texts.where(F.col("n_bytes") >= length).select(*TEXT, "text"), length, reach)
    packed = spans.select(*TEXT, (F.col("lo") * reach + F.col("hi") - F.col("lo")).alias("span")).distinct()
    lists = settled(packed.groupBy(*TEXT).agg(F.collect_list("span").alias("spans")), "spans")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_cut(text, spans, length, reach) for text, spans in zip(batch["text"], batch["spans"])]
            kept = pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "kept"], index=batch.index)
            yield batch[["doc_id", "n_bytes"]].join(kept)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return texts.join(lists, [*TEXT], "left").mapInPandas(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )


def _cut(text: bytes, spans: np.ndarray | None, length: int, reach: int) -> tuple[int, int, str, bytes]:
    if spans is None:
        return 0, 0, hashlib.sha256(text).hexdigest(), text
    spans = np.sort(np.asarray(spans, np.int64))
    begin, end = spans // reach, spans // reach + spans % reach + length
    end = np.maximum.accumulate(end)
    new = np.flatnonzero(np.r_[True, begin[1:] > end[:-1]])
    runs = list(zip(begin[new].tolist(), end[np.r_[new[1:], len(end)] - 1].tolist()))
    ends = [0, *[stop for _, stop in runs]]
    starts = [*[start for start, _ in runs], len(text)]
    kept = b"".join(text[a:b] for a, b in zip(ends, starts))
    return len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept
