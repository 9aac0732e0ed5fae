"""Near copies by SimHash, found through a hierarchical index in Gray order.

The index has three levels. Its upper nodes are shared masked bit patterns: the 64 bits are cut into
pieces, and two fingerprints within the radius agree on all pieces but ``radius`` at most, so they meet
in the node of some mask with no difference counted yet. Below a node the members are sorted by Gray
rank and cut into runs, and runs into blocks; each keeps the pattern of the bits that all its members
share. A search adds up the differences against these patterns and drops whole runs and blocks as soon as
the sum passes the radius. Only members of what is left are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shingles import small
from tidemark.llm.tables import in_small_batches, renamed, settled

BITS = 64
# Members of one upper node that one task compares; larger nodes are cut into pairs of blocks.
NODE_ROWS = 4096
# Pieces are added until an upper node would hold so many fingerprints, were they spread evenly.
EVEN_NODE_ROWS = 512
_MOST_PIECES = 3
_FAN_OUT = 16
_FRONTIER = 1 << 20


def fingerprints(documents: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """One row (doc_id, text_key, fingerprint) per row of ``documents``; the fingerprint is a signed 64-bit number.

    Words are runs of bytes other than space and \\t to \\r, with A-Z in lower case. A bit is 1 if it is
    set in over half the XXH64 hashes of the shingles, repeats included. Fewer words than a shingle make
    one shingle; NULL texts and texts without a word have fingerprint 0.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = np.fromiter((simhash(text, shingle, seed) for text in batch["text"]), np.uint64, len(batch))
            yield batch[["doc_id", "text_key"]].assign(fingerprint=marks.view(np.int64))

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return in_small_batches(texts).mapInPandas(run, f"doc_id {kind}, text_key bigint, fingerprint bigint")


def simhash(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    stops = np.cumsum([len(word) + 1 for word in words]).tolist()
    starts = [0, *stops[:-shingle]]
    hashes = [xxhash.xxh64_intdigest(line[s : e - 1], seed) for s, e in zip(starts, stops[shingle - 1 :])]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def near_copy_groups(documents: DataFrame, shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id and text_key, a hash of the text.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked; ``component_id`` is the
    smallest doc_id that can be reached over links. Repeated rows and ids stay as they are. NULL ids get a
    row too, but never name a component unless it holds nothing else; then it is NULL. No input rows, no
    output rows.
    """
    marks, named = _rooted(documents, shingle, radius, seed)
    # Settled, it is a join side of its own, and a root that holds many fingerprints can be split.
    smallest = settled(named.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    known = named.select("fingerprint", "root").join(smallest, "root").select("fingerprint", "component_id")
    return marks.join(known, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "text_key"
    )


def _rooted(documents: DataFrame, shingle: int = 4, radius: int = 4, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows; and each fingerprint with the root of its component and its smallest doc_id."""
    documents = renamed(documents, {"doc_id": "doc_id", "text": "text"})
    marks = settled(fingerprints(documents, shingle, seed), "fingerprints")
    distinct = settled(marks.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fingerprint"), radius))
    named = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least"
    )
    return marks, named


def one_of_each_group(documents: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``documents`` with the smallest id of their group, with all their columns.

    Of rows that share this id the one with the least text hash stays, and one row of those that repeat it.
    Groups are told apart by their root: ids may repeat or be NULL in any number of them.
    """
    marks, named = _rooted(documents, **bounds)
    groups = marks.join(named.select("fingerprint", "root"), "fingerprint").select("root", "doc_id", "text_key")
    copies = settled(groups.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("times")), "copies")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    least = copies.groupBy("root").agg(first).select(
        F.col("root").alias("_root"), F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")
    )
    # Settled, it is a join side of its own, and a root that holds many rows can be split.
    least = settled(least, "least")
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    judged = copies.join(least, F.col("root") == F.col("_root")).select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text"), own.alias("stays"), "times"
    )
    judged = settled(judged.where("not stays or times > 1"), "judged")
    keyed = documents.withColumn("_text_key", F.xxhash64("text"))
    match = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text_key") == F.col("_text"))
    single = keyed.join(small(judged), match, "left_anti")
    repeated = keyed.join(small(judged.where("stays")), match, "left_semi").dropDuplicates(["doc_id", "_text_key"])
    return single.unionByName(repeated).drop("_text_key")


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints within ``radius`` bits of each other.

    Every edge is a link or a chain of links; a task returns a spanning forest of the links it finds, at
    most one edge per row it reads.
    """
    masks = _masks(distinct.count(), radius)
    nodes = distinct.select(
        "fingerprint",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("pattern"))
                    for n, m in enumerate(masks)
                ]
            )
        ),
    )
    large = (
        nodes.groupBy("mask", "pattern")
        .agg(F.count(F.lit(1)).alias("members"))
        .where(F.col("members") > NODE_ROWS)
        .select("mask", "pattern", F.ceil(F.col("members") / NODE_ROWS).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    split = nodes.join(large, ["mask", "pattern"], "left").select(
        "fingerprint",
        "mask",
        "pattern",
        F.explode(
            F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.col("blocks") - 1),
                    lambda other: F.struct(F.least(own, other).alias("x"), F.greatest(own, other).alias("y")),
                )
            )
        ).alias("pair"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for node, marks in _whole_nodes(batches):
            a, b = spanning_links(node, marks, radius)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    key = F.xxhash64("mask", "pattern", "pair")
    tasks = split.select("fingerprint", key.alias("node")).repartition("node").sortWithinPartitions("node")
    return tasks.mapInPandas(run, "a bigint, b bigint")


def _masks(rows: int, radius: int) -> list[int]:
    """Bit masks such that two fingerprints within ``radius`` agree under at least one of them."""
    for extra in range(1, _MOST_PIECES + 1):
        pieces = radius + extra
        agreed = BITS * extra // pieces
        if rows / 2**agreed <= EVEN_NODE_ROWS:
            break
    cuts = [BITS * n // pieces for n in range(pieces + 1)]
    piece = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(piece, extra)]
    assert len(masks) == comb(pieces, extra)
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def _whole_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of nodes and fingerprints, cut only where a node ends."""
    node, marks = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        node = np.concatenate([node, batch["node"].to_numpy(np.int64)])
        marks = np.concatenate([marks, batch["fingerprint"].to_numpy(np.int64).view(np.uint64)])
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
        if cut:
            yield node[:cut], marks[:cut]
            node, marks = node[cut:], marks[cut:]
    if len(node):
        yield node, marks


def gray_rank(marks: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = marks.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def spanning_links(node: np.ndarray, marks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all members of a node that lie within ``radius`` bits of each other.

    ``node`` must hold equal values side by side.
    """
    order = np.lexsort((gray_rank(marks), node))
    node, marks = node[order], marks[order]
    runs = _group(node, np.arange(len(node)))
    run_node = node[runs]
    blocks = _group(run_node, np.arange(len(runs)))
    run_bits = _shared(marks, marks, runs)
    block_bits = _shared(*_reduced(marks, runs), blocks)
    run_of = np.repeat(np.arange(len(runs)), np.diff([*runs, len(node)]))
    block_of = np.repeat(np.arange(len(blocks)), np.diff([*blocks, len(runs)]))[run_of]
    block_node = run_node[blocks]
    last_block = np.searchsorted(block_node, node, side="right")
    label = np.arange(len(node))
    # Only later members are searched, so that a pair is met once.
    for rows in _slices(last_block - block_of):
        query, block = _expand(rows, block_of[rows], last_block[rows])
        query, block = _near(query, block, marks, block_bits, radius)
        first, last = blocks[block], np.append(blocks, len(runs))[block + 1]
        query, run = _expand(query, np.maximum(first, run_of[query]), last)
        query, run = _near(query, run, marks, run_bits, radius)
        first, last = runs[run], np.append(runs, len(node))[run + 1]
        query, other = _expand(query, np.maximum(first, query + 1), last)
        close = np.bitwise_count(marks[query] ^ marks[other]) <= radius
        label = _joined(label, query[close], other[close])
    linked = np.flatnonzero(label != np.arange(len(node)))
    return marks[linked], marks[label[linked]]


def _group(key: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Starts of groups of at most ``_FAN_OUT`` neighbours with equal keys."""
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    begin = np.repeat(new, np.diff([*new, len(key)]))
    return np.flatnonzero((position - begin) % _FAN_OUT == 0)


def _reduced(marks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.bitwise_and.reduceat(marks, starts), np.bitwise_or.reduceat(marks, starts)


def _shared(all_set: np.ndarray, any_set: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per group the mask of the bits that all members share, and their values."""
    ones, some = np.bitwise_and.reduceat(all_set, starts), np.bitwise_or.reduceat(any_set, starts)
    return ~(ones ^ some), ones


def _near(query: np.ndarray, group: np.ndarray, marks: np.ndarray, bits, radius: int):
    mask, value = bits
    keep = np.bitwise_count((marks[query] ^ value[group]) & mask[group]) <= radius
    return query[keep], group[keep]


def _expand(query: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each query with every number from ``first`` to before ``last``."""
    sizes = np.maximum(last - first, 0)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(query, sizes), np.arange(total) + np.repeat(first - (ends - sizes), sizes)


def _slices(blocks: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers in runs whose frontier stays below a bound even if nothing is pruned."""
    cost = np.cumsum(blocks * _FAN_OUT * _FAN_OUT)
    bounds = np.searchsorted(cost, np.arange(_FRONTIER, (cost[-1] if len(cost) else 0) + _FRONTIER, _FRONTIER))
    start = 0
    for stop in [*np.unique(bounds), len(blocks)]:
        if stop > start:
            yield np.arange(start, stop)
            start = stop


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining each a with its b; a label is the least row number of its group."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            return label
