"""Benchmark decontamination by SimHash over windows as long as the benchmark's items.

Windows that share too few shingles with every item to be similar to one are left out beforehand; that
loses nothing, since a similar window shares four fifths of an item's shingles. The others get a SimHash.
A multi-index over the items' fingerprints finds every pair within the radius: two fingerprints that
differ in 20 of 64 bits at most differ in two bits at most in one of eight bytes, so the index holds each
byte of an item with all its variants of up to two bits. What is found is verified exactly.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import DOC, item_windows, joined, sized_items, sized_shingles, small, with_words
from tidemark.llm.tables import renamed, settled

# What tells items apart, as DOC does documents: ids may repeat with other texts or be NULL.
ITEM = ("item_id", "item_key")
BITS = 64
BLOCK_BITS = 8


def leaks(
    documents: DataFrame, benchmark: DataFrame, shingle: int = 5, radius: int = 20, similarity: float = 0.8
) -> DataFrame:
    """One row per document and item of which the document holds a similar window.

    Columns: doc_id, text_key (a hash of the text), item_id, start_word and window_words of the best window (the first of equal ones),
    distance in bits and similarity. Similar means: fingerprints at most ``radius`` bits apart and a
    weighted Jaccard similarity of the shingles, repeats counted, of at least ``similarity``. A window has
    as many words as the item; a shorter document is one window. Items of fewer words than a shingle are
    one shingle; items and documents without words match nothing. NULL texts have no words, NULL ids are
    kept, rows that repeat an id and a text count once, also those of the benchmark. Texts that share an
    item_id, or have none, are compared one by one; the row of the item holds the best window of any.
    """
    if not 0.5 <= similarity <= 1:
        raise ValueError("windows are chosen for similarities of 0.5 to 1")
    texts = with_words(documents)
    items = renamed(benchmark, {"item_id": "item_id", "text": "text"}).distinct()
    items = settled(sized_items(items.withColumn("item_key", F.xxhash64("text")), shingle, "item_key"), "items")
    sizes = sorted(row["k"] for row in items.select("k").distinct().collect())
    if not sizes:
        return _best(_no_matches(texts, items))
    item_shingles = settled(reduce(DataFrame.union, [sized_shingles(items, k, *ITEM, "n", "k") for k in sizes]), "item-shingles")
    windows = settled(
        reduce(DataFrame.union, [item_windows(texts, item_shingles, k) for k in sizes]), "windows"
    )
    item_marks = _marks(item_shingles, *ITEM, "n").toDF(*ITEM, "n", "item_mark")
    shingles = reduce(DataFrame.union, [sized_shingles(windows, k, *DOC, "n", "k", "start") for k in sizes])
    marks = settled(_marks(shingles, *DOC, "n", "start"), "marks")
    near = settled(_within(marks, item_marks, radius), "near")
    return _best(_verified(near, windows, item_shingles, sizes, similarity))


def _marks(shingles: DataFrame, *keys: str) -> DataFrame:
    """The SimHash of each group of shingles: a bit is 1 if it is set in over half of them."""
    ones = [F.sum(F.shiftright("shingle", bit).bitwiseAND(F.lit(1))).alias(f"b{bit}") for bit in range(BITS)]
    counted = shingles.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *ones)
    bits = [
        F.shiftleft(F.when(F.col(f"b{bit}") * 2 > F.col("total"), F.lit(1)).otherwise(0).cast("bigint"), bit)
        for bit in range(BITS)
    ]
    return counted.select(*keys, reduce(Column.bitwiseOR, bits).alias("mark"))


def _blocks(mark: str) -> Column:
    """The bytes of a fingerprint with their places."""
    return F.array(
        *[
            F.struct(
                F.lit(at).alias("block"),
                F.shiftright(mark, at).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("value"),
            )
            for at in range(0, BITS, BLOCK_BITS)
        ]
    )


def _within(marks: DataFrame, item_marks: DataFrame, radius: int) -> DataFrame:
    """All pairs of a window and an item of its size whose fingerprints differ in ``radius`` bits or fewer."""
    flips = radius // (BITS // BLOCK_BITS)
    variants = [sum(1 << bit for bit in bits) for n in range(flips + 1) for bits in combinations(range(BLOCK_BITS), n)]
    index = (
        item_marks.select(*ITEM, "n", "item_mark", F.inline(_blocks("item_mark")))
        .withColumn("flip", F.explode(F.array(*map(F.lit, variants))))
        .select(*ITEM, "n", "item_mark", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    )
    probes = marks.select(*DOC, "n", "start", "mark", F.inline(_blocks("mark")))
    return (
        probes.join(small(settled(index, "index")), ["n", "block", "value"])
        .withColumn("distance", F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))))
        .where(F.col("distance") <= radius)
        .select(*DOC, "n", "start", *ITEM, "distance")
        .distinct()
    )


def _verified(
    near: DataFrame, windows: DataFrame, item_shingles: DataFrame, sizes: list[int], similarity: float
) -> DataFrame:
    """Pairs with their weighted Jaccard similarity, where it is high enough."""
    pairs = joined(near, windows, *DOC, "n", "start")
    keys = (*DOC, "n", "start", *ITEM, "distance")
    own = reduce(DataFrame.union, [sized_shingles(pairs, k, *keys) for k in sizes])
    own = own.groupBy(*keys, "shingle").agg(F.count(F.lit(1)).alias("times"))
    theirs = item_shingles.groupBy(*ITEM, "shingle").agg(F.count(F.lit(1)).alias("item_times"))
    totals = item_shingles.groupBy(*ITEM).agg(F.count(F.lit(1)).alias("item_total"))
    common = (
        joined(own, small(theirs), *ITEM, "shingle", how="left")
        .groupBy(*keys)
        .agg(
            F.sum("times").alias("total"),
            F.sum(F.least("times", F.coalesce("item_times", F.lit(0)))).alias("common"),
        )
    )
    return (
        joined(common, small(totals), *ITEM)
        .withColumn("similarity", F.col("common") / (F.col("total") + F.col("item_total") - F.col("common")))
        .where(F.col("similarity") >= similarity)
        .select("doc_id", "text_key", "item_id", "start", "n", "distance", "similarity")
    )


def _no_matches(texts: DataFrame, items: DataFrame) -> DataFrame:
    none = texts.join(items, F.lit(False))
    return none.select(
        "doc_id", "text_key", "item_id", F.lit(0).alias("start"), "n", F.lit(0).alias("distance"), F.lit(0.0).alias("similarity")
    )


def _best(matches: DataFrame) -> DataFrame:
    best = F.max_by(
        F.struct("start", "n", "distance", "similarity"), F.struct("similarity", -F.col("distance"), -F.col("start"), -F.col("n"))
    ).alias("best")
    return matches.groupBy("doc_id", "text_key", "item_id").agg(best).select(
        "doc_id",
        "text_key",
        "item_id",
        F.col("best.start").alias("start_word"),
        F.col("best.n").alias("window_words"),
        "best.distance",
        "best.similarity",
    )


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no similar window of any item, with all their columns."""
    found = leaks(documents, benchmark).select("doc_id", "text_key").distinct()
    keyed = documents.withColumn("_text_key", F.xxhash64("text"))
    leaked = small(settled(found, "leaked").toDF("_leaked_id", "_leaked_key"))
    match = F.col("doc_id").eqNullSafe(F.col("_leaked_id")) & (F.col("_text_key") == F.col("_leaked_key"))
    return keyed.join(leaked, match, "left_anti").drop("_text_key")
