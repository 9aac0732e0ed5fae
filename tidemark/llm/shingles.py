"""Words and word shingles as rows, and the places where texts share shingles with a reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import renamed, settled

# What tells documents apart: rows that repeat both are one.
DOC = ("doc_id", "text_key")
# Rows of a few numbers each: at most some 50 MB on every executor.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; NULL texts have none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def with_words(documents: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text) and words of every row."""
    return renamed(documents, {"doc_id": "doc_id", "text": "text"}).select(
        "doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words")
    )


def sized_items(items: DataFrame, shingle: int, *keep: str) -> DataFrame:
    """Items (item_id, text) that have words: item_id, ``keep``, words, their number n, and k, the size of their shingles.

    An item of fewer words than a shingle is one shingle.
    """
    worded = items.select("item_id", *keep, words(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.size("words")
    return worded.select("item_id", *keep, "words", size.alias("n"), F.least(size, F.lit(shingle)).alias("k"))


def sized_shingles(frame: DataFrame, k: int, *keep: str) -> DataFrame:
    """The shingles of the rows of ``frame`` whose shingles have ``k`` words."""
    return shingle_rows(frame.where(F.col("k") == k), "words", k, *keep)


def item_windows(texts: DataFrame, item_shingles: DataFrame, k: int) -> DataFrame:
    """Windows of documents, as long as items, that share at least half as many shingles with them as one has.

    ``item_shingles`` has the columns shingle, n and k. A document shorter than an item is one window. Columns:
    doc_id, text_key, n, k, start and words.
    """
    known = item_shingles.where(F.col("k") == k).select("shingle", "n").distinct()
    sized = texts.withColumn("size", F.size("words"))
    hits = shingle_rows(sized, "words", k, *DOC, "size").join(small(known), "shingle")
    span = F.col("n") - (k - 1)
    first = F.greatest(F.lit(0), F.col("pos") - span + 1)
    last = F.greatest(F.lit(0), F.least(F.col("pos"), F.col("size") - F.col("n")))
    starts = (
        hits.select(*DOC, "n", F.explode(F.sequence(first, last)).alias("start"))
        .groupBy(*DOC, "n", "start")
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") * 2 >= span)
        .groupBy(*DOC)
        .agg(F.collect_list(F.struct("n", "start")).alias("places"))
    )
    placed = joined(texts, small(settled(starts, "starts")), *DOC).select(
        *DOC, "words", F.explode("places").alias("place")
    )
    own = F.slice("words", F.col("place.start") + 1, F.col("place.n"))
    return placed.select(
        *DOC, "place.n", F.lit(k).alias("k"), "place.start", own.alias("words")
    ).distinct()


def shingle_rows(frame: DataFrame, array: str, size: int, *keep: str) -> DataFrame:
    """A row (pos, shingle) for every run of ``size`` words of the column ``array``; the hash stands for the run."""
    shifted = [F.slice(array, n + 1, F.greatest(F.size(array) - size + 1, F.lit(0))).alias(f"w{n}") for n in range(size)]
    zipped = frame.select(*keep, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "run"))
    return zipped.select(*keep, "pos", F.xxhash64(*[f"run.w{n}" for n in range(size)]).alias("shingle"))


def small(frame: DataFrame) -> DataFrame:
    """``frame`` marked for broadcast if it has been counted to be small; else as it is, for a shuffled join."""
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def joined(left: DataFrame, right: DataFrame, *names: str, how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL, keeping the left side's keys."""
    renamed = right.select(*[F.col(n).alias(f"_{n}") if n in names else F.col(n) for n in right.columns])
    match = F.lit(True)
    for name in names:
        match = match & F.col(name).eqNullSafe(F.col(f"_{name}"))
    both = left.join(renamed, match, how)
    return both if how in ("left_semi", "left_anti") else both.drop(*[f"_{name}" for name in names])
