"""Language identification by prediction by partial matching.

Every language has a context tree over bytes of order 3: a byte that a context has never seen costs the
context's escape and is then coded by the next shorter context, down to 8 bits for a byte that training
never held (escape method C). The statistics are frozen after training, so the exact code length of each
byte after each context is known; a text belongs to the language whose tree codes it in the fewest bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import id_remainder, in_small_batches, renamed

UNDETERMINED = "und"
# Not a byte of any UTF-8 text: stands before the first byte of a text.
_EDGE = b"\xff" * 3
_STRETCH = 1 << 19


@dataclass(frozen=True)
class LanguageModel:
    """``cost[row[context], byte class, language]`` in bits; a context is the classes of three bytes."""

    languages: tuple[str, ...]
    classes: np.ndarray
    rows: np.ndarray
    cost: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        for owners, lengths, stretch in _stretches(texts):
            code = self.classes[np.frombuffer(stretch, np.uint8)]
            width = len(self.rows)
            context = (code[:-3] * width + code[1:-2]) * width + code[2:-1]
            each = self.cost[self.rows.ravel()[context], code[3:]]
            starts = np.cumsum([0, *lengths[:-1]]) + 3 * np.arange(len(lengths))
            bounds = np.column_stack([starts, starts + lengths]).ravel()[: 2 * len(lengths) - 1]
            sums = np.add.reduceat(each, bounds, axis=0, dtype=np.float64)[::2]
            np.add.at(total, owners, sums)
        return total


def _stretches(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], bytes]]:
    """Texts joined to stretches of bounded length, each led by three bytes of context; long ones are cut."""
    owners, lengths, parts, size = [], [], [], 0
    for n, text in enumerate(texts):
        for at in range(0, len(text), _STRETCH):
            part = text[at : at + _STRETCH]
            owners.append(n)
            lengths.append(len(part))
            parts += [text[at - 3 : at] if at else _EDGE, part]
            size += len(part)
            if size >= _STRETCH:
                yield owners, lengths, b"".join(parts)
                owners, lengths, parts, size = [], [], [], 0
    if owners:
        yield owners, lengths, b"".join(parts)


def train(labelled: DataFrame, per_language: int = 3000, least: int = 16) -> LanguageModel | None:
    """Fit the trees to rows (doc_id, text, lang) with a language; None if there are none.

    ``per_language`` bounds the sample: about so many documents of each language, chosen by a hash of the
    id, with their whole texts. Contexts met fewer than ``least`` times are left to shorter ones, which
    bounds the table. Grams are counted by Spark; only their counts reach the driver.
    """
    labelled = labelled.where("text is not null and lang is not null")
    sizes = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = tuple(sorted(sizes))
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit(per_language / sizes[name])).otherwise(share)
    place = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / (1 << 30)
    sample = labelled.where(place < share).select("lang", F.col("text").cast("binary").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, group in batch.groupby("lang"):
                for _, _, stretch in _stretches(group["text"].tolist()):
                    byte = np.frombuffer(stretch, np.uint8).astype(np.int64)
                    gram = (byte[:-3] << 24) | (byte[1:-2] << 16) | (byte[2:-1] << 8) | byte[3:]
                    gram, times = np.unique(gram[byte[3:] != _EDGE[0]], return_counts=True)
                    yield pd.DataFrame({"lang": name, "gram": gram, "times": times})

    grams = (
        in_small_batches(sample).mapInPandas(count, "lang string, gram bigint, times bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
        .toPandas()
    )
    return _frozen(languages, grams, least) if len(grams) else None


def _frozen(languages: tuple[str, ...], grams: pd.DataFrame, least: int) -> LanguageModel:
    gram = grams["gram"].to_numpy(np.int64)
    times = grams["times"].to_numpy(np.float64)
    language = np.searchsorted(np.array(languages), grams["lang"].to_numpy(str))
    seen = np.unique(gram & 255)
    # Class 0 is the edge of a text, class 1 all bytes that training never held.
    classes = np.ones(256, np.int32)
    classes[_EDGE[0]] = 0
    classes[seen] = np.arange(2, len(seen) + 2)
    width = len(seen) + 2
    part = [classes[(gram >> shift) & 255].astype(np.int64) for shift in (24, 16, 8, 0)]
    shape = (width, width, width)
    rows = np.zeros(shape, np.int32)
    cost = np.full((1, width, len(languages)), 8.0)
    parents, parent_codes = np.zeros(1, np.int64), np.zeros(1, np.int64)
    tables = []
    for order in range(4):
        code = np.zeros(len(gram), np.int64)
        for at in range(3 - order, 3):
            code = code * width + part[at]
        kept, place = np.unique(code, return_inverse=True)
        often = np.bincount(place, times) >= (least if order else 0)
        kept, place = kept[often], np.where(often[place], (np.cumsum(often) - 1)[place], -1)
        inside = place >= 0
        counts = np.zeros((len(kept), width, len(languages)))
        np.add.at(counts, (place[inside], part[3][inside], language[inside]), times[inside])
        total, distinct = counts.sum(axis=1), (counts > 0).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            own = -np.log2(counts / (total + distinct)[:, None, :])
        shorter = kept % width ** max(order - 1, 0)
        below = parents[np.searchsorted(parent_codes, shorter)] if order else np.zeros(len(kept), np.int64)
        base = cost if order == 0 else np.concatenate(tables)
        cost = np.where(counts > 0, own, escape[:, None, :] + base[below])
        begin = sum(map(len, tables))
        tables.append(cost)
        parents, parent_codes = begin + np.arange(len(kept)), kept
        # A longer context overwrites the shorter ones that end like it.
        digits = [kept // width**n % width for n in range(order)]
        where = tuple(digits[2 - axis] if 2 - axis < order else slice(None) for axis in range(3))
        if order == 0:
            rows[:] = 0
        elif order == 3:
            rows[where] = parents
        else:
            free = 3 - order
            rows[where] = parents.reshape((1,) * free + (-1,)) if order == 1 else parents[None, :]
    return LanguageModel(languages, classes, rows, np.concatenate(tables).astype(np.float32))


def identify(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``documents`` with the columns lang_pred and score added or replaced.

    ``score`` is the probability of the language, all of them being as likely before the text is seen. A
    text that is NULL or has no letter, and any text if there is no model, is ``und`` with score 0. Long
    texts are coded to their end; of languages that code a text equally well the first by name wins.
    """
    keep = [F.col(f"`{name}`") for name in documents.columns if name not in ("lang_pred", "score")]
    if model is None:
        return documents.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def guess(text: pd.Series, lettered: pd.Series) -> pd.DataFrame:
        known = shared.value
        chosen = lettered.to_numpy(bool)
        bits = known.bits([value if use else b"" for value, use in zip(text, chosen)])
        best = bits.argmin(axis=1)
        with np.errstate(under="ignore"):
            odds = np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
        names = np.array(known.languages, dtype=object)[best]
        return pd.DataFrame(
            {"lang_pred": np.where(chosen, names, UNDETERMINED), "score": np.where(chosen, 1 / odds, 0.0)}
        )

    found = guess(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), has_letter(F.col("text")))
    return in_small_batches(documents).select(*keep, found.alias("_found")).select(*keep, "_found.lang_pred", "_found.score")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def with_language(
    documents: DataFrame,
    languages: Sequence[str] | None = None,
    folds: int = 4,
    held_fold: int = 2,
    **bounds: int,
) -> DataFrame:
    """The rows of ``documents`` that are in one of ``languages``; the trees are fitted as in ``predicted_languages``.

    Without ``languages`` every learnt one will do, so that only texts without a letter, NULL ones among them,
    go. Where nothing is labelled there are no trees: then all texts with a letter stay, whatever is asked
    for. Repeated rows stay as they are, long texts are coded whole, columns are those given, and their
    labels do not decide. No rows in, no rows out.
    """
    model = train(_in_folds(documents, folds, held_fold).where("not held_out"), **bounds)
    if model is None:
        return documents.where(has_letter(F.col("text")))
    rest = [F.col(f"`{name}`") for name in documents.columns]
    marked = identify(documents.select(F.struct(*rest).alias("row"), "text"), model)
    wanted = model.languages if languages is None else languages
    # A language of that name may have been learnt, so a letter decides what is undetermined.
    return marked.where(F.col("lang_pred").isin(list(wanted)) & has_letter(F.col("text"))).select("row.*")


def _in_folds(documents: DataFrame, folds: int, held_fold: int) -> DataFrame:
    rows = renamed(documents, {"doc_id": "doc_id", "text": "text", "lang": "lang"})
    return rows.withColumn("held_out", id_remainder(F.col("doc_id"), folds) == held_fold)


def predicted_languages(documents: DataFrame, folds: int = 4, held_fold: int = 2, **bounds: int) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; trained on the rows that are not held out.

    A row is held out if crc32 of its id as text, modulo ``folds``, is ``held_fold``. Neither lang, source
    nor doc_id takes part in a prediction. Rows with a NULL id or language are predicted like any other.
    """
    rows = _in_folds(documents, folds, held_fold)
    model = train(rows.where("not held_out"), **bounds)
    return identify(rows.select("doc_id", "held_out", "text"), model).drop("text")
