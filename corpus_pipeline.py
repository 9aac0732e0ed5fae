"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import without_leaks
from tidemark.llm.language import with_language
from tidemark.llm.near_copies import one_of_each_group
from tidemark.llm.packing import pack
from tidemark.llm.settings import SURROGATE_KEY, TOKENIZER
from tidemark.llm.surrogates import with_surrogates
from tidemark.llm.tables import Stage, settled, table


# Languages whose documents stay; None: all that the labels teach.
LANGUAGES: list[str] | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of ``LANGUAGES``, by their text and not their label, and those without a letter go."""
    return with_language(docs, LANGUAGES)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays."""
    return one_of_each_group(docs, shingle=4, radius=4, seed=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or nearly so, go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets give way to surrogates; n_chars follows the text."""
    replaced = with_surrogates(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        replaced = replaced.withColumn("n_chars", F.when(F.col("n_replaced") > 0, length).otherwise(F.col("n_chars")))
    return replaced.select(*[F.col(f"`{name}`") for name in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    return pack(docs, **TOKENIZER, capacity=1024)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# SQL has neither the hashes and models nor the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
