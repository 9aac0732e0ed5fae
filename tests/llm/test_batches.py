"""What a Python worker holds at a time."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents
from tidemark.llm.language import with_language
from tidemark.llm.near_copies import one_of_each_group
from tidemark.llm.packing import CACHED_LENGTH, CACHED_STRETCHES, TextTokens, pack
from tidemark.llm.settings import TOKENIZER
from tidemark.llm.tables import BATCH_BYTES, in_small_batches

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
STAGES = {
    "language": with_language,
    "near_copies": one_of_each_group,
    "packing": lambda docs: pack(docs, **TOKENIZER),
}


@pytest.fixture
def unbounded(spark):
    before = spark.conf.get(BOUND)
    spark.conf.unset(BOUND)
    yield spark
    spark.conf.set(BOUND, before)


def batches(frame):
    """Rows and characters of every batch that a Python worker gets."""

    def run(parts):
        for part in parts:
            yield pd.DataFrame({"n": [len(part)], "size": [int(part["text"].str.len().sum())]})

    return frame.coalesce(1).mapInPandas(run, "n bigint, size bigint").collect()


def texts(spark):
    return spark.range(600).select(F.repeat(F.lit("x"), 30_000).alias("text"))


@pytest.mark.parametrize("name", STAGES)
def test_stages_give_workers_batches_of_bounded_bytes(unbounded, name):
    assert len(batches(texts(unbounded))) == 1
    STAGES[name](documents(unbounded)).collect()
    got = batches(texts(unbounded))
    assert sum(row.n for row in got) == 600
    assert max(row["size"] for row in got) <= BATCH_BYTES + 30_000


def test_a_lower_bound_stays_and_a_row_above_it_comes_whole(unbounded):
    unbounded.conf.set(BOUND, "1k")
    got = batches(in_small_batches(texts(unbounded).limit(3)))
    assert [(row.n, row["size"]) for row in got] == [(1, 30_000)] * 3


def test_cached_tokens_are_bounded_and_the_tokenizer_file_waits():
    tokens = TextTokens(**TOKENIZER)
    words = [f"w{n}" for n in range(CACHED_STRETCHES + 1000)]
    first = tokens(" ".join(words))
    assert len(tokens.stretches) + len(tokens.stretches.earlier) <= CACHED_STRETCHES < 1 << 18
    tokens(" ".join(["y" * 100_000] * 2))
    assert max(map(len, [*tokens.stretches, *tokens.stretches.earlier])) <= CACHED_LENGTH
    assert "whole" not in vars(tokens)
    assert first == tokens(" ".join(words))
    assert tokens("a <|endoftext|>") and "whole" in vars(tokens)
