from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.cases import documents, rows
from tidemark.llm import repeats
from tidemark.llm.repeats import without_repeats

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def plain(pairs, length):
    met = {}
    for _, text in pairs:
        for at in range(len(text) - length + 1):
            met[text[at : at + length]] = met.get(text[at : at + length], 0) + 1
    result = []
    for doc, text in pairs:
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if met[text[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for n, g in enumerate(gone) if g and not (n and gone[n - 1]))
        result.append((doc, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=repr)


def patched_texts(letters):
    draw = random.Random(letters)
    passages = ["".join(draw.choices("abcdefgh"[:letters], k=draw.randrange(10, 60))) for _ in range(10)]
    texts = []
    for doc in range(60):
        parts = []
        for _ in range(draw.randrange(8)):
            own = "".join(draw.choices("abcdefgh"[:letters], k=draw.randrange(30)))
            parts += [own, draw.choice(passages)[draw.randrange(6) :]]
        texts.append((doc, "".join(parts)))
    return texts


@pytest.mark.parametrize("letters", [2, 8])
@pytest.mark.parametrize("stretch", [1 << 19, 64])
def test_equals_brute_force(spark, monkeypatch, letters, stretch):
    monkeypatch.setattr(repeats, "_STRETCH", stretch)
    texts = patched_texts(letters) + [(100, "ab" * 90), (101, "z" * 70), (102, "héé" * 20)]
    got = without_repeats(documents(spark, texts), length=24, reach=12)
    assert rows(got, *COLUMNS) == plain([(doc, text.encode()) for doc, text in texts], 24)


def test_nulls_empty_long_and_repeated_rows(spark):
    frame = documents(spark)
    pairs = [(row.doc_id, (row.text or "").encode()) for row in frame.collect() if row.doc_id != 7]
    got = without_repeats(frame.where("doc_id is null or doc_id <> 7"), length=40, reach=16)
    assert rows(got, *COLUMNS) == plain(pairs, 40)


def test_long_text_loses_its_periods(spark):
    frame = documents(spark).where("doc_id = 7")
    row = without_repeats(frame).first()
    assert row.n_removed == row.n_bytes and row.n_spans == 1 and row.kept == b""


def test_no_documents_and_bad_reach(spark):
    assert without_repeats(documents(spark, [])).count() == 0
    with pytest.raises(ValueError, match="reach"):
        without_repeats(documents(spark), length=20, reach=20)
