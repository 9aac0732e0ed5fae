from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import TEXTS, documents, rows
from tidemark.llm import periodic as operator
from tidemark.llm.periodic import periodic_runs, run_digests, with_periodic_tails, word_runs
from tools.check_oracle import compare, tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:-q])


def plain_runs(words, least=24, times=3):
    """Every stretch of equal words at every lag, kept if it cannot be longer and has no smaller period."""
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            length = i - start
            if length >= max(least, times * q) and smallest_period(words[start:i]) == q:
                found.append((start, length, q))
    return sorted(found)


def plain_digests(doc, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    lines = "".join(f"{start},{length},{q}\n" for start, length, q in runs)
    collapsed = " ".join(word for i, word in enumerate(words) if i not in gone)
    best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    digest = [hashlib.sha256(part.encode()).hexdigest() for part in (lines, collapsed)]
    return (doc, len(runs), *best, milli, *digest)


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def digests(frame):
    return rows(run_digests(periodic_runs(with_periodic_tails(frame))), *COLUMNS)


def runs_of(texts, least, times):
    lengths = [len(text) for text in texts]
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = np.concatenate([np.arange(n) for n in lengths]) if lengths else np.empty(0, np.int64)
    words = np.array([word for text in texts for word in text], np.int64)
    return [tuple(run) for run in word_runs(owner * 10 + words, place, least, times).tolist()]


@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 26), st.integers(3, 5))
@settings(max_examples=300, deadline=None)
def test_runs_equal_a_search_of_all_lags(text, least, times):
    assert runs_of([text], least, times) == plain_runs(text, least, times)


@given(
    st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=6),
    st.integers(1, 30),
)
@settings(max_examples=300, deadline=None)
def test_runs_of_repeated_blocks(blocks, least):
    text = [word for block, n in blocks for word in block * n]
    assert runs_of([text], least, 3) == plain_runs(text, least)


def test_texts_laid_end_to_end_share_no_run():
    texts = [[1] * 20, [1] * 30, [], [1, 2] * 13, [1, 2] * 5]
    expected, at = [], 0
    for text in texts:
        expected += [(start + at, length, q) for start, length, q in plain_runs(text)]
        at += len(text)
    assert runs_of(texts, 24, 3) == expected


@pytest.mark.parametrize("together", [1 << 22, 50])
def test_query_equals_the_definition(spark, monkeypatch, together):
    monkeypatch.setattr(operator, "_TOGETHER", together)
    draw = np.random.default_rng(13)
    texts = [(n, " ".join(draw.choice(list("abcdefgh"), 60))) for n in range(400)]
    texts += [(600 + n, "xé y z \n " * n + "tail of it\x0b\x1c") for n in range(14)]
    texts += [(300, "a " * 4000), (301, "line of words here\n" * 40 + "other words " * 30), (301, "b " * 25)]
    texts += [(None, "c d " * 30), (None, None), (302, None), (303, ""), (304, " \t\n"), (301, "b " * 25)]
    expected = sorted([plain_digests(*text) for text in texts], key=repr)
    assert digests(documents(spark, texts)) == expected
    assert sum(row[1] > 0 for row in expected) > 20


def test_odd_documents(spark):
    short = [text for text in TEXTS if text[0] != 7]
    got = digests(documents(spark))
    assert len(got) == len(TEXTS)
    assert {row for row in got if row[0] != 7} == {plain_digests(*text) for text in short}
    assert digests(documents(spark, [])) == []


def test_a_very_long_text_of_one_word(spark):
    found = periodic_runs(documents(spark, [(9, "w " * 400_000)])).first()
    assert (found.n_words, [tuple(run) for run in found.runs], found.collapsed) == (400_000, [(0, 400_000, 1)], "w")


def test_parameters(spark):
    with pytest.raises(ValueError):
        periodic_runs(documents(spark), times=2)


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, tables(sf), "op13_periodic_runs", sf) == []
