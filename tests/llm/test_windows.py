"""Decontamination and license scans against brute force over all windows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
import regex
import xxhash

from tests.llm.cases import documents, rows
from tidemark.llm.decontaminate import leaks, without_leaks
from tidemark.llm.licenses import TEMPLATES, license_matches, templates


def words(text):
    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def hashes(tokens, k):
    result = []
    for at in range(len(tokens) - k + 1):
        h = 42
        for token in tokens[at : at + k]:
            h = xxhash.xxh64_intdigest(token.encode(), h)
        result.append(h)
    return result


def mark(shingles):
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in shingles) > len(shingles))


def plain_leaks(pairs, items):
    found = set()
    for doc, text in pairs:
        tokens = words(text)
        for item, content in items:
            own = words(content)
            k = min(5, len(own))
            if not own:
                continue
            theirs, shingles = hashes(own, k), hashes(tokens, k)
            span, best = len(theirs), None
            if not set(theirs) & set(shingles):
                continue
            for start in range(max(0, len(tokens) - len(own)) + 1):
                window = shingles[start : start + span]
                common = sum((Counter(window) & Counter(theirs)).values())
                likeness = common / (len(window) + span - common)
                if likeness < 0.8:
                    continue
                distance = (mark(window) ^ mark(theirs)).bit_count()
                if distance <= 20:
                    best = max(best or (0, 0, 0), (likeness, -distance, -start))
            if best:
                found.add((doc, item, -best[2], -best[1], round(best[0], 9)))
    return sorted(found, key=repr)


def planted():
    draw = random.Random(9)
    vocabulary = [f"w{n}" for n in range(60)]
    items = [(n, " ".join(draw.choices(vocabulary, k=size))) for n, size in enumerate((30, 30, 44, 6, 5, 3, 1))]
    items += [(90, None), (91, ""), (None, " ".join(draw.choices(vocabulary, k=20)))]
    texts = []
    for doc in range(60):
        parts = draw.choices(vocabulary, k=draw.randrange(40))
        for _, item in draw.sample(items, 2):
            copied = (item or "").upper().split()
            if copied and draw.random() < 0.4:
                copied[draw.randrange(len(copied))] = "other"
            parts += [*copied[draw.randrange(3) :], *draw.choices(vocabulary, k=draw.randrange(9))]
        texts.append((doc, ", ".join(parts)))
    return items, texts


def test_leaks_equal_brute_force(spark):
    items, texts = planted()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, words string")
    got = leaks(documents(spark, texts), benchmark).toPandas()
    got = {
        (r.doc_id, None if r.item_id != r.item_id else int(r.item_id), r.start_word, r.distance, round(r.similarity, 9))
        for r in got.itertuples()
    }
    assert sorted(got, key=repr) == plain_leaks(texts, items)
    assert len(got) > 40


def test_items_that_repeat_share_an_id_or_have_none(spark):
    texts = {name: " ".join(f"{name}{n}" for n in range(size)) for name, size in zip("abcdef", (12, 12, 20, 12, 20, 12))}
    # a twice; b and c (another length) without an id; d, e and f under one id.
    items = [(1, "a"), (1, "a"), (None, "b"), (None, "c"), (2, "d"), (2, "e"), (2, "f")]
    benchmark = spark.createDataFrame([(i, texts[t]) for i, t in items], "item_id bigint, text string")
    frame = documents(spark, [(n, f"before it {text} after it") for n, text in enumerate(texts.values())] + [(9, "none of them")])
    got = leaks(frame, benchmark)
    expected = [(n, item, 2, len(texts[t].split()), 1.0) for n, (t, item) in enumerate(zip("abcdef", (1, None, None, 2, 2, 2)))]
    assert rows(got, "doc_id", "item_id", "start_word", "window_words", "similarity") == sorted(expected, key=repr)
    assert [row[0] for row in rows(without_leaks(frame, benchmark), "doc_id")] == [9]


def test_documents_with_leaks_go(spark):
    frame = documents(spark)
    item = "quick brown fox jumps over the lazy dog and runs"
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    kept = without_leaks(frame, benchmark)
    assert kept.columns == frame.columns
    assert [row[0] for row in rows(kept, "doc_id")] == [3, 4, 5, 6, 7, 8, None]


@pytest.mark.parametrize("items", [[], [(1, None), (2, " .. ")]])
def test_empty_tables(spark, items):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert leaks(documents(spark), benchmark).count() == 0
    assert without_leaks(documents(spark), benchmark).count() == documents(spark).count()
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert leaks(documents(spark, []), some).count() == 0
    assert license_matches(documents(spark), benchmark.withColumnRenamed("item_id", "license_id")).count() == 0
    assert license_matches(documents(spark, []), templates(spark)).count() == 0


def test_licenses_equal_brute_force(spark):
    draw = random.Random(5)
    texts = []
    for doc in range(50):
        name, notice = draw.choice(TEMPLATES)
        copied = notice.split()
        if draw.random() < 0.5:
            copied[draw.randrange(len(copied))] = "changed"
        texts.append((doc, " ".join(["some", "code"] * draw.randrange(5) + copied + ["more", "code"])))
    expected = set()
    for doc, text in texts:
        tokens = words(text)
        for name, notice in TEMPLATES:
            own = words(notice)
            k = min(5, len(own))
            theirs, shingles = set(hashes(own, k)), hashes(tokens, k)
            span = len(own) - k + 1
            starts = range(max(0, len(tokens) - len(own)) + 1)
            held, start = max((len(theirs & set(shingles[s : s + span])) / len(theirs), -s) for s in starts)
            if held >= 0.8:
                expected.add((doc, name, -start, held))
    got = license_matches(documents(spark, texts), templates(spark))
    assert rows(got, "doc_id", "license_id", "start_word", "containment") == sorted(expected, key=repr)
