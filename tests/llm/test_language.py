from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents
from tidemark.llm import language
from tidemark.llm.language import UNDETERMINED, predicted_languages, train, with_language

SF = "/root/testdata/sf0.01"


def plain_bits(text, training, least):
    """Escape method C, byte by byte, with counts of all orders up to three."""
    counts = {}
    seen = Counter()
    for lang, texts in training.items():
        for one in texts:
            line = b"\xff\xff\xff" + one
            for at in range(3, len(line)):
                for order in range(4):
                    context = line[at - order : at]
                    counts.setdefault((lang, context), Counter())[line[at]] += 1
                    seen[context] += 1
    known = {byte for (_, context), met in counts.items() if not context for byte in met}
    result = {}
    for lang in training:
        total = 0.0
        line = b"\xff\xff\xff" + text
        for at in range(3, len(line)):
            for order in (3, 2, 1, 0):
                context = line[at - order : at]
                if order and seen[context] < least:
                    continue
                met = counts.get((lang, context))
                if not met:
                    continue
                size, distinct = sum(met.values()), len(met)
                if line[at] in met:
                    total -= math.log2(met[line[at]] / (size + distinct))
                    break
                total -= math.log2(distinct / (size + distinct))
            else:
                total += 8
        result[lang] = total
    assert known
    return result


def labelled(spark):
    training = {"aa": [b"abab abba baab " * 9, b"aab"], "bb": ["bcé bcb cbé".encode() * 8], "cc": [b"xyz zyx abc" * 7]}
    rows = [(n, text.decode(), lang) for n, (lang, text) in enumerate((l, t) for l, ts in training.items() for t in ts)]
    return training, spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.mark.parametrize("stretch", [1 << 19, 5])
def test_code_lengths_equal_the_definition(spark, monkeypatch, stretch):
    training, rows = labelled(spark)
    model = train(rows, least=4)
    monkeypatch.setattr(language, "_STRETCH", stretch)
    for text in (b"", b"abba", "é b\x01 w ab".encode(), b"zzzzyx ab" * 5):
        expected = plain_bits(text, training, 4)
        got = dict(zip(model.languages, model.bits([b"ab", text])[1]))
        assert got == pytest.approx(expected, rel=1e-4)


def test_held_out_documents_of_the_tables(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    found = predicted_languages(frame).join(frame.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    assert found["score"].between(0, 1).all()


def test_texts_without_a_letter_are_undetermined(spark):
    frame = documents(spark)
    found = {(row.doc_id, row.lang_pred) for row in predicted_languages(frame).collect()}
    assert found == {
        (1, "en"), (2, "en"), (3, "en"), (None, "en"), (7, "en"),
        (4, UNDETERMINED), (5, UNDETERMINED), (6, UNDETERMINED), (8, UNDETERMINED),
    }
    kept = with_language(frame)
    assert kept.columns == frame.columns
    assert sorted((row.doc_id or 0) for row in kept.collect()) == [0, 1, 2, 2, 3, 7]


def test_nothing_to_learn_and_no_documents(spark):
    unlabelled = documents(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {row.lang_pred for row in predicted_languages(unlabelled).collect()} == {UNDETERMINED}
    assert predicted_languages(documents(spark, [])).count() == 0


@pytest.mark.parametrize("lang, bounds", [(None, {}), ("en", {"folds": 1, "held_fold": 0}), (UNDETERMINED, {})])
def test_texts_with_letters_stay_whatever_there_is_to_learn(spark, lang, bounds):
    frame = documents(spark).withColumn("lang", F.lit(lang).cast("string"))
    kept = with_language(frame, **bounds)
    assert kept.columns == frame.columns
    assert sorted((row.doc_id or 0) for row in kept.collect()) == [0, 1, 2, 2, 3, 7]


def test_documents_in_other_languages_go(spark):
    training, frame = labelled(spark)
    extra = spark.createDataFrame([(90, "xyz zyx", "aa"), (91, "abab abba", None), (92, "123 ...", "aa")], frame.schema)
    # The text decides, not the label; what has no letter is in no language.
    kept = with_language(frame.union(extra), ["aa", "bb"], folds=1, held_fold=1, least=4)
    texts = {one.decode() for name in ("aa", "bb") for one in training[name]} | {"abab abba"}
    assert {row.text for row in kept.collect()} == texts
    every = with_language(frame.union(extra), folds=1, held_fold=1, least=4)
    assert every.count() == frame.count() + 2
    assert with_language(frame.union(extra), [], folds=1, held_fold=1, least=4).count() == 0
