from __future__ import annotations

import random

import numpy as np

from tests.llm.cases import documents
from tidemark.llm.toxicity import BlockMaxIndex, _isotonic, toxicity, train


def test_nearest_equals_all_cosines():
    draw = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        term = np.sort(draw.choice(40, draw.integers(0, 6), replace=False))
        weight = draw.integers(1, 4, len(term)).astype(float)
        vectors.append((term, weight / np.sqrt((weight**2).sum()) if len(term) else weight))
    index, order = BlockMaxIndex.build(list(range(500)), [0] * 500, vectors, 40)
    dense = np.zeros((500, 40))
    for at, n in enumerate(order):
        dense[at, vectors[n][0]] = vectors[n][1]
    for at in range(0, 500, 7):
        term, weight = vectors[order[at]]
        cosine = dense[:, term] @ weight
        cosine[at] = 0
        best = np.lexsort((np.arange(500), -np.round(cosine, 9)))[:15]
        found, score = index.nearest(term, weight, 15, but=at)
        assert np.allclose(score, cosine[best][cosine[best] > 0])


def test_isotonic_curve_rises():
    votes = np.sort(np.random.default_rng(1).random(300))
    x, y = _isotonic(votes, (np.random.default_rng(2).random(300) < votes).astype(int))
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= -1e-12).all() and 0 <= y[0] and y[-1] <= 1


def corpus(spark):
    draw = random.Random(8)
    rows = []
    for doc in range(1500):
        tokens = ["".join(draw.choices(["ba", "ko", "li", "mu", "ne"], k=3)) for _ in range(80)]
        toxic = draw.random() < 0.2
        for _ in range(4 * toxic):
            tokens[draw.randrange(80)] = draw.choice(["grobfit", "zarduk"]) + draw.choice(["", "ba", "ko"])
        rows.append((doc, " ".join(tokens), int(toxic)))
    return rows


def test_held_out_toxic_documents_are_found(spark):
    rows = corpus(spark)
    labels = spark.createDataFrame([(doc, y, 1, "x") for doc, _, y in rows], "doc_id bigint, toxic int, quality int, text string")
    got = toxicity(documents(spark, [(doc, text) for doc, text, _ in rows]), labels, examples=1000).toPandas()
    truth = {doc: y for doc, _, y in rows}
    held = got[got["held_out"]]
    assert (held["predicted"] == held["doc_id"].map(truth)).mean() > 0.98
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == got["predicted"]).all()
    evidence = held[held["predicted"] == 1]["evidence"].iloc[0]
    assert len(evidence) == 3 and evidence[0]["cosine"] >= evidence[1]["cosine"] > 0


def test_nulls_empty_texts_and_clashing_columns(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (5, None), (7, 0)], "doc_id bigint, toxic int")
    got = toxicity(documents(spark), labels).toPandas()
    assert len(got) == 10 and got["score"].between(0, 1).all()


def test_nothing_to_learn_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {row.score for row in toxicity(documents(spark), none).collect()} == {0.0}
    assert toxicity(documents(spark, []), none).count() == 0
    texts = documents(spark).select("doc_id", "text").where("text is not null")
    assert train(texts, none) is None
