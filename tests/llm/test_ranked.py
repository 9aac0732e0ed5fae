from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import TEXTS, documents
from tidemark.llm import ranked as operator
from tidemark.llm.ranked import ranked_documents, terms
from tools.check_oracle import compare, tables

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [] if text is None else TERM.findall(text.translate(LOWER))


def plain(texts, items, k=10):
    counted = [(doc, Counter(words(text))) for doc, text in texts]
    counted = [(doc, own, own.total()) for doc, own in counted if own]
    total = sum(n for _, _, n in counted)
    df = Counter(term for _, own, _ in counted for term in own)
    result = []
    for item, text in set(items):
        scored = []
        for doc, own, n in counted:
            m = 100 - 75 + (75 * n * len(counted)) // total
            score = 0
            for term in words(text):
                weight = math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[term] + 1)))
                score += weight * ((1000000000 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda row: (row[0], row[1], row[2] or 0))
        result += [(item, rank + 1, doc, -score) for rank, (score, _, doc) in enumerate(scored[:k])]
    return sorted(result, key=repr)


def items_of(spark, items):
    schema = "item_id bigint, text string, doc_id bigint, score int, rank string"
    return spark.createDataFrame([(i, text, 1, 2, "x") for i, text in items], schema)


def found(spark, texts, items, k=10):
    result = ranked_documents(documents(spark, texts), items_of(spark, items), k)
    return sorted([tuple(row) for row in result.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def corpus(n=400, seed=11):
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    share = 1 / np.arange(1, 121)
    share /= share.sum()
    texts = [(i, " ".join(draw.choice(vocabulary, draw.integers(1, 40), p=share))) for i in range(n)]
    items = [(i, " ".join(draw.choice(vocabulary, draw.integers(1, 90), p=share))) for i in range(25)]
    return texts, items


def test_terms():
    texts = ["Aé9-b_c d\x1cE\x85ß", "ÀÉ xİ", "", "a\x00B", *[text for _, text in TEXTS if text]]
    assert [[term.decode() for term in terms(text.encode())] for text in texts] == [words(text) for text in texts]


@pytest.mark.parametrize("item_bytes", [1 << 22, 500])
def test_equals_scoring_every_document(spark, monkeypatch, item_bytes):
    """Also with the items in many blocks."""
    monkeypatch.setattr(operator, "ITEM_BYTES", item_bytes)
    texts, items = corpus()
    texts += [(n % 7, "w1 w2 w2 w50") for n in range(60)]
    items += [(30, "w50 " * 70), (31, "w1 w1 W2"), (31, "w1 w1 W2"), (31, "w3")]
    assert found(spark, texts, items) == plain(texts, items)


def test_items_of_more_terms_than_a_word_has_bits(spark):
    draw = np.random.default_rng(1)
    texts = [(n, " ".join(f"t{i}" for i in draw.integers(0, 300, 40))) for n in range(300)]
    items = [(n, " ".join(f"t{i}" for i in draw.permutation(300)[: 130 + n])) for n in range(4)]
    assert found(spark, texts, items, 7) == plain(texts, items, 7)


def test_odd_documents_and_items(spark):
    items = [(1, "quick fox text écrit WORD1X"), (2, None), (3, ""), (4, " -- "), (None, "dog a"), (None, "id of"), (5, "unseen")]
    items += [(6, "word5x " * 50_000)]
    texts = [*TEXTS, (None, "dog a"), (None, "dog a")]
    assert found(spark, texts, items) == plain(texts, items)
    assert found(spark, [], items) == found(spark, texts, []) == []
    assert found(spark, [(1, None), (2, "")], items) == []


def test_ids_beyond_doubles_beside_null(spark):
    texts = [((1 << 60) + n, "rare word") for n in range(3)] + [(None, "rare word"), (7, "others"), (8, "more of them")]
    assert found(spark, texts, [(1, "rare")]) == plain(texts, [(1, "rare")])


def test_few_masks_are_evaluated(spark):
    """What no remaining mask can reach is not scored."""
    import pyarrow as pa

    texts, items = corpus(3000, 5)
    known = {f"w{i}".encode(): i for i in range(120)}
    own = [Counter(known[term] for term in terms(text.encode())) for _, text in texts]
    batch = pa.RecordBatch.from_pydict(
        {
            "doc_id": [doc for doc, _ in texts],
            "n": [counts.total() for counts in own],
            "terms": [np.array(list(counts), np.int32).tobytes() for counts in own],
            "times": [np.array(list(counts.values()), np.int32).tobytes() for counts in own],
        }
    )
    block = operator._Block.of(batch, 120, (len(texts), sum(counts.total() for counts in own)))
    df = Counter(term for counts in own for term in counts)
    scored = 0

    class Counted(operator._Block):
        def scores(self, item, chosen):
            nonlocal scored
            scored += len(chosen)
            return super().scores(item, chosen)

    block = Counted(*[getattr(block, name) for name in block.__dataclass_fields__])
    item = operator._Weighed(
        np.array([3, 40, 80, 110]), np.array([math.floor(1000 * math.log(6002 / (2 * df[t] + 1))) for t in (3, 40, 80, 110)])
    )
    best = block.search(item, np.empty((0, 2), np.int64), 10)
    every = block.scores(item, np.arange(len(texts)))
    assert best[:, 0].tolist() == sorted(every, reverse=True)[:10]
    assert scored - len(texts) < len(texts) / 10


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, tables(sf), "op11_ranked_search", sf) == []
