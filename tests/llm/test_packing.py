from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import documents
from tidemark.llm.packing import TextTokens, pack, plan
from tidemark.llm.settings import TOKENIZER


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
@settings(max_examples=200, deadline=None)
def test_plan_uses_every_piece_once_and_fits(counts):
    patterns = plan(counts, 64)
    used = Counter()
    for lengths, times in patterns:
        assert sum(lengths) <= 64 and times > 0
        for length in lengths:
            used[length] += times
    assert used == Counter(counts)


def test_exact_complements_come_first():
    # One, two and three lengths that fill a gap exactly.
    assert sorted(plan({40: 2, 24: 1, 14: 1, 10: 1}, 64)) == [((40, 14, 10), 1), ((40, 24), 1)]
    assert plan({40: 1, 12: 1, 8: 1, 4: 1, 23: 1}, 64) == [((40, 12, 8, 4), 1), ((23,), 1)]
    assert plan({32: 5}, 64) == [((32, 32), 2), ((32,), 1)]


@given(st.text(alphabet=st.sampled_from("ab é1.\n\t 　'<>|我") | st.characters(codec="utf-8"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_tokens_equal_the_tokenizer_files(text):
    for whole in (text, text + "<|endoftext|> x", f"it's {text} don't"):
        expected = TOKENS.whole.encode(whole, add_special_tokens=False).ids
        assert np.frombuffer(TOKENS(whole), "<u4").tolist() == expected


TOKENS = TextTokens(**TOKENIZER)


def test_pieces_have_their_ids_and_sequences_have_no_gaps(spark):
    frame = documents(spark)
    packed = pack(frame, **TOKENIZER, capacity=128).toPandas()
    tokenizer = Tokenizer.from_file(TOKENIZER["vocabulary"])
    expected = []
    for row in frame.collect():
        ids = np.array(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 128 or 128
        cuts = [0, *range(first, len(ids) + 1, 128)]
        expected += [
            (row.doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    got = packed[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(object)
    got = got.where(got.notna(), None).itertuples(index=False, name=None)
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for _, sequence in packed.sort_values("offset").groupby("sequence_id"):
        assert (sequence["offset"] == sequence["length"].cumsum() - sequence["length"]).all()
        assert sequence["length"].sum() <= 128
    assert packed["sequence_id"].nunique() <= -(-packed["length"].sum() // 128) + 1


def test_no_documents_no_sequences(spark):
    assert pack(documents(spark, []), **TOKENIZER).count() == 0
