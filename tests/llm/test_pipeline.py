"""The pipeline and the registered queries over the smallest tables."""

from __future__ import annotations

import re

import __spark_entry__ as contract
import corpus_pipeline
import pytest

from tests.llm.cases import documents
from tests.llm.test_near_copies import plain_groups
from tests.llm.test_windows import plain_leaks
from tidemark.llm.tables import settled, table

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    kept = {}
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settled(stage(spark, docs, SF), name)
        kept[name] = (before, docs)
    ids = {name: [sorted(row.doc_id for row in frame.select("doc_id").collect()) for frame in pair] for name, pair in kept.items()}

    before, after = ids["language"]
    assert before == after  # every document of the tables has letters

    pairs = [(row.doc_id, row.text) for row in kept["near_copies"][0].collect()]
    assert ids["near_copies"][1] == sorted({least for _, _, least in plain_groups(pairs)})

    pairs = [(row.doc_id, row.text) for row in kept["decontamination"][0].collect()]
    items = [(row.item_id, row.text) for row in table(spark, SF, "benchmark").collect()]
    leaked = {doc for doc, *_ in plain_leaks(pairs, items)}
    assert leaked and ids["decontamination"][1] == sorted(set(ids["decontamination"][0]) - leaked)

    old, new = ({row.doc_id: row for row in frame.collect()} for frame in kept["personal_data"])
    private = re.compile(r"[\w.]+@[\w.]+\w|\+\d \(\d+\) [\d-]+|\d+(?:\.\d+){3}|\d{13,}|[0-9a-fA-F]{40}")
    for doc, row in old.items():
        met = private.findall(row.text)
        assert not [one for one in met if one in new[doc].text]
        assert met or row == new[doc]
        assert new[doc].n_chars == (len(new[doc].text) if met else row.n_chars)

    packed = kept["packing"][1].toPandas()
    assert set(packed["doc_id"]) == set(ids["packing"][0])
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_all_but_the_last_stage_keep_the_columns_and_stand_odd_rows(spark):
    docs = documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns
        docs = settled(stage(spark, docs, SF), name)
    assert {row.doc_id for row in docs.collect()} == {1, 3, 7, None}


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns[:2] == ["doc_id", "piece"]


QUERIES = sorted(name for name in contract.queries() if name.startswith("op"))


def test_there_is_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", QUERIES)
def test_registered_queries_run(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0
