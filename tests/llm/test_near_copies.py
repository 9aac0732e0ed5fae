from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tests.llm.cases import documents, rows
from tidemark.llm import near_copies
from tidemark.llm.near_copies import near_copy_groups, one_of_each_group, simhash, spanning_links


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[n : n + 4]) for n in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(gram, 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(pairs, radius=4):
    marks = [plain_simhash(text) for _, text in pairs]
    root = list(range(len(pairs)))

    def find(n):
        return n if root[n] == n else find(root[n])

    for a in range(len(pairs)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for n, (doc, _) in enumerate(pairs):
        ids = least.setdefault(find(n), [])
        if doc is not None:
            ids.append(doc)
    return [(doc, f"{marks[n]:016x}", min(least[find(n)], default=None)) for n, (doc, _) in enumerate(pairs)]


def near_texts():
    draw = random.Random(4)
    texts = []
    for group in range(12):
        words = [f"w{draw.randrange(300)}" for _ in range(250)]
        for _ in range(9):
            changed = list(words)
            changed[draw.randrange(250)] = "changed"
            texts.append((draw.randrange(10_000), " ".join(changed)))
    return texts


def test_fingerprint_is_that_of_the_contract():
    for text in ("", "a b", "A b C d", "A b C d e f f f f f g", "é è ü ß x y z \x0b q"):
        assert simhash(text.encode(), 4, 42) == plain_simhash(text)


def test_groups_equal_brute_force_with_nulls_repeats_and_clashing_columns(spark):
    frame = documents(spark)
    pairs = [(row.doc_id, row.text) for row in frame.collect()]
    got = near_copy_groups(frame)
    assert rows(got, "doc_id", "fingerprint", "component_id") == sorted(plain_groups(pairs), key=repr)


@pytest.mark.parametrize("node_rows", [4096, 5])
def test_near_copies_are_found_in_whole_and_in_split_nodes(spark, monkeypatch, node_rows):
    monkeypatch.setattr(near_copies, "NODE_ROWS", node_rows)
    texts = near_texts()
    got = near_copy_groups(documents(spark, texts))
    assert rows(got, "doc_id", "fingerprint", "component_id") == sorted(plain_groups(texts), key=repr)


def test_one_document_of_each_group_stays_with_its_columns(spark):
    frame = documents(spark)
    kept = one_of_each_group(frame)
    assert kept.columns == frame.columns
    # NULL, empty and blank texts share a fingerprint; repeated rows are one document.
    assert [row[0] for row in rows(kept, "doc_id")] == [1, 3, 4, 7, 8, None]


def test_groups_without_ids_or_with_the_same_smallest_id_stay_apart(spark):
    unlike = [" ".join(f"{name}{n}" for n in range(30)) for name in ("apple", "birch", "cedar", "daisy")]
    texts = [(None, unlike[0]), (None, unlike[1]), (None, unlike[1]), (5, unlike[2]), (5, unlike[3]), (6, unlike[3])]
    kept = one_of_each_group(documents(spark, texts))
    assert rows(kept, "doc_id", "text") == sorted(
        [(None, unlike[0]), (None, unlike[1]), (5, unlike[2]), (5, unlike[3])], key=repr
    )


def test_no_documents_no_groups(spark):
    assert near_copy_groups(documents(spark, [])).count() == 0
    assert one_of_each_group(documents(spark, [])).count() == 0


def test_spanning_links_join_what_lies_within_the_radius():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 63, 40, np.uint64)
    marks = np.unique(np.concatenate([base ^ (np.uint64(1) << draw.integers(0, 64, 40, np.uint64)) for _ in range(30)]))
    node = (marks >> np.uint64(3) & np.uint64(1)).astype(np.int64)
    node, marks = node[np.argsort(node, kind="stable")], marks[np.argsort(node, kind="stable")]
    a, b = spanning_links(node, marks, 4)
    assert len(a) < len(marks)

    def labels(edges):
        label = {int(m): int(m) for m in marks}

        def find(n):
            return n if label[n] == n else find(label[n])

        for x, y in edges:
            label[find(int(x))] = find(int(y))
        groups = {}
        for m in label:
            groups.setdefault(find(m), set()).add(m)
        return sorted(map(sorted, groups.values()))

    plain = [(x, y) for n, x in zip(node, marks) for o, y in zip(node, marks) if n == o and (int(x) ^ int(y)).bit_count() <= 4]
    assert labels(zip(a, b)) == labels(plain)
