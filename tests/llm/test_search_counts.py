"""Texts are read once for all counts, and the trie is opened where an item needs it."""

import random

import numpy as np
import pytest

from keelmark.llm import search

DOCS = [(i, t) for i, t in enumerate(["Alpha beta BETA", "alpha;beta\x7fgamma", None, "", "été\xa0café alpha", "x-y z", "alpha beta beta"] * 3)] + [(None, "beta")]
ITEMS = [(1, "alpha BETA alpha"), (2, "été café"), (3, None), (4, "nothing")]


@pytest.mark.parametrize("limit", [search.BROADCAST_TERMS, 0])
def test_a_sent_and_a_joined_vocabulary_give_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(search, "BROADCAST_TERMS", limit)
    docs, items = spark.createDataFrame(DOCS, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = sorted((tuple(r) for r in search.top_documents(docs, items).collect()), key=repr)
    assert got == sorted(search.brute_force(DOCS, ITEMS), key=repr)


def test_counts_of_a_document_are_one_row(spark):
    rows = search.counted(spark.createDataFrame([(1, "b A a-b É a"), (None, None)], "doc_id bigint, text string"), {b"a", b"z"}).collect()
    assert sorted(((r["doc_id"], r["n"], r["terms"], r["tfs"]) for r in rows), key=repr) == [(1, 6, ["a"], [3]), (None, 0, [], [])]


def test_trie_opened_on_demand_scores_as_plain_sums():
    pick = random.Random(7)
    tree, docs = search._Tree(), []
    for doc_id in range(400):
        path = [(t, pick.randint(1, 3)) for t in range(12) if pick.random() < 0.4] or [(0, 1)]
        docs += [(path, doc_id, pick.randint(25, 300))] * (1 + 20 * (doc_id == 5))  # one large group of copies
    for path, doc_id, m in docs:
        tree.add(path, doc_id, m)
    tree.summarise()
    weights = {1: 900, 4: 5000, 11: 40, 99: 7}
    scored = [(sum(weights.get(t, 0) * search.gain(f, m) for t, f in path), -doc_id) for path, doc_id, m in docs]
    expected = [(s, -d) for s, d in sorted(scored, reverse=True)[:10]]
    assert not tree.opened
    for leaf in (1000, 50, 3, 0):
        assert search.search_tree(tree, weights, 10, leaf) == expected
    assert tree.opened and np.all(np.diff(tree.starts) > 0)
