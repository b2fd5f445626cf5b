"""Ranked search, k-means and byte-level BPE against brute force, their SQL and tiktoken."""

import base64
import hashlib
from collections import Counter

import pytest

from keelmark.llm import bpe, kmeans, queries, search
from parity.compare import connect, differences

AWKWARD_DOCS = [
    (1, "Alpha beta BETA gamma"), (1, "Alpha beta BETA gamma"), (2, None), (3, ""), (None, "alpha delta"),
    (4, "été café 42 alpha_beta x-y"), (5, "alpha " * 30_000), (6, "gamma delta epsilon"), (7, "\t\n "),
]
AWKWARD_ITEMS = [(10, "alpha beta"), (10, "alpha beta"), (11, None), (None, "gamma"), (12, "zzz"), (13, "alpha alpha café")]


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i, t, "x", 1, 2) for i, t in AWKWARD_DOCS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, item_id string, rid int, term string")


@pytest.fixture(scope="module")
def odd_items(spark):
    return spark.createDataFrame([(i, t, 0) for i, t in AWKWARD_ITEMS], "item_id bigint, text string, doc_id int")


def test_search_matches_brute_force_on_awkward_rows(odd_docs, odd_items):
    got = sorted((tuple(r) for r in search.top_documents(odd_docs, odd_items).collect()), key=repr)
    assert got == sorted(search.brute_force(AWKWARD_DOCS, AWKWARD_ITEMS), key=repr)
    ranks = Counter((r[0], r[1]) for r in got)
    assert all(v == 1 for v in ranks.values())  # one row per rank and item


def test_search_matches_brute_force_on_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = sorted(tuple(r) for r in search.top_documents(docs, items).collect())
    expected = search.brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()],
                                  [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got == sorted(expected) and got


def test_tree_search_prunes_nothing_it_needs():
    tree = search._Tree()
    # ties on score: the smaller id wins; null ids come last
    for doc_id in (5, 3, None, 4):
        tree.add([(0, 1)], doc_id, 30)
    tree.add([(0, 2), (1, 1)], 9, 40)
    tree.summarise()
    top = search.search_tree(tree, {0: 100, 1: 50}, 3)
    assert [d for _, d in top] == [9, 3, 4]
    # the same with leaf buckets of one document: bounds, not buckets, decide
    assert search.search_tree(tree, {0: 100, 1: 50}, 3, leaf=0) == top


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert search.top_documents(docs, items).count() == 0


def test_search_agrees_with_sql(spark, folder):
    count, found = differences(queries.op11_lexical_search(spark, folder), connect(folder), queries.SQL["op11_lexical_search"])
    assert not found and count > 0, found[:3]


ODD_VECTORS = [
    (1, [0.1] * 64), (1, [0.1] * 64), (2, [0.2] * 63), (3, None), (4, [float("nan")] + [0.0] * 63),
    (5, [float("inf")] + [0.0] * 63), (None, [-0.3] * 64), (6, [None] + [0.5] * 63), (7, [-0.2, 0.4] * 32), (8, [0.49] * 64),
]


def test_kmeans_awkward_vectors(spark):
    df = spark.createDataFrame([(i, e, "x") for i, e in ODD_VECTORS], "vec_id bigint, embedding array<double>, cluster string")
    got = sorted((tuple(r) for r in kmeans.clusters(df, k=3).collect()), key=repr)
    assert got == sorted(kmeans.brute_force(ODD_VECTORS, k=3), key=repr)
    assert len(got) == 5  # lengths other than 64, nulls and non-finite values are dropped


def test_kmeans_matches_brute_force(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = sorted(tuple(r) for r in kmeans.clusters(df).collect())
    assert got == sorted(kmeans.brute_force([tuple(r) for r in df.select("vec_id", "embedding").collect()]))


def test_kmeans_empty(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert kmeans.clusters(df).count() == 0


def test_kmeans_agrees_with_sql(spark, folder):
    count, found = differences(queries.op12_kmeans(spark, folder), connect(folder), queries.SQL["op12_kmeans"])
    assert not found and count > 0, found[:3]


ODD_TEXTS = [
    (1, "Hello world!! 's 've  \n\n  x"), (1, "Hello world!! 's 've  \n\n  x"), (2, None), (3, ""), (None, "été \U0001f600 naïve"),
    (4, "  　 spaces line\x85next "), (5, "ab" * 20_000), (6, "数字١٢٣ 123456789 ｆｕｌｌ"),
]


def _tiktoken():
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _expected(rows, enc):
    out = []
    for doc_id, text in rows:
        ids = enc.encode_ordinary(text or "")
        decoded = enc.decode_bytes(ids)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(decoded).hexdigest(), True))
    return sorted(out, key=repr)


def test_bpe_matches_tiktoken_on_awkward_texts(spark):
    path, enc = _tiktoken()
    df = spark.createDataFrame([(i, t, 1) for i, t in ODD_TEXTS], "doc_id bigint, text string, n_tokens int")
    got = sorted((tuple(r) for r in bpe.encoded(df, path).collect()), key=repr)
    assert got == _expected(ODD_TEXTS, enc)


def test_bpe_matches_tiktoken_on_tables(spark, folder):
    path, enc = _tiktoken()
    df = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted((tuple(r) for r in bpe.encoded(df, path).collect()), key=repr)
    assert got == _expected([tuple(r) for r in df.select("doc_id", "text").collect()], enc)


def test_bpe_model_ids_are_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}
    codec = bpe.Codec(bpe.model_proto(ranks), r"\S+|\s+")
    assert codec.encode("abc ab") == [257, 32, 256]
    assert codec.decode(codec.encode("abc ab")) == b"abc ab"
    with pytest.raises(ValueError):
        bpe.model_proto({b"a": 1})
