"""Ranked lexical search: every benchmark item against all documents, top k per item.

Scoring (integer BM25 form). Terms are maximal runs of ASCII letters and digits and of any
non-ASCII character, A-Z lowered. N counts documents with a term, L all their terms, n one
document's terms, df the documents holding a term, tf its count in a document. A term weighs
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document has ``m = 25 + (75 n N) div L``;
an item scores a document by ``sum w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's
terms with repeats. Each item keeps its k best documents with a score above 0, equal scores
by ascending doc_id (null ids last).

Method (document FP-tree). Each text is read once: its terms are counted in an Arrow batch,
restricted to the vocabulary of the items, and kept as one row per document; statistics are
Spark aggregates over those rows. Items are
cut into blocks and documents into hash shards; each (shard, block) task receives the shard's
term vectors restricted to the block's vocabulary and builds a trie in which documents are
paths of (term, tf) nodes, terms ordered by descending df so that frequent terms share the
upper paths. Documents lie in the order of their paths, so a node is a range of them; its
children are made when an item first needs them. Every node keeps the maximal tf and the
minimal m below it and the set of terms below it. For each item a depth-first branch and bound walks the trie: a subtree whose bound
(path terms at the smallest m on the way, terms below at the subtree's tf maximum and m
minimum) is under the item's current k-th score is skipped, best child first; a subtree of at
most ``LEAF_DOCS`` documents (a contiguous range in depth-first order) is scored exactly in
one numpy step instead of node by node. Local top-k lists are merged by a window per item;
the global top k is contained in the union of the local ones, so the result is exact.

Scale: a document's counts never leave its row before the shards are dealt, and df is a
map-side combined aggregate, so a hot term only adds to partial counts. A vocabulary of more
than ``BROADCAST_TERMS`` terms is not sent to the tasks but joined afterwards.
Shards are sized from the restricted row count (``SHARD_ROWS`` rows each), so no task holds
more than a shard whatever the skew of texts or sources; items go to every shard of their
block (the stated query set, in blocks, not a join of all pairs).

Edge cases: null or empty texts have no terms and are never returned; null doc_ids are kept
and sort after all ids on equal scores; repeated document rows are separate documents with
equal scores; benchmark rows repeated with the same (item_id, text) count once, and a null
or term-free item returns nothing. Extra columns of either table are dropped first.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelmark.llm.common import stored

__all__ = ["TERM", "terms_of", "top_documents", "brute_force", "search_tree"]

# Fixed values of the contract: the term pattern and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 10
SHARD_ROWS = 250_000
BLOCK_ITEMS = 2_000
BROADCAST_TERMS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same over UTF-8: what parts terms becomes a space, A-Z is lowered.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms_of(text):
    """Array of terms of a text column, A-Z lowered; null gives an empty array."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(TERM), 0)


def gain(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Tree:
    """Trie of frequency-ordered (term, tf) paths with subtree bounds.

    Documents are numbered in the order of their paths, so every subtree holds one contiguous
    range of documents, those that end at its root first, and the (term, tf) entries of the
    documents lie in flat arrays in that order. A node is (first, last, depth).
    """

    def __init__(self):
        self.added: list[tuple] = []

    def add(self, path: list[tuple[int, int]], doc_id, m: int) -> None:
        self.added.append((path, doc_id, m))

    def summarise(self) -> None:
        paths = [path for path, _, _ in self.added]
        entries = np.array([e for path in paths for e in path], dtype=np.int64).reshape(-1, 2)
        starts = np.cumsum([0, *map(len, paths)])
        self.load(starts, entries[:, 0], entries[:, 1], [d for _, d, _ in self.added], np.array([m for _, _, m in self.added], dtype=np.int64))

    def load(self, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, doc_ids: list, ms: np.ndarray) -> None:
        """Documents as ranges ``starts`` of the entries, which are in path order within each."""
        wide = np.empty((len(terms), 2), dtype=">u8")
        wide[:, 0], wide[:, 1] = terms, tfs
        data, cuts = wide.tobytes(), (starts * 16).tolist()
        keys = [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        sizes = np.diff(starts)[order]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.entry_depth = np.arange(len(terms)) - np.repeat(self.starts[:-1], sizes)
        take = np.repeat(starts[:-1][order], sizes) + self.entry_depth
        self.entry_term, self.entry_tf = terms[take], tfs[take]
        self.doc_ids, self.doc_m = [doc_ids[i] for i in order.tolist()], ms[order]
        self.entry_gain = (1_000_000_000 * self.entry_tf) // (1000 * self.entry_tf + 8 * np.repeat(self.doc_m, sizes))
        self.terms = int(terms.max(initial=-1)) + 1
        self.opened: dict[tuple, tuple] = {}

    def summary(self, node: tuple[int, int, int]) -> tuple[np.ndarray, int, int]:
        """The terms strictly below a node, their maximal tf, and the minimal m of its documents."""
        first, last, depth = node
        lo, hi = self.starts[first], self.starts[last]
        below = self.entry_depth[lo:hi] >= depth
        held = np.zeros(self.terms, dtype=bool)
        held[self.entry_term[lo:hi][below]] = True
        return np.flatnonzero(held), int(self.entry_tf[lo:hi][below].max(initial=0)), int(self.doc_m[first:last].min())

    def children(self, node: tuple[int, int, int]) -> tuple:
        """Where the documents that end at the node stop, and of its children: the nodes, their terms, the gains of their
        own tf and of the most below them, the terms below all of them one after the other, and where each one's begin."""
        if node not in self.opened:
            first, last, depth = node
            ends = first + int(np.searchsorted(self.starts[first + 1: last + 1] - self.starts[first:last] > depth, True))
            if not (np.diff(self.starts[first: last + 1])[: ends - first] == depth).all():
                raise ValueError("documents are not in path order")
            at = self.starts[ends:last] + depth
            term, tf = self.entry_term[at], self.entry_tf[at]
            heads = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])) if len(at) else np.zeros(0, np.int64)
            bounds = [*(heads + ends).tolist(), last]
            nodes = [(a, b, depth + 1) for a, b in zip(bounds[:-1], bounds[1:])]
            found = [self.summary(child) for child in nodes]
            own = np.array([gain(f, m) for f, (_, _, m) in zip(tf[heads].tolist(), found)], dtype=np.int64)
            most = np.array([gain(f, m) if f else 0 for _, f, m in found], dtype=np.int64)
            # a place without weight closes each list, so that none is empty
            lists = [part for terms, _, _ in found for part in (terms, [self.terms])]
            flat = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
            begins = np.cumsum([0, *(len(terms) + 1 for terms, _, _ in found)])[:-1]
            self.opened[node] = ends, nodes, term[heads], own, most, flat, begins
        return self.opened[node]


#: A subtree with at most this many documents is scored whole, in one vectorised step.
LEAF_DOCS = 256


def search_tree(tree: _Tree, weights: dict[int, int], k: int, leaf: int = LEAF_DOCS) -> list[tuple[int, object]]:
    """The k best (score, doc_id) of one item over one tree, ties by ascending doc_id, nulls last.

    Depth-first branch and bound. A node's bound is the path's matched terms, each at the
    smallest m met on the way down (m only grows with depth, so these gains never fall short),
    plus every wanted term occurring below at the subtree's largest tf and smallest m. Children
    are taken best bound first; a subtree under the current k-th score is skipped, and one with
    at most ``leaf`` documents is scored exactly in one step.
    """
    lookup = np.zeros(tree.terms + 1, dtype=np.int64)
    for term, w in weights.items():
        if term < tree.terms:
            lookup[term] = w
    best: list = []  # heap of (score, order key, doc_id): the worst kept entry on top

    def order_key(doc_id):
        # larger key = better on equal score: smaller ids first, null last
        return (0, 0) if doc_id is None else (1, -doc_id)

    def limit() -> int:
        return best[0][0] if len(best) == k else 1  # scores must exceed 0

    def score_range(a: int, b: int) -> None:
        lo, hi = tree.starts[a], tree.starts[b]
        if hi == lo:
            return  # no terms, no score
        part = lookup[tree.entry_term[lo:hi]] * tree.entry_gain[lo:hi]
        # every document has at least one entry: segments are never empty
        scores = np.add.reduceat(part, tree.starts[a:b] - lo)
        for i in np.flatnonzero(scores >= limit()).tolist():
            score = int(scores[i])
            doc_id = tree.doc_ids[a + i]
            entry = (score, order_key(doc_id), doc_id)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry[:2] > best[0][:2]:
                heapq.heapreplace(best, entry)

    size = len(tree.doc_ids)
    stack = [(limit(), (0, size, 0), 0)] if size else []  # bound, node, path bound
    while stack:
        bound, node, path_bound = stack.pop()
        if bound < limit():
            continue
        first, last, _ = node
        if last - first <= leaf:
            score_range(first, last)
            continue
        ends, nodes, terms, own, most, flat, begins = tree.children(node)
        # documents ending exactly at this node come first in its range
        if ends > first:
            score_range(first, ends)
        if nodes:
            steps = path_bound + lookup[terms] * own
            bounds = steps + np.add.reduceat(lookup[flat], begins) * most
            for i in np.argsort(bounds, kind="stable").tolist():  # most promising child last: it is taken next
                if bounds[i] >= limit():
                    stack.append((int(bounds[i]), nodes[i], int(steps[i])))
    return [(score, doc_id) for score, _, doc_id in sorted(best, reverse=True)]


def _searched(docs: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
    """One (shard, block) task: build the trie of the shard's documents, run every item of the block."""
    out: dict[str, list] = {"item_key": [], "doc_id": [], "no_id": [], "score": []}
    if docs.empty or items.empty:
        return pd.DataFrame(out)
    # term numbers in descending df order: frequent terms near the root
    numbers, at, place = np.unique(docs["number"].to_numpy(), return_index=True, return_inverse=True)
    by_df = np.empty(len(numbers), dtype=np.int64)
    by_df[np.argsort(-docs["df"].to_numpy()[at], kind="stable")] = np.arange(len(numbers))
    terms, rid = by_df[place], docs["rid"].to_numpy()
    order = np.lexsort((terms, rid))
    rid = rid[order]
    heads = np.flatnonzero(np.concatenate([[True], rid[1:] != rid[:-1]]))
    of = order[heads]
    ids = [None if no else i for i, no in zip(docs["doc_id"].to_numpy()[of].tolist(), docs["no_id"].to_numpy()[of].tolist())]
    tree = _Tree()
    tree.load(np.append(heads, len(rid)), terms[order], docs["tf"].to_numpy()[order], ids, docs["m"].to_numpy()[of])
    number = dict(zip(numbers.tolist(), by_df.tolist()))
    wanted: dict[int, dict[int, int]] = {}
    for key, term, w in zip(items["item_key"].tolist(), items["number"].tolist(), items["w"].tolist()):
        weights = wanted.setdefault(key, {})
        if term in number:
            weights[number[term]] = weights.get(number[term], 0) + w
    for key, weights in wanted.items():
        for score, doc_id in search_tree(tree, weights, K):
            out["item_key"].append(key)
            out["doc_id"].append(0 if doc_id is None else doc_id)
            out["no_id"].append(doc_id is None)
            out["score"].append(score)
    return pd.DataFrame(out)


def counted(docs: DataFrame, wanted: set[bytes] | None) -> DataFrame:
    """``rid``, ``doc_id``, ``n`` and, of the wanted terms or of all, ``terms`` and ``tfs`` of every document.

    In UTF-8 every byte of a non-ASCII character is above 0x7F, so bytes part terms as characters do.
    """
    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, tfs, ends = [], [], [], [0]
            for text in batch.column("text"):
                words = (text.as_py() or b"").translate(_TERM_BYTES).split()
                found = Counter(words if wanted is None else filter(wanted.__contains__, words))
                sizes.append(len(words))
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))],
                names=["rid", "doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.col("text").cast("string").cast("binary").alias("text"))
    tallies = texts.mapInArrow(tallied, "rid bigint, doc_id bigint, n bigint, terms array<binary>, tfs array<bigint>")
    return tallies.withColumn("terms", F.col("terms").cast("array<string>"))


def top_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the K best documents of every benchmark item."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = items.withColumn("item_key", F.xxhash64("item_id", "text"))
    item_terms = items.select("item_key", "item_id", F.explode(terms_of(F.col("text"))).alias("term"))
    blocks = max(1, math.ceil(items.count() / BLOCK_ITEMS))
    item_terms = item_terms.withColumn("block", F.pmod(F.col("item_key"), F.lit(blocks)).cast("int"))
    vocabulary = item_terms.select("term", "block").distinct()

    # term counts per document, restricted to the items' vocabulary where it is small enough to be sent
    own = vocabulary.select("term").distinct()
    listed = own.limit(BROADCAST_TERMS + 1).collect()
    few = len(listed) <= BROADCAST_TERMS
    texts = stored(counted(docs, {r["term"].encode() for r in listed} if few else None), "search-tf")
    totals = texts.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    n_docs, n_terms = int(totals["N"]), int(totals["L"])
    tf = texts.select("rid", "doc_id", "n", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))))
    if not few:
        tf = tf.join(own, "term", "left_semi")
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    df = stored(df.withColumn("w", weight).withColumn("number", F.monotonically_increasing_id()), "search-df")

    entries = df.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, math.ceil(entries / SHARD_ROWS))
    # m = 25 + (75 n N) div L in 64-bit integers
    m = F.expr(f"25L + (75L * n * {n_docs}L) div {max(n_terms, 1)}L")
    doc_side = (tf.join(df.select("term", "df", "number"), "term").join(vocabulary, "term")
                .select(F.col("block").alias("block"), F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard"),
                        "rid", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
                        m.alias("m"), "number", "tf", "df"))
    item_side = (item_terms.join(df.select("term", "w", "number"), "term")
                 .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
                 .select(*(F.col(c).alias(c) for c in ("block", "shard", "item_key", "number", "w"))))
    schema = "item_key bigint, doc_id bigint, no_id boolean, score bigint"
    local = (doc_side.groupBy("block", "shard").cogroup(item_side.groupBy("block", "shard"))
             .applyInPandas(_searched, schema))
    local = local.select("item_key", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
    order = Window.partitionBy("item_key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K)
    # item ids back by the item key: one row per item, joined to at most K rows each
    return (ranked.join(items.select("item_key", "item_id"), "item_key")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def brute_force(docs: list[tuple], items: list[tuple], k: int = K) -> list[tuple]:
    """Plain Python of the same contract, for tests: (item_id, rank, doc_id, score) rows."""
    import re
    from collections import Counter

    pattern = re.compile(TERM)
    table = str.maketrans(_UPPER, _LOWER)
    vectors = [(doc_id, Counter(pattern.findall((text or "").translate(table)))) for doc_id, text in docs]
    counted = [(d, v, sum(v.values())) for d, v in vectors]
    n_docs = sum(1 for _, _, n in counted if n)
    n_terms = sum(n for _, _, n in counted)
    df = Counter(t for _, v, _ in counted for t in v)
    rows = []
    for item_id, text in sorted(set(items), key=repr):
        q = pattern.findall((text or "").translate(table))
        scored = []
        for doc_id, v, n in counted:
            if not n:
                continue
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * gain(v[t], m) for t in q if v[t])
            if score > 0:
                scored.append((score, doc_id))
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        rows += [(item_id, r + 1, d, s) for r, (s, d) in enumerate(scored[:k])]
    return rows
