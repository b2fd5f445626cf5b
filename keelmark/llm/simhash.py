"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each read as a 23-bit word.
The perfect (23, 12) Golay code gives every word a set of *indices*: the
codewords within distance 4 of it, one where a codeword lies within distance
2 and six otherwise. Two words that differ in at most two bits have a word
within one bit of both of them; its codeword (at most three bits away) is
within four bits of either, so they share an index.

Two errors spread over three segments leave one segment unharmed, and at most
two errors in each of the others. So fingerprints that link share a key made
of an unharmed segment and one Golay index of the segment after it: about
sixteen keys of 33 to 34 bits for each fingerprint, joined and verified by the
real distance.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import identified, lowered_words, stored
from keelmark.llm.components import components

# ---------------------------------------------------------------- fixed values
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
WORD_BITS = 23
CHECK_BITS = 11
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
SEED = 42
# ------------------------------------------------------------ end fixed values

MAX_BITS = 2
#: Distinct fingerprints of one key that are compared pair by pair; larger buckets go through masks.
BUCKET = 2048


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64).copy()
    for bit in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - CHECK_BITS))
    return rest


@lru_cache(maxsize=1)
def near_patterns() -> np.ndarray:
    """For each syndrome the error patterns of up to four bits that lead to a codeword; -1 fills short rows."""
    found: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(WORD_BITS), weight)], dtype=np.int64)
        for pattern, rest in zip(patterns.tolist(), syndrome(patterns).tolist()):
            found[rest].append(pattern)
    table = np.full((1 << CHECK_BITS, max(map(len, found))), -1, dtype=np.int64)
    for rest, patterns in enumerate(found):
        table[rest, : len(patterns)] = patterns
    return table


def golay_indices(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of all codewords within four bits of each word; -1 fills short rows."""
    words = words.astype(np.int64)
    patterns = near_patterns()[syndrome(words)]
    return np.where(patterns < 0, -1, (words[:, None] ^ patterns) >> CHECK_BITS)


def segment(prints: np.ndarray, number: int) -> np.ndarray:
    first, width = SEGMENTS[number]
    return ((prints >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)


def keys(prints: np.ndarray) -> np.ndarray:
    """One row of bucket keys for each fingerprint; -1 fills short rows."""
    columns = []
    for number in range(len(SEGMENTS)):
        indices = golay_indices(segment(prints, (number + 1) % len(SEGMENTS)))
        whole = (number << 34) | (segment(prints, number) << 12)
        columns.append(np.where(indices < 0, -1, whole[:, None] | indices))
    return np.hstack(columns)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority of the bits of all shingle hashes; zero for a text without words."""
    words = lowered_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in joined], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        part = hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``print`` (the 64 bits as a signed long) of every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    narrow = identified(docs, id_column, text_column)
    return narrow.mapInArrow(hashed, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, print bigint")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def bucket_links(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket that connect what is connected inside it: a spanning forest, not all pairs."""
    rest = np.arange(len(prints))
    left, right = [], []
    frontier: list[int] = []
    while len(rest) or frontier:
        if not frontier:
            frontier.append(int(rest[0]))
            rest = rest[1:]
        at = frontier.pop()
        near = distance(prints[rest], prints[at]) <= bits
        reached = rest[near]
        rest = rest[~near]
        left += [at] * len(reached)
        right += reached.tolist()
        frontier += reached.tolist()
    return prints[left], prints[right]


def links(prints: DataFrame, bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints within ``bits`` bits whose closure is the closure of all such pairs.

    Fingerprints are dealt out by key. A bucket of up to ``bucket`` of them is
    compared inside its task; members of a larger one are passed on and linked
    through shared masks instead, in work proportional to its size.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the keys guarantee up to {MAX_BITS} differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            table = keys(values.view(np.uint64))
            row, column = np.nonzero(table >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(table[row, column]), pa.array(values[row])], names=["key", "print"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def linked(ks: np.ndarray, ps: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not len(ks):
                return
            starts = np.flatnonzero(np.r_[True, ks[1:] != ks[:-1]])
            sizes = np.diff(np.r_[starts, len(ks)])
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            pairs = starts[sizes == 2]  # most buckets with company hold two
            first, second = ps[pairs].view(np.uint64), ps[pairs + 1].view(np.uint64)
            near = distance(first, second) <= bits
            out.append((first[near], second[near], np.full(near.sum(), -1, np.int64)))
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                members = ps[start: start + size].view(np.uint64)
                if size <= bucket:
                    a, b = bucket_links(members, bits)
                    out.append((a, b, np.full(len(a), -1, np.int64)))
                else:
                    out.append((members, members, np.full(size, ks[start], np.int64)))
            a, b, key = (np.concatenate(x) for x in zip(*out))
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(key)], names=["a", "b", "key"])

        for batch in batches:
            ks = np.concatenate([held_keys, batch.column(0).to_numpy(zero_copy_only=False)])
            ps = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False)])
            whole = np.searchsorted(ks, ks[-1]) if len(ks) else 0  # the last key may go on in the next batch
            yield from linked(ks[:whole], ps[:whole])
            held_keys, held = ks[whole:], ps[whole:]
        yield from linked(held_keys, held)

    dealt = prints.select("print").mapInArrow(keyed, "key bigint, print bigint")
    met = dealt.repartition("key").sortWithinPartitions("key", "print").mapInArrow(compared, "a bigint, b bigint, key bigint")
    met = stored(met, "simhash-links")
    return met.where("key < 0").select("a", "b").union(masked_links(met.where("key >= 0").select("key", F.col("a").alias("print")), bits))


def masked_links(members: DataFrame, bits: int) -> DataFrame:
    """Links inside overfull buckets: fingerprints are within ``bits`` bits if and only if they agree outside some
    ``bits`` positions, so each is put under every mask of so many positions and linked to the least print there.

    Only positions outside the segment that the bucket's key fixes are masked.
    """
    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ks = batch.column(0).to_numpy(zero_copy_only=False)
            ps = batch.column(1).to_numpy(zero_copy_only=False)
            for number, (first, width) in enumerate(SEGMENTS):
                own = ps[(ks >> 34) == number]
                free = [b for b in range(64) if not first <= b < first + width]
                for positions in combinations(free, bits):
                    mask = sum(1 << b for b in positions)
                    if len(own):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(own), mask, np.uint64).view(np.int64)),
                             pa.array((own.view(np.uint64) & np.uint64(~mask & (1 << 64) - 1)).view(np.int64)), pa.array(own)],
                            names=["mask", "shared", "print"])

    under = members.mapInArrow(masks, "mask bigint, shared bigint, print bigint")
    least = under.groupBy("mask", "shared").agg(F.min("print").alias("a"), F.max("print").alias("z")).where("a < z")
    return under.join(least, ["mask", "shared"]).where("a <> print").select("a", F.col("print").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = MAX_BITS, bucket: int = BUCKET,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 lowercase hex digits) and ``component_id`` (the smallest id reachable over links of
    at most ``bits`` bits) of every row.

    Null and empty texts, and texts of white space alone, have fingerprint zero and link like any other. Shorter texts
    than a shingle count as one shingle. Equal fingerprints are one node, so copies cost a row each and no pairs. Rows
    with a null id are returned with what they reach; null is never the smallest id unless all are null. Repeated rows
    come out as often as they came in. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle, id_column, text_column), "simhash-prints")
    nodes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    groups = components(links(nodes, bits, bucket), "a", "b")  # node, component: of linked fingerprints only
    grouped = nodes.join(groups, nodes["print"] == groups["node"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(smallest, "component").select("print", "component_id")
    return prints.join(named, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
