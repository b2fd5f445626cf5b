"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are normalised to lower-case words with single spaces. An item of ``m`` characters may differ by
``k = floor(rate * m)`` edits; it is cut into ``k + 1`` pieces, one of which a match must hold unchanged. Pieces are
found by one Aho-Corasick pass over the text, and each place that a hit implies is verified by Myers' bit-parallel
distance against the text around it.
"""

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import identified, stored

RATE = 0.06
#: An item below so many characters could be chance; it must occur whole, between word ends.
SHORT = 24
#: Benchmarks are sent to tasks in blocks of at most so many bytes, one pass over the documents for each block.
BLOCK_BYTES = 8 << 20
_APART = re.compile(r"[\W_]+")


def normalised(text: str | None) -> str:
    return " " + _APART.sub(" ", (text or "").lower()).strip() + " "


def budget(item: str, rate: float = RATE) -> int:
    return int(rate * len(item)) if len(item) >= SHORT else 0


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of nearly equal length, with their offsets."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of the text, and the first place where such a part ends."""
    m = len(pattern)
    if masks is None:
        masks = pattern_masks(pattern)
    every, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = every, 0, m
    best, where = m, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        x = equal | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        hp = minus | (every & ~(d0 | plus))
        hn = plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = (hp << 1) & every
        hn = (hn << 1) & every
        plus = hn | (every & ~(d0 | hp))
        minus = hp & d0
        if score < best:
            best, where = score, at
    return best, where


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        self.items = [(i, normalised(t)) for i, t in items]
        self.items = [(i, t if len(t) < SHORT else t.strip()) for i, t in self.items if t.strip()]
        self.errors = [budget(t, rate) for _, t in self.items]
        self.masks = [pattern_masks(t) for _, t in self.items]
        found: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(self.items):
            for offset, piece in pieces(text, self.errors[number]):
                found.setdefault(piece, []).append((number, offset))
        self.search = ahocorasick.Automaton()
        for piece, places in found.items():
            self.search.add_word(piece, (len(piece), places))
        if found:
            self.search.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int, int]]:
        """(item id, least distance) of each item within its budget."""
        if not self.items:
            return []
        body = normalised(text)
        best: dict[int, int] = {}
        tried: dict[int, int] = {}
        for end, (size, places) in self.search.iter(body):
            for number, offset in places:
                errors, m = self.errors[number], len(self.items[number][1])
                start = end + 1 - size - offset
                if best.get(number) == 0 or (number in tried and start <= tried[number]):
                    continue
                # one window verifies all starts up to ``slack`` further on
                slack = errors + 1
                begin = max(0, start - errors)
                part = body[begin: start + m + errors + slack]
                if body.startswith(self.items[number][1], max(0, start)):
                    distance = 0
                else:
                    distance = myers(self.items[number][1], part, self.masks[number])[0] if errors else m
                tried[number] = start + (slack if errors else 0)
                if distance <= errors:
                    best[number] = min(best.get(number, distance), distance)
        return sorted((self.items[n][0], d) for n, d in best.items())


def blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; one that is larger by itself is a block of its own."""
    held, size = [], 0
    for row in items.select(F.col("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").orderBy("item_id", "text").toLocalIterator():
        more = len(row["text"].encode())
        if held and size + more > block_bytes:
            yield held
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += more
    if held:
        yield held


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``item_id``, ``distance`` for each item that a document holds within the item's error budget.

    Null and empty texts hold none; null and empty items, and items without a letter or digit, are held by none. Null
    ids are returned as they are. Repeated rows and items give repeated rows. Empty tables give an empty result; other
    columns are ignored.
    """
    narrow = identified(docs)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, distance int"

    def search(items: list[tuple[int, str]]):
        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, rate)
            for batch in batches:
                rows = [(d, i, e) for d, t in zip(batch.column(0).to_pylist(), batch.column(1)) for i, e in matcher.matches(t.as_py())]
                if rows:
                    d, i, e = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(d, batch.schema.field(0).type), pa.array(i), pa.array(e, pa.int32())], names=["doc_id", "item_id", "distance"])

        return narrow.mapInArrow(found, schema)

    out = None
    for items in blocks(benchmark, block_bytes):
        part = search(items)
        out = part if out is None else stored(out, "leaks").union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` whose id is on no match."""
    leaks = contaminated(docs, benchmark, rate).select(F.col("doc_id").alias("leaked")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(F.col("leaked")), "left_anti")
