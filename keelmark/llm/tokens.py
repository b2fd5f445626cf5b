"""Token ids in files of rANS blocks.

The container is a Parquet table of blocks, so that Spark's writers commit it and any store can hold it: one row per
block with its shard (a range of ids), its number, the ids and token counts of its documents, and the coded bytes.
Documents are never split over blocks; checkpoints within a block part a very long one. The frequency table is counted
over all documents and lies beside the blocks; it has one entry for each vocabulary id.

Texts are encoded by the tokenizers library. Where its file asks for plain byte-level BPE, texts are cut first at places
that no token of it crosses, some megabytes of them at once in Arrow; each distinct piece is looked up once, and a worker
keeps the ids of the pieces it met last from task to task, so each is merged once, not each time.
"""

import json
import os
import re
import string
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelmark.llm.common import identified, stored
from keelmark.llm.rans import Coder, quantised
from keelmark.session import run_dir

END_ID = 2
BLOCK_TOKENS = 1 << 18
SLICE_ROWS = 64  # texts that the library gets at once: its encodings take far more room than their ids
SLICE_BYTES = 4 << 20  # of texts that are cut at once, at least one text
LINE_PARTS = 1 << 12  # pieces that the library gets at once
KEPT_PIECES = 500_000  # pieces of either generation whose ids a worker keeps

#: What the library's splitting pattern takes as white space; all of it but space and newline; maximal parts to cut at.
WHITE = "\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD = re.compile("[\x09\x0b-\x0d\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Texts with white space side by side, at an end, or of other kinds, and empty ones; in the syntax of Arrow too.
_UNEVEN = rf"^$|^[ \n]|[ \n]$|[ \n][ \n]|{_ODD.pattern}"
_RUNS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
_MARKS = string.punctuation
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f"[{_LETTERS}]+")
_MARKED = rf"([{_LETTERS}])([!-/:-@\[-`{{-~])"  # a plain letter ends a token where a mark follows


def width(vocabulary: str, end_id: int = END_ID) -> str:
    """The narrowest type that holds every id."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True).values()
    return "<u2" if max(end_id, *ids) < 1 << 16 else "<u4"


class Encoder:
    """Ids of whole texts as ``dtype`` bytes, by the tokenizers library.

    The byte-level pattern never lets a token run from another character into white space, and gives the last space of a
    run to what follows. So a text whose white space is single spaces and newlines may be cut before each of them and
    between a plain letter and a mark, and any text into ``_RUNS``: the ids of the parts, one after the other, are those
    of the whole. Words of plain letters go to the library's model one by one, other parts to the library a line each;
    the newline's id cannot come from a part. Texts that hold an added token, and files that ask for more than byte-level
    BPE, are encoded whole.

    A part goes by a key: itself after ``\\r``, or from its newline on, or without the space before it.
    """

    def __init__(self, vocabulary: str, dtype: str):
        from tokenizers import Tokenizer, pre_tokenizers

        plan = json.loads(Path(vocabulary).read_text(encoding="utf-8"))
        split, model = plan.get("pre_tokenizer") or {}, plan.get("model") or {}
        self.tokenizer, self.dtype = Tokenizer.from_file(vocabulary), dtype
        self.added = [t["content"] for t in plan.get("added_tokens") or ()]
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if newline else None
        self.cuts = (
            len(newline) == 1 and model.get("type") == "BPE" and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space", True)
            and not any(plan.get(k) for k in ("normalizer", "truncation", "padding"))
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")))
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {code: spelt(chr(code))[0][0] for code in (0x20, *range(0x41, 0x7B), *range(0xC0, 0x100))}
        self.merge = self.tokenizer.model.tokenize
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for at in range(0, len(texts), SLICE_ROWS)
                for e in self.tokenizer.encode_batch_fast(texts[at: at + SLICE_ROWS], add_special_tokens=False)]

    def lines(self, parts: list[str]) -> list[bytes]:
        """Ids of parts without white space, but for one space that may come first."""
        out = []
        for at in range(0, len(parts), LINE_PARTS):
            ids = np.frombuffer(self.whole(["\n".join(parts[at: at + LINE_PARTS])])[0], self.dtype)
            size, data = ids.itemsize, ids.tobytes()
            ends = (np.flatnonzero(ids == self.newline) * size).tolist()
            out += [data[a:b] for a, b in zip([0, *(e + size for e in ends)], [*ends, len(data)], strict=True)]
        return out

    def words(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that are one match of the pattern each: plain letters, after one space or none."""
        ids, ends = [], [0]
        for part in parts:  # spelt as the byte-level step does, which leaves the letters of ASCII as they are
            spelt = part.replace(" ", self.spelling[0x20]) if part.isascii() else part.translate(self.spelling)
            ids += [token.id for token in self.merge(spelt)]
            ends.append(len(ids))
        data = np.array(ids, self.dtype).tobytes()
        size = np.dtype(self.dtype).itemsize
        return [data[a * size: b * size] for a, b in pairwise(ends)]

    def cut(self, texts: list[str]) -> tuple[list[int], np.ndarray, pa.Array]:
        """Which texts may be cut, in the order of their parts; where the parts of each end; the parts' keys."""
        column = pa.array(texts, pa.large_string())
        barred = np.zeros(len(texts), bool)
        for token in self.added:
            barred |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        uneven = pc.match_substring_regex(column, _UNEVEN).to_numpy(zero_copy_only=False)
        even = pc.replace_substring(column.filter(pa.array(~barred & ~uneven)), "\n", " \n \r")
        even = pc.replace_substring_regex(even, _MARKED, "\\1 \r\\2")
        first, nothing = pa.scalar("\r", even.type), pa.scalar("", even.type)
        split = pc.split_pattern(pc.binary_join_element_wise(first, even, nothing), " ")
        at = np.flatnonzero(~barred & uneven).tolist()
        runs = [[part[1:] if part[0] == " " and not part.isspace() else "\r" + part for part in _RUNS.findall(texts[n])] for n in at]
        counts = np.concatenate([np.diff(split.offsets.to_numpy()), np.array([len(r) for r in runs], np.int64)])
        keys = pa.concat_arrays([split.flatten(), pa.array([key for run in runs for key in run], pa.large_string())])
        return np.flatnonzero(~barred & ~uneven).tolist() + at, np.cumsum(counts, dtype=np.int64), keys

    def learn(self, missing: set[str]) -> None:
        """Take the missing keys into the younger generation; the older one goes when that is full."""
        if len(self.young) > KEPT_PIECES:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        marked, words, fresh = [], set(), set()
        for key in missing:
            if key in old:
                young[key] = old[key]
            elif _WORD.fullmatch(key, key[0] == "\r"):
                words.add(key)
            else:
                core = key.rstrip(_MARKS)
                if len(core) < len(key) and _WORD.fullmatch(core):
                    mark = "\r" + key[len(core):]
                    marked.append((key, core, mark))
                    words.add(core)
                    fresh.add(mark)
                else:
                    fresh.add(key)
        words = [key for key in words if key not in young]
        if words:
            young.update(zip(words, self.words([key[1:] if key[0] == "\r" else " " + key for key in words]), strict=True))
        plain, apart = {}, {}
        for key in fresh.difference(young):
            part = key[1:] if key[0] == "\r" else key if key[0] == "\n" else " " + key
            (apart if key[0] in "\r\n" and (not part or part.isspace() or "\n" in part or _ODD.search(part)) else plain)[key] = part
        if apart:
            young.update(zip(apart, self.whole(list(apart.values())), strict=True))
        if plain:
            young.update(zip(plain, self.lines(list(plain.values())), strict=True))
        for key, core, mark in marked:
            young[key] = young[core] + young[mark]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.cuts:
            return self.whole(texts)
        order, ends, keys = self.cut(texts)
        coded = keys.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far quicker than to_pylist
        ids = list(map(self.young.get, distinct))
        gaps = [at for at, known in enumerate(ids) if known is None]
        if gaps:
            self.learn({distinct[at] for at in gaps})
            for at in gaps:
                ids[at] = self.young[distinct[at]]
        # every part's ids side by side, and from there the texts'
        laid = pa.array(ids, pa.large_binary()).take(coded.indices)
        places = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1) if len(laid) else np.zeros(1, np.int64)
        data = memoryview(laid.buffers()[2] or b"")
        bounds = places[np.concatenate([np.zeros(1, np.int64), ends])].tolist()
        out: list = [None] * len(texts)
        for at, (a, b) in zip(order, pairwise(bounds), strict=True):
            out[at] = bytes(data[a:b])
        left = [at for at, found in enumerate(out) if found is None]
        for at, found in zip(left, self.whole([texts[at] for at in left]), strict=True):
            out[at] = found
        return out


@lru_cache(maxsize=1)
def _kept(vocabulary: str, dtype: str, changed: int, size: int) -> Encoder:
    return Encoder(vocabulary, dtype)


def encoder_for(vocabulary: str, dtype: str) -> Encoder:
    """The process's encoder for this file: a worker's next task goes on with the pieces that its last one kept."""
    stat = os.stat(vocabulary)
    return _kept(vocabulary, dtype, stat.st_mtime_ns, stat.st_size)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Where to part texts so that each part has ``SLICE_BYTES`` at most, or one text: first row and number of rows."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield at, end - at
        at = end


def tokenised(docs: DataFrame, vocabulary: str, end_id: int = END_ID, dtype: str = "<u4") -> DataFrame:
    """``doc_id``, ``tie`` and ``ids`` (little-endian unsigned 32-bit or as ``dtype``, with the end id) of every row."""
    narrow = identified(docs).withColumn("tie", F.xxhash64("text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks share the cores
        encoder, end = encoder_for(vocabulary, dtype), np.array([end_id], dtype).tobytes()
        for batch in batches:
            for at, n in slices(batch.column("text")):
                part = batch.slice(at, n)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = [found + end for found in encoder.encode(texts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), pa.array(ids, pa.binary())], names=["doc_id", "tie", "ids"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.select("doc_id", "text", "tie").mapInArrow(encoded, f"doc_id {kind}, tie bigint, ids binary")


def counted(tokens: DataFrame, dtype: str = "<u4") -> np.ndarray:
    """How often each id occurs, over all rows. Tasks send their sums; the driver gets one row per vocabulary id."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype))
            if len(got) > len(total):
                total = np.pad(total, (0, len(got) - len(total)))
            total[: len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(summed, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write ``folder/blocks`` and ``folder/table``, in ascending id order; equal ids in the order of a text hash."""
    dtype = width(vocabulary, end_id)
    tokens = stored(tokenised(docs, vocabulary, end_id, dtype), "token-ids")
    frequencies = quantised(counted(tokens, dtype))
    spark = docs.sparkSession
    spark.createDataFrame([(frequencies.astype("<i8").tobytes(),)], "frequencies binary").coalesce(1).write.parquet(f"{folder}/table")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, held, size, number, shard = Coder(frequencies), [], 0, 0, 0

        def block() -> pa.RecordBatch:
            payload = coder.encode(np.concatenate([ids for _, ids in held]))
            docs_type = pa.list_(kind)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([number]), pa.array([[d for d, _ in held]], docs_type),
                 pa.array([[len(ids) for _, ids in held]], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                names=["shard", "block", "doc_ids", "sizes", "payload"])

        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc, ids, part in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("part").to_pylist()):
                shard = part
                held.append((doc, np.frombuffer(ids.as_py(), dtype)))
                size += len(held[-1][1])
                if size >= block_tokens:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()

    kind = tokens.schema["doc_id"].dataType.simpleString()
    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    parted = ordered.select("doc_id", "ids", F.spark_partition_id().cast("bigint").alias("part"))
    parted.mapInArrow(blocks, f"shard bigint, block bigint, doc_ids array<{kind}>, sizes array<bigint>, payload binary").write.parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) of all documents in the files."""
    row = spark.read.parquet(f"{folder}/table").first()
    frequencies = np.frombuffer(row["frequencies"], "<i8")
    stored_blocks = spark.read.parquet(f"{folder}/blocks")
    kind = stored_blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequencies)
        for batch in batches:
            for at in range(len(batch)):
                one = batch.slice(at, 1)
                sizes = np.array(one.column("sizes")[0].as_py(), np.int64)
                ids = coder.decode(one.column("payload")[0].as_py())
                ends = np.cumsum(sizes)
                texts = [ids[e - n: e].astype("<u4").tobytes() for e, n in zip(ends.tolist(), sizes.tolist())]
                starts = one.column("first")[0].as_py() + ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [one.column("doc_ids")[0].values, pa.array(starts), pa.array(sizes), pa.array(texts, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    # a block's first place: blocks before it in its shard, and whole shards before that (one row for each)
    sized = stored_blocks.withColumn("n", F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sized.groupBy("shard").agg(F.sum("n").alias("n")).select(
        F.col("shard").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_first"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = sized.select("shard", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("block_first")).join(shards, F.col("shard") == F.col("of"))
    placed = stored_blocks.join(places.select("shard", "block", (F.col("shard_first") + F.col("block_first")).alias("first")), ["shard", "block"])
    return placed.select("doc_ids", "sizes", "payload", "first").mapInArrow(
        decoded, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents, read the files back, and return ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` from them.

    Null and empty texts are the end id alone. Null ids come first. Repeated rows are written as often as they occur.
    An empty table gives an empty result; other columns are ignored.
    """
    folder = run_dir(docs.sparkSession, "token-files")
    write(docs, folder, vocabulary, end_id)
    return read(docs.sparkSession, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
