"""Byte-level BPE by a sentencepiece model serialised straight from a rank vocabulary.

Method. The rank file lists every token as bytes and its rank. Each byte is mapped to one
printable character (the usual byte-level table: printable Latin-1 bytes stand for themselves,
the other 68 take the code points from 256 on), so every token becomes a string piece. A
sentencepiece BPE model is written from those pieces with score ``-rank`` and an identity
normaliser that adds no prefix and keeps white space as it is; its id of a piece is then the
token's rank, and its merges (highest score first) are the rank file's merges (lowest rank
first). A text is cut into pre-tokens by the splitting pattern, each pre-token is byte-mapped
and encoded on its own, and ids are decoded by mapping pieces back to their bytes.

The model is built once on the driver (its size is the vocabulary's, about 1 MB for 50k
tokens), sent to executors by broadcast, and texts are encoded in Arrow batches inside tasks,
some megabytes at once: the pre-tokens met for the first time are merged in one call, the ids of
the others are kept from before, and all ids of all texts are decoded through Arrow's ``take``.

Edge cases: a null text encodes as the empty text (no ids, empty decoded bytes); very long
texts and pre-tokens are encoded whole (sentencepiece merges in n log n); repeated rows and
ties are encoded independently; only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelmark.llm.common import identified
from keelmark.llm.tokens import slices

__all__ = ["byte_table", "ranks_of", "model_proto", "Codec", "encoded"]

# The bytes that stand for themselves in the byte-level table, in ascending
# order: 33-126 ('!' to '~'), 161-172 and 174-255. All other bytes take 256, 257, ... in order.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_table() -> list[str]:
    """Character that stands for each byte 0-255."""
    table, spare = {}, 256
    for b in range(256):
        if b in _SELF:
            table[b] = chr(b)
        else:
            table[b] = chr(spare)
            spare += 1
    return [table[b] for b in range(256)]


def ranks_of(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 bytes, a space, the rank, one per line."""
    with open(path, "rb") as handle:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in handle if line.strip())}


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks.

    Ranks must be 0..n-1 without gaps; ``<unk>`` takes id n, the first free id, so no rank moves.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    ordered = sorted(ranks.items(), key=lambda item: item[1])
    if [rank for _, rank in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0, 1, ... without gaps")
    table = byte_table()
    model = pb.ModelProto()
    spec = model.trainer_spec
    spec.model_type = pb.TrainerSpec.BPE
    spec.vocab_size = len(ordered) + 1
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ordered), -1, -1, -1
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    for token, rank in ordered:
        piece = model.pieces.add()
        piece.piece = "".join(table[b] for b in token)
        piece.score = -float(rank)
        piece.type = pb.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    return model.SerializeToString()


#: Distinct pre-tokens of either generation whose ids a codec keeps, and the most characters of one kept beyond its slice (bounded memory).
CACHE_PIECES = 300_000
CACHE_CHARS = 256

_ID = np.dtype("<i4")


class Codec:
    """Encoder and decoder over one serialised model and one splitting pattern.

    The ids of a pre-token depend on that pre-token alone, so those met last are kept, in two
    generations: when the younger one is full the older goes, and what is met again moves to the
    younger. So a frequent pre-token is merged once, however many rare ones come between.
    """

    def __init__(self, proto: bytes, pattern: str):
        import regex
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.splitter = regex.compile(pattern)
        table = byte_table()
        self.forward = str.maketrans({b: c for b, c in enumerate(table)})
        backward = str.maketrans({c: chr(b) for b, c in enumerate(table)})
        spelt = self.processor.id_to_piece(list(range(self.processor.get_piece_size())))
        #: By id: its bytes, by the inverse byte map, and its decimal text with a comma.
        self.spelt = pa.array([piece.translate(backward).encode("latin-1") for piece in spelt], pa.large_binary())
        self.decimal = pa.array([b"%d," % n for n in range(len(spelt))], pa.large_binary())
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _merged(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of each pre-token, byte-mapped and merged on its own."""
        mapped = [piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.forward) for piece in pieces]
        ids = self.processor.encode(mapped, out_type=int, num_threads=1)
        data = np.fromiter(chain.from_iterable(ids), _ID).tobytes()
        ends = np.cumsum([0, *map(len, ids)]) * _ID.itemsize
        return (data[a:b] for a, b in pairwise(ends.tolist()))

    def _coded(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, all of its pre-tokens one after the other; null is empty."""
        if len(self.young) > CACHE_PIECES:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        pieces = [self.splitter.findall(text) if text else [] for text in texts]
        fresh = []
        for piece in set().union(*(filterfalse(young.__contains__, part) for part in pieces)):
            if piece in old:
                young[piece] = old[piece]
            else:
                fresh.append(piece)
        if fresh:
            young.update(zip(fresh, self._merged(fresh), strict=True))
        out = [b"".join(map(young.__getitem__, part)) for part in pieces]
        for piece in fresh:
            if len(piece) > CACHE_CHARS:
                del young[piece]
        return out

    @staticmethod
    def _laid(table: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
        """The table's entries for the ids side by side: where each begins (and the last ends), and their bytes."""
        if not len(ids):
            return np.zeros(1, np.int64), memoryview(b"")
        laid = table.take(pa.array(ids))
        return np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1), memoryview(laid.buffers()[2] or b"")

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text: each pre-token byte-mapped and merged on its own; null is empty."""
        return np.frombuffer(self._coded([text])[0], _ID).tolist()

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids: those that each id's piece stands for, joined."""
        places, data = self._laid(self.spelt, np.array(ids, _ID))
        return bytes(data[: places[-1]])

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str, bool]]:
        """Per text: n_tokens, sha256 of the ids as comma-joined decimals, sha256 of the decoded bytes, and round trip."""
        coded = self._coded(texts)
        ends = np.cumsum([0, *map(len, coded)]) // _ID.itemsize
        ids = np.frombuffer(b"".join(coded), _ID)
        places, listed = self._laid(self.decimal, ids)
        spots, decoded = self._laid(self.spelt, ids)
        for text, (first, last), (a, b), (c, d) in zip(texts, *(pairwise(x.tolist()) for x in (ends, places[ends], spots[ends])), strict=True):
            back = bytes(decoded[c:d])
            yield (last - first, hashlib.sha256(listed[a: max(a, b - 1)]).hexdigest(), hashlib.sha256(back).hexdigest(),
                   back == (text or "").encode("utf-8", "surrogatepass"))


@lru_cache(maxsize=1)
def _codec(broadcast, pattern: str) -> Codec:
    # one codec per Python worker, for the last broadcast: the model is parsed once, not per batch
    return Codec(broadcast.value, pattern)


def encoded(docs: DataFrame, rank_path: str, pattern: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip.

    ``ids_sha256`` is the sha256 of the decimal ids joined by commas, ``decoded_sha256`` that of
    the decoded bytes, ``round_trip`` whether they equal the text's UTF-8 bytes. Rows with a null
    id are kept; the result has one row per input row.
    """
    import public_tokenizers

    pattern = pattern or public_tokenizers.PATTERN
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(model_proto(ranks_of(rank_path)))

    def batches(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, pattern)
        for batch in batches_in:
            # slices of some megabytes: Python objects of a whole Arrow batch are never held at once
            for start, rows in slices(batch.column("text")):
                part = batch.slice(start, rows)
                counts, id_hashes, text_hashes, same = zip(*codec.digests(part.column("text").to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()),
                     pa.array(text_hashes, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
    return identified(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(batches, schema)
