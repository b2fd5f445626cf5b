"""Kept and slice-wise merged pre-tokens give tiktoken's ids and bytes, with fewer merges and calls."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from keelmark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Counting:
    """A processor that notes what it is given to merge."""

    def __init__(self, processor):
        self.processor, self.calls = processor, []

    def encode(self, pieces, **options):
        self.calls.append(list(pieces))
        return self.processor.encode(pieces, **options)

    def __getattr__(self, name):
        return getattr(self.processor, name)


@pytest.fixture(scope="module")
def proto():
    return bpe.model_proto(bpe.ranks_of(PATH))


@pytest.fixture
def codec(proto):
    codec = bpe.Codec(proto, public_tokenizers.PATTERN)
    codec.processor = Counting(codec.processor)
    return codec


def expected(texts):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})
    ids = [enc.encode_ordinary(text or "") for text in texts]
    return [(len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(enc.decode_bytes(x)).hexdigest(), True) for x in ids]


def awkward(n):
    pick = random.Random(7)
    parts = ["a", "Bc", "é", "'s", "'", " ", " ", "\n", "\t", ".", ",", "12", "\xa0", "\r", "²", "字", "$#", "\x1c", "\x00", "\U0001f600", "alpha "]
    return [None, "", " ", "ab" * 3000, "字" * 300] + ["".join(pick.choices(parts, k=pick.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize(("kept", "chars"), [(bpe.CACHE_PIECES, 256), (5, 2), (0, 0)])
def test_slices_give_the_ids_of_tiktoken(monkeypatch, codec, kept, chars):
    monkeypatch.setattr(bpe, "CACHE_PIECES", kept)
    monkeypatch.setattr(bpe, "CACHE_CHARS", chars)
    texts = awkward(400)
    for rows in (1, 6, 500):
        assert [row for at in range(0, len(texts), rows) for row in codec.digests(texts[at: at + rows])] == expected(texts)


def test_a_frequent_piece_is_merged_once_among_rare_ones(monkeypatch, codec):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    for n in range(100):
        codec.encode(" frequent" + "".join(f" {chr(97 + n % 26)}{chr(97 + k)}{chr(97 + n // 26)}" for k in range(20)))
    assert sum(piece.endswith("frequent") for call in codec.processor.calls for piece in call) == 1
    assert len(codec.young) + len(codec.old) < 200


def test_a_slice_is_merged_in_one_call(codec):
    list(codec.digests([f"text number{'a' * n}" for n in range(200)]))
    assert len(codec.processor.calls) == 1


def test_a_very_long_piece_is_not_kept(codec):
    assert codec.decode(codec.encode("b" * 5000 + " c")) == b"b" * 5000 + b" c"
    assert list(codec.young) == [" c"]


def test_another_vocabulary_in_turn(spark, tmp_path):
    texts = awkward(60)
    other = {bytes([b]): b for b in range(256)} | {b"al": 256, b"alp": 257}
    (tmp_path / "other").write_bytes(b"".join(base64.b64encode(token) + b" %d\n" % rank for token, rank in other.items()))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    want = expected(texts)
    for path in (PATH, str(tmp_path / "other"), PATH):
        got = [tuple(r)[1:] for r in sorted(bpe.encoded(rows, path).collect())]
        assert (got == want) == (path == PATH) and all(r[3] for r in got) and [r[2] for r in got] == [r[2] for r in want]
