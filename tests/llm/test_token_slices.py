"""Many texts cut at once: each distinct piece is looked up once, a word before any mark is merged once, ids stay the library's."""

import random
import shutil
import string

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from keelmark.llm import queries, tokens


def library(texts):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def marked(seed, n):
    pick = random.Random(seed)
    parts = ["foo", "Été", "ß", "ü", "ſ", "é", "s", "t", "ll", "7", "字", " ", " ", " ", "\n", "\r", "\t", *string.punctuation, "'", "'", "\x00", "\x1c", "\x85"]
    return ["".join(pick.choices(parts, k=pick.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_marks_after_letters_part_tokens(seed):
    encoder = tokens.Encoder(queries.vocabulary(), "<u2")
    texts = [*marked(seed, 400), *(f"{a}{b}{c}" for a in ("x", " é", "\ny") for b in string.punctuation for c in ("s", " s", "", "'s x"))]
    assert encoder.encode(texts) == library(texts)


def test_texts_of_one_kind_only():
    encoder = tokens.Encoder(queries.vocabulary(), "<u2")
    for texts in ([], [""], [" ", "a  b"], ["one <|endoftext|> two"], ["a b", "c"]):
        assert encoder.encode(texts) == library(texts)


def test_a_word_is_merged_once_whatever_mark_follows(monkeypatch):
    encoder, sent = tokens.Encoder(queries.vocabulary(), "<u2"), []
    for name in ("whole", "words", "lines"):
        monkeypatch.setattr(encoder, name, lambda parts, f=getattr(encoder, name): sent.extend(parts) or f(parts))
    texts = ["so alphabetic$$$ alphabetic### alphabetic, alphabetic) alphabetic's alphabetic"] * 3
    assert encoder.encode(texts) == library(texts)
    assert sum(part.count("alphabetic") for part in sent) == 1


def test_a_distinct_piece_is_looked_up_once():
    class Counting(dict):
        asked = 0

        def get(self, key):
            Counting.asked += 1
            return super().get(key)

    encoder = tokens.Encoder(queries.vocabulary(), "<u2")
    encoder.young = Counting()
    encoder.encode(["alpha beta, alpha"] * 50)
    assert Counting.asked <= 4  # the first alpha, beta, the mark, alpha after a space


def test_the_encoder_stays_with_its_process_until_the_file_changes(tmp_path):
    path = str(tmp_path / "vocabulary.json")
    shutil.copyfile(queries.vocabulary(), path)
    first = tokens.encoder_for(path, "<u2")
    first.encode(["some words"])
    assert tokens.encoder_for(path, "<u2") is first
    with open(path, "a", encoding="utf-8") as file:
        file.write("\n")
    assert tokens.encoder_for(path, "<u2") is not first
    assert tokens.encoder_for(path, "<u4").dtype == "<u4"


def test_slices_hold_all_texts_within_their_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 10)
    texts = pa.array(["a" * 30, None, "", "é" * 4, "bb", "c", "d" * 10, "e"])
    got = list(tokens.slices(texts))
    assert [row for at, n in got for row in range(at, at + n)] == list(range(len(texts)))
    for at, n in got:
        assert n == 1 or sum(len((t or "").encode()) for t in texts.slice(at, n).to_pylist()) <= 10
    assert list(tokens.slices(pa.array([], pa.string()))) == []


def test_rows_keep_their_ids_over_slices(spark):
    docs = spark.createDataFrame([(n, None if n % 7 == 0 else "x, y " * (n % 5) + f"é{n}! ") for n in range(60)], "doc_id bigint, text string")
    rows = docs.collect()
    got = {r["doc_id"]: bytes(r["ids"]) for r in tokens.tokenised(docs, queries.vocabulary(), 2, "<u2").collect()}
    assert got == {r["doc_id"]: ids + np.array([2], "<u2").tobytes() for r, ids in zip(rows, library([r["text"] or "" for r in rows]), strict=True)}
