"""Texts cut into kept pieces give the ids that the library gives for the whole, with fewer pieces merged."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from keelmark.llm import queries, tokens

TEXTS = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a   b", "a\nb", "a \nb", "a\n b", "a\n\n b", "a\n\n\nb", "\n\na", "a\t b", "a \tb", "a\r\nb", "\rfoo bar",
    "it's we'll 'tis x.'s y,'s ' s", "word. word, word... word?! (word) word;", "a\xa0b\x85 c　 d  e", "a\x1c b\x1f\x1fc ᠎ d", "x²3 ½½ ٣٤ 1,234.5",
    "été naïve Œuvre ªº ×÷ ñandú.", "数字 数字、数字 \U0001f600\U0001f600 é", "one <|endoftext|> two", "one  <|endoftext|>  two", "end<|endoftext|>", "a\x00b \x00", "a" * 5000 + " b",
]


def library(texts):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def awkward(seed, n):
    pick = random.Random(seed)
    return ["".join(pick.choices(["a", "Bc", "é", "'s", "'", " ", " ", "\n", "\t", ".", ",", "12", "\xa0", "\r", "²", "字", "$#", "\x1c"], k=pick.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("kept", [tokens.KEPT_PIECES, 5])
def test_pieces_give_the_ids_of_the_whole(monkeypatch, kept):
    monkeypatch.setattr(tokens, "KEPT_PIECES", kept)
    encoder = tokens.Encoder(queries.vocabulary(), "<u2")
    assert encoder.cuts
    for texts in (TEXTS, [t for t in TEXTS for _ in range(2)], *(awkward(seed, 300) for seed in range(5))):
        assert encoder.encode(texts) == library(texts)


def test_white_space_is_the_librarys():
    split = Tokenizer.from_file(queries.vocabulary()).pre_tokenizer.pre_tokenize_str
    for code in (*range(0x100), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF):
        # white space parts marks; a run of it gives its last one away
        white = code == 32 or len(split(f"!{chr(code)}{chr(code)}!")) == 4
        assert white == (chr(code) in " \n" or bool(tokens._ODD.match(chr(code)))), hex(code)


def test_a_repeated_piece_is_merged_once(monkeypatch):
    encoder, sent = tokens.Encoder(queries.vocabulary(), "<u2"), []
    for name in ("whole", "words", "lines"):
        monkeypatch.setattr(encoder, name, lambda parts, f=getattr(encoder, name): sent.extend(parts) or f(parts))
    encoder.encode(["alpha beta, alpha"] * 50)
    encoder.encode(["gamma alpha beta"] * 50)
    assert sum(len(part) for part in sent) < 100


def test_other_kinds_of_files_are_encoded_whole(tmp_path):
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    from tokenizers import normalizers

    tokenizer.normalizer = normalizers.Lowercase()
    tokenizer.save(str(tmp_path / "lower.json"))
    encoder = tokens.Encoder(str(tmp_path / "lower.json"), "<u2")
    assert not encoder.cuts
    assert encoder.encode(["A b  C", ""]) == library(["a b  c", ""])
