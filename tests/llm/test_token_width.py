"""Ids lie in two bytes between the steps where the vocabulary allows it, and come back the same."""

import numpy as np
from tokenizers import Tokenizer

from keelmark.llm import queries, tokens

TEXTS = [(1, "a b a"), (2, None), (None, "x\n\n  <|endoftext|> y"), (1, "a b a")]


def test_ids_are_stored_in_two_bytes_where_they_fit(spark):
    assert tokens.width(queries.vocabulary()) == "<u2"
    assert tokens.width(queries.vocabulary(), 1 << 16) == "<u4"
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    tokenizer = Tokenizer.from_file(queries.vocabulary())
    expected = sorted([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in TEXTS)
    for dtype in ("<u2", "<u4"):
        got = tokens.tokenised(docs, queries.vocabulary(), 2, dtype).collect()
        assert sorted(np.frombuffer(bytes(r["ids"]), dtype).tolist() for r in got) == expected


def test_an_end_id_beyond_two_bytes_comes_back(spark, tmp_path):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    tokens.write(docs, str(tmp_path / "files"), queries.vocabulary(), end_id=70_000)
    got = tokens.read(spark, str(tmp_path / "files")).collect()
    assert len(got) == len(TEXTS) and all(np.frombuffer(bytes(r["ids"]), "<u4")[-1] == 70_000 for r in got)
