"""Token counts against the library, text by text."""

import random

import public_tokenizers
import pytest
import sentencepiece

from zonelens.llm import token_counts as T

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    rng = random.Random(4)
    alphabet = ["a", "th", "ing", " ", " ", "  ", "\n", "\t", "é", "▁", "日本", "\x00", "<s>", "😀", "1", "ß", ".", "\r\n"]
    made = [None, "", " ", "\n", "▁", "a", " a", "a ", "<0x0A>", "x" * 3000, " " * 500, "the cat " * 400]
    return made + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(800)]


def test_sum_over_pre_tokens(model):
    assert T.usable(model)
    for text in texts():
        assert sum(T.count_each(model, T.pre_tokens(text))) == len(model.encode(text or "")), repr(text)


@pytest.mark.parametrize("frequent", [0, 5, 10**6])
def test_frame(spark, model, frequent, monkeypatch):
    monkeypatch.setattr(T, "HELD", 7)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts()[:200])] + [(None, "the cat", "y", 2), (3, "\n", "x", 1), (3, "\n", "x", 1), (2**60 + 1, "cat", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pre_token string, n int")
    got = sorted(map(str, T.count_tokens(docs, MODEL, frequent=frequent).collect()))
    want = [T_row(i, t, model) for i, t, _, _ in rows]
    assert got == sorted(want)


def T_row(i, t, model):
    from pyspark.sql import Row

    return str(Row(doc_id=i, n_bytes=len((t or "").encode()), n_tokens=len(model.encode(t or ""))))


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
