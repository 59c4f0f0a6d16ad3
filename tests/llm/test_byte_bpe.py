"""Byte-level BPE against the library of the rank file, and round trips."""

import base64
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from zonelens.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def model():
    return byte_bpe.loaded(byte_bpe.model_blob(PATH, PATTERN))


def ids_of(segments, text):
    held = array("I")
    held.frombytes(byte_bpe.encode_text(segments, text))
    return held.tolist()


def test_perfect_hash_is_minimal_and_rejects_other_keys():
    keys = [f"key{i}".encode() for i in range(5000)] + [b"", b"\x00"]
    table = byte_bpe.PerfectHash(keys)
    assert [table.get(k) for k in keys] == list(range(len(keys)))
    assert table.slots == len(keys) and None not in table.keys
    assert table.get(b"no such key") == -1 and byte_bpe.PerfectHash([]).get(b"x") == -1


def test_equal_to_the_library(model, library):
    rng = random.Random(5)
    alphabet = "ab cdé's  \n\t  ß1２'llve### \x1c\x85 　日本😀"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16)))
        assert ids_of(model[1], text) == library.encode_ordinary(text), text
    for text in ["<|endoftext|>", "x" * 30000, " " * 5000, "thth" * 5000, "\n\n \n a  b"]:
        assert ids_of(model[1], text) == library.encode_ordinary(text)


def test_every_low_code_point(model, library):
    for point in [*range(0x0, 0x3100), 0xFFFD, 0x1F600]:
        if not 0xD800 <= point < 0xE000:
            c = chr(point)
            text = f"a{c}{c} {c}b  {c}1 "
            assert ids_of(model[1], text) == library.encode_ordinary(text), hex(point)


def test_full_cache_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 3)
    segments = byte_bpe.Segments(model[0])
    text = "one two three four five one six two seven one, two."
    for _ in range(3):
        assert ids_of(segments, text) == library.encode_ordinary(text)


def test_frame_round_trip_and_edge_rows(spark, library):
    texts = [None, "", "Hello  wörld\n", "Hello  wörld\n", "日本\x00 <|endoftext|>"]
    docs = spark.createDataFrame([(i, t, b"z") for i, t in enumerate(texts)], "doc_id long, text string, decoded_sha256 binary")
    both = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    for row in both.withColumn("n", byte_bpe.n_ids(F.col("ids"))).collect():
        want = library.encode_ordinary(row["text"] or "")
        assert array("I", want).tobytes() == bytes(row["ids"]) and row["n"] == len(want)
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert byte_bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0
    null = spark.createDataFrame([(None,)], "ids binary")
    assert byte_bpe.decode(null, PATH, PATTERN).first()["decoded"] is None
