"""Byte-level BPE encoding and decoding with a given rank file.

Two tiers.  A minimal perfect hash, built once on the driver from the rank file and broadcast (its size is that of the
vocabulary), answers a pre-token that is itself in the vocabulary.  Every other pre-token is merged by rank with a heap
over linked byte positions.  A worker keeps the ids of text segments it has met in a cache of bounded size.

Defined results: a null text is encoded like an empty text (no ids); ids decode to the exact bytes of the text; rows
that repeat give repeated rows; an empty table gives an empty result; other columns of the input are kept as they are,
and ``out`` must be a new name.
"""

from __future__ import annotations

import base64
import heapq
import pickle
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.llm.common import column, ship

# Segments in each of the two generations of a worker's cache.
CACHE_ENTRIES = 100_000
# Texts longer than this are not remembered.
CACHE_CHARS = 64
# Keys that share a displacement, on average.
BUCKET = 2

# The white space of the pre-token pattern (Unicode White_Space), written out because Python's own classes differ.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A space before a character that is no white space always begins a pre-token.
SEGMENT = re.compile(f" (?=[^{SPACE}])")
ODD_SPACE = re.compile(f" (?:[{SPACE}]|$)")


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace: n keys in n slots.

    Buckets are placed from the largest; a bucket's seed sends all its keys to free slots, and a bucket of one key
    names its slot (as a negative number).
    """

    def __init__(self, keys: Sequence[bytes]) -> None:
        n = len(keys)
        self.slots = n
        self.buckets = max(1, n // BUCKET)
        self.seeds = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = array("I", bytes(4 * n))
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            groups[xxhash.xxh64_intdigest(key) % self.buckets].append(i)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        taken = bytearray(n)
        free = 0
        for b in order:
            group = groups[b]
            if len(group) > 1:
                seed = 1
                while True:
                    at = [xxhash.xxh64_intdigest(keys[i], seed) % n for i in group]
                    if len(set(at)) == len(at) and not any(taken[s] for s in at):
                        break
                    seed += 1
                self.seeds[b] = seed
            elif group:
                while taken[free]:
                    free += 1
                at = [free]
                self.seeds[b] = -1 - free
            else:
                continue
            for i, s in zip(group, at, strict=True):
                taken[s] = 1
                self.keys[s] = keys[i]
                self.values[s] = i

    def get(self, key: bytes) -> int:
        """The index of the key, or -1."""
        if not self.slots:
            return -1
        seed = self.seeds[xxhash.xxh64_intdigest(key) % self.buckets]
        slot = xxhash.xxh64_intdigest(key, seed) % self.slots if seed >= 0 else -1 - seed
        return self.values[slot] if self.keys[slot] == key else -1


class Model:
    """Ranks, the perfect hash over them, and the pre-token pattern; built once on the driver."""

    def __init__(self, rank_file: bytes, pattern: str) -> None:
        self.pattern = pattern
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        names = sorted(self.rank, key=self.rank.__getitem__)
        self.hash = PerfectHash(names)
        self.ids = [self.rank[x] for x in names]
        self.text: list[bytes | None] = [None] * (max(self.ids, default=-1) + 1)
        for x, i in self.rank.items():
            self.text[i] = x


class Segments(dict):
    """Ids of text segments as little-endian unsigned 32-bit integers, computed on first use.

    Two generations bound the memory: when the young one is full it becomes the old one, and entries that are asked
    for again come back from there.
    """

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.old: dict[str, bytes] = {}
        explicit = model.pattern.replace("[^\\s", f"[^{SPACE}").replace("\\S", f"[^{SPACE}]").replace("\\s", f"[{SPACE}]")
        self.find = regex.compile(explicit).findall

    def __missing__(self, segment: str) -> bytes:
        ids = self.old.get(segment)
        if ids is None:
            # One letter run, with or without the space before it, is one pre-token (tables agree below U+0250).
            word = segment[1:] if segment[:1] == " " else segment
            plain = word.isalpha() and (word.isascii() or max(word) < "\u0250")
            pieces = [segment] if plain else self.find(segment)
            if len(pieces) == 1:
                ids = little_endian(array("I", encode_piece(self.model, pieces[0].encode("utf-8"))))
            else:
                ids = b"".join([self[x] for x in pieces])
        if len(segment) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[segment] = ids
        return ids


def little_endian(ids: array) -> bytes:
    import sys

    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode_piece(model: Model, piece: bytes) -> list[int]:
    """Ids of one pre-token: the perfect hash first, then merges."""
    whole = model.hash.get(piece)
    if whole >= 0:
        return [model.ids[whole]]
    return merge(model.rank, piece)


def merge(rank: dict[bytes, int], piece: bytes) -> list[int]:
    """Merge the pair of least rank, the leftmost on ties, until no pair has a rank.

    Parts are linked by start positions.  A heap entry holds the rank above the start position in one integer, and
    counts only while the pair that starts there still has that rank.
    """
    n = len(piece)
    bits = n.bit_length()
    mask = (1 << bits) - 1
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    now = [rank.get(piece[i : i + 2], -1) for i in range(n)]
    now[-1] = -1
    heap = [r << bits | i for i, r in enumerate(now) if r >= 0]
    heapq.heapify(heap)
    pop, push, find = heapq.heappop, heapq.heappush, rank.get
    while heap:
        entry = pop(heap)
        i = entry & mask
        if now[i] != entry >> bits:
            continue
        gone = after[i]
        end = after[gone]
        now[gone] = -1
        after[i] = end
        if end < n:
            before[end] = i
            now[i] = r = find(piece[i : after[end]], -1)
            if r >= 0:
                push(heap, r << bits | i)
        else:
            now[i] = -1
        if i:
            p = before[i]
            now[p] = r = find(piece[p:end], -1)
            if r >= 0:
                push(heap, r << bits | p)
    out = []
    i = 0
    while i < n:
        end = after[i]
        out.append(rank[piece[i:end]])
        i = end
    return out


def encode_text(segments: Segments, text: str | None) -> bytes:
    """Ids of a whole text; segments begin at a space before a character that is no white space."""
    if not text:
        return b""
    parts = text.split(" ")
    if ODD_SPACE.search(text):
        parts = SEGMENT.split(text)
    lookup = segments.__getitem__
    return lookup(parts[0]) + b"".join(map(lookup, [" " + p for p in parts[1:]]))


def decode_ids(model: Model, ids: bytes | None) -> bytes | None:
    """The bytes that ids stand for."""
    if ids is None:
        return None
    held = array("I")
    held.frombytes(ids)
    import sys

    if sys.byteorder == "big":
        held.byteswap()
    return b"".join(map(model.text.__getitem__, held))


@lru_cache(maxsize=4)
def loaded(blob: bytes) -> tuple[Model, Segments]:
    """The model and the cache of one worker process."""
    model = pickle.loads(blob)
    return model, Segments(model)


@lru_cache(maxsize=4)
def built(path: str, pattern: str) -> bytes:
    with open(path, "rb") as f:
        return pickle.dumps(Model(f.read(), pattern))


def model_blob(path: str, pattern: str) -> bytes:
    """The pickled model of a rank file that the driver can open; executors need no copy of it."""
    return built(path, pattern)


def encoder(spark: SparkSession, path: str, pattern: str):
    """A column function: text -> ids as little-endian unsigned 32-bit integers."""
    ship(spark)
    blob = spark.sparkContext.broadcast(model_blob(path, pattern))

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, segments = loaded(blob.value)
        for texts in batches:
            yield pd.Series([encode_text(segments, t) for t in texts], dtype=object)

    return encode


def decoder(spark: SparkSession, path: str, pattern: str):
    """A column function: ids -> bytes."""
    ship(spark)
    blob = spark.sparkContext.broadcast(model_blob(path, pattern))

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, _ = loaded(blob.value)
        for ids in batches:
            yield pd.Series([decode_ids(model, x) for x in ids], dtype=object)

    return decode


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of every whole text."""
    return df.withColumn(out, encoder(df.sparkSession, path, pattern)(column(text).cast("string")))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded bytes of every id sequence; null ids give null."""
    return df.withColumn(out, decoder(df.sparkSession, path, pattern)(column(ids)))


def n_ids(ids: Column) -> Column:
    """Number of ids in a binary column."""
    return (F.octet_length(ids) / F.lit(4)).cast("long")
