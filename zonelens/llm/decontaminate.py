"""Benchmark decontamination by greedy string tiling.

Texts are lower-case word tokens.  A seed is ``min_match`` tokens in a row, hashed by Karp-Rabin over token hashes.

1. The benchmark gives its seeds as a table, and a Bloom filter of a fixed number of bits over them, which is broadcast.
2. Every document keeps the stretches of tokens whose seeds pass the filter; a common substring of ``min_match`` tokens
   or more always lies inside such a stretch, so nothing that could match is lost.  Few documents keep any.
3. The kept seeds are joined with the benchmark's seeds.  A pair of document and item goes on only if the item's
   tokens under shared seeds could reach the threshold (tiles never cover more).
4. Each such pair is tiled: the longest run of tokens that is unmarked on both sides is marked, again and again, until
   no run of ``min_match`` is left.  Passages that were cut up and reordered are covered by several tiles.

A document is contaminated by an item if the tiles cover at least ``threshold`` of the item's tokens.

Defined results: null and empty texts and texts shorter than a seed are clean with coverage 0; so are all documents
against an item shorter than a seed, and against an empty benchmark; of equal coverages the least item id is named;
items that repeat act once each; repeated documents are judged each; an empty table gives an empty result; other
columns are never read (:func:`judge`) or kept as they are (:func:`clean`).
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import column, free_name, pick, ship, stage

MIN_MATCH = 4
THRESHOLD = 0.5
# Bits of the filter; a benchmark with more seeds than this is still answered exactly, only with more rows to join.
BLOOM_BITS = 1 << 25
# Tokens whose hashes a worker remembers before it starts anew.
REMEMBERED = 150_000
BASE = np.uint64(0x9E3779B97F4A7C15)
WORDS = re.compile(r"\w+")


def tokens_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


class TokenHashes(dict):
    """Token -> hash of 62 bits."""

    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = value = xxhash.xxh64_intdigest(token.encode("utf-8")) >> 2
        return value


def seed_hashes(tokens: list[str], hashes: TokenHashes, k: int) -> np.ndarray:
    """Karp-Rabin hash of every ``k`` tokens in a row, modulo 2**64."""
    if len(tokens) < k:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, tokens), np.int64, len(tokens)).astype(np.uint64)
    n = len(tokens) - k + 1
    rolled = values[:n].copy()
    for j in range(1, k):
        rolled *= BASE
        rolled += values[j : j + n]
    return rolled


def places(seeds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that a seed sets."""
    mask = np.uint64(bits - 1)
    mixed = seeds * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(32)) & mask, (mixed ^ (seeds >> np.uint64(29))) & mask


def tile(item: list[str], stretches: list[list[str]], min_match: int) -> list[tuple[int, int, int, int]]:
    """Greedy string tiling: (item start, stretch, start in it, length) of every tile, the longest first.

    Matches are found through a table of the Karp-Rabin hashes of the item's windows, checked token by token and
    extended to both sides.  Of equal lengths the first in the item goes first, then the first in the text.
    """
    if len(item) < min_match:
        return []
    hashes = TokenHashes()
    table = defaultdict(list)
    for i, h in enumerate(seed_hashes(item, hashes, min_match).tolist()):
        table[h].append(i)
    heap = []
    for s, words in enumerate(stretches):
        for t, h in enumerate(seed_hashes(words, hashes, min_match).tolist()):
            for i in table.get(h, ()):
                if i and t and item[i - 1] == words[t - 1] or item[i : i + min_match] != words[t : t + min_match]:
                    continue  # the run began earlier, or only the hashes agree
                n = min_match
                while i + n < len(item) and t + n < len(words) and item[i + n] == words[t + n]:
                    n += 1
                heap.append((-n, i, s, t))
    heapq.heapify(heap)
    used = bytearray(len(item))
    taken = [bytearray(len(words)) for words in stretches]
    tiles = []
    while heap:
        n, i, s, t = heapq.heappop(heap)
        n = -n
        free = [not (used[i + j] or taken[s][t + j]) for j in range(n)]
        if all(free):
            tiles.append((i, s, t, n))
            used[i : i + n] = b"\x01" * n
            taken[s][t : t + n] = b"\x01" * n
            continue
        j = 0
        while j < n:  # what is left of an occluded match competes by its own length
            if not free[j]:
                j += 1
                continue
            end = j
            while end < n and free[end]:
                end += 1
            if end - j >= min_match:
                heapq.heappush(heap, (j - end, i + j, s, t + j))
            j = end
    return tiles


def coverage(item: list[str], stretches: list[list[str]], min_match: int = MIN_MATCH) -> float:
    return sum(t[3] for t in tile(item, stretches, min_match)) / len(item) if item else 0.0


def benchmark_items(benchmark: DataFrame, item_id: str, text: str, min_match: int) -> DataFrame:
    """item, item_id, words, seeds: the items long enough for a seed, written once so that their keys stay."""

    @F.pandas_udf("words string, n int, seeds array<long>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = TokenHashes()
        for texts in batches:
            rows = []
            for t in texts:
                words = tokens_of(t)
                rows.append((" ".join(words), len(words), seed_hashes(words, hashes, min_match).view(np.int64)))
            yield pd.DataFrame(rows, columns=["words", "n", "seeds"])

    rows = pick(benchmark, item_id=item_id, text=text).select("item_id", split(F.col("text").cast("string")).alias("s"))
    keyed = rows.select(F.monotonically_increasing_id().alias("item"), "item_id", "s.words", "s.n", "s.seeds")
    return stage(keyed, "benchmark-items").filter(F.col("n") >= min_match)


def bloom(items: DataFrame, bits: int) -> bytes:
    """The filter over all seeds; at most 16 filters of that size reach the driver."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for seeds in batch["seeds"]:
                for at in places(np.asarray(seeds, np.int64).view(np.uint64), bits):
                    np.bitwise_or.at(held, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
        yield pd.DataFrame({"bits": [held.tobytes()]})

    total = np.zeros(bits // 8, np.uint8)
    for row in items.select("seeds").coalesce(16).mapInPandas(build, "bits binary").toLocalIterator():
        total |= np.frombuffer(row["bits"], np.uint8)
    return total.tobytes()


def with_stretches(df: DataFrame, filter_bits: bytes, text: str, out: str, min_match: int) -> DataFrame:
    """Add a struct: the stretches of tokens whose seeds pass the filter, and their distinct seeds; null for none."""
    bits = len(filter_bits) * 8
    shared = df.sparkSession.sparkContext.broadcast(filter_bits)

    @F.pandas_udf("stretches array<string>, seeds array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = np.frombuffer(shared.value, np.uint8)
        hashes = TokenHashes()
        for texts in batches:
            rows = []
            for t in texts:
                words = tokens_of(t)
                seeds = seed_hashes(words, hashes, min_match)
                first, second = places(seeds, bits)
                at = np.flatnonzero(held[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8) & 1)
                at = at[(held[second[at] >> np.uint64(3)] >> (second[at] & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
                if not len(at):
                    rows.append((None, None))
                    continue
                # Seeds that start within one another's reach make one stretch.
                cuts = np.flatnonzero(np.diff(at) > 1) + 1
                parts = [" ".join(words[p[0] : p[-1] + min_match]) for p in np.split(at, cuts)]
                rows.append((parts, np.unique(seeds[at]).view(np.int64)))
            yield pd.DataFrame(rows, columns=["stretches", "seeds"])

    return df.withColumn(out, run(column(text).cast("string")))


def reachable(positions: Column, k: int) -> Column:
    """Number of an item's tokens under the seeds that start at the sorted positions."""
    steps = F.transform(positions, lambda p, i: F.least(F.lit(k), F.coalesce(F.get(positions, i + 1) - p, F.lit(k))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def matches(kept: DataFrame, items: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """key, item_id, coverage of every pair that reaches the threshold.

    ``kept`` has key, stretches, seeds.  Seeds that very many documents share are one key of the join; the small
    benchmark side lets the adaptive plan broadcast it or split the large side.
    """
    seeds = items.select("item", "n", F.posexplode("seeds").alias("at", "seed"))
    shared = kept.select("key", F.explode("seeds").alias("seed")).join(seeds, "seed")
    pairs = shared.groupBy("key", "item").agg(F.max("n").alias("n"), F.sort_array(F.collect_set("at")).alias("starts"))
    pairs = pairs.filter(reachable(F.col("starts"), min_match) >= F.col("n") * threshold).select("key", "item")
    full = pairs.join(items.select("item", "item_id", "words"), "item").join(kept.select("key", "stretches"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, stretches = batch.column("words").to_pylist(), batch.column("stretches").to_pylist()
            found = [coverage(w.split(" "), [s.split(" ") for s in parts], min_match) for w, parts in zip(words, stretches, strict=True)]
            names = ["key", "item_id", "coverage"]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("item_id"), pa.array(found, pa.float64())], names)

    kind = items.schema["item_id"].dataType.simpleString()
    tiled = full.select("key", "item_id", "words", "stretches").mapInArrow(run, f"key long, item_id {kind}, coverage double")
    return tiled.filter(F.col("coverage") >= threshold)


def best_of(found: DataFrame) -> DataFrame:
    """One row of each document: its highest coverage, and the least item id that has it."""
    order = F.struct(-F.col("coverage"), F.col("item_id").isNull(), F.col("item_id"))
    chosen = F.min(order)
    return found.groupBy("key").agg((-chosen["col1"]).alias("coverage"), chosen["item_id"].alias("item_id"), F.count("*").alias("n_items"))


def judge(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    min_match: int = MIN_MATCH, threshold: float = THRESHOLD, bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """doc_id, contaminated, coverage, item_id (null if clean), n_items for every document."""
    ship(docs.sparkSession)
    items = benchmark_items(benchmark, item_id, item_text, min_match)
    narrow = pick(docs, id=doc_id, text=text).withColumn("key", F.monotonically_increasing_id())
    seen = with_stretches(narrow, bloom(items, bloom_bits), "text", "s", min_match).select("key", "id", "s.stretches", "s.seeds")
    seen = stage(seen, "decontaminate-docs")
    found = best_of(matches(seen.filter("seeds IS NOT NULL"), items, min_match, threshold))
    joined = seen.select("key", "id").join(found, "key", "left")
    return joined.select(
        F.col("id").alias(doc_id),
        F.col("coverage").isNotNull().alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        "item_id",
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
    )


def clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    min_match: int = MIN_MATCH, threshold: float = THRESHOLD, bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """The rows of ``docs`` that no item contaminates."""
    ship(docs.sparkSession)
    items = benchmark_items(benchmark, item_id, item_text, min_match)
    key, held = free_name(docs, "decontaminate_key"), free_name(docs, "decontaminate_seen")
    keyed = docs.withColumn(key, F.monotonically_increasing_id())
    seen = stage(with_stretches(keyed, bloom(items, bloom_bits), text, held, min_match), "decontaminate-docs")
    kept = seen.filter(F.col(held)["seeds"].isNotNull()).select(F.col(key).alias("key"), F.col(held)["stretches"].alias("stretches"), F.col(held)["seeds"].alias("seeds"))
    found = matches(kept, items, min_match, threshold).select(F.col("key").alias(key)).distinct()
    # Only rows with stretches can be contaminated; the others are not shuffled.
    untouched = seen.filter(F.col(held)["seeds"].isNull())
    passed = seen.filter(F.col(held)["seeds"].isNotNull()).join(found, key, "left_anti")
    names = [column(c) for c in docs.columns]
    return untouched.select(*names).unionByName(passed.select(*names))
