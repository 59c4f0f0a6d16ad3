"""Resampling towards a target distribution by importance weights, with exact ranks from a parallel sort.

1. Hashed features (runs of 1 to ``longest`` words, repeats counted) of all documents and of all target texts are
   counted into ``buckets`` buckets; every task gives one array of counts per partition, which are added up.
2. A bucket's gain compares both shares; a document's weight is the floored mean of its features' gains, looked up in
   one array.  Noise from a hash of the id is added to the weight (Gumbel noise, so that the highest scores are a
   sample without replacement), and the highest scores are drawn.
3. Scores are ranked by parallel sorting by regular sampling: every partition sorts its own run and gives regular
   samples of it; regular members of the sorted samples split all rows into segments; segments are exchanged and put in
   order where they arrive; the counts of the segments before give every row its exact rank.  No segment gets more than
   twice its share, however often a score occurs, since rows are told apart by id and row number as well.

Defined results: null and empty texts, and texts without words, have no features and weight 0; a null id is hashed as
an empty text and comes after all other ids; repeated rows count and are ranked each; ties go to the smaller id;
an empty target, and an empty table, only leave the smoothing terms; whole texts are read, of any length, one at a time;
other columns are never read (:func:`ranked`) or kept as they are (:func:`resample`).
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonelens.llm.common import column, free_name, ship, stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Words or runs whose buckets a worker remembers before it starts anew.
REMEMBERED = 200_000
# Words that are turned into features at once, whatever the length of the text.
BLOCK = 1 << 16
# Runs of the parallel sort; at most the square of this number of samples comes to the driver.
RUNS = 64
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


class Buckets(dict):
    """UTF-8 feature -> its bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = value = zlib.crc32(feature) % self.buckets
        return value


def feature_buckets(text: str | None, longest: int, known: Buckets) -> Iterator[np.ndarray]:
    """The buckets of all features of a text in blocks, in the order of their first words."""
    held: list[bytes] = []

    def block(last: bool) -> np.ndarray:
        n = len(held) if last else len(held) - longest + 1
        grams = list(map(known.__getitem__, held[:n]))
        for size in range(2, longest + 1):
            grams += [known[b" ".join(held[i : i + size])] for i in range(min(n, len(held) - size + 1))]
        del held[:n]
        return np.array(grams, np.int64)

    for m in WORDS.finditer((text or "").encode("utf-8").lower()):  # bytes: only A-Z change
        held.append(m[0])
        if len(held) >= BLOCK + longest:
            yield block(False)
    yield block(True)


def bucket_counts(df: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket; what comes back has one number per bucket."""
    ship(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for found in feature_buckets(value.as_py(), longest, known):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = df.select(column(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of the target's smoothed share over the source's), in doubles."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = (t + 1.0) * (s.sum() + n) / ((s + 1.0) * (t.sum() + n))
    return np.array([math.floor(1000.0 * math.log(x)) for x in ratio], np.int64)


def noise(doc_id: str, seed: int) -> int:
    """floor(1000 times a Gumbel value) from the hash of an id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0)))


def scored(df: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """Add n_words, n_features, weight and score to the columns id and text, and drop the text."""
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(gain)
    keep = [f for f in df.schema.fields if f.name != "text"]
    names = [f.name for f in keep]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = Buckets(len(sent.value)), sent.value
        for batch in batches:
            out = []
            for text, doc_id in zip(batch.column("text"), batch.column("as_text"), strict=True):
                total = n = 0
                for found in feature_buckets(text.as_py(), longest, known):
                    total += int(gain[found].sum())
                    n += len(found)
                # n words give n + (n-1) + ... features, so the number of words follows from theirs.
                words = next(w for w in range(n // longest, n + 1) if sum(max(0, w - k) for k in range(longest)) == n)
                weight = total // n if n else 0
                out.append((words, n, weight, weight + noise(doc_id.as_py() or "", seed)))
            added = [pa.array([row[k] for row in out], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in names] + added, [*names, "n_words", "n_features", "weight", "score"])

    with_id = df.withColumn("as_text", F.col("id").cast("string"))
    return with_id.mapInArrow(score, f"{kinds}, n_words long, n_features long, weight long, score long")


def sort_ranks(rows: DataFrame, order: list[str], runs: int = RUNS) -> DataFrame:
    """Add ``rank`` (1, 2, 3 ...) by the columns of ``order``, all ascending, nulls last; a parallel sort by regular sampling.

    The columns of ``order`` must tell all rows apart and be comparable in Python.
    """
    key = [F.col(c).asc_nulls_last() for c in order]
    place = F.monotonically_increasing_id()
    sorted_runs = rows.repartition(runs, order[-1]).sortWithinPartitions(*key).withColumn("__at", place)
    sorted_runs = stage(sorted_runs, "importance-runs")
    run, at = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted_runs.groupBy(run.alias("run")).agg(F.count("*").alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / runs)).cast("long")
    regular = sorted_runs.withColumns({"run": run, "at": at}).join(F.broadcast(sizes), "run").filter(F.col("at") % step == 0)

    def comparable(row: tuple) -> tuple:
        return tuple((v is None, 0 if v is None else v) for v in row)

    samples = sorted(comparable(tuple(r)) for r in regular.select(*order).collect())  # about the square of ``runs``
    splitters = [samples[len(samples) * k // runs] for k in range(1, runs)] if samples else []
    sent = rows.sparkSession.sparkContext.broadcast(splitters)
    plain = sorted_runs.drop("__at")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields) + ", __segment int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in order), strict=True)
            found = [bisect_right(sent.value, tuple((v is None, 0 if v is None else v) for v in row)) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "__segment"])

    exchanged = plain.mapInArrow(cut, kinds).repartitionById(runs, F.col("__segment"))
    merged = stage(exchanged.sortWithinPartitions("__segment", *key).withColumn("__at", place), "importance-segments")
    per_segment = merged.groupBy("__segment").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    # One row per segment, at most ``runs`` of them.
    before = F.coalesce(F.sum("n").over(Window.orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_segment.select("__segment", (before - F.col("first") + 1).alias("__offset"))
    return merged.join(F.broadcast(offsets), "__segment").withColumn("rank", F.col("__at") + F.col("__offset")).drop("__segment", "__at", "__offset")


def weighed(
    docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", longest: int = 1, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, runs: int = RUNS, more: tuple[str, ...] = (),
) -> DataFrame:
    """id, the columns ``more`` of ``docs``, n_words, n_features, weight, score, and rank (null if not drawn)."""
    narrow = docs.select(column(doc_id).alias("id"), *map(column, more), column(text).cast("string").alias("text"))
    gain = gains(bucket_counts(narrow, "text", longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = scored(narrow, gain, longest, seed).withColumn("__row", F.monotonically_increasing_id())
    rows = stage(rows, "importance-scores")
    enough = F.col("n_words") >= least_words
    candidates = rows.filter(enough).withColumn("__down", -F.col("score"))
    drawn = percent * candidates.count() // 100
    placed = sort_ranks(candidates, ["__down", "id", "__row"], runs).drop("__down", "__row")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(rows.filter(~enough).drop("__row").withColumn("rank", F.lit(None).cast("long")))


def ranked(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; the settings are those of :func:`weighed`."""
    return weighed(docs, target, doc_id, **settings).withColumnRenamed("id", doc_id)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; of rows with one id, as many as were drawn of it."""
    row = free_name(docs, "row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "importance-docs")
    found = weighed(numbered, target, doc_id, text, more=(row,), **settings)
    return numbered.join(found.filter(F.col("rank").isNotNull()).select(row), row, "left_semi").select(*map(column, docs.columns))
