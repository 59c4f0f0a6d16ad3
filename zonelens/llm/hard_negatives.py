"""Hard negatives of anchors, by Strassen products of integer tiles and mergeable heaps.

Vectors become integers (floor of ``scale`` times the component).  Anchors are taken in blocks of a fixed number of rows,
and every block goes to all candidates: the anchors' block is broadcast, each task reads its own candidates once, cuts
them into tiles, and multiplies anchor tile by candidate tile with Strassen's recursion on int64 matrices, padded with
zeros to even sizes.  Integer sums wrap modulo 2**64, so the recursion gives the exact product wherever the product
itself fits, which a bound on the norms makes sure of.

First pass: every task merges its tiles into one heap of positives per anchor (the best rows of the anchor's label), and
the tasks' heaps are merged into the best ones of all.  Second pass: per anchor and positive, a heap of the best
rows of other labels whose score lies in the window from ``low`` to ``high`` percent of the positive's score.  A heap
holds a fixed number of entries, so neither tasks nor shuffle nor driver see more than that per anchor and positive.

Better scores come first, of equal ones the smaller id.  Defined results: rows with a null id or label, a null
vector, or any null or not finite component take no part; vectors of different lengths are padded with zeros; repeated rows take part each
(a row never is its own positive, a copy of it may be); an anchor without positives, and an empty table, give no rows; other
columns are never read.  Vectors with an integer norm of ``MOST_NORM`` or more are an error, since products might not fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonelens.llm.common import column, ship, stage

SCALE = 256
KEPT = 5
LOW, HIGH = 80, 100
# Anchors that are broadcast at once, anchors of a tile and candidates of a tile.
BLOCK, TILE_ANCHORS, TILE_ROWS = 8192, 256, 2048
# Sides up to which a product is taken directly.
LEAF = 8
# Scores stay below 2**50, so that 100 times a score, and a score with a place in its tile, fit 64 bits.
MOST_NORM = 1 << 25
LOWEST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, modulo 2**64; odd sides are padded with zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    i, j, h = m // 2, n // 2, k // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b12, b21, b22 = b[:h, :j], b[:h, j:], b[h:, :j], b[h:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The best ``kept`` (score, id) of each of ``n`` lists, the best first; empty places have the lowest score."""

    def __init__(self, n: int, kept: int):
        self.scores, self.ids = np.full((n, kept), LOWEST, np.int64), np.zeros((n, kept), np.int64)

    def merge(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge entries into the lists numbered ``at``, one row of entries for each."""
        kept = self.scores.shape[1]
        scores, ids = np.hstack([self.scores[at], scores]), np.hstack([self.ids[at], ids])
        down = np.where(scores == LOWEST, np.iinfo(np.int64).max, -scores)
        order = np.lexsort((ids, down), axis=1)[:, :kept]
        self.scores[at], self.ids[at] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)

    def rows(self) -> tuple[np.ndarray, ...]:
        """list, score, id of every entry."""
        at, place = np.nonzero(self.scores != LOWEST)
        return at, self.scores[at, place], self.ids[at, place]


def best_of_tile(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a tile the best allowed (score, id); the tile's columns go up by id."""
    width = scores.shape[1]
    places = width - 1 - np.arange(width)
    # One number per entry: the score, then the smaller column first.
    keys = np.where(allowed, scores * width + places, LOWEST)
    kept = min(kept, width)
    top = np.partition(keys, width - kept, axis=1)[:, width - kept :]
    empty = top == LOWEST
    return np.where(empty, LOWEST, top // width), ids[width - 1 - np.where(empty, 0, top) % width]


def rows_that_count(df: DataFrame, vec_id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """row, id, label and the integer vector of the rows that take part."""
    vec = F.transform(column(vector), lambda x: x.cast("double"))
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    found = df.select(column(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), vec.alias("vec"))
    found = found.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(good, F.lit(False)))
    whole = F.transform("vec", lambda x: F.floor(x * scale).cast("long"))
    norm = F.aggregate(F.transform("vec", lambda x: F.floor(x * scale).cast("double")), F.lit(0.0), lambda s, x: s + x * x)
    fits = F.when(norm < float(MOST_NORM) ** 2, whole).otherwise(F.raise_error(F.lit("vector too large for exact 64-bit products")).cast("array<long>"))
    numbered = found.select(F.monotonically_increasing_id().alias("row"), "id", "label", fits.alias("vec"))
    numbered = stage(numbered, "negatives-rows")
    widths = numbered.agg(F.min(F.size("vec")).alias("least"), F.max(F.size("vec")).alias("most")).first()
    if widths["least"] == widths["most"]:
        return numbered
    return numbered.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(widths["most"]) - F.size("vec"))))


def matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1), np.int64)


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """row, id, label and vectors of the candidates, in tiles whose ids go up."""
    for batch in batches:
        row, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "label"))
        vectors = matrix(batch.column("vec"))
        for at in range(0, len(ids), TILE_ROWS):
            part = slice(at, at + TILE_ROWS)
            order = np.argsort(ids[part], kind="stable")
            yield row[part][order], ids[part][order], labels[part][order], np.ascontiguousarray(vectors[part][order].T)


def merged(parts: DataFrame, keys: list[str], kept: int) -> DataFrame:
    """The best of all tasks' heaps, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return parts.withColumn("rank", rank).filter(F.col("rank") <= kept)


def block_positives(rows: DataFrame, block: tuple[np.ndarray, ...], kept: int) -> DataFrame:
    """anchor (place in the block), rank, score, id of the best rows of each anchor's label."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_row, _, a_label, a_vec = sent.value
        heaps = Heaps(len(a_row), kept)
        for row, ids, labels, vectors in tiles(batches):
            for at in range(0, len(a_row), TILE_ANCHORS):
                some = slice(at, at + TILE_ANCHORS)
                scores = strassen(a_vec[some], vectors)
                allowed = (a_label[some, None] == labels) & (a_row[some, None] != row)
                heaps.merge(np.arange(at, at + len(scores)), *best_of_tile(scores, allowed, ids, kept))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, heaps.rows())), ["anchor", "score", "id"])

    return merged(rows.mapInArrow(search, "anchor long, score long, id long"), ["anchor"], kept)


def block_negatives(rows: DataFrame, block: tuple[np.ndarray, ...], positives: tuple[np.ndarray, ...], kept: int, low: int, high: int) -> DataFrame:
    """pair (place among the positives), rank, score, id of the best rows in each positive's window.

    ``positives`` has the anchor's place and the score of each pair.
    """
    sent = rows.sparkSession.sparkContext.broadcast((block, positives))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (_, _, a_label, a_vec), (of, limit) = sent.value
        heaps = Heaps(len(of), kept)
        for _, ids, labels, vectors in tiles(batches):
            for at in range(0, len(a_label), TILE_ANCHORS):
                some = slice(at, at + TILE_ANCHORS)
                scores = strassen(a_vec[some], vectors)
                other = a_label[some, None] != labels
                pairs = np.flatnonzero((of >= at) & (of < at + len(scores)))
                for first in range(0, len(pairs), TILE_ANCHORS):
                    few = pairs[first : first + TILE_ANCHORS]
                    own, top = scores[of[few] - at], limit[few, None]
                    allowed = other[of[few] - at] & (100 * own <= high * top) & (100 * own >= low * top)
                    heaps.merge(few, *best_of_tile(own, allowed, ids, kept))
        yield pa.RecordBatch.from_arrays(list(map(pa.array, heaps.rows())), ["pair", "score", "id"])

    return merged(rows.mapInArrow(search, "pair long, score long, id long"), ["pair"], kept)


def mine(
    df: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None,
    positives: int = KEPT, negatives: int = KEPT, low: int = LOW, high: int = HIGH, scale: int = SCALE, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, and positive_rank.

    ``anchors`` is a condition on the column ``id``; ``label`` the column of labels, ``label`` of the frame unless given.
    """
    spark = df.sparkSession
    ship(spark)
    rows = rows_that_count(df, vec_id, vector, column("label") if label is None else label, scale)
    chosen = rows.filter(F.coalesce(anchors, F.lit(False))).repartition("row").sortWithinPartitions("row")
    chosen = stage(chosen.withColumn("place", F.monotonically_increasing_id()), "negatives-anchors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    out = None
    for lower, upper in block_bounds(chosen, block):
        part = chosen.filter((F.col("place") >= lower) & (F.col("place") <= upper)).select("row", "id", "label", "vec").toArrow()  # at most ``block``
        part = part.combine_chunks()
        a_row, a_id, a_label = (part.column(c).to_numpy() for c in ("row", "id", "label"))
        vectors = part.column("vec").combine_chunks()
        anchor_block = (a_row, a_id, a_label, matrix(vectors))
        best = block_positives(rows, anchor_block, positives).toArrow()  # at most ``positives`` for each anchor
        of, p_rank, p_score, p_id = (best.column(c).to_numpy() for c in ("anchor", "rank", "score", "id"))
        found = block_negatives(rows, anchor_block, (of, p_score), negatives, low, high)
        pairs = spark.createDataFrame(
            pa.table({"pair": np.arange(len(of)), "anchor_id": a_id[of], "positive_id": p_id, "positive_score": p_score, "positive_rank": p_rank}),
            "pair long, anchor_id long, positive_id long, positive_score long, positive_rank int",
        )
        named = found.join(pairs, "pair").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), "positive_rank"
        )
        named = stage(named, "negatives-found")
        out = named if out is None else out.unionByName(named)
    return spark.createDataFrame([], schema) if out is None else out


def block_bounds(chosen: DataFrame, block: int) -> list[tuple[int, int]]:
    """Ranges of places with at most ``block`` anchors each; only counts of partitions come to the driver."""
    runs = chosen.groupBy(F.shiftright("place", 33).alias("run")).agg(F.count("*").alias("n")).orderBy("run").collect()
    bounds: list[tuple[int, int]] = []
    room = 0
    for run, n in ((r["run"] << 33, r["n"]) for r in runs):
        at = 0
        while at < n:
            if not room:
                bounds.append((run + at, run + at))
                room = block
            taken = min(room, n - at)
            bounds[-1] = (bounds[-1][0], run + at + taken - 1)
            room, at = room - taken, at + taken
    return bounds
