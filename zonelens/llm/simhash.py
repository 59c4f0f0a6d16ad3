"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments.  Two fingerprints that differ in at most ``distance`` bits agree, in some segment,
up to ``distance // segments`` bits.  So every distinct fingerprint looks up, for each segment, the small Hamming ball
around its own segment value in a table of all segment values, and complete distances verify what is found.  Copies
share one fingerprint and are never paired.

A segment value that more than ``crowded`` distinct fingerprints share is left out of the lookup, since pairs there
would grow with the square of its size.  The fingerprints in it, and those whose balls reach it, are linked exactly by
midpoints instead: two fingerprints are within ``distance`` if and only if some 64-bit value is within half of it from
one and within the rest from the other, so fingerprints that name the same midpoint are linked to the least of them,
in rows that grow linearly.

Defined results: null and empty texts, and texts of white space, have fingerprint zero and are linked like any other;
fewer than ``shingle`` words make one shingle; repeated rows stay; a component's id is the least id that is not null in
it (null if it has none); an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import column, free_name, pick, ship, stage
from zonelens.llm.components import least_members

SEED = 42
BITS = 64
# Shingles whose bits are counted at once.
BLOCK = 1 << 15
# Distinct fingerprints that may share a segment value before midpoints replace the lookup.
CROWDED = 4096


def fingerprint_of(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and the white space of ASCII
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 4) -> DataFrame:
    """Add the fingerprint of every whole text as a bigint; all other columns stay."""
    ship(df.sparkSession)

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return df.withColumn(out, fingerprints(column(text).cast("string")))


def hex_of(fingerprint: Column) -> Column:
    """16 lower-case hex digits of the unsigned value."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def segments_of(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; the widths differ by one at most and cover all bits."""
    ends = [BITS * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def segment_value(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(signed((1 << width) - 1)).cast("long"))


def masks(values: list[int]) -> Column:
    return F.array(*[F.lit(signed(v)).cast("long") for v in values])


def links(fps: DataFrame, distance: int = 4, segments: int | None = None, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between distinct fingerprints: every pair within ``distance``, except that pairs met only in a
    crowded segment value are linked through the least fingerprint of a shared midpoint.

    ``fps`` has one column ``fp`` of distinct values.  ``segments`` follows their number unless given, so that a
    segment has more values than there are fingerprints for each; the links mean the same either way.
    """
    if segments is None:
        segments = 3 if fps.count() < 1 << 24 else 2
    cuts = segments_of(segments)
    radius = distance // segments
    entries = F.array(*[F.struct(F.lit(s).alias("s"), segment_value(F.col("fp"), *c).alias("key")) for s, c in enumerate(cuts)])
    table = fps.select("fp", F.inline(entries))
    full = stage(table.groupBy("s", "key").agg(F.count("*").alias("n")).filter(F.col("n") > crowded), "simhash-crowded")
    widths = [width for _, width in cuts]
    narrow, wide = (masks(ball(w, radius)) for w in (min(widths), max(widths)))
    is_wide = F.col("s").isin([s for s, w in enumerate(widths) if w == max(widths)])
    around = table.select(F.col("fp").alias("a"), "s", "key", F.explode(F.when(is_wide, wide).otherwise(narrow)).alias("mask"))
    probes = around.select("a", "s", F.col("key").bitwiseXOR(F.col("mask")).alias("key"))
    within = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    targets = table.withColumnRenamed("fp", "b")
    some_full = not full.isEmpty()
    if some_full:
        targets = targets.join(full, ["s", "key"], "left_anti")
    # Estimates do not see how many rows a ball has, so the side of the balls must never be taken for a small one.
    found = probes.hint("merge").join(targets, ["s", "key"]).filter((F.col("a") < F.col("b")) & within).select("a", "b")
    if some_full:
        near = probes.hint("merge").join(full, ["s", "key"], "left_semi").select(F.col("a").alias("fp")).distinct()
        found = found.unionByName(midpoint_links(near, distance))
    return found.distinct()


def midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) from every fingerprint to the least one that shares a midpoint with it."""
    # An odd distance needs one side to reach one bit further; the side is told by a flag in the key.
    near, far = distance // 2, distance - distance // 2

    def points(radius: int) -> DataFrame:
        around = fps.select("fp", F.explode(masks(ball(BITS, radius))).alias("mask"))
        return around.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))

    reach = stage(points(far), "simhash-midpoints")
    if near == far:
        least = reach.groupBy("point").agg(F.min("fp").alias("a"))
        pairs = reach.hint("merge").join(least, "point")
        return pairs.filter(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b")).distinct()
    least = points(near).groupBy("point").agg(F.min("fp").alias("m"))
    pairs = reach.hint("merge").join(least, "point").filter(F.col("m") != F.col("fp"))
    return pairs.select(F.least("m", "fp").alias("a"), F.greatest("m", "fp").alias("b")).distinct()


def components(marked: DataFrame, distance: int = 4, segments: int | None = None, crowded: int = CROWDED) -> DataFrame:
    """Component of every distinct fingerprint: fp, component_id (the least id in it), component_fp (its least fp).

    ``marked`` has the columns id and fp.
    """
    fps = stage(marked.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    edges = stage(links(fps.select("fp"), distance, segments, crowded), "simhash-links")
    member = least_members(edges)  # node, component
    joined = fps.join(member, fps.fp == member.node, "left").select("fp", "least_id", F.coalesce("component", "fp").alias("component_fp"))
    least = joined.groupBy("component_fp").agg(F.min("least_id").alias("component_id"))
    # Most components are a single fingerprint; both sides keep the partitioning on the component.
    return joined.join(least, "component_fp").select("fp", "component_id", "component_fp")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4, shingle: int = 4, segments: int | None = None, crowded: int = CROWDED,
) -> DataFrame:
    """doc_id, fingerprint (bigint), component_id for every document."""
    marked = stage(with_fingerprint(pick(docs, id=doc_id, text=text), out="fp", shingle=shingle).select("id", "fp"), "simhash-marked")
    found = components(marked, distance, segments, crowded)
    return marked.join(found, "fp").select(F.col("id").alias(doc_id), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs``, one of each component: the one with the least id.

    Where several rows have that id (or no row has an id), one of them stays.  Rows are chosen by a number of their own
    and their narrow columns, so the texts are shuffled once at most.
    """
    fp, row = (free_name(docs, x) for x in ("fp", "row"))
    # The written table holds the numbers, so a task that runs again finds the same ones.
    marked = stage(with_fingerprint(docs, text, fp, shingle).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    ids = marked.select(column(row).alias("row"), column(doc_id).alias("id"), column(fp).alias("fp"))
    found = components(ids.select("id", "fp"), distance)
    least = ids.join(found, "fp").filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = least.groupBy("component_fp").agg(F.min("row").alias(row)).select(row)
    return marked.join(chosen, row, "left_semi").select(*map(column, docs.columns))
