"""Exact Jaccard self-join of shingle sets by a grouped prefix join.

1. A document becomes the set of its distinct shingles, hashed to 64 bits.  Documents with equal sets are one class.
2. Shingles are ordered by the count of their hash bucket over all documents, rare ones first.  The prefix of a class
   is the start of its ordered set: two sets that link always share a shingle there.  Classes with the same prefix and
   size form one group, and only groups have postings.
3. Groups that share a prefix shingle are paired if their sizes and the places of the shingle leave room for enough
   overlap.  Pairs are expanded to classes, thinned by parity bitmaps (which can only overestimate the overlap), and the
   rest is verified on complete sets, which are made from the texts of just those classes.

Crowded postings are worked off in rounds, so that no group's pairs are all written out.  In a round the first
``pivots`` groups of every posting list are paired with the others (groups come in one order everywhere, those that share
most prefix shingles with others first, so the lists of a crowd agree on its most central groups); links collapse into components; lists with more pivots to come go on with eight times as many,
but only between groups that are still in different components.  A pair that is never verified is therefore always
joined by other links already, and the components are exact.  The same holds for the members of a group.

Defined results: words are split at ASCII white space and only A-Z are lower-cased; fewer words than a shingle make one
shingle; null and empty texts, and texts of white space, have the empty set and link with nothing; repeated rows stay and
are one class; a component is named by its least id that is not null (null if it has none, and for an empty set the row's
own id); an empty table gives an empty result; a long text takes memory in proportion to its own length; other columns
are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonelens.llm.common import column, ship, stage
from zonelens.llm.components import least_members

SHINGLE = 3
PERCENT = 90
# Hash buckets whose counts order the shingles; the order decides on speed only, never on the result.
BUCKETS = 1 << 18
# 64-bit words of a parity bitmap.
PARITY = 16
PIVOTS = 1
GROWTH = 8
# Bits of the filter that thins the texts before they are shuffled; more texts than that only pass more often.
FILTER_BITS = 1 << 24
# Words whose hashes a worker remembers before it starts anew.
REMEMBERED = 200_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles_of(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """The distinct shingles of one text as sorted 64-bit hashes."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z and the white space of ASCII
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    rolled = np.full(n, width, np.uint64)
    for j in range(width):
        rolled = rolled * FACTOR + values[j : j + n]
        rolled ^= rolled >> np.uint64(29)
        rolled *= MIX
    return np.unique(rolled)


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def bucket_counts(docs: DataFrame, size: int) -> np.ndarray:
    """In how many documents the shingles of each hash bucket occur; one number per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = WordHashes(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(bucket_of(shingles_of(text.as_py(), size, known)), minlength=BUCKETS) if text.is_valid else 0
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = docs.select("text").mapInArrow(count, "bucket int, n long")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS, np.int64)
    total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return total


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which any linked set shares one; none if only equal sets can link."""
    if 100 * n < percent * (n + 1):
        return 0  # even with one shingle more or less the share is too small
    return n - -(-percent * n // 100) + 1


def parity(shingles: np.ndarray) -> np.ndarray:
    """Bit b tells if an odd number of the shingles fall to it."""
    odd = np.bincount((shingles & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def with_sets(docs: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """id, text keys, n, digest of the set (d1, d2), ordered prefix, its weight and parity bitmap of every document.

    The weight, how often the shingles of the prefix occur in all, is high for sets in the middle of a crowd, which have
    no rare shingles of their own.
    """
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    kept = [f for f in docs.schema.fields if f.name != "text"]
    names = [f.name for f in kept]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ns, firsts, seconds, prefixes, bits, weights = [], [], [], [], [], []
            for text in batch.column("text"):
                found = shingles_of(text.as_py(), size, known)
                digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8")
                length = prefix_length(len(found), percent)
                often = sent.value[bucket_of(found)]
                first = np.argsort(often, kind="stable")[:length]
                ordered = found[first]
                weights.append(int(often[first].sum()))
                ns.append(len(found))
                firsts.append(digest[0])
                seconds.append(digest[1])
                prefixes.append(ordered.view(np.int64))
                bits.append(parity(found))
            added = [pa.array(x, pa.int64()) for x in (ns, firsts, seconds, weights)]
            added += [pa.array(x, pa.list_(pa.int64())) for x in (prefixes, bits)]
            yield pa.RecordBatch.from_arrays([batch.column(x) for x in names] + added, [*names, "n", "d1", "d2", "weight", "prefix", "bits"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(describe, f"{kinds}, n long, d1 long, d2 long, weight long, prefix array<long>, bits array<long>")


def sets_of(texts: DataFrame, size: int) -> DataFrame:
    """The whole set of every text: cls, shingles."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for cls, text in zip(batch.column("cls"), batch.column("text"), strict=True):  # one set at a time
                found = shingles_of(text.as_py(), size, known).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([cls.as_py()], pa.int64()), pa.array([found], pa.list_(pa.int64()))], ["cls", "shingles"])

    return texts.select("cls", "text").mapInArrow(make, "cls long, shingles array<long>")


def with_text(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """Add the texts of the asked keys (k1, k2); a filter of a fixed size keeps the other texts out of the shuffle."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            held[batch.column(0).to_numpy() % FILTER_BITS] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held).tobytes()], pa.binary())], ["bits"])

    total = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in asked.select("k1").coalesce(16).mapInArrow(build, "bits binary").toLocalIterator():
        total |= np.frombuffer(row["bits"], np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(total)

    @F.pandas_udf("boolean")
    def maybe(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = np.unpackbits(sent.value).astype(bool)
        for k in keys:
            yield pd.Series(held[k.to_numpy() % FILTER_BITS])

    some = docs.filter(maybe("k1")).join(asked.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    return asked.join(some.groupBy("k1", "k2").agg(F.any_value("text").alias("text")), ["k1", "k2"])


def least_overlap(total: Column, percent: int) -> Column:
    """Shingles that two sets with ``total`` shingles together must share to link."""
    raised = total * percent + F.lit(99 + percent)  # whole numbers, so that the limit itself is exact
    return ((raised - F.pmod(raised, F.lit(100 + percent))) / (100 + percent)).cast("long")


def group_pairs(postings: DataFrame, pivots: int, percent: int) -> DataFrame:
    """g, h, and the place of g among the pivots: pairs of groups of different components that could link.

    ``postings`` has token, gid, n, pos, turn (the order of the groups), low and high (the least and greatest component
    of the group's members).
    """
    place = F.row_number().over(Window.partitionBy("token").orderBy("turn"))
    first = postings.withColumn("place", place).filter(F.col("place") <= pivots)
    # Written, so that the join below can split a crowded list, which it could not together with the window.
    first = stage(first.select("token", "place", *[F.col(c).alias(f"p_{c}") for c in ("gid", "n", "pos", "turn", "low", "high")]), "ngram-pivots")
    room = F.least(F.col("n") - F.col("pos"), F.col("p_n") - F.col("p_pos"))
    apart = ~((F.col("low") == F.col("high")) & (F.col("p_low") == F.col("p_high")) & (F.col("low") == F.col("p_low")))
    found = postings.join(first, "token").filter((F.col("turn") > F.col("p_turn")) & apart & (room >= least_overlap(F.col("n") + F.col("p_n"), percent)))
    return found.groupBy(F.col("p_gid").alias("g"), F.col("gid").alias("h")).agg(F.min("place").alias("place"))


def class_pairs(pairs: DataFrame, members: DataFrame, pivots: int, before: int) -> DataFrame:
    """a < b: members of the paired groups, and of one group, that are in different components and new in this round."""
    place = F.row_number().over(Window.partitionBy("gid").orderBy("cls"))
    first = members.withColumn("member", place).filter(F.col("member") <= pivots)
    first = first.select(F.col("gid").alias("g"), F.col("cls").alias("a"), F.col("comp").alias("a_comp"), "member")
    rest = members.select(F.col("gid").alias("h"), F.col("cls").alias("b"), F.col("comp").alias("b_comp"))
    between = pairs.join(first, "g").filter(F.greatest("place", "member") > before).join(rest, "h")
    many = members.groupBy("gid").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(F.col("gid").alias("g"))
    inside = first.filter(F.col("member") > before).join(many, "g").join(rest.withColumnRenamed("h", "g"), "g").filter(F.col("a") < F.col("b"))
    both = [x.filter(F.col("a_comp") != F.col("b_comp")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for x in (between, inside)]
    return both[0].unionByName(both[1]).distinct()


def verified(pairs: DataFrame, facts: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of classes whose sets link."""
    one, two = (facts.select(*[F.col(c).alias(f"{s}_{c}" if c != "cls" else s) for c in ("cls", "n", "bits")]) for s in ("a", "b"))
    wide = pairs.join(one, "a").join(two, "b")
    total = F.col("a_n") + F.col("b_n")
    unlike = sum((F.bit_count(F.col("a_bits")[k].bitwiseXOR(F.col("b_bits")[k])) for k in range(PARITY)), F.lit(0))
    close = wide.filter(unlike <= total - 2 * least_overlap(total, percent)).select("a", "b", total.alias("total"))
    close = stage(close, "ngram-candidates")
    if close.isEmpty():
        return close.select("a", "b")
    asked = close.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    asked = stage(facts.select("cls", "k1", "k2").join(asked, "cls", "left_semi").select("cls", "k1", "k2"), "ngram-asked")
    whole = stage(sets_of(with_text(asked, docs), size), "ngram-sets")
    left, right = (whole.select(F.col("cls").alias(c), F.col("shingles").alias(f"{c}_set")) for c in ("a", "b"))
    shared = F.size(F.array_intersect("a_set", "b_set"))
    linked = close.join(left, "a").join(right, "b").filter(shared >= least_overlap(F.col("total"), percent))
    return linked.select("a", "b")


def class_components(marked: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int, pivots: int) -> DataFrame:
    """node (of a class) and component (its least node) for every class that links with another one.

    ``marked`` has the facts of all rows; a class is the number of one of its rows.  A node is (id is null, least id,
    class), so that the least node of a component holds its least id.
    """
    facts = marked.withColumnRenamed("row", "cls")
    able = facts.filter(F.size("prefix") > 0)
    grouped = able.select("cls", "n", "g1", "g2").join(classes.select("cls"), "cls")
    groups = grouped.groupBy("n", "g1", "g2").agg(F.min("cls").alias("gid"))
    members = stage(grouped.select("cls", "n", "g1", "g2").join(groups, ["n", "g1", "g2"]).select("cls", "gid"), "ngram-members")
    # Rows that have no postings, as copies and members of a group do; the prefixes stay where they are if these are few.
    spared = stage(able.select("cls").join(groups.select(F.col("gid").alias("cls")), "cls", "left_anti"), "ngram-spared")
    postings = able.join(spared, "cls", "left_anti")
    turn = F.struct((-F.col("weight")).alias("weight"), F.col("cls").alias("gid")).alias("turn")
    postings = postings.select(F.col("cls").alias("gid"), "n", turn, F.posexplode("prefix").alias("pos", "token"))
    shared = postings.groupBy("token").agg(F.count("*").alias("listed")).filter(F.col("listed") > 1)
    postings = stage(postings.join(shared.select("token"), "token"), "ngram-postings")
    nodes = classes.select("cls", F.struct(F.col("least_id").isNull().alias("none"), F.col("least_id").alias("id"), "cls").alias("node"))
    found: DataFrame | None = None
    comps: DataFrame | None = None
    before = 0
    while True:
        if comps is None:
            placed = members.withColumn("comp", F.col("cls"))
        else:
            known = comps.select(F.col("node.cls").alias("cls"), F.col("component.cls").alias("comp"))
            placed = stage(members.join(known, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), "ngram-marked")
        spans = placed.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members"))
        # Groups of one class that links with nothing yet are not named here.
        spans = stage(spans.filter((F.col("low") != F.col("gid")) | (F.col("high") != F.col("gid")) | (F.col("members") > 1)), "ngram-spans")
        lists = postings.join(spans, "gid", "left").withColumns({"low": F.coalesce("low", "gid"), "high": F.coalesce("high", "gid")})
        if before:  # lists and groups that have pivots to come and more than one component
            mixed = (F.min("low") != F.max("high")) & (F.greatest(F.count("*") - 1, F.coalesce(F.max("members"), F.lit(1))) > before)
            open_lists = lists.groupBy("token").agg(mixed.alias("open")).filter("open").select("token")
            lists = stage(lists.join(open_lists, "token", "left_semi"), "ngram-open")
            postings = lists.select(*postings.columns)  # a list that is done stays done
            open_groups = spans.filter((F.col("low") != F.col("high")) & (F.col("members") > before)).select("gid")
            if lists.isEmpty() and open_groups.isEmpty():
                break
        pairs = stage(group_pairs(lists, pivots, percent), "ngram-pairs")
        fresh = stage(class_pairs(pairs, placed, pivots, before), "ngram-fresh")
        links = stage(verified(fresh, facts, docs, size, percent), "ngram-links")
        ends = [nodes.select(F.col("cls").alias(c), F.col("node").alias(f"{c}_node")) for c in ("a", "b")]
        links = stage(links.join(ends[0], "a").join(ends[1], "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "ngram-links")
        found = links if found is None else found.unionByName(links)
        comps = stage(least_members(found), "ngram-components")
        before, pivots = pivots, pivots * GROWTH
    return comps


def components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, pivots: int = PIVOTS,
) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    ship(docs.sparkSession)
    content = column(text).cast("string")
    keyed = docs.select(column(doc_id).alias("id"), content.alias("text"), F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2"))
    described = with_sets(keyed, bucket_counts(keyed, size), size, percent)
    groups = {"g1": F.xxhash64("prefix"), "g2": F.xxhash64(F.lit(1), "prefix"), "row": F.monotonically_increasing_id()}
    marked = stage(described.withColumns(groups), "ngram-marked")
    key = ["n", "d1", "d2"]
    classes = marked.filter(F.col("n") > 0).groupBy(*key).agg(F.min("row").alias("cls"), F.min("id").alias("least_id"))
    classes = stage(classes, "ngram-classes")
    comps = class_components(marked, classes, keyed.select("k1", "k2", "text"), size, percent, pivots)
    named = comps.select(F.col("node.cls").alias("cls"), F.col("component.id").alias("linked_id"))
    least = classes.select("cls", *key, "least_id").join(named, "cls", "left").select(*key, F.coalesce("linked_id", "least_id").alias("component_id"))
    rows = marked.select("id", *key).join(least, key, "left")
    return rows.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
