"""Connected components of a link table by alternating star rounds, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.llm.common import stage

# Rounds grow with the logarithm of the longest chain; this only ends a run that cannot converge.
MOST_ROUNDS = 60


def least_members(edges: DataFrame) -> DataFrame:
    """node, component for every node of the links (a, b); the component is named by its least node.

    Large star: every node links its larger neighbours to the least of its neighbourhood.  Small star: every node links
    its smaller neighbours, and itself, to the least of them.  No round makes more links than the last one had, up to
    the nodes themselves, and minima are aggregated before the shuffle, so a node with very many neighbours costs no
    task more than its share of rows.
    """
    links = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    links = stage(links, "component-links")
    mark = summary(links)
    for _ in range(MOST_ROUNDS):
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        small = small.select(F.inline(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))))
        after = stage(small.filter(F.col("hi") != F.col("lo")).distinct(), "component-links")
        mark, last = summary(after), mark
        links = after
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    named = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return named.unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def summary(links: DataFrame) -> tuple:
    """Count and order-free checksums of a set of links."""
    one, two = F.xxhash64("hi", "lo"), F.xxhash64("lo", "hi", F.lit(1))
    total = [F.sum(c.cast("decimal(38,0)")) for c in (one, two)]
    return tuple(links.agg(F.count("*"), *total).first())
