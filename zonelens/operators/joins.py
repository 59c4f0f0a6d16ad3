"""Equi joins that stay even when one key holds a large share of the rows.

Lookup tables are joined with a plain left join: Catalyst's size threshold and the adaptive plan choose the
broadcast from measured sizes, and a lookup that is too large for it becomes a sort-merge join whose skewed
partitions the adaptive plan splits.

:func:`spread_join` is for two sides that both grow with the data, on keys that are known to concentrate (shared
hosting addresses, mail hosts, alias targets, parent zones).  A key is hot when it holds ``HOT_ROWS`` rows and a
``MOST_HOT``-th of all rows, and is spread over as many parts as it takes to bring each below that, so the largest part
follows the average and no key is left out.  No more than ``MOST_HOT`` keys can hold such a share: that bounds the one
table with a broadcast hint in this package, and the copies of right rows, which are twice that at most for all keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.session import shared_dir

HOT_ROWS = 1_000_000
MOST_HOT = 1 << 16


class Crowded(list):
    """Hot keys, the fullest first, and the number of parts each is spread over."""

    def __init__(self, pairs: Iterable[tuple[str, int]]) -> None:
        pairs = list(pairs)
        super().__init__(key for key, _ in pairs)
        self.ways = dict(pairs)


def _hot_only(counted: DataFrame, rows: DataFrame, hot_rows: int | None) -> DataFrame:
    """The hot ones of counted keys with their ``__ways``; ``rows``: the number of all rows as one value."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    least = F.greatest(F.lit(float(hot_rows)), rows.scalar() / MOST_HOT)
    hot = counted.withColumn("__least", least).filter(F.col("__rows") >= F.col("__least"))
    return hot.withColumn("__ways", F.greatest(F.lit(2), F.ceil(F.col("__rows") / F.col("__least"))).cast("int")).drop("__least")


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """The keys with at least ``hot_rows`` rows and a ``MOST_HOT``-th of all rows, and their ``__ways``."""
    counted = df.groupBy(*on).agg(F.count("*").alias("__rows"))
    return _hot_only(counted, counted.agg(F.sum("__rows")), hot_rows).select(*on, "__ways")


def hot_lists(df: DataFrame, columns: Mapping[str, Column], hot_rows: int | None = None) -> dict[str, Crowded]:
    """Hot keys per column, all columns counted together; at most ``MOST_HOT`` keys per column come back.

    Most frames have none, which one row per column tells; keys are collected only where a column has hot ones.
    """
    pairs = [F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in columns.items()]
    counted = (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("key").isNotNull())
        .groupBy("kind", "key")
        .agg(F.count("*").alias("__rows"))
    )
    found: dict[str, list] = {kind: [] for kind in columns}
    sizes = counted.groupBy("kind").agg(F.max("__rows").alias("top"), F.sum("__rows").alias("all")).collect()
    least = max([float(HOT_ROWS if hot_rows is None else hot_rows), *[r["all"] / MOST_HOT for r in sizes]])
    if any(r["top"] >= least for r in sizes):
        for row in counted.filter(F.col("__rows") >= least).collect():
            found[row["kind"]].append((-row["__rows"], row["key"], max(2, ceil(row["__rows"] / least))))
    return {kind: Crowded((key, ways) for _, key, ways in sorted(rows)) for kind, rows in found.items()}


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    ways: int = 64,
    hot_rows: int | None = None,
    hot: DataFrame | Sequence | None = None,
) -> DataFrame:
    """Join where every hot key of the left side is spread over as many parts as its rows ask for.

    The salt is a hash of ``spread_by`` columns, so a task that runs again gives every row the same salt.
    Right rows are repeated for hot keys only.  Null keys match nothing and are spread over ``MOST_HOT`` parts, the keys
    of a plain list, which has no counts, over ``ways``.  ``hot`` names the hot keys: a frame from :func:`hot_keys`, a list from
    :func:`hot_lists` or a plain one, for a join on one column.  Without it the left side is counted here, so a caller
    that chains joins makes the list once, at the start of the chain.
    """
    on = list(on)
    blank = F.lit(False)
    for c in on:
        blank = blank | F.col(c).isNull()
    if hot is None:
        hot = hot_keys(left.filter(~blank), on, hot_rows)
    if not isinstance(hot, DataFrame):
        pairs = [(key, hot.ways[key] if isinstance(hot, Crowded) else ways) for key in hot]
        kind = T.StructType([T.StructField(on[0], left.schema[on[0]].dataType), T.StructField("__ways", T.IntegerType())])
        hot = left.sparkSession.createDataFrame(pairs, kind) if pairs else None
    if hot is None:
        left, right = left.withColumn("__ways", F.lit(None).cast("int")), right.withColumn("__salt", F.lit(0))
    else:
        left, right = left.join(F.broadcast(hot), on, "left"), right.join(F.broadcast(hot), on, "left")
        copies = F.sequence(F.lit(0), F.coalesce("__ways", F.lit(1)) - 1)
        right = right.withColumn("__salt", F.explode(copies)).drop("__ways")
    # Null keys have no count, so they go over all bits of the salt.
    salt = F.xxhash64(*spread_by)
    spread = F.when(blank, F.pmod(salt, F.lit(MOST_HOT))).otherwise(F.pmod(salt, F.coalesce("__ways", F.lit(1))))
    salted = left.withColumn("__salt", spread.cast("int")).drop("__ways")
    return salted.join(right, [*on, "__salt"], how).drop("__salt")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame below the cluster's shared folder and read it back; without such a folder, the frame itself.

    A Parquet table keeps later scans pruned to their columns and tells the optimizer its size.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None):
        return df
    path = shared_dir(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
