"""Running a stream to its end, and reading what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append_to(df: DataFrame, path: str, checkpoint: str) -> None:
    """Drain what is there into a Parquet table; a restart goes on where the checkpoint ends."""
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Drain what is there through a function of batch and batch number."""
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def update_log(df: DataFrame, path: str, checkpoint: str) -> None:
    """Write changed result rows of every batch below their batch number.

    A batch that runs again replaces its own folder, so the log holds each batch once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    each_batch(df, write, checkpoint, "update")


def latest_of_log(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of an update log."""
    log = spark.read.option("basePath", path).parquet(path)
    rest = [c for c in log.columns if c not in (*keys, "batch_id")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__r"))
    return newest.select(*keys, "__r.*")


# A merged table lies in folders run=<batch> (what one batch adds) and base=<batch> (everything up to that batch).  The
# numbers fence them: a batch that runs again replaces its own folders with the same rows, and readers take the newest
# finished base and the runs after it.
COMPACT_EVERY = 8


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Numbers of the finished runs and bases below a path, in order."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {"run": [], "base": []}
    for status in fs.listStatus(place) if fs.exists(place) else ():
        kind, _, number = status.getPath().getName().partition("=")
        if kind in found and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found[kind].append(int(number))
    return {kind: sorted(numbers) for kind, numbers in found.items()}


def _merge(df: DataFrame, keys: Sequence[str], merges: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    return df.groupBy(*keys).agg(*[fold(c).alias(c) for c, fold in merges.items()])


def _parts(spark: SparkSession, path: str, upto: int | None = None) -> list[str]:
    """The newest base and the runs after it, up to a batch."""
    found = _folders(spark, path)
    bases = [n for n in found["base"] if upto is None or n < upto]
    base = bases[-1] if bases else -1
    runs = [n for n in found["run"] if n > base and (upto is None or n <= upto)]
    return [f"{path}/base={n}" for n in bases[-1:]] + [f"{path}/run={n}" for n in runs]


def merge_batch(
    rows: DataFrame, number: int, path: str, keys: Sequence[str], merges: Mapping[str, Callable[[str], Column]],
    compact_every: int = COMPACT_EVERY, files: int = 8,
) -> None:
    """Add one batch to a merged table (I6); ``merges`` folds each column, in any order and grouping (min, max, sum of counts).

    A batch adds a run, sorted by key range, of its own rows only, so its cost follows the batch and not the table.  Every
    ``compact_every`` batches all runs since the last base are folded into the next one.  Runs and bases that two newer
    bases cover are removed, so a reader of the base before the last one is not disturbed.
    """
    spark = rows.sparkSession

    def write(df: DataFrame, place: str) -> None:
        df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(place)

    write(_merge(rows, keys, merges), f"{path}/run={number}")
    if (number + 1) % compact_every:
        return
    parts = _parts(spark, path, number)
    write(_merge(spark.read.schema(rows.schema).parquet(*parts), keys, merges), f"{path}/base={number}")
    found = _folders(spark, path)
    older = [n for n in found["base"] if n <= number][:-2]
    for kind in ("run", "base"):
        for n in found[kind]:
            if older and n <= older[-1]:
                place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={n}")
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def merged_table(spark: SparkSession, path: str, schema: str, keys: Sequence[str], merges: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """One row per key: the newest base and the runs after it, at most ``compact_every`` of them, whatever the table's age."""
    parts = _parts(spark, path)
    if not parts:
        return spark.createDataFrame([], schema)
    return _merge(spark.read.schema(schema).parquet(*parts), keys, merges)
