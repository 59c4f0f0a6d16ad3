"""What the operators share: the package on executors, staged tables, free column names, table reading."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.session import shared_dir

# White space of the word contracts: the space and the code points 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


# Bounds of what goes to a Python worker at once, whatever the length of the texts.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship(spark: SparkSession) -> None:
    """Give executors this package (once per context), as ``spark-submit --py-files`` would, and bound Arrow batches.

    The archive is written in the driver's own temporary folder; Spark serves it to the executors.
    """
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if getattr(context, "_zonelens_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="zonelens-ship-"), "zonelens-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(archive)
    context._zonelens_shipped = True


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back, which cuts its lineage."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under new names, so that other columns cannot clash."""
    return df.select(*[column(old).alias(new) for new, old in columns.items()])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of an id as text, modulo n; null stays null."""
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def chunks(texts: Iterable[str], max_chars: int) -> Iterable[list[str]]:
    """Lists of texts with about ``max_chars`` code points each; one long text is a list of its own."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > max_chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
