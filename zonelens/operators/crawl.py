"""Crawl plans: buckets, chunks, rates, order, time estimates and measured speed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonelens.functions.hosts import is_high_risk_tld

# Chunk size and queries per second of a bucket.
CHUNK_PLAN = {
    "com": (5000, 200),
    "net": (5000, 200),
    "uk": (1000, 50),
    "co.uk": (1000, 50),
    "de": (2000, 50),
    "xyz": (1000, 50),
}
DEFAULT_CHUNK = (10000, 200)
# Rate caps per bucket, overall cap, concurrency cap, and buckets that start slowly.
RATE_LIMITS = {"com": 500, "net": 500, "xyz": 128, "highrisk": 128, "uk": 12, "de": 12}
GLOBAL_QPS = 500
SEMAPHORE_LIMIT = 500
WARM_UP = ("com", "net", "uk", "co.uk", "de", "xyz")
WARM_UP_FACTOR = 0.5
# The order of work; com alternates with the slow buckets.
SLOTS = {"uk": 2, "co.uk": 3, "de": 4, "xyz": 6, "highrisk": 7, "rest": 8}
COM_SLOTS = (1, 5, 9)
LAST_SLOT = 10

# 3 hex digits of a name's hash cut each bucket into 4096 even parts.
_PART_DIGITS = 3


def tld_bucket(domain: Column) -> Column:
    """The one bucket of a domain."""
    return (
        F.when(is_high_risk_tld(domain), F.lit("highrisk"))
        .when(F.endswith(domain, F.lit(".uk")), F.lit("uk"))
        .when(F.endswith(domain, F.lit(".de")), F.lit("de"))
        .when(F.endswith(domain, F.lit(".com")) | F.endswith(domain, F.lit(".net")), F.lit("com"))
        .otherwise(F.lit("rest"))
    )


def _by_bucket(values: dict[str, int], default: int, bucket: Column) -> Column:
    out = F.lit(default)
    for name, value in values.items():
        out = F.when(bucket == name, F.lit(value)).otherwise(out)
    return out


def chunk_size(bucket: Column) -> Column:
    return _by_bucket({k: v[0] for k, v in CHUNK_PLAN.items()}, DEFAULT_CHUNK[0], bucket)


def chunk_qps(bucket: Column) -> Column:
    return _by_bucket({k: v[1] for k, v in CHUNK_PLAN.items()}, DEFAULT_CHUNK[1], bucket)


def rate_limit(bucket: Column) -> Column:
    return _by_bucket(RATE_LIMITS, GLOBAL_QPS, bucket)


def effective_qps(bucket: Column, wanted: Column) -> Column:
    """The smallest of bucket cap, overall cap and wanted rate."""
    return F.least(rate_limit(bucket), F.lit(GLOBAL_QPS), wanted)


def tld_bucket_counts(domains: DataFrame, domain: str = "domain") -> DataFrame:
    """Domains per bucket; empty buckets have no row."""
    return domains.groupBy(tld_bucket(F.col(domain)).alias("bucket")).agg(F.count("*").alias("domains"))


def assign_chunks(domains: DataFrame, domain: str = "domain", size: Column | None = None) -> DataFrame:
    """bucket, domain, chunk (from 1): chunks of fixed size inside a bucket, in hash order of the names (F1).

    Numbering never sorts a bucket in one task.  A bucket is cut into 4096 parts by the name's hash, the parts
    are counted (at most 4096 rows per bucket), and a row's number is the offset of its part plus its place in
    the part.  Copies of a name are counted before the shuffle and written out only inside their chunk.
    """
    bucket = F.col("bucket")
    per_chunk = (size if size is not None else chunk_size(bucket)).cast("bigint")
    counted = (
        domains.select(tld_bucket(F.col(domain)).alias("bucket"), F.col(domain))
        .groupBy("bucket", domain)
        .agg(F.count("*").alias("__n"))
        .withColumn("__hash", F.md5(domain))
        .withColumn("__part", F.substring("__hash", 1, _PART_DIGITS))
    )
    parts = counted.groupBy("bucket", "__part").agg(F.sum("__n").alias("__in_part"))
    before = Window.partitionBy("bucket").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "bucket", "__part", F.coalesce(F.sum("__in_part").over(before), F.lit(0)).alias("__offset")
    )
    upto = (
        Window.partitionBy("bucket", "__part")
        .orderBy("__hash", domain)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        counted.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0)))
        .join(offsets, ["bucket", "__part"])
        .withColumn("__first", F.col("__offset") + F.col("__before"))
        .withColumn("__size", per_chunk)
    )
    # A run of copies may reach over several chunks: one row per chunk first, then the copies of that chunk.
    last = F.col("__first") + F.col("__n") - 1
    pieces = placed.withColumn("__last", last).withColumn(
        "__c", F.explode(F.sequence(F.floor(F.col("__first") / F.col("__size")), F.floor(last / F.col("__size"))))
    )
    start = F.greatest(F.col("__first"), F.col("__c") * F.col("__size"))
    end = F.least(F.col("__last"), (F.col("__c") + 1) * F.col("__size") - 1)
    sized = pieces.select("bucket", domain, (F.col("__c") + 1).alias("chunk"), (end - start + 1).alias("__copies"))
    alone = sized.filter("__copies = 1").drop("__copies")
    many = sized.filter("__copies > 1").repartition("bucket", "chunk")
    repeated = many.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies"))))
    return alone.unionByName(repeated.drop("__copies", "__i"))


def crawl_plan(chunks: DataFrame) -> DataFrame:
    """One row per chunk with rates, concurrency and place in the order of work."""
    bucket, chunk = F.col("bucket"), F.col("chunk")
    counted = chunks.groupBy("bucket", "chunk").agg(F.count("*").alias("domains"))
    slow = (chunk == 1) & bucket.isin(*WARM_UP)
    wanted = F.when(slow, F.floor(chunk_qps(bucket) * F.lit(WARM_UP_FACTOR)).cast("int")).otherwise(chunk_qps(bucket))
    rated = counted.withColumns({"warm_up": slow, "requested_qps": wanted}).withColumn(
        "qps", effective_qps(bucket, F.col("requested_qps"))
    )
    com_slot = (
        F.when(chunk == 1, F.lit(COM_SLOTS[0])).when(chunk == 2, F.lit(COM_SLOTS[1])).otherwise(F.lit(COM_SLOTS[2]))
    )
    slot = F.when(bucket == "com", com_slot).otherwise(_by_bucket(SLOTS, LAST_SLOT, bucket))
    slotted = rated.withColumns({"concurrency": F.least(F.lit(SEMAPHORE_LIMIT), F.col("qps")), "__slot": slot})
    # Chunks of a bucket are numbered without gaps, so places follow from one short row per slot and bucket.
    groups = slotted.groupBy("__slot", "bucket").agg(
        F.count("*").alias("__n"), F.min("chunk").alias("__first")
    )
    before = Window.orderBy("__slot", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    placed = slotted.join(offsets, ["__slot", "bucket"])
    return placed.withColumn("position", F.col("__offset") + chunk - F.col("__first") + 1).drop(
        "__slot", "__first", "__offset"
    )


def crawl_estimate(counts: DataFrame, key: str = "bucket") -> DataFrame:
    """Chunks, rate and time per bucket, and one total row (E11).  Counts have the key and ``domains``."""
    bucket = F.col(key)
    qps = effective_qps(bucket, chunk_qps(bucket))
    rows = counts.select(
        bucket,
        "domains",
        F.ceil(F.col("domains") / chunk_size(bucket)).alias("chunks"),
        qps.alias("qps"),
        (F.col("domains") / F.greatest(qps, F.lit(1))).alias("processing_time"),
        F.lit(0.0).alias("cooldown_time"),
        chunk_size(bucket).alias("chunk_size"),
    ).withColumn("total_time", F.col("processing_time") + F.col("cooldown_time"))
    total = rows.agg(
        F.lit("total").alias(key),
        F.sum("domains").alias("domains"),
        F.sum("chunks").alias("chunks"),
        F.lit(None).cast("int").alias("qps"),
        F.sum("processing_time").alias("processing_time"),
        F.sum("cooldown_time").alias("cooldown_time"),
        F.lit(None).cast("int").alias("chunk_size"),
        F.sum("total_time").alias("total_time"),
    )
    return rows.unionByName(total)


def batch_metrics(records: DataFrame, elapsed_s: float) -> DataFrame:
    """Domains, results, retries and speed of a batch."""
    retry = F.coalesce(F.sum(F.when(F.col("status") == "needs_retry", 1).otherwise(0)), F.lit(0))
    speed = F.count("*") / F.lit(elapsed_s) if elapsed_s > 0 else F.lit(0.0)
    return records.agg(
        F.count("*").alias("domains"),
        (F.count("*") - retry).alias("results"),
        retry.alias("retries"),
        F.lit(float(elapsed_s)).alias("elapsed_s"),
        speed.alias("domains_per_s"),
    )


def chunk_performance(done: DataFrame) -> DataFrame:
    """Measured against planned rate per chunk; more than 20 % off is flagged.

    ``done`` has one row per finished domain: bucket, chunk, target_qps, started_ts, finished_ts.
    """
    spent = (F.unix_micros(F.max("finished_ts")) - F.unix_micros(F.min("started_ts"))) / F.lit(1e6)
    per_chunk = done.groupBy("bucket", "chunk").agg(
        F.count("*").alias("domains"), F.max("target_qps").alias("target_qps"), spent.alias("elapsed_s")
    )
    actual = F.when(F.col("elapsed_s") > 0, F.col("domains") / F.col("elapsed_s")).otherwise(F.lit(0.0))
    deviation = F.abs(F.col("actual_qps") - F.col("target_qps")) / F.col("target_qps")
    flag = (
        F.when(F.col("actual_qps") < F.col("target_qps") * 0.8, F.lit("slow"))
        .when(F.col("actual_qps") > F.col("target_qps") * 1.2, F.lit("fast"))
        .otherwise(F.lit("ok"))
    )
    return per_chunk.withColumn("actual_qps", actual).withColumns({"deviation": deviation, "flag": flag})
