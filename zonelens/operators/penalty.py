"""Which zones throttle us."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of a healthy zone, and minutes to wait.
MAX_FAILURE_RATE = 0.3
MAX_AVG_SECONDS = 3.0
LONG_WAIT_TLDS = ("com", "uk")
LONG_WAIT_MIN = 30
SHORT_WAIT_MIN = 15


def penalty_measures() -> list[Column]:
    """Aggregates over probe rows; sums only, so streams and batches share them."""
    failed = F.col("status").isin("TIMEOUT", "ERROR")
    return [
        F.count("*").alias("tested"),
        F.sum(F.when(failed, 1).otherwise(0)).alias("failures"),
        F.avg("response_time").alias("avg_response_time"),
        F.sum(F.when(F.col("rcode") == "SERVFAIL", 1).otherwise(0)).alias("servfails"),
    ]


def penalty_verdict(measured: DataFrame) -> DataFrame:
    """Failure rate, verdict and reason text out of the measures."""
    rate = F.col("failures") / F.col("tested")
    many = F.col("failure_rate") > MAX_FAILURE_RATE
    slow = F.col("avg_response_time") > MAX_AVG_SECONDS
    refused = F.col("servfails") > 0
    percent = F.bround(F.col("failure_rate") * 100, 0).cast("int").cast("string")
    seconds = F.bround("avg_response_time", 1).cast("decimal(18,1)").cast("string")
    reason = F.concat_ws(
        " | ",
        F.when(many, F.concat(F.lit("High failure rate: "), percent, F.lit("%"))),
        F.when(slow, F.concat(F.lit("Slow responses: "), seconds, F.lit("s avg"))),
        F.when(refused, F.lit("SERVFAIL detected")),
    )
    return measured.withColumn("failure_rate", rate).withColumns(
        {
            "in_penalty": many | slow | refused,
            "reason": F.when(many | slow | refused, reason).otherwise(F.lit("OK")),
        }
    ).drop("servfails")


def tld_penalty(probes: DataFrame, keys: Sequence[str] = ("tld",)) -> DataFrame:
    """Penalty verdict per top-level domain."""
    return penalty_verdict(probes.groupBy(*keys).agg(*penalty_measures()))


def penalty_wait(verdicts: DataFrame) -> DataFrame:
    """Minutes to wait for the zones in penalty."""
    minutes = F.when(F.col("tld").isin(*LONG_WAIT_TLDS), F.lit(LONG_WAIT_MIN)).otherwise(F.lit(SHORT_WAIT_MIN))
    return verdicts.filter("in_penalty").select("tld", minutes.alias("wait_minutes"))


def penalty_report(verdicts: DataFrame) -> DataFrame:
    """Report rows sorted by zone."""
    return verdicts.select(
        "tld",
        F.when(F.col("in_penalty"), F.lit("PENALTY")).otherwise(F.lit("OK")).alias("state"),
        F.concat_ws("/", F.col("failures").cast("string"), F.col("tested").cast("string")).alias("failures"),
        F.concat(F.bround("avg_response_time", 2).cast("decimal(18,2)").cast("string"), F.lit("s")).alias("avg_time"),
        F.when(F.col("in_penalty"), F.col("reason")).otherwise(F.lit("")).alias("reason"),
    ).orderBy("tld")
