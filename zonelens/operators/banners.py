"""Mail-server greetings as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions import banners as B
from zonelens.functions.hosts import clean_domain, strip, under_domain


def _mx_source(df: DataFrame) -> Column:
    if "mx_host_norm" in df.columns:
        return F.col("mx_host_norm")
    for name in ("mail_mx", "mx"):
        if name in df.columns:
            return F.lower(name)
    return F.lit("")


def self_hosted_candidate(df: DataFrame) -> DataFrame:
    """Flag mail hosts below the registered domain."""
    return df.withColumn("mx_self_hosted_candidate", under_domain(_mx_source(df), F.col("registered_domain")))


def banner_features(df: DataFrame) -> DataFrame:
    """Parsed greeting, fingerprint, inferred flag, self-hosted flag and version."""
    if "registered_domain" not in df.columns:
        df = df.withColumn("registered_domain", F.lower("domain") if "domain" in df.columns else F.lit(""))
    raw = F.col("mx_banner_raw") if "mx_banner_raw" in df.columns else F.lit(None).cast("string")
    host, details = B.parse_banner(raw, anchored=True)
    parsed = df.withColumns(
        {
            "mx_banner_host": F.coalesce(F.lower(host), F.lit("")),
            "mx_banner_details": F.coalesce(details, F.lit("")),
        }
    )
    verdict = B.first_match(
        B.FINGERPRINTS,
        F.lower("mx_banner_host"),
        F.lower("mx_banner_details"),
        ("Unknown", "unknown", 0),
        ignore_case=False,
    )
    named = parsed.withColumn("__fp", verdict).withColumns(
        {
            "mx_banner_provider": F.col("__fp.provider"),
            "mx_banner_category": F.col("__fp.category"),
            "mx_banner_confidence": F.col("__fp.confidence"),
            "mx_banner_inferred": F.col("__fp.provider") != "Unknown",
        }
    )
    return self_hosted_candidate(named.drop("__fp")).withColumn("banner_features_version", F.lit(B.BANNER_VERSION))


def classify_banners(df: DataFrame, now_epoch: int, rules: Sequence[B.Rule] | None = None) -> DataFrame:
    """Ten-column banner table out of raw greetings (H22); built-in rules where none are given."""
    host, details = B.parse_banner(F.col("banner_raw"), anchored=False)
    verdict = B.first_match(rules or B.CLASSIFIER, host, details, ("Unknown", "Unknown", 0))
    return df.withColumn("__v", verdict).select(
        F.lit(now_epoch).cast("bigint").alias("ts_unix"),
        "mx_host",
        F.coalesce("banner_raw", F.lit("")).alias("banner_raw"),
        F.coalesce(host, F.lit("")).alias("banner_host"),
        F.coalesce(details, F.lit("")).alias("banner_details"),
        F.col("__v.provider").alias("provider"),
        F.col("__v.category").alias("category"),
        F.col("__v.confidence").alias("confidence"),
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce("tries", F.lit(0)).cast("int").alias("tries"),
    )


def unique_hosts(df: DataFrame, column: str = "mx_host") -> DataFrame:
    """Distinct tidy hosts (G2); sort where the reader needs an order."""
    return df.select(F.nullif(F.lower(strip(F.col(column))), F.lit("")).alias(column)).filter(
        F.col(column).isNotNull()
    ).distinct()


def mx_hosts(df: DataFrame, column: str = "mx_host") -> DataFrame:
    """Host list of a scan: trailing dots off, lower case, each host once (A2)."""
    return df.select(clean_domain(F.col(column)).alias(column)).filter(F.col(column).isNotNull()).distinct()


def fresh_banners(cache: DataFrame, now_epoch: int, ttl_days: int = 30) -> DataFrame:
    """Cached greetings whose age in whole elapsed days is within the limit."""
    age = F.floor((F.lit(float(now_epoch)) - F.col("ts_epoch")) / F.lit(86400.0))
    stamped = F.coalesce(F.col("ts_epoch"), F.lit(0.0)) != 0
    return cache.filter(stamped & (F.coalesce("banner", F.lit("")) != "") & (age <= ttl_days))


def banner_worklist(hosts: DataFrame, cache: DataFrame, now_epoch: int, ttl_days: int = 30) -> DataFrame:
    """Hosts that need a new greeting: those without a fresh cached one."""
    fresh = fresh_banners(cache, now_epoch, ttl_days).select(F.col("host").alias("mx_host")).distinct()
    return unique_hosts(hosts).join(fresh, "mx_host", "left_anti")
