"""Entity tables: domains, addresses, and the edges between them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions.hosts import naive_tld, strip
from zonelens.functions.identity import entity_id, entity_key
from zonelens.functions.ips import ip_version

DEFAULT_TTL = 300


def _at(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def entity_domains(records: DataFrame, now: datetime | Column) -> DataFrame:
    """One node per distinct domain (E3).  Records have domain, registered_domain, status."""
    apex = F.coalesce(F.nullif("registered_domain", F.lit("")), F.col("domain"))
    rows = records.filter(F.coalesce(F.col("domain"), F.lit("")) != "").select(
        entity_id("domain", F.col("domain")).alias("domain_id"),
        F.lower("domain").alias("domain"),
        F.lower(apex).alias("apex"),
        naive_tld(apex).alias("tld"),
        _at(now).alias("first_seen_ts"),
        _at(now).alias("last_seen_ts"),
        F.to_json(F.struct(F.coalesce("status", F.lit("")).alias("status"))).alias("source_flags"),
    )
    return rows.groupBy("domain_id").agg(
        F.min("domain").alias("domain"),
        F.min("apex").alias("apex"),
        F.min("tld").alias("tld"),
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
        F.max("source_flags").alias("source_flags"),
    )


def domain_addresses(records: DataFrame) -> DataFrame:
    """(domain, ip, edge_type, ttl) out of the ``a`` and ``aaaa`` lists."""

    def tagged(column: str, kind: str, ttl: str) -> Column:
        life = F.coalesce(F.when(F.col(ttl) > 0, F.col(ttl)), F.lit(DEFAULT_TTL))
        return F.transform(
            F.coalesce(column, F.array().cast("array<string>")),
            lambda ip: F.struct(strip(ip).alias("ip"), F.lit(kind).alias("edge_type"), life.cast("int").alias("ttl")),
        )

    both = F.concat(tagged("a", "A", "a_ttl"), tagged("aaaa", "AAAA", "aaaa_ttl"))
    rows = records.filter(F.coalesce(F.col("domain"), F.lit("")) != "").select("domain", F.inline(both))
    return rows.filter(F.coalesce(F.col("ip"), F.lit("")) != "")


def entity_ips(records: DataFrame, now: datetime | Column) -> DataFrame:
    """One node per distinct address."""
    rows = domain_addresses(records).select(
        entity_id("ip", F.col("ip")).alias("ip_id"),
        entity_key("ip", F.col("ip")).alias("ip"),
        F.coalesce(ip_version(F.col("ip")), F.when(F.col("edge_type") == "A", F.lit(4)).otherwise(F.lit(6)))
        .cast("tinyint")
        .alias("ip_version"),
    )
    # Equal ids have equal text, so the text can be part of the key: the aggregation then hashes, it need not sort.
    return rows.groupBy("ip_id", "ip").agg(
        F.min("ip_version").alias("ip_version"),
        _at(now).alias("first_seen_ts"),
        _at(now).alias("last_seen_ts"),
    )


def entity_edges(records: DataFrame, now: datetime | Column) -> DataFrame:
    """One edge per address answer, with its TTL as JSON."""
    return domain_addresses(records).select(
        F.lit("domain").alias("src_type"),
        entity_id("domain", F.col("domain")).alias("src_id"),
        F.lit("ip").alias("dst_type"),
        entity_id("ip", F.col("ip")).alias("dst_id"),
        "edge_type",
        _at(now).alias("first_seen_ts"),
        _at(now).alias("last_seen_ts"),
        _at(now).alias("last_observed_ts"),
        F.to_json(F.struct("ttl")).alias("attrs"),
    )


def merge_nodes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Node upsert: earliest first sight, latest last sight, other fields from the newest row."""
    rest = [c for c in old.columns if c not in (key, "first_seen_ts", "last_seen_ts")]
    both = old.unionByName(new.select(*old.columns))
    merged = both.groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct("last_seen_ts", *rest)).alias("__r"),
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
    )
    return merged.select(key, "__r.*", "first_seen_ts", "last_seen_ts").select(*old.columns)


EDGE_KEY = ("src_type", "src_id", "dst_type", "dst_id", "edge_type")


def merge_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Edge upsert: earliest first sight, latest last sight and observation, attributes of the newest row."""
    both = old.unionByName(new.select(*old.columns))
    return both.groupBy(*EDGE_KEY).agg(
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
        F.max("last_observed_ts").alias("last_observed_ts"),
        F.max_by("attrs", F.struct("last_observed_ts", "attrs")).alias("attrs"),
    ).select(*old.columns)
