"""Signatures and entity keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelens.functions.hosts import strip
from zonelens.functions.ips import canonical_ip, canonical_prefix


def dns_signature(ns: Column, a: Column, mx_regdom: Column) -> Column:
    """Tagged SHA-1 over the three texts, null as '' (H18)."""
    parts = [F.coalesce(c, F.lit("")) for c in (ns, a, mx_regdom)]
    return F.concat(F.lit("sha1:"), F.sha1(F.concat_ws("|", *parts)))


def domain_key(c: Column) -> Column:
    """Lower-case name of an ASCII domain; other names go through ``normalize_hosts`` first."""
    return F.lower(strip(c))


def entity_key(kind: str, *cols: Column) -> Column:
    """Normal text of an entity; equal entities have equal text."""
    if kind == "domain":
        return domain_key(cols[0])
    if kind == "ip":
        return canonical_ip(cols[0])
    if kind == "prefix":
        return canonical_prefix(cols[0])
    if kind == "asn":
        return F.concat(F.lit("AS"), cols[0].cast("bigint").cast("string"))
    if kind == "cert":
        return F.lower(F.regexp_replace(strip(cols[0]), "[: ]", ""))
    if kind == "jarm":
        return F.lower(strip(cols[0]))
    if kind == "observation":
        source, entity, ts = cols
        return F.concat_ws("_", source, entity.cast("string"), ts.cast("bigint").cast("string"))
    raise ValueError(f"unknown entity kind {kind!r}")


def entity_id(kind: str, *cols: Column) -> Column:
    """64-bit id of an entity; compare for equality only."""
    return F.xxhash64(entity_key(kind, *cols))
