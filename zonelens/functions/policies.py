"""Mail policies published in TXT records, and policy files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the policy texts look like.
MTA_STS_MARK = r"(?i)v\s*=\s*(?:stsv1|mta[-_]?sts)"
MTA_STS_ID = r"(?i)^v\s*=\s*mta-sts:\s*id=([^;\s]+)"
MTA_STS_ID_REGISTERED = r"(?i)^v\s*=\s*stsv1\s*;.*?\bid\s*=\s*([^;\s]+)"
MTA_STS_MODE = r"(?mi)^mode\s*:\s*(\S+)"
MTA_STS_MAX_AGE = r"(?mi)^max_age\s*:\s*(\d+)"
TLSRPT_RUA = r"(?i)^v=tlsrpt1;\s*rua=([^;]+)"
TLSRPT_RUA_REGISTERED = r"(?i)^v=tlsrptv1;\s*rua=([^;]+)"


def first_containing(txts: Column, mark: str) -> Column:
    """First text that contains the mark, case ignored, else ''."""
    hits = F.filter(txts, lambda t: F.contains(F.lower(t), F.lit(mark)))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def first_starting(txts: Column, mark: str) -> Column:
    """First text that starts with the mark, case ignored, else ''."""
    hits = F.filter(txts, lambda t: F.startswith(F.lower(t), F.lit(mark)))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def has_mta_sts(txt: Column) -> Column:
    return F.coalesce(txt, F.lit("")).rlike(MTA_STS_MARK)


def mta_sts_id(txt: Column, strict: bool = False) -> Column:
    """Policy id, or null; ``strict`` reads the registered syntax."""
    pattern = MTA_STS_ID_REGISTERED if strict else MTA_STS_ID
    return F.nullif(F.regexp_extract(txt, pattern, 1), F.lit(""))


def mta_sts_mode(policy: Column) -> Column:
    """Mode line of a policy file, lower case, else '' (B22)."""
    return F.lower(F.coalesce(F.regexp_extract(policy, MTA_STS_MODE, 1), F.lit("")))


def mta_sts_max_age(policy: Column) -> Column:
    """Lifetime of a policy file in seconds, or null."""
    return F.regexp_extract(policy, MTA_STS_MAX_AGE, 1).try_cast("bigint")


def tlsrpt_rua(txt: Column, strict: bool = False) -> Column:
    """Report address, else the whole text."""
    pattern = TLSRPT_RUA_REGISTERED if strict else TLSRPT_RUA
    text = F.coalesce(txt, F.lit(""))
    return F.when(text.rlike(pattern), F.trim(F.regexp_extract(text, pattern, 1))).otherwise(text)


def certificate_features(not_after: Column, issuer: Column, alt_names: Column, now: Column) -> Column:
    """Whole days left, issuer text, number of alternative names."""
    # OpenSSL pads the day with a second blank, and always prints GMT.
    text = F.regexp_replace(F.regexp_replace(F.trim(not_after), r"\s+", " "), r" GMT$", "")
    end = F.try_to_timestamp(text, F.lit("MMM d HH:mm:ss yyyy"))
    seconds = F.unix_seconds(end) - F.unix_seconds(now)
    return F.struct(
        F.floor(seconds / F.lit(86400)).cast("int").alias("days_left"),
        F.nullif(
            F.array_join(F.transform(issuer, lambda p: F.concat(p["k"], F.lit("="), p["v"])), ", "), F.lit("")
        ).alias("issuer"),
        F.coalesce(F.when(alt_names.isNotNull(), F.size(alt_names)), F.lit(0)).alias("san_count"),
    )
