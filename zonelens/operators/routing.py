"""Routing-risk lookups by ASN, top-level domain and mail address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.functions.hosts import first_token, naive_tld
from zonelens.functions.ips import ipv4_to_int
from zonelens.operators.normalize import conform
from zonelens.operators.ranges import ip_to_asn, primary_asn


def base_columns(df: DataFrame) -> DataFrame:
    """Optional inputs with safe defaults, ``tld`` and the first mail address as a number."""
    out = conform(df, {"ip_int": "bigint", "mx_ips": "string", "registered_domain": "string"})
    if "tld" not in out.columns:
        out = out.withColumn("tld", naive_tld(F.col("registered_domain")))
    if "mx_ip_int" not in out.columns:
        out = out.withColumn("mx_ip_int", ipv4_to_int(first_token(F.col("mx_ips"))))
    return out


def _pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in names if c in df.columns])


def _join_asn(df: DataFrame, side: DataFrame) -> DataFrame:
    return df.join(side, "asn", "left")


def _moas_side(moas: DataFrame) -> DataFrame:
    return _pick(moas, ["asn", "asn_moas_ratio", "moas_prefix_count", "asn_total_prefix_count"])


def _churn_side(churn: DataFrame) -> DataFrame | None:
    if "prefixes_churn_total" not in churn.columns:
        return None
    return churn.select("asn", F.col("prefixes_churn_total").alias("asn_churn_total"))


def _fill(df: DataFrame, name: str, default, kind: str) -> DataFrame:
    if name not in df.columns:
        return df.withColumn(name, F.lit(default).cast(kind))
    return df.withColumn(name, F.coalesce(F.col(name).cast(kind), F.lit(default).cast(kind)))


def join_moas(df: DataFrame, moas: DataFrame) -> DataFrame:
    """Shared-origin ratio and counts of the ASN."""
    return _fill(_join_asn(df, _moas_side(moas)), "asn_moas_ratio", 0.0, "double")


def join_churn(df: DataFrame, churn: DataFrame) -> DataFrame:
    """Prefix churn of the ASN."""
    side = _churn_side(churn)
    out = df if side is None else _join_asn(df, side)
    return _fill(out, "asn_churn_total", 0, "bigint")


def join_asn_risk(df: DataFrame, risk: DataFrame | None) -> DataFrame:
    """Risk level and drop flag of the ASN; the columns are there without the table, too."""
    out = df if risk is None else _join_asn(df, _pick(risk, ["asn", "asn_risk_level", "in_drop"]))
    return _fill(_fill(out, "asn_risk_level", "", "string"), "in_drop", False, "boolean")


def join_tld_risk(df: DataFrame, risk: DataFrame | None) -> DataFrame:
    """Points of the top-level domain."""
    out = df if risk is None else df.join(risk.select("tld", "tld_risk_points"), "tld", "left")
    return _fill(out, "tld_risk_points", 0.0, "double")


def join_mx_dnsbl(df: DataFrame, counters: DataFrame | None) -> DataFrame:
    """Flagged domains behind the mail address."""
    out = df
    if counters is not None:
        out = df.join(counters.select("mx_ip_int", "flagged_domains_30d"), "mx_ip_int", "left")
    return _fill(out, "flagged_domains_30d", 0, "bigint")


def join_asn_tables(
    df: DataFrame,
    moas: DataFrame,
    churn: DataFrame,
    risk: DataFrame | None = None,
) -> DataFrame:
    """D10 to D12 with one join of the facts.

    The ASN tables are joined with each other first; per ASN this gives the same combinations as three left
    joins in a row.
    """
    side = _moas_side(moas)
    churn_side = _churn_side(churn)
    if churn_side is not None:
        side = side.join(churn_side, "asn", "full")
    if risk is not None:
        side = side.join(_pick(risk, ["asn", "asn_risk_level", "in_drop"]), "asn", "full")
    out = _join_asn(df, side)
    for name, default, kind in (
        ("asn_moas_ratio", 0.0, "double"),
        ("asn_churn_total", 0, "bigint"),
        ("asn_risk_level", "", "string"),
        ("in_drop", False, "boolean"),
    ):
        out = _fill(out, name, default, kind)
    return out


def routing_enrich(
    df: DataFrame,
    prefixes: DataFrame,
    moas: DataFrame,
    churn: DataFrame,
    asn_risk: DataFrame | None = None,
    tld_risk: DataFrame | None = None,
    mx_dnsbl: DataFrame | None = None,
    prefer_mx: bool = True,
) -> DataFrame:
    """Addresses to ASN, then every routing table that is there."""
    out = primary_asn(ip_to_asn(base_columns(df), prefixes), prefer_mx)
    out = join_asn_tables(out, moas, churn, asn_risk)
    return join_mx_dnsbl(join_tld_risk(out, tld_risk), mx_dnsbl)
