"""Output row shapes: JSON results, expanded rows, signature rows and domain profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens import schemas as S
from zonelens.functions import hosts as H
from zonelens.functions import records as R
from zonelens.functions.ips import ipv4_to_int
from zonelens.operators.normalize import conform

_NO_ITEMS = "array<string>"
RECORD_TTLS = ("a_ttl", "aaaa_ttl", "mx_ttl", "txt_ttl", "caa_ttl", "naptr_ttl")


# Keys of the record map that the flat row shapes read.
RECORD_KEYS = (
    "registered_domain ns ns1 soa a aaaa mx mail_mx txt cname caa naptr srv ptr www www_cname www_a www_ptr mail_a "
    "mail_cname mail_spf mail_dmarc spf dmarc bimi mx_host_final mx_regdom_final mx_domain mx_ips mx_ptr mx_ptr_regdom "
    "ns_ips ns_ptr ns_ptr_regdom ns_host_final ns_regdom_final"
).split()


def _lifted(records: DataFrame) -> DataFrame:
    """Record lists as columns of their own: each key is looked up once per row; empty lists become null."""
    found = {k: F.element_at("records", k) for k in RECORD_KEYS}
    lists = records.withColumns({f"__{k}": c for k, c in found.items()})
    return lists.withColumns({f"__{k}": F.when(F.size(f"__{k}") > 0, F.col(f"__{k}")) for k in RECORD_KEYS})


def _pick(*keys: str) -> Column:
    """Record list under the first key that has items; null where none has.  Reads lifted columns."""
    return F.coalesce(*[F.col(f"__{k}") for k in keys])


def _text(*keys: str) -> Column:
    return H.join_list(_pick(*keys))


def _items(*keys: str) -> Column:
    return F.coalesce(_pick(*keys), F.array().cast(_NO_ITEMS))


def _json(name: str) -> Column:
    return F.coalesce(F.to_json(F.col(name), {"ignoreNullFields": "false"}), F.lit("{}"))


def to_result_rows(records: DataFrame) -> DataFrame:
    """Five text columns, maps as compact JSON."""
    return records.select(
        F.coalesce("domain", F.lit("")).alias("domain"),
        F.coalesce("status", F.lit("")).alias("status"),
        _json("records").alias("records_json"),
        _json("errors").alias("errors_json"),
        _json("meta").alias("meta_json"),
    )


def to_expanded_rows(records: DataFrame) -> DataFrame:
    """44 top-level columns out of the record map."""
    mx = H.list_tokens(_items("mx", "mail_mx"))
    plain = ["soa", "a", "aaaa", "txt", "cname", "caa", "naptr", "srv", "ptr", "www", "www_cname", "mail_mx",
             "mx_host_final", "mx_ips", "mx_ptr", "mx_ptr_regdom", "ns_ips", "ns_ptr", "ns_ptr_regdom"]
    text = {k: _text(k) for k in plain}
    lists = {f"{k}_list": H.list_tokens(_items(k)) for k in ("a", "aaaa", "txt", "ptr")}
    ttl = {k: F.element_at("meta", k).try_cast("int") for k in RECORD_TTLS}
    columns = {
        "domain": F.coalesce("domain", F.lit("")),
        "status": F.coalesce("status", F.lit("")),
        "records_json": _json("records"),
        "registered_domain": _text("registered_domain"),
        "ns": _text("ns", "ns1"),
        "ns_list": H.list_tokens(_items("ns", "ns1")),
        **text,
        **lists,
        "mx": _text("mx", "mail_mx"),
        "mx_records": R.parse_mx(mx),
        "caa_records": R.parse_caa(H.list_tokens(_items("caa"))),
        "naptr_records": R.parse_naptr(H.list_tokens(_items("naptr"))),
        "srv_records": R.parse_srv(H.list_tokens(_items("srv"))),
        **ttl,
        "mx_regdom_final": _text("mx_regdom_final", "mx_domain"),
        "ns_ip_int": ipv4_to_int(F.get(_items("ns_ips"), F.lit(0))),
        "errors_json": _json("errors"),
        "meta_json": _json("meta"),
    }
    return _lifted(records).select(*[c.alias(n) for n, c in columns.items()])


def to_signature_rows(records: DataFrame) -> DataFrame:
    """48 columns for change detection and enrichment."""
    ns = _pick("ns", "ns1")
    same = ["aaaa", "soa", "ptr", "cname", "txt", "spf", "dmarc", "bimi", "caa", "srv", "naptr", "mx", "mx_domain",
            "mx_host_final", "mx_ips", "mx_ptr", "ns_host_final", "ns_regdom_final", "ns_ips", "ns_ptr",
            "ns_ptr_regdom", "www", "www_cname", "www_a", "www_ptr", "mail_a", "mail_mx", "mail_cname", "mail_spf",
            "mail_dmarc"]
    listed = H.ns_list_from_array(ns)
    columns = {
        "domain": F.lower(F.coalesce("domain", F.lit(""))),
        "status": F.coalesce("status", F.lit("")),
        "registered_domain": F.lower(_text("registered_domain")),
        **{k: F.element_at("meta", k).try_cast("int") for k in RECORD_TTLS},
        "ns": F.array_join(listed, "|"),
        "ns_raw": H.join_list(ns),
        "ns_list_norm": listed,
        "a": _text("a"),
        "ip_int": ipv4_to_int(H.first_item(_items("a"))),
        **{k: _text(k) for k in same},
        "mx_host_norm": _text("mx_host_final", "mx", "mail_mx"),
        "mx_regdom_norm": _text("mx_regdom_final", "mx_domain"),
        "mx_regdom_final": _text("mx_regdom_final", "mx_domain"),
        "ns_ip_int": ipv4_to_int(F.get(_items("ns_ips"), F.lit(0))),
    }
    return _lifted(records).select(*[c.alias(n) for n, c in columns.items()])


def _first(name: str) -> Column:
    return F.coalesce(F.get(F.col(name), F.lit(0)), F.lit(""))


def to_domain_profile(wide: DataFrame, blanks_to_null: bool = True) -> DataFrame:
    """The 82-column profile (B28) out of one wide row per domain.

    ``wide`` carries the lists ``ns``, ``a``, ``aaaa``, ``mx_parsed``, ``mx_ips``, ``ns_ips``, ``caa``, ``naptr``,
    ``srv`` and the joined fields of the policy, certificate, sub-host and PTR operators; absent ones are null.
    ``cname`` may be the list of answers, of which the first is taken, or one name.
    """
    lists = ["ns", "a", "aaaa", "mx_ips", "ns_ips", "caa", "naptr", "srv", "mx_ptr", "mx_ptr_regdom",
             "mx_cname_chain"]
    have = set(wide.columns)
    wide = wide.withColumns({c: F.array().cast(_NO_ITEMS) for c in lists if c not in have})
    wide = wide.withColumns({c: F.coalesce(c, F.array().cast(_NO_ITEMS)) for c in lists})
    if "mx_parsed" not in have:
        wide = wide.withColumn("mx_parsed", F.array().cast(f"array<{S.MX_RECORD}>"))
    if "cname" in have and isinstance(wide.schema["cname"].dataType, T.ArrayType):
        wide = wide.withColumn("cname", F.lower(H.strip_dots(F.get("cname", F.lit(0)))))
    if "ptr" not in have:
        wide = wide.withColumn("ptr", F.create_map().cast("map<string,string>"))
    wide = conform(wide, {
        **dict.fromkeys(["soa_text", "mx_host_final", "mx_regdom_final", "www_a", "mail_a", "cname", "spf", "dmarc",
                         "mx_banner_raw", "mx_banner_host", "mx_banner_details", "mx_banner_provider",
                         "mx_banner_category"], "string"),
    })
    primary = R.primary_mx(F.col("mx_parsed"))
    host = F.coalesce(F.nullif("mx_host_final", F.lit("")), primary["exchange"], F.lit(""))
    soa = R.parse_soa(F.col("soa_text"))
    has_soa = F.coalesce(F.col("soa_text"), F.lit("")) != ""
    regdom = F.coalesce("mx_regdom_final", F.lit(""))

    def ptr_of(ip: Column) -> Column:
        return F.coalesce(F.element_at("ptr", ip), F.lit(""))

    derived = {
        "ns1": F.array_join("ns", ","),
        "soa": F.when(has_soa, soa["mname"]).otherwise(F.lit("")),
        "ip_int": ipv4_to_int(_first("a")),
        "ns_ip_int": ipv4_to_int(_first("ns_ips")),
        "mx": F.coalesce(primary["exchange"], F.lit("")),
        "mx_priority": F.coalesce(primary["preference"], F.lit(0)),
        "mx_host_final": host,
        "mx_regdom_final": regdom,
        "mx_domain": regdom,
        "mx_tld": H.last_label(regdom),
        "mail_mx": host,
        "mail_mx_domain": regdom,
        "mail_mx_tld": H.last_label(regdom),
        "www": F.concat(F.lit("www."), F.col("registered_domain")),
        "www_int": ipv4_to_int(F.col("www_a")),
        "mail_int": ipv4_to_int(F.col("mail_a")),
        "mail_spf": F.col("spf"),
        "mail_dmarc": F.col("dmarc"),
        **{f"mail_{c}": F.col(c) for c in ("mx_banner_raw", "mx_banner_host", "mx_banner_details",
                                           "mx_banner_provider", "mx_banner_category")},
        "soa_serial": soa["serial"],
        "soa_records": F.when(has_soa, F.array(soa)).otherwise(F.array().cast(f"array<{S.SOA_RECORD}>")),
        "caa_records": R.parse_caa(F.col("caa")),
        "naptr_records": R.parse_naptr(F.col("naptr")),
        "srv_records": R.parse_srv(F.col("srv")),
        "ptr": ptr_of(_first("a")),
        "www_ptr": ptr_of(F.col("www_a")),
        "mail_ptr": ptr_of(F.col("mail_a")),
        "mx_ptr": _first("mx_ptr"),
        "mx_ptr_regdom": _first("mx_ptr_regdom"),
        "a": F.array_join("a", ","),
        "aaaa": F.array_join("aaaa", ","),
        "caa": F.array_join("caa", ","),
        "naptr": F.array_join("naptr", ","),
        "srv": F.array_join("srv", ","),
    }
    if "errors" in wide.columns:
        derived |= {f"{k.lower()}_error": F.element_at("errors", k) for k in ("NS", "SOA", "A")}
    full = conform(wide.withColumns(derived), S.DOMAIN_PROFILE).select(*S.DOMAIN_PROFILE)
    if not blanks_to_null:
        return full
    texts = [f.name for f in full.schema.fields if isinstance(f.dataType, T.StringType)]
    return full.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def to_json_documents(df: DataFrame, name: str = "document") -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def stamp_version(df: DataFrame, **versions: str) -> DataFrame:
    """Constant version columns."""
    return df.withColumns({name: F.lit(value) for name, value in versions.items()})
