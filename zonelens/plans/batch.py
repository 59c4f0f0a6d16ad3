"""From observations to record envelopes, profiles and the batch outputs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions import hosts as H
from zonelens.functions import records as R
from zonelens.operators import change, crawl, graph, resolve, rows, topology
from zonelens.operators.joins import cut_lineage, hot_lists
from zonelens.operators.normalize import clean_domains, normalize_hosts
from zonelens.operators.resolve import dealt, is_positive, newest_order, normal_names
from zonelens.operators.suffixes import SuffixTables, kept_suffix_tables, with_registered_domain
from zonelens.sources import writers

TYPES = ("NS", "SOA", "A", "AAAA", "MX", "TXT", "CAA", "NAPTR", "CNAME", "DNSKEY")


def wide_answers(obs: DataFrame) -> DataFrame:
    """Newest answer of every record type side by side: one aggregation for all ten types.

    A row of ten answers is far wider than an observation, so observations are dealt by name first: each name is then
    one wide row, or few, before the shuffle of the aggregation.
    """
    obs, order = dealt(normal_names(obs).filter(F.col("rtype").isin(*TYPES))), newest_order()
    payload = F.struct("rcode", F.coalesce("answers", F.array().cast("array<string>")).alias("answers"), "ttl")
    picks = [F.max_by(payload, F.when(F.col("rtype") == t, order)).alias(f"__{t}") for t in TYPES]
    wide = obs.groupBy(F.col("name").alias("domain")).agg(*picks)
    out = [F.col("domain")]
    for t in TYPES:
        k = t.lower()
        out += [
            F.coalesce(f"__{t}.rcode", F.lit("NODATA")).alias(f"{k}_rcode"),
            F.coalesce(f"__{t}.answers", F.array().cast("array<string>")).alias(f"{k}_answers"),
            F.coalesce(f"__{t}.ttl", F.lit(0)).alias(f"{k}_ttl"),
        ]
    return wide.select(*out)


def _good(t: str) -> Column:
    k = t.lower()
    hit = is_positive(F.col(f"{k}_rcode"), F.col(f"{k}_answers"))
    return F.when(hit, F.col(f"{k}_answers")).otherwise(F.array().cast("array<string>"))


def _positive(wide: DataFrame, t: str) -> DataFrame:
    """Positive answers of one type out of :func:`wide_answers`: name, answers, ttl."""
    found = wide.select(F.col("domain").alias("name"), _good(t).alias("answers"), F.col(f"{t.lower()}_ttl").alias("ttl"))
    return found.filter(F.size("answers") > 0)


def _hosts(wide: DataFrame) -> DataFrame:
    """:func:`topology.host_answers` out of :func:`wide_answers`, without names that have none."""
    cname = F.coalesce(F.lower(H.strip_dots(F.get(_good("CNAME"), F.lit(0)))), F.lit(""))
    found = wide.select(F.col("domain").alias("name"), _good("A").alias("a"), _good("AAAA").alias("aaaa"), cname.alias("cname"))
    return found.filter((F.size("a") > 0) | (F.size("aaaa") > 0) | (F.col("cname") != ""))


def _owners(wide: DataFrame) -> DataFrame:
    """Names with positive address or TXT answers out of :func:`wide_answers`, for :func:`topology.owner_answers`."""
    cname = F.coalesce(F.lower(H.strip_dots(F.get(_good("CNAME"), F.lit(0)))), F.lit(""))
    return wide.select(F.col("domain").alias("name"), _good("A").alias("a"), _good("AAAA").alias("aaaa"), cname.alias("cname"), _good("TXT").alias("txt"))


def domain_base(domains: DataFrame, wide: DataFrame, suffixes: DataFrame | SuffixTables) -> DataFrame:
    """One row per distinct domain: its newest answers, status, registered domain, mail and name-server host.

    ``wide`` comes from :func:`wide_answers`.
    """
    # Cut, because the optimizer would move the tests of names below the distinct, to every row.
    asked = clean_domains(cut_lineage(domains.select("domain").distinct()))
    names = normalize_hosts(asked, ["domain"]).filter("domain <> ''").distinct()
    fill = {}
    for t in TYPES:
        k = t.lower()
        fill[f"{k}_rcode"] = F.coalesce(f"{k}_rcode", F.lit("NODATA"))
        fill[f"{k}_answers"] = F.coalesce(f"{k}_answers", F.array().cast("array<string>"))
        fill[f"{k}_ttl"] = F.coalesce(f"{k}_ttl", F.lit(0))
    joined = names.join(wide, "domain", "left").withColumns(fill)
    status = resolve.core_status(joined)
    good = status.withColumns({t.lower(): _good(t) for t in TYPES}).drop(*[f"{t.lower()}_answers" for t in TYPES])
    hosts = good.withColumn("mx_parsed", R.parse_mx(F.col("mx"), 0)).withColumns(
        {
            "mx_host": F.coalesce(R.primary_mx(F.col("mx_parsed"))["exchange"], F.lit("")),
            "ns_host_final": F.coalesce(F.lower(H.strip_dots(F.get("ns", F.lit(0)))), F.lit("")),
            "dnssec": F.size("dnskey") > 0,
        }
    )
    out = with_registered_domain(hosts, suffixes, host="domain", regdom="registered_domain", tld="tld")
    return with_registered_domain(out, suffixes, host="ns_host_final", regdom="ns_regdom_final", tld=None)


def domain_wide(
    domains: DataFrame,
    obs: DataFrame,
    suffixes: DataFrame,
    policies: DataFrame | None = None,
    max_hops: int = 8,
    changed: DataFrame | None = None,
    srv_mode: str = "new_only",
) -> DataFrame:
    """Everything known about each domain, one wide row per domain.

    ``changed`` (``domain``, ``changed``) tells whose service records are taken unless ``srv_mode`` is ``always``.
    Observations are grouped once for all ten types.  What hangs on hosts and zones is looked up for short rows of domain
    and keys; the wide rows are shuffled once, by domain.  The driver holds every plan and its generated code, so owner
    names take one join, suffix rules are planned once, and lookups end in tables before the wide rows meet them.
    """
    suffixes = kept_suffix_tables(suffixes)
    newest = cut_lineage(wide_answers(obs))
    base = cut_lineage(domain_base(domains, newest, suffixes))
    answers, txt = _hosts(newest), _positive(newest, "TXT")
    # Crowded keys of the joins below, counted in one pass over the base.
    mx_host = F.nullif("mx_host", F.lit(""))
    hot = hot_lists(base, {"mx": mx_host, "ns": F.col("ns_host_final"), "apex": F.col("registered_domain")})
    keys = ["registered_domain", "mx_host", "ns_host_final"]
    edges = topology.alias_edges(obs, _positive(newest, "CNAME"))
    asked = base.select("domain", *keys, mx_host.alias("host"))
    out = topology.cname_chain(asked, edges, "host", max_hops, hot=hot["mx"])
    out = out.withColumnsRenamed({"final_host": "mx_host_final", "cname_chain": "mx_cname_chain"}).drop("host")
    out = with_registered_domain(out, suffixes, host="mx_host_final", regdom="mx_regdom_final", tld=None)
    # Many mail hosts can be aliases of one, so the final hosts are counted again.
    out = cut_lineage(out)
    final = hot_lists(out, {"mx": F.nullif("mx_host_final", F.lit(""))})["mx"]
    out = topology.attach_host_ips(out, answers, "mx_host_final", "mx_ips", hot=final)
    out = topology.attach_host_ips(out, answers, "ns_host_final", "ns_ips", hot=hot["ns"])
    out = topology.attach_owner_answers(out, topology.owner_answers(_owners(newest)), hot=hot["apex"])
    for prefix in ("www", "mail"):
        out = topology.attach_subhost(out, None, prefix)
    out = topology.mail_policies(out, obs, txt=txt, joined=True)
    out = topology.mta_sts(out, obs, policies, hot=hot["apex"], joined=True)
    out = base.join(cut_lineage(out.drop(*keys)), "domain", "left")
    out = resolve.attach_srv(out, obs, changed, srv_mode)
    out = topology.attach_ptr(out, obs, suffixes)
    return topology.mx_ownership(out).withColumn("soa_text", F.get("soa", F.lit(0)))


def _one(c: str) -> Column:
    value = F.coalesce(F.col(c), F.lit(""))
    return F.when(value != "", F.array(value)).otherwise(F.array().cast("array<string>"))


def to_records(wide: DataFrame) -> DataFrame:
    """The record envelope: domain, status and the three maps."""
    lists = ["ns", "soa", "a", "aaaa", "mx", "txt", "caa", "naptr", "srv", "cname", "mx_ips", "ns_ips", "mx_ptr",
             "mx_ptr_regdom", "ns_ptr", "ns_ptr_regdom"]
    single = ["registered_domain", "mx_host_final", "mx_regdom_final", "ns_host_final", "ns_regdom_final", "www_a",
              "www_cname", "mail_a", "mail_cname", "spf", "dmarc", "bimi"]
    entries = [F.struct(F.lit(k).alias("k"), F.coalesce(k, F.array().cast("array<string>")).alias("v")) for k in lists]
    entries += [F.struct(F.lit(k).alias("k"), _one(k).alias("v")) for k in single]
    entries.append(F.struct(F.lit("ptr").alias("k"), F.map_values("ptr").alias("v")))
    full = F.filter(F.array(*entries), lambda e: F.size(e["v"]) > 0)

    def text(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("k"), value.cast("string").alias("v"))

    issuers = R.caa_free_issuers(F.col("caa"))
    meta = [text(f"{t.lower()}_ttl", F.col(f"{t.lower()}_ttl")) for t in ("A", "AAAA", "MX", "TXT", "CAA", "NAPTR")]
    meta += [text(f"{t.lower()}_rcode", F.col(f"{t.lower()}_rcode")) for t in ("NS", "SOA", "A", "TXT")]
    meta += [
        text("dnssec", F.col("dnssec")),
        text("soa_serial", R.parse_soa(F.col("soa_text"))["serial"]),
        text("caa_free_ca_detected", F.size(issuers) > 0),
        text("caa_issuers", F.array_join(issuers, ",")),
    ]
    return wide.select(
        "domain",
        "status",
        F.map_from_entries(full).alias("records"),
        "errors",
        F.map_from_entries(F.filter(F.array(*meta), lambda e: e["v"].isNotNull())).alias("meta"),
    )


def run_batch(
    domains: DataFrame,
    obs: DataFrame,
    suffixes: DataFrame,
    state: DataFrame,
    out: str,
    now: datetime,
    policies: DataFrame | None = None,
) -> DataFrame:
    """Write results, expanded rows, entities, retries and the activity log; return the batch metrics.

    The record envelopes are written first and read back, so that all outputs share one computation and a lost
    executor costs no more than its own tasks.
    """
    spark = obs.sparkSession
    started = datetime.now()
    envelope = f"{out.rstrip('/')}/records"
    to_records(domain_wide(domains, obs, suffixes, policies)).write.mode("overwrite").parquet(envelope)
    records = spark.read.parquet(envelope)
    done, again = resolve.split_retries(records)
    writers.write_results(done, f"{out}/results")
    writers.write_expanded(done, f"{out}/expanded")
    writers.write_retries(again, f"{out}/retries")
    flat = done.select(
        "domain",
        "status",
        F.get(F.element_at("records", "registered_domain"), F.lit(0)).alias("registered_domain"),
        F.element_at("records", "a").alias("a"),
        F.element_at("records", "aaaa").alias("aaaa"),
        F.element_at("meta", "a_ttl").try_cast("int").alias("a_ttl"),
        F.element_at("meta", "aaaa_ttl").try_cast("int").alias("aaaa_ttl"),
    )
    writers.write_entities(
        graph.entity_domains(flat, now), graph.entity_ips(flat, now), graph.entity_edges(flat, now), out
    )
    signed = rows.to_signature_rows(done).select(
        "domain", F.col("ns_raw").alias("ns"), "a", F.col("mx_regdom_final").alias("mx_regdom"), "status", "mx_ips"
    )
    delta = change.activity_delta(change.activity_flags(signed, state), int(now.timestamp()))
    writers.append_activity_delta(delta, f"{out}/activity_delta", int(now.timestamp()))
    return crawl.batch_metrics(records, (datetime.now() - started).total_seconds())
