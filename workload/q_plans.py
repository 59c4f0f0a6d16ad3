"""Whole plans and output row shapes (A9-A17, B25-B28, H15, entry)."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.inputs import listed, load, observations, suffixes
from workload.q_observations import _LATEST, _PIVOT, _USABLE
from workload.registry import query
from zonelens.operators import rows
from zonelens.plans import batch, scored

SCORED_SQL = """
    WITH m AS (SELECT page_id, host, max(n_labels) AS k FROM page_hosts
            JOIN suffix_list ON host = suffix OR ends_with(host, concat('.', suffix)) GROUP BY page_id, host),
        r AS (SELECT page_id, host, array_to_string(list_slice(string_split(host, '.'), len(string_split(host, '.')) - k,
            len(string_split(host, '.'))), '.') AS rd FROM m),
        s AS (SELECT *, split_part(rd, '.', 1) AS sld, list_filter(string_split(rtrim(left(host, length(host) - length(rd)), '.'),
            '.'), lambda x: x <> '') AS front FROM r),
        ent AS (SELECT sld, -sum(p * log2(p)) AS e FROM (SELECT d.sld, count(*) / length(d.sld) AS p
            FROM (SELECT DISTINCT sld FROM s) d, unnest(string_split(d.sld, '')) AS u(ch) GROUP BY d.sld, u.ch) GROUP BY sld),
        p AS (SELECT s.page_id, s.rd, s.sld, cast(least(10, CASE WHEN e.e > 4.0 THEN 5 WHEN e.e > 3.5 THEN 3 ELSE 0 END
            + CASE WHEN length(s.sld) > 20 THEN 3 WHEN length(s.sld) > 15 THEN 2 ELSE 0 END
            + CASE WHEN length(regexp_replace(s.sld, '[^0-9]', '', 'g')) / length(s.sld) > 0.30 THEN 2 ELSE 0 END
            + CASE WHEN length(regexp_replace(s.sld, '[^aeiou]', '', 'g')) / length(s.sld) < 0.20 AND length(s.sld) > 6 THEN 1 ELSE 0 END
            + CASE WHEN len(front) >= 5 THEN 4 WHEN len(front) >= 3 THEN 2 ELSE 0 END
            + CASE WHEN coalesce(list_max(list_transform(front, lambda x: length(x))), 0) >= 25 THEN 2
                WHEN coalesce(list_max(list_transform(front, lambda x: length(x))), 0) >= 18 THEN 1 ELSE 0 END) AS integer) AS points
            FROM s JOIN ent e ON s.sld = e.sld)
    SELECT page_id, rd AS registered_domain, sld AS dga_sld, points AS subdomain_points, points AS risk_score, 'low' AS risk_level,
        '' AS risk_reasons FROM p"""


@query("scored_hosts", SCORED_SQL, "page_hosts", "suffix_list")
def scored_hosts(spark, sf):
    out = scored.scored_hosts(load(spark, sf, "page_hosts"), suffixes(spark, sf))
    columns = ["page_id", "registered_domain", "dga_sld", "subdomain_points", "risk_score", "risk_level", "risk_reasons"]
    return out.select(*columns)


def _envelopes(spark, sf):
    """Record envelopes out of the flat record input."""
    raw = load(spark, sf, "records")
    entries = F.array(
        F.struct(F.lit("a").alias("k"), listed("a_txt").alias("v")),
        F.struct(F.lit("aaaa").alias("k"), listed("aaaa_txt").alias("v")),
        F.struct(F.lit("mx").alias("k"), F.array(F.concat(F.lit("10:"), F.trim("mx_txt"))).alias("v")),
        F.struct(F.lit("ns1").alias("k"), F.array(F.lit("NS1.Host.net."), F.col("domain")).alias("v")),
        F.struct(F.lit("ns_ips").alias("k"), F.slice(listed("a_txt"), 2, 1).alias("v")),
        F.struct(F.lit("caa").alias("k"), F.array(F.lit('0 issue "x.org"')).alias("v")),
        F.struct(F.lit("registered_domain").alias("k"), listed("registered_domain").alias("v")),
    )
    retry = F.col("status") == "needs_retry"
    return raw.select(
        "domain", "status", F.map_from_entries(F.filter(entries, lambda e: F.size(e["v"]) > 0)).alias("records"),
        F.when(retry, F.create_map(F.lit("core"), F.lit("boom"))).alias("errors"),
        F.create_map(F.lit("a_ttl"), F.col("a_ttl").cast("string"), F.lit("mx_ttl"), F.lit("junk")).alias("meta"),
    )


@query("result_rows", """
    SELECT domain, status, concat('{"a":["', replace(a_txt, '|', '","'), '"]',
            CASE WHEN aaaa_txt = '' THEN '' ELSE concat(',"aaaa":["', aaaa_txt, '"]') END, ',"mx":["10:', trim(mx_txt),
            '"],"ns1":["NS1.Host.net.","', domain, '"],"ns_ips":["', split_part(a_txt, '|', 2), '"],"caa":["0 issue \\"x.org\\""]',
            CASE WHEN registered_domain = '' THEN '' ELSE concat(',"registered_domain":["', registered_domain, '"]') END, '}')
            AS records_json,
        CASE WHEN status = 'needs_retry' THEN '{"core":"boom"}' ELSE '{}' END AS errors_json,
        concat('{"a_ttl":"', cast(a_ttl AS varchar), '","mx_ttl":"junk"}') AS meta_json FROM records""", "records")
def result_rows(spark, sf):
    return rows.to_result_rows(_envelopes(spark, sf))


@query("expanded_rows", """
    SELECT domain, status, registered_domain, concat('NS1.Host.net.|', domain) AS ns, concat('NS1.Host.net;', domain) AS ns_list,
        a_txt AS a, replace(a_txt, '|', ';') AS a_list, aaaa_txt AS aaaa, concat('10:', trim(mx_txt)) AS mx, 10 AS mx_preference,
        trim(mx_txt) AS mx_exchange, '0 issue "x.org"' AS caa, 'issue=x.org' AS caa_first, '' AS txt, 0 AS n_srv, a_ttl,
        cast(NULL AS integer) AS mx_ttl,
        cast(split_part(split_part(a_txt, '|', 2), '.', 1) AS bigint) * 16777216 + 65536 + cast(o_orderkey % 50 AS bigint) * 256 + 2
            AS ns_ip_int, 44 AS n_columns FROM records""", "records")
def expanded_rows(spark, sf):
    out = rows.to_expanded_rows(_envelopes(spark, sf))
    width = len(out.columns)
    return out.select(
        "domain", "status", "registered_domain", "ns", F.array_join("ns_list", ";").alias("ns_list"), "a",
        F.array_join("a_list", ";").alias("a_list"), "aaaa", "mx", F.col("mx_records")[0]["preference"].alias("mx_preference"),
        F.col("mx_records")[0]["exchange"].alias("mx_exchange"), "caa",
        F.concat_ws("=", F.col("caa_records")[0]["tag"], F.col("caa_records")[0]["value"]).alias("caa_first"), "txt",
        F.size("srv_records").alias("n_srv"), "a_ttl", "mx_ttl", "ns_ip_int", F.lit(width).alias("n_columns"),
    )


@query("signature_rows", """
    SELECT domain, status, lower(registered_domain) AS registered_domain, concat('ns1.host.net|', domain) AS ns,
        concat('NS1.Host.net.|', domain) AS ns_raw, a_txt AS a, 167772161 + (o_custkey % 256) * 256 AS ip_int,
        concat('10:', trim(mx_txt)) AS mx_host_norm, '' AS mx_regdom_norm, split_part(a_txt, '|', 2) AS ns_ips, a_ttl,
        cast(NULL AS integer) AS txt_ttl, 48 AS n_columns FROM records JOIN orders USING (o_orderkey)""", "records")
def signature_rows(spark, sf):
    out = rows.to_signature_rows(_envelopes(spark, sf))
    width = len(out.columns)
    keep = ["domain", "status", "registered_domain", "ns", "ns_raw", "a", "ip_int", "mx_host_norm", "mx_regdom_norm", "ns_ips",
            "a_ttl", "txt_ttl"]
    return out.select(*keep, F.lit(width).alias("n_columns"))


@query("json_documents", """
    SELECT concat('{"s_suppkey":', cast(s_suppkey AS varchar), ',"mx_host":"', mx_host, '","tries":', cast(tries AS varchar), '}')
    AS document FROM banners""", "banners")
def json_documents(spark, sf):
    return rows.to_json_documents(load(spark, sf, "banners").select("s_suppkey", "mx_host", "tries"))


_PROFILE = f"""
    WITH {_LATEST},
    good AS (SELECT name, rtype, answers_txt, ttl FROM latest WHERE rcode = 'NOERROR' AND answers_txt <> ''),
    d AS (SELECT DISTINCT name AS domain FROM obs),
    w AS (SELECT d.domain, n.answers_txt AS ns, a.answers_txt AS a, a.ttl AS a_ttl, s.answers_txt AS soa, m.answers_txt AS mx,
            t.answers_txt AS txt,
            try_cast(split_part(m.answers_txt, ':', 1) AS integer) AS pref
        FROM d LEFT JOIN good n ON n.name = d.domain AND n.rtype = 'NS' LEFT JOIN good a ON a.name = d.domain AND a.rtype = 'A'
        LEFT JOIN good s ON s.name = d.domain AND s.rtype = 'SOA' LEFT JOIN good m ON m.name = d.domain AND m.rtype = 'MX'
        LEFT JOIN good t ON t.name = d.domain AND t.rtype = 'TXT')
    SELECT domain, domain AS registered_domain, replace(ns, '|', ',') AS ns1, replace(a, '|', ',') AS a,
        nullif(rtrim(split_part(coalesce(soa, ''), ' ', 1), '.'), '') AS soa, try_cast(split_part(soa, ' ', 3) AS bigint) AS soa_serial,
        CASE WHEN pref <= 20 THEN rtrim(split_part(split_part(mx, '|', 1), ':', 2), '.') WHEN pref > 20 THEN 'backup.mail.org' END AS mx,
        CASE WHEN pref IS NULL THEN 0 ELSE least(pref, 20) END AS mx_priority,
        CASE WHEN pref <= 20 THEN 'mail.net' WHEN pref > 20 THEN 'mail.org' END AS mx_regdom_final,
        CASE WHEN pref <= 20 THEN 'net' WHEN pref > 20 THEN 'org' END AS mx_tld, FALSE AS mx_under_customer,
        CASE WHEN txt LIKE 'v=spf1%' THEN 'v=spf1 include:mail.net -all' WHEN txt LIKE 'v=DMARC%' THEN 'note v=spf1' END AS spf,
        CASE WHEN txt LIKE 'v=DMARC%' THEN 'v=DMARC1; p=none' END AS dmarc, concat('www.', domain) AS www, FALSE AS dnssec,
        82 AS n_columns FROM w"""


@query("domain_profile", _PROFILE, "obs")
def domain_profile(spark, sf):
    obs = observations(spark, sf)
    domains = obs.select(F.col("name").alias("domain"))
    out = rows.to_domain_profile(batch.domain_wide(domains, obs, suffixes(spark, sf)))
    width = len(out.columns)
    keep = ["domain", "registered_domain", "ns1", "a", "soa", "soa_serial", "mx", "mx_priority", "mx_regdom_final", "mx_tld",
            "mx_under_customer", "spf", "dmarc", "www", "dnssec"]
    return out.select(*keep, F.lit(width).alias("n_columns"))


@query("record_envelopes", f"""
    WITH {_PIVOT},
    m AS (SELECT name, answers_txt AS mx FROM latest WHERE rtype = 'MX' AND rcode = 'NOERROR' AND answers_txt <> ''),
    u AS (SELECT p.*, m.mx, {_USABLE} AS usable FROM p LEFT JOIN m ON m.name = p.domain)
    SELECT domain, CASE WHEN ns_rcode = 'NXDOMAIN' AND soa_rcode = 'NXDOMAIN' AND a_rcode = 'NXDOMAIN' THEN 'dormant'
            WHEN usable THEN 'alive' ELSE 'needs_retry' END AS status,
        CASE WHEN ns_rcode = 'NOERROR' THEN nullif(ns_txt, '') END AS ns, CASE WHEN a_rcode = 'NOERROR' THEN nullif(a_txt, '') END AS a,
        mx, domain AS registered_domain, ns_rcode, cast(a_ttl AS varchar) AS a_ttl, NOT usable AS core_failed FROM u""", "obs")
def record_envelopes(spark, sf):
    obs = observations(spark, sf)
    domains = obs.select(F.col("name").alias("domain"))
    records = batch.to_records(batch.domain_wide(domains, obs, suffixes(spark, sf)))
    fields = [F.array_join(F.element_at("records", k), "|").alias(k) for k in ("ns", "a", "mx", "registered_domain")]
    meta = [F.element_at("meta", k).alias(k) for k in ("ns_rcode", "a_ttl")]
    return records.select(
        "domain", "status", *fields, *meta, F.element_at("errors", "core").isNotNull().alias("core_failed")
    )


@query("scored_profiles", f"""
    WITH {_LATEST}, d AS (SELECT DISTINCT name AS domain FROM obs),
    a AS (SELECT name, split_part(answers_txt, '|', 1) AS ip FROM latest
        WHERE rtype = 'A' AND rcode = 'NOERROR' AND answers_txt <> ''),
    i AS (SELECT d.domain, cast(split_part(a.ip, '.', 1) AS bigint) * 16777216 + cast(split_part(a.ip, '.', 2) AS bigint) * 65536
            + cast(split_part(a.ip, '.', 3) AS bigint) * 256 + cast(split_part(a.ip, '.', 4) AS bigint) AS ip_int,
            CASE WHEN (length(split_part(d.domain, '.', 1)) - 1) / length(split_part(d.domain, '.', 1)) > 0.3 THEN 2 ELSE 0 END AS points
        FROM d LEFT JOIN a ON a.name = d.domain)
    SELECT i.domain, i.domain AS registered_domain, cast(NULL AS varchar) AS mx_provider_name,
        cast(NULL AS varchar) AS ns_provider_name, r.asn, i.points AS subdomain_points, i.points AS risk_score,
        'low' AS risk_level, '' AS risk_reasons, '2025.10.20-rc1' AS score_version
    FROM i LEFT JOIN asn_ranges r ON i.ip_int BETWEEN r.start_int AND r.end_int""", "obs", "asn_ranges")
def scored_profiles(spark, sf):
    obs = observations(spark, sf)
    wide = batch.domain_wide(obs.select(F.col("name").alias("domain")), obs, suffixes(spark, sf))
    out = scored.scored_profiles(
        rows.to_domain_profile(wide), load(spark, sf, "mx_catalog"), load(spark, sf, "provider_catalog"),
        load(spark, sf, "asn_ranges"),
    )
    return out.select("domain", "registered_domain", "mx_provider_name", "ns_provider_name", "asn", "subdomain_points",
                      "risk_score", "risk_level", "risk_reasons", "score_version")
