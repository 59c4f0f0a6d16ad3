"""Answers, caches, related names and change."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from workload.inputs import CUT, NOW, listed, load, observations, seq_observations, suffixes
from workload.registry import query
from zonelens.operators import change, resolve, topology
from zonelens.operators.joins import hot_keys
from zonelens.sources.writers import flat_mx_hosts

_NOW = datetime.fromisoformat(NOW).replace(tzinfo=timezone.utc)

# The newest row per key; ties in time do not occur in the event table.
_LATEST = """
    latest AS (SELECT name, rtype, arg_max(rcode, observed_ts) AS rcode, arg_max(answers_txt, observed_ts) AS answers_txt,
        arg_max(ttl, observed_ts) AS ttl, max(observed_ts) AS observed_ts FROM obs GROUP BY name, rtype)"""


def _latest_of(name: str, where: str) -> str:
    return f"""
    {name} AS (SELECT name, rtype, arg_max(rcode, observed_ts) AS rcode, arg_max(answers_txt, observed_ts) AS answers_txt,
        arg_max(ttl, observed_ts) AS ttl, max(observed_ts) AS observed_ts FROM obs WHERE {where} GROUP BY name, rtype)"""


_OLD = _latest_of("old", f"observed_ts < TIMESTAMP '{CUT}'")
_NEW = _latest_of("new", f"observed_ts >= TIMESTAMP '{CUT}'")


def _text(c: str = "answers"):
    return F.array_join(c, "|").alias("answers_txt")


def _micros(c: str = "observed_ts"):
    return F.unix_micros(c).alias("ts_us")


def _halves(spark, sf):
    obs = observations(spark, sf)
    cut = F.lit(CUT).cast("timestamp")
    return obs.filter(F.col("observed_ts") < cut), obs.filter(F.col("observed_ts") >= cut)


@query("latest_observation", f"""
    WITH {_LATEST} SELECT name, rtype, rcode, answers_txt, ttl, epoch_us(observed_ts) AS ts_us FROM latest""", "obs")
def latest_observation(spark, sf):
    out = resolve.latest_observation(observations(spark, sf))
    return out.select("name", "rtype", "rcode", _text(), "ttl", _micros())


@query("valid_cached", f"""
    WITH {_LATEST} SELECT name, rtype, rcode, answers_txt, ttl FROM latest
    WHERE rcode = 'NOERROR' AND answers_txt <> '' AND epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_ts) < ttl * 1000000::BIGINT""",
       "obs")
def valid_cached(spark, sf):
    newest = resolve.latest_observation(observations(spark, sf))
    return resolve.valid_cached(newest, _NOW).select("name", "rtype", "rcode", _text(), "ttl")


@query("valid_cached_options", f"""
    WITH {_LATEST} SELECT name, rtype, rcode FROM latest WHERE rtype IN ('A', 'NS', 'TXT')
    AND epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_ts) <= ttl * 1000000::BIGINT
    AND ((rcode = 'NOERROR' AND answers_txt <> '') OR rtype <> 'NS')""", "obs")
def valid_cached_options(spark, sf):
    newest = resolve.latest_observation(observations(spark, sf))
    kept = resolve.valid_cached(
        newest, _NOW, only_positive=False, keep_equal_age=True, types=["A", "NS", "TXT"], bypass_negative=["NS"]
    )
    return kept.select("name", "rtype", "rcode")


@query("cache_first", f"""
    WITH {_OLD}, {_NEW},
    c AS (SELECT * FROM old WHERE rcode = 'NOERROR' AND answers_txt <> ''
        AND epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_ts) < ttl * 1000000::BIGINT)
    SELECT coalesce(c.name, n.name) AS name, coalesce(c.rtype, n.rtype) AS rtype, coalesce(c.rcode, n.rcode) AS rcode,
        coalesce(c.answers_txt, n.answers_txt) AS answers_txt, coalesce(c.ttl, n.ttl) AS ttl,
        CASE WHEN c.name IS NOT NULL THEN 'cache' ELSE 'live' END AS answered_from,
        c.name IS NULL AND n.rtype = 'A' AND n.rcode = 'NOERROR' AND n.answers_txt <> '' AS risk_cache_miss
    FROM c FULL JOIN new n ON c.name = n.name AND c.rtype = n.rtype""", "obs")
def cache_first(spark, sf):
    cache, live = _halves(spark, sf)
    out = resolve.cache_first(live, cache, _NOW)
    return out.select("name", "rtype", "rcode", _text(), "ttl", "answered_from", "risk_cache_miss")


@query("cache_backfill", f"""
    WITH {_OLD}, {_NEW},
    c AS (SELECT * FROM old WHERE rcode = 'NOERROR' AND answers_txt <> '' AND rtype IN ('NS', 'SOA', 'A', 'AAAA', 'TXT')
        AND epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_ts) < ttl * 1000000::BIGINT)
    SELECT n.name, n.rtype, n.rcode, CASE WHEN n.answers_txt = '' AND c.name IS NOT NULL THEN c.answers_txt
            ELSE n.answers_txt END AS answers_txt,
        CASE WHEN n.answers_txt = '' AND c.name IS NOT NULL THEN c.ttl ELSE n.ttl END AS ttl,
        n.answers_txt = '' AND c.name IS NOT NULL AS backfilled
    FROM new n LEFT JOIN c ON c.name = n.name AND c.rtype = n.rtype""", "obs")
def cache_backfill(spark, sf):
    cache, live = _halves(spark, sf)
    out = resolve.cache_backfill(live, cache, _NOW)
    return out.select("name", "rtype", "rcode", _text(), "ttl", "backfilled")


_PIVOT = f"""{_LATEST},
    p AS (SELECT name AS domain,
        coalesce(max(rcode) FILTER (rtype = 'NS'), 'NODATA') AS ns_rcode, coalesce(max(rcode) FILTER (rtype = 'SOA'), 'NODATA') AS soa_rcode,
        coalesce(max(rcode) FILTER (rtype = 'A'), 'NODATA') AS a_rcode,
        coalesce(max(answers_txt) FILTER (rtype = 'NS'), '') AS ns_txt, coalesce(max(answers_txt) FILTER (rtype = 'SOA'), '') AS soa_txt,
        coalesce(max(answers_txt) FILTER (rtype = 'A'), '') AS a_txt,
        coalesce(max(ttl) FILTER (rtype = 'NS'), 0) AS ns_ttl, coalesce(max(ttl) FILTER (rtype = 'SOA'), 0) AS soa_ttl,
        coalesce(max(ttl) FILTER (rtype = 'A'), 0) AS a_ttl
        FROM latest WHERE rtype IN ('NS', 'SOA', 'A') GROUP BY name)"""
_USABLE = """(ns_rcode = 'NOERROR' AND ns_txt <> '') OR (soa_rcode = 'NOERROR' AND soa_txt <> '')
    OR (a_rcode = 'NOERROR' AND a_txt <> '')"""


@query("core_status", f"""
    WITH {_PIVOT},
    s AS (SELECT *, {_USABLE} AS usable FROM p),
    t AS (SELECT *, CASE WHEN ns_rcode = 'NXDOMAIN' AND soa_rcode = 'NXDOMAIN' AND a_rcode = 'NXDOMAIN' THEN 'dormant'
            WHEN usable THEN 'alive' ELSE 'needs_retry' END AS status FROM s)
    SELECT domain, status, ns_rcode, soa_rcode, a_rcode,
        CASE WHEN status = 'dormant' THEN 'All core lookups failed (NXDOMAIN)' WHEN usable THEN NULL
            WHEN ns_rcode = 'SERVFAIL' AND soa_rcode = 'SERVFAIL' AND a_rcode = 'SERVFAIL' THEN 'All core lookups SERVFAIL'
            WHEN ns_rcode = 'TIMEOUT' AND soa_rcode = 'TIMEOUT' AND a_rcode = 'TIMEOUT' THEN 'All core lookups timed out'
            ELSE 'All core lookups failed after retries' END AS core_error,
        CASE WHEN usable AND ns_txt = '' THEN ns_rcode END AS ns_error,
        CASE WHEN usable AND soa_txt = '' THEN soa_rcode END AS soa_error,
        CASE WHEN usable AND a_txt = '' THEN a_rcode END AS a_error FROM t""", "obs")
def core_status(spark, sf):
    out = resolve.core_status(resolve.core_pivot(observations(spark, sf)))
    errors = [
        F.element_at("errors", k).alias(n)
        for k, n in (("core", "core_error"), ("NS", "ns_error"), ("SOA", "soa_error"), ("A", "a_error"))
    ]
    return out.select("domain", "status", "ns_rcode", "soa_rcode", "a_rcode", *errors)


@query("overall_status", f"""
    WITH {_PIVOT}
    SELECT domain, CASE WHEN 'NXDOMAIN' IN (ns_rcode, soa_rcode, a_rcode) THEN 'NXDOMAIN'
            WHEN ns_rcode IN ('SERVFAIL', 'REFUSED', 'ERROR') THEN ns_rcode
            WHEN soa_rcode IN ('SERVFAIL', 'REFUSED', 'ERROR') THEN soa_rcode
            WHEN a_rcode IN ('SERVFAIL', 'REFUSED', 'ERROR') THEN a_rcode ELSE 'NOERROR' END AS overall_status,
        coalesce(least(nullif(ns_ttl, 0), nullif(soa_ttl, 0), nullif(a_ttl, 0)), 0) AS ttl FROM p""", "obs")
def overall_status(spark, sf):
    out = resolve.overall_status(resolve.core_pivot(observations(spark, sf)))
    return out.select("domain", "overall_status", "ttl")


@query("core_gate", f"WITH {_PIVOT} SELECT domain FROM p WHERE {_USABLE}", "obs")
def core_gate(spark, sf):
    return resolve.core_gate(resolve.core_pivot(observations(spark, sf))).select("domain")


@query("effective_ttl", """
    SELECT event_id, CASE WHEN rcode <> 'NOERROR' THEN 60 WHEN rtype = 'MX' THEN greatest(ttl, 50000)
        ELSE greatest(ttl, 5) END AS ttl FROM obs""", "obs")
def effective_ttl(spark, sf):
    ttl = resolve.effective_ttl(F.col("rcode"), F.col("ttl"), F.col("rtype"), {"MX": 50000, "A": 1})
    return load(spark, sf, "obs").select("event_id", ttl.alias("ttl"))


@query("dnssec_flag", """
    SELECT name AS domain, bool_or(rtype = 'DNSKEY' AND rcode = 'NOERROR' AND answers_txt <> '') AS dnssec FROM keyed_obs
    GROUP BY name""", "keyed_obs")
def dnssec_flag(spark, sf):
    obs = load(spark, sf, "keyed_obs").select("name", "rtype", "rcode", listed("answers_txt").alias("answers"))
    return resolve.dnssec_flag(obs)


def _records(spark, sf):
    raw = load(spark, sf, "records")
    entry = F.when(F.col("o_orderkey") % 17 == 0, F.create_map(F.lit("exception"), F.lit("boom"))).otherwise(
        F.create_map().cast("map<string,string>")
    )
    return raw.withColumn("errors", entry).withColumn("attempt", (F.col("o_orderkey") % 4).cast("int"))


@query("split_retries", """
    SELECT domain, CASE WHEN o_orderkey % 17 = 0 THEN 'needs_retry' ELSE status END AS status,
        CASE WHEN o_orderkey % 17 = 0 OR status = 'needs_retry' THEN 'retries' ELSE 'results' END AS part FROM records""",
       "records")
def split_retries(spark, sf):
    done, again = resolve.split_retries(_records(spark, sf).select("domain", "status", "errors"))
    both = done.withColumn("part", F.lit("results")).unionByName(again.withColumn("part", F.lit("retries")))
    return both.drop("errors")


@query("retry_round", """
    WITH r AS (SELECT *, o_orderkey % 17 = 0 OR status = 'needs_retry' AS again, o_orderkey % 4 + 1 AS n FROM records)
    SELECT domain, CASE WHEN again THEN 'needs_retry' ELSE status END AS status,
        cast(CASE WHEN again THEN n ELSE n - 1 END AS integer) AS attempt,
        CASE WHEN NOT again THEN 'done' WHEN n <= 2 THEN 'queued' ELSE 'used_up' END AS part,
        CASE WHEN again AND n = 2 THEN 0.4::DOUBLE WHEN again AND n = 1 THEN 0.0::DOUBLE END AS pause_s FROM r""",
       "records")
def retry_round(spark, sf):
    rows = _records(spark, sf).select("domain", "status", "errors", "attempt")
    return resolve.retry_parts(rows, retry_limit=2).drop("errors")


@query("srv_scope", """
    SELECT event_id, concat('u', cast(user_id AS varchar), '.example.com') AS domain,
        CASE event_id % 3 WHEN 0 THEN '_xmpp._tcp' ELSE '_sip._tcp' END AS service FROM service_obs
    WHERE rtype = 'SRV' AND event_id % 3 < 2 AND user_id % 2 = 0""", "service_obs")
def srv_scope(spark, sf):
    obs = load(spark, sf, "service_obs")
    name = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.com"))
    changed = obs.select(name.alias("domain"), (F.col("user_id") % 2 == 0).alias("changed"))
    return resolve.srv_scope(obs, changed).select("event_id", "domain", "service")


@query("srv_errors", """
    WITH s AS (SELECT DISTINCT user_id, CASE event_id % 3 WHEN 0 THEN '_xmpp._tcp' ELSE '_sip._tcp' END AS service
        FROM service_obs WHERE rtype = 'SRV' AND event_id % 3 < 2 AND rcode <> 'NOERROR')
    SELECT concat('u', cast(user_id AS varchar), '.example.com') AS domain,
        string_agg(concat(service, ':NXDOMAIN'), ', ' ORDER BY service) AS srv_error, cast(count(*) AS integer) AS n
    FROM s GROUP BY user_id""", "service_obs")
def srv_errors(spark, sf):
    obs = load(spark, sf, "service_obs").withColumn("answers", listed("answers_txt"))
    out = resolve.srv_errors(resolve.srv_scope(obs, None, "always"))
    return out.select("domain", "srv_error", F.size("srv_errors").alias("n"))


# --- related names -------------------------------------------------------------------------------------------


@query("cname_chain", """
    WITH RECURSIVE edges AS (SELECT name, rtrim(split_part(answers_txt, '|', 1), '.') AS target FROM alias_obs
            WHERE rcode = 'NOERROR' AND rtrim(split_part(answers_txt, '|', 1), '.') <> name),
        starts AS (SELECT DISTINCT concat('h', cast(l_partkey AS varchar), '.net') AS host FROM lineitem),
        walk AS (SELECT host, host AS cur, '' AS chain, 0 AS hops FROM starts
            UNION ALL SELECT w.host, e.target, concat(w.chain, '>', e.target), w.hops + 1
            FROM walk w JOIN edges e ON w.cur = e.name WHERE w.hops < 8),
        ends AS (SELECT host, arg_max(cur, hops) AS final_host, arg_max(chain, hops) AS chain, max(hops) AS hops
            FROM walk GROUP BY host)
    SELECT l.l_orderkey, l.l_linenumber, e.final_host, e.chain, e.hops AS cname_hops, e.hops > 0 AS has_cname
    FROM lineitem l JOIN ends e ON e.host = concat('h', cast(l.l_partkey AS varchar), '.net')""", "alias_obs")
def cname_chain(spark, sf):
    line = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("h"), F.col("l_partkey").cast("string"), F.lit(".net")).alias("host")
    )
    edges = topology.alias_edges(seq_observations(spark, sf, "alias_obs"))
    out = topology.cname_chain(line, edges, spread_by=["l_orderkey", "l_linenumber"])
    chain = F.array_join(F.transform("cname_chain", lambda x: F.concat(F.lit(">"), x)), "")
    return out.select("l_orderkey", "l_linenumber", "final_host", chain.alias("chain"), "cname_hops", "has_cname")


@query("cname_chain_five", """
    WITH RECURSIVE edges AS (SELECT name, rtrim(split_part(answers_txt, '|', 1), '.') AS target FROM alias_obs
            WHERE rcode = 'NOERROR' AND rtrim(split_part(answers_txt, '|', 1), '.') <> name),
        walk AS (SELECT p_partkey, concat('h', cast(p_partkey AS varchar), '.net') AS cur,
                concat('h', cast(p_partkey AS varchar), '.net') AS chain, 0 AS hops FROM part
            UNION ALL SELECT w.p_partkey, e.target, concat(w.chain, '>', e.target), w.hops + 1
            FROM walk w JOIN edges e ON w.cur = e.name WHERE w.hops < 5)
    SELECT p_partkey, arg_max(cur, hops) AS final_host, arg_max(chain, hops) AS chain FROM walk GROUP BY p_partkey""",
       "alias_obs")
def cname_chain_five(spark, sf):
    part = load(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("h"), F.col("p_partkey").cast("string"), F.lit(".net")).alias("host")
    )
    edges = topology.alias_edges(seq_observations(spark, sf, "alias_obs"))
    out = topology.cname_chain(part, edges, max_hops=5, include_start=True, spread_by=["p_partkey"])
    return out.select("p_partkey", "final_host", F.array_join("cname_chain", ">").alias("chain"))


@query("soa_parent_walk", """
    WITH newest AS (SELECT name, arg_max(rcode, seq) AS rcode, arg_max(answers_txt, seq) AS soa, arg_max(ttl, seq) AS soa_ttl
            FROM zone_obs GROUP BY name),
        z AS (SELECT * FROM newest WHERE rcode = 'NOERROR' AND soa <> ''),
        names AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN host ELSE concat('a.b.', host) END AS name FROM page_hosts),
        hits AS (SELECT n.page_id, z.name AS soa_zone, z.soa, z.soa_ttl,
                len(string_split(n.name, '.')) - len(string_split(z.name, '.')) AS soa_depth
            FROM names n JOIN z ON n.name = z.name OR ends_with(n.name, concat('.', z.name)))
    SELECT n.page_id, n.name, arg_min(h.soa_zone, h.soa_depth) AS soa_zone, arg_min(h.soa, h.soa_depth) AS soa,
        arg_min(h.soa_ttl, h.soa_depth) AS soa_ttl, cast(min(h.soa_depth) AS integer) AS soa_depth
    FROM names n LEFT JOIN hits h ON n.page_id = h.page_id GROUP BY n.page_id, n.name""", "zone_obs", "page_hosts")
def soa_parent_walk(spark, sf):
    host = F.col("host")
    names = load(spark, sf, "page_hosts").select(
        "page_id", F.when(F.col("page_id") % 2 == 0, host).otherwise(F.concat(F.lit("a.b."), host)).alias("name")
    )
    return topology.soa_parent_walk(names, seq_observations(spark, sf, "zone_obs"))


@query("txt_apex_fallback", """
    WITH t AS (SELECT * FROM text_obs WHERE rcode = 'NOERROR' AND answers_txt <> '')
    SELECT a.c_custkey, a.domain, coalesce(o.answers_txt, u.answers_txt, '') AS txt, coalesce(o.ttl, u.ttl) AS txt_ttl,
        o.name IS NULL AND u.name IS NOT NULL AS txt_from_apex
    FROM asked_names a LEFT JOIN t o ON o.name = a.domain
    LEFT JOIN t u ON u.name = a.registered_domain AND a.registered_domain <> a.domain""", "text_obs", "asked_names")
def txt_apex_fallback(spark, sf):
    out = topology.txt_apex_fallback(load(spark, sf, "asked_names"), seq_observations(spark, sf, "text_obs"))
    return out.select("c_custkey", "domain", F.array_join("txt", "|").alias("txt"), "txt_ttl", "txt_from_apex")


@query("mail_policies", """
    WITH t AS (SELECT * FROM text_obs WHERE rcode = 'NOERROR' AND answers_txt <> '')
    SELECT a.c_custkey, CASE WHEN o.name IS NOT NULL THEN CASE WHEN a.c_custkey % 4 = 0 THEN 'V=spf1 a' ELSE 'v=spf1 -all' END
            WHEN s.name IS NOT NULL THEN CASE WHEN a.c_custkey % 4 = 0 THEN 'V=spf1 a' ELSE 'v=spf1 -all' END ELSE '' END AS spf,
        CASE WHEN o.name IS NOT NULL THEN CASE WHEN a.c_custkey % 4 = 0 THEN 'v=DMARC1 own' ELSE '' END
            ELSE coalesce(d.answers_txt, '') END AS dmarc,
        CASE WHEN o.name IS NOT NULL THEN '' ELSE coalesce(b.answers_txt, '') END AS bimi
    FROM asked_names a LEFT JOIN t o ON o.name = a.domain LEFT JOIN t s ON s.name = a.registered_domain
    LEFT JOIN t d ON d.name = concat('_dmarc.', a.registered_domain)
    LEFT JOIN t b ON b.name = concat('default._bimi.', a.registered_domain)""", "text_obs", "asked_names")
def mail_policies(spark, sf):
    out = topology.mail_policies(load(spark, sf, "asked_names"), seq_observations(spark, sf, "text_obs"))
    return out.select("c_custkey", "spf", "dmarc", "bimi")


@query("mta_sts", """
    SELECT c_custkey, c_custkey % 3 <> 0 AS has_mta_sts,
        CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('v=mta-sts: id=', cast(c_custkey AS varchar)) END AS mta_sts_txt,
        CASE WHEN c_custkey % 3 <> 0 THEN cast(c_custkey AS varchar) END AS mta_sts_id,
        CASE WHEN c_custkey % 2 = 0 THEN 'testing' ELSE '' END AS mta_sts_mode,
        CASE WHEN c_custkey % 2 = 0 THEN 600::BIGINT END AS mta_sts_max_age,
        concat('mailto:', registered_domain) AS tlsrpt_rua FROM asked_names""", "text_obs", "asked_names")
def mta_sts(spark, sf):
    asked = load(spark, sf, "asked_names")
    text = F.when(F.col("c_custkey") % 2 == 0, F.lit("mode: testing\nmax_age: 600"))
    policies = asked.select(F.col("registered_domain").alias("regdom"), text.alias("policy_text"))
    out = topology.mta_sts(asked, seq_observations(spark, sf, "text_obs"), policies)
    return out.drop("domain", "registered_domain")


@query("attach_subhost", """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('198.51.100.', cast(c_custkey % 250 AS varchar)) END
            AS www_a,
        CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 2 = 0 THEN concat('cdn', cast(c_custkey % 5 AS varchar), '.net') ELSE '' END
            AS www_cname,
        CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 2 = 1 THEN '2001:db8::9' ELSE '' END AS www_aaaa,
        c_custkey % 3 <> 0 AS www_exists, CASE WHEN c_custkey % 5 = 0 THEN '203.0.113.77' ELSE '' END AS mail_a,
        c_custkey % 5 = 0 AS mail_exists FROM mail_facts""", "mail_facts")
def attach_subhost(spark, sf):
    answers = topology.host_answers(seq_observations(spark, sf, "host_obs"))
    base = load(spark, sf, "mail_facts").select("c_custkey", "domain", "registered_domain")
    hot = hot_keys(base, ["registered_domain"])
    out = topology.attach_subhost(base, answers, "www", hot=hot)
    out = topology.attach_subhost(out, answers, "mail", hot=hot)
    aaaa = F.coalesce(F.array_join("www_aaaa_list", "|"), F.lit("")).alias("www_aaaa")
    return out.select("c_custkey", "www_a", "www_cname", aaaa, "www_exists", "mail_a", "mail_exists")


@query("attach_host_ips", """
    SELECT c_custkey, concat('203.0.113.', cast(c_custkey % 3 AS varchar), '|203.0.114.1',
        CASE WHEN c_custkey % 3 = 1 THEN '' ELSE '|2001:db8::a' END) AS mx_ips FROM mail_facts""", "mail_facts")
def attach_host_ips(spark, sf):
    answers = topology.host_answers(seq_observations(spark, sf, "host_obs"))
    facts = load(spark, sf, "mail_facts").select("c_custkey", "domain", F.lower("mx_host_norm").alias("mx_host"))
    out = topology.attach_host_ips(facts, answers, "mx_host", "mx_ips")
    return out.select("c_custkey", F.array_join("mx_ips", "|").alias("mx_ips"))


@query("mx_host_table", """
    SELECT DISTINCT lower(mx_host_norm) AS host, concat('203.0.113.', cast(c_custkey % 3 AS varchar), '|203.0.114.1') AS a_ips,
        'NOERROR' AS a_rcode, 600 AS a_ttl, CASE WHEN c_custkey % 3 = 1 THEN '' ELSE '2001:db8::a' END AS aaaa_ips,
        CASE WHEN c_custkey % 3 = 1 THEN 'SERVFAIL' ELSE 'NOERROR' END AS aaaa_rcode, 601 AS aaaa_ttl FROM mail_facts""",
       "mail_facts")
def mx_host_table(spark, sf):
    hosts = load(spark, sf, "mail_facts").select(F.col("mx_host_norm").alias("host"))
    return flat_mx_hosts(topology.mx_host_table(hosts, seq_observations(spark, sf, "host_obs")))


@query("ptr_results", """
    WITH ips AS (SELECT DISTINCT u.ip FROM records r, unnest(string_split(r.a_txt, '|')) AS u(ip)),
        p AS (SELECT DISTINCT name, rcode, rtrim(answers_txt, '.') AS ptr, ttl FROM reverse_obs)
    SELECT i.ip, coalesce(p.ptr, '') AS ptr, coalesce(p.rcode, 'ERROR') AS rcode, coalesce(p.ttl, 0) AS ttl FROM ips i
    LEFT JOIN p ON p.name = concat(split_part(i.ip, '.', 4), '.', split_part(i.ip, '.', 3), '.', split_part(i.ip, '.', 2), '.',
        split_part(i.ip, '.', 1), '.in-addr.arpa')""", "records", "reverse_obs")
def ptr_results(spark, sf):
    ips = load(spark, sf, "records").select(F.explode(F.split("a_txt", r"\|")).alias("ip"))
    return topology.ptr_results(ips, seq_observations(spark, sf, "reverse_obs"))


_PTR_OF = """
    p AS (SELECT DISTINCT name, rtrim(answers_txt, '.') AS ptr FROM reverse_obs WHERE rcode = 'NOERROR'),
    x AS (SELECT r.o_orderkey, r.domain, u.ip, split_part(u.ip, '.', 2) AS net, p.ptr,
            CASE WHEN p.ptr LIKE '%.co.uk' THEN concat('isp', regexp_extract(p.ptr, 'isp([0-9])', 1), '.co.uk') ELSE p.ptr END
                AS regdom
        FROM records r, unnest(string_split(r.a_txt, '|')) AS u(ip) JOIN p ON p.name = concat(split_part(u.ip, '.', 4), '.',
            split_part(u.ip, '.', 3), '.', split_part(u.ip, '.', 2), '.', split_part(u.ip, '.', 1), '.in-addr.arpa'))"""


@query("attach_ptr", f"""
    WITH {_PTR_OF}
    SELECT r.o_orderkey, coalesce(string_agg(concat(x.ip, '=', x.ptr), ';' ORDER BY x.ip), '') AS ptr,
        coalesce(max(x.ptr) FILTER (x.net = '0'), '') AS mx_ptr, coalesce(max(x.regdom) FILTER (x.net = '0'), '') AS mx_ptr_regdom,
        coalesce(max(x.ptr) FILTER (x.net = '1'), '') AS ns_ptr, coalesce(max(x.regdom) FILTER (x.net = '1'), '') AS ns_ptr_regdom
    FROM records r LEFT JOIN x ON r.o_orderkey = x.o_orderkey GROUP BY r.o_orderkey""", "records", "reverse_obs")
def attach_ptr(spark, sf):
    a = F.split("a_txt", r"\|")
    base = load(spark, sf, "records").select(
        "o_orderkey", "domain", F.slice(a, 1, 1).alias("mx_ips"), F.slice(a, 2, 1).alias("ns_ips"), a.alias("a"),
        listed("aaaa_txt").alias("aaaa"),
    )
    out = topology.attach_ptr(base, seq_observations(spark, sf, "reverse_obs"), suffixes(spark, sf))
    pairs = F.transform(F.array_sort(F.map_entries("ptr")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    lists = ["mx_ptr", "mx_ptr_regdom", "ns_ptr", "ns_ptr_regdom"]
    return out.select(
        "o_orderkey", F.array_join(pairs, ";").alias("ptr"), *[F.array_join(c, "|").alias(c) for c in lists]
    )


@query("ptr_summary", f"""
    WITH {_PTR_OF}, y AS (SELECT DISTINCT concat('mx', cast(o_orderkey % 40 AS varchar)) AS mx_host, ptr, regdom FROM x)
    SELECT mx_host, string_agg(DISTINCT ptr, ',' ORDER BY ptr) AS ptr_hosts,
        string_agg(DISTINCT regdom, ',' ORDER BY regdom) AS ptr_regdoms, min(ptr) AS ptr_host_first,
        min(regdom) AS ptr_regdom_first FROM y GROUP BY mx_host""", "records", "reverse_obs")
def ptr_summary(spark, sf):
    ips = load(spark, sf, "records").select(
        F.concat(F.lit("mx"), (F.col("o_orderkey") % 40).cast("string")).alias("mx_host"),
        F.explode(F.split("a_txt", r"\|")).alias("ip"),
    )
    from zonelens.operators.suffixes import with_registered_domain

    table = topology.ptr_results(ips, seq_observations(spark, sf, "reverse_obs")).select("ip", "ptr")
    table = with_registered_domain(table, suffixes(spark, sf), host="ptr", regdom="ptr_regdom", tld=None)
    out = topology.ptr_summary(ips.distinct().join(table, "ip"))
    return out.select(
        "mx_host", F.array_join("ptr_hosts", ",").alias("ptr_hosts"), F.array_join("ptr_regdoms", ",").alias("ptr_regdoms"),
        "ptr_host_first", "ptr_regdom_first",
    )


@query("mx_ownership", """
    SELECT c_custkey, c_custkey % 3 = 0 AS mx_under_customer, c_custkey % 2 = 0 AND c_custkey % 5 <> 0 AS mx_ptr_missing
    FROM mail_facts""", "mail_facts")
def mx_ownership(spark, sf):
    key = F.col("c_custkey")
    df = load(spark, sf, "mail_facts").select(
        "c_custkey", "registered_domain",
        F.when(key % 3 == 0, F.col("domain")).when(key % 3 == 1, F.lit("")).otherwise(F.lit("x.org")).alias("mx_regdom_final"),
        F.when(key % 2 == 0, F.array(F.lit("10.0.0.1"))).otherwise(F.array().cast("array<string>")).alias("mx_ips"),
        F.when(key % 5 == 0, F.array(F.lit("p.org"))).alias("mx_ptr"),
    )
    return topology.mx_ownership(df).select("c_custkey", "mx_under_customer", "mx_ptr_missing")


@query("want_cert_probe", """
    SELECT c_custkey FROM mail_facts WHERE c_custkey % 7 <> 0 AND (c_custkey % 3 = 0 OR c_custkey % 5 = 0)""", "mail_facts")
def want_cert_probe(spark, sf):
    key = F.col("c_custkey")
    df = load(spark, sf, "mail_facts").select(
        "c_custkey", F.when(key % 7 != 0, F.col("mx_host_norm")).otherwise(F.lit("")).alias("mx_host_final"),
        (key % 3 == 0).alias("mx_under_customer"), F.when(key % 5 == 0, F.lit(True)).alias("has_mta_sts"),
    )
    return resolve.want_cert_probe(df).select("c_custkey")


# --- change --------------------------------------------------------------------------------------------------

_SORTED = "array_to_string(list_sort(string_split({}, '|')), '|')"
_CHANGES = f"""{_OLD}, {_NEW},
    ch AS (SELECT n.name, n.rtype, n.rcode, n.ttl, o.rcode AS prev_rcode, o.ttl AS prev_ttl, o.name IS NULL AS is_new,
        o.name IS NULL OR n.rcode <> o.rcode OR {_SORTED.format('n.answers_txt')} <> {_SORTED.format('o.answers_txt')} AS changed
        FROM new n LEFT JOIN old o ON n.name = o.name AND n.rtype = o.rtype)"""


@query("detect_changes", f"WITH {_CHANGES} SELECT name, rtype, rcode, ttl, prev_rcode, prev_ttl, is_new, changed FROM ch", "obs")
def detect_changes(spark, sf):
    old, new = _halves(spark, sf)
    return change.detect_changes(new, old).drop("answers", "prev_answers", "observed_ts")


@query("domain_changes", f"""
    WITH {_CHANGES} SELECT name AS domain, bool_or(changed) AS changed FROM ch WHERE rtype IN ('NS', 'SOA') GROUP BY name""",
       "obs")
def domain_changes(spark, sf):
    old, new = _halves(spark, sf)
    return change.domain_changes(change.detect_changes(new, old))


@query("change_flags", f"""
    WITH {_CHANGES}
    SELECT name AS domain, bool_or(changed AND NOT is_new AND rtype = 'NS') AS ns_changed,
        bool_or(changed AND NOT is_new AND rtype IN ('A', 'AAAA')) AS ip_changed,
        bool_or(changed AND NOT is_new AND rtype = 'SOA') AS soa_changed,
        bool_or(coalesce(prev_ttl > 0 AND ttl <= prev_ttl * 0.5, FALSE) AND rtype = 'A') AS ttl_drop_big
    FROM ch GROUP BY name""", "obs")
def change_flags(spark, sf):
    old, new = _halves(spark, sf)
    return change.change_flags(change.detect_changes(new, old))


_HISTORY = f"""
    h AS (SELECT name, rtype, epoch_us(observed_ts) AS ts_us, rcode, {_SORTED.format('answers_txt')} AS sig,
            lag(rcode) OVER w AS prev_rcode, lag({_SORTED.format('answers_txt')}) OVER w AS prev_sig
        FROM obs WINDOW w AS (PARTITION BY name, rtype ORDER BY observed_ts))"""
HISTORY_SQL = f"""
    WITH {_HISTORY} SELECT name, rtype, ts_us, rcode, prev_rcode, prev_rcode IS NULL AS is_new FROM h
    WHERE prev_rcode IS NULL OR prev_rcode <> rcode OR prev_sig <> sig"""


@query("change_history", HISTORY_SQL, "obs")
def change_history(spark, sf):
    out = change.change_history(observations(spark, sf))
    return out.select("name", "rtype", _micros(), "rcode", "prev_rcode", "is_new")


@query("dns_signature", """
    SELECT c_custkey, concat('sha1:', sha1(concat(ns, '|', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE cast(ip_int AS varchar) END, '|',
        mx_regdom_norm))) AS dns_sig FROM mail_facts""", "mail_facts")
def dns_signature(spark, sf):
    from zonelens.functions.identity import dns_signature as sign

    a = F.when(F.col("c_custkey") % 4 != 0, F.col("ip_int").cast("string"))
    return load(spark, sf, "mail_facts").select("c_custkey", sign(F.col("ns"), a, F.col("mx_regdom_norm")).alias("dns_sig"))


def activity_rows(spark, sf):
    """Signature rows and an earlier state of the same domains."""
    facts = load(spark, sf, "mail_facts")
    key = F.col("c_custkey")
    rows = facts.select(
        "domain", "ns", F.col("ip_int").cast("string").alias("a"), F.upper("mx_regdom_norm").alias("mx_regdom"),
        F.when(key % 5 == 0, F.lit("dormant")).when(key % 5 == 1, F.lit("nxdomain")).otherwise(F.lit("ALIVE")).alias("status"),
        F.when(key % 2 == 0, F.lit("1.1.1.1")).alias("mx_ips"),
    )
    sig = F.concat(F.lit("sha1:"), F.sha1(F.concat_ws("|", "ns", F.col("ip_int").cast("string"), "mx_regdom_norm")))
    state = facts.select(
        F.when(key % 7 == 0, F.concat(F.lit("gone-"), "domain")).otherwise(F.col("domain")).alias("domain"),
        F.when(key % 4 != 3, key % 4 != 0).alias("is_active"),
        F.when(key % 3 == 0, F.lit("sha1:old")).otherwise(sig).alias("dns_sig"),
    )
    return rows, state


_ACTIVITY = """
    f AS (SELECT c_custkey, domain, concat('sha1:', sha1(concat(ns, '|', cast(ip_int AS varchar), '|', mx_regdom_norm)))
            AS dns_sig, c_custkey % 5 > 1 AS is_active, c_custkey % 7 <> 0 AS known, mx_regdom_norm AS mx_regdom,
            CASE WHEN c_custkey % 2 = 0 THEN '1.1.1.1' ELSE '' END AS mx_ips FROM mail_facts),
    g AS (SELECT *, known AND c_custkey % 4 = 0 AND is_active AS reactivated FROM f),
    act AS (SELECT *, NOT known OR reactivated OR c_custkey % 3 = 0 AS needs_enrich FROM g)"""


@query("activity_flags", f"WITH {_ACTIVITY} SELECT domain, dns_sig, is_active, reactivated, needs_enrich FROM act", "mail_facts")
def activity_flags(spark, sf):
    out = change.activity_flags(*activity_rows(spark, sf))
    return out.select("domain", "dns_sig", "is_active", "reactivated", "needs_enrich")


@query("activity_delta", f"""
    WITH {_ACTIVITY} SELECT domain, CASE WHEN is_active THEN 'true' ELSE 'false' END AS is_active, '1705708800' AS last_seen_ts,
        dns_sig, mx_regdom, mx_ips FROM act WHERE needs_enrich""", "mail_facts")
def activity_delta(spark, sf):
    return change.activity_delta(change.activity_flags(*activity_rows(spark, sf)), 1705708800)
