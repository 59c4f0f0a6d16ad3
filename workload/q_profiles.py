"""The whole domain profile over observations of every record type: sub-hosts, aliases, PTR, policies, services."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.inputs import load, seq_observations, suffixes
from workload.registry import query
from zonelens.operators import rows
from zonelens.plans import batch
from zonelens.schemas import DOMAIN_PROFILE

# Columns that no operator of the batch plan fills: certificates and greetings come from probes.
_PROBED = [c for c in DOMAIN_PROFILE if "cert" in c or "banner" in c]


def _ints(name: str, ips: str) -> str:
    """A left join that gives the number of an address."""
    return f"LEFT JOIN ints {name} ON {name}.ip = {ips}"


def _of(alias: str, owner: str, rtype: str) -> str:
    """A left join with the usable answer of a name."""
    return f"LEFT JOIN g {alias} ON {alias}.name = {owner} AND {alias}.rtype = '{rtype}'"


_SQL = f"""
    WITH o AS (SELECT DISTINCT name, rtype, rcode, answers_txt, ttl FROM zone_facts),
    g AS (SELECT name, rtype, answers_txt AS t, ttl FROM o WHERE rcode = 'NOERROR' AND answers_txt <> ''),
    ints AS (SELECT ip, cast(split_part(ip, '.', 1) AS bigint) * 16777216 + cast(split_part(ip, '.', 2) AS bigint) * 65536
            + cast(split_part(ip, '.', 3) AS bigint) * 256 + cast(split_part(ip, '.', 4) AS bigint) AS n,
            concat_ws('.', split_part(ip, '.', 4), split_part(ip, '.', 3), split_part(ip, '.', 2), split_part(ip, '.', 1),
                'in-addr.arpa') AS rev
        FROM (SELECT DISTINCT unnest(string_split(t, '|')) AS ip FROM g WHERE rtype = 'A')),
    ptrs AS (SELECT ip, rtrim(t, '.') AS host FROM ints JOIN g ON g.name = rev AND rtype = 'PTR'),
    alias AS (SELECT name, lower(rtrim(t, '.')) AS target FROM g WHERE rtype = 'CNAME'),
    raw AS (SELECT name, max(rcode) FILTER (rtype = 'NS') AS ns_rcode, max(rcode) FILTER (rtype = 'SOA') AS soa_rcode,
            max(rcode) FILTER (rtype = 'A') AS a_rcode, max(ttl) FILTER (rtype = 'A') AS a_ttl,
            max(ttl) FILTER (rtype = 'AAAA') AS aaaa_ttl, max(ttl) FILTER (rtype = 'MX') AS mx_ttl,
            max(ttl) FILTER (rtype = 'TXT') AS txt_ttl, max(ttl) FILTER (rtype = 'CAA') AS caa_ttl,
            max(ttl) FILTER (rtype = 'NAPTR') AS naptr_ttl FROM o GROUP BY name),
    mails AS (SELECT name, min(pref * 1000 + place) AS best FROM (SELECT name, cast(split_part(item, ':', 1) AS integer) AS pref,
            place FROM (SELECT name, unnest(string_split(t, '|')) AS item, generate_subscripts(string_split(t, '|'), 1) AS place
            FROM g WHERE rtype = 'MX')) GROUP BY name),
    m AS (SELECT g.name, cast(floor(best / 1000) AS integer) AS pref,
            rtrim(split_part(split_part(t, '|', cast(best % 1000 AS integer)), ':', 2), '.') AS host
        FROM g JOIN mails ON mails.name = g.name WHERE rtype = 'MX'),
    f AS (SELECT m.*, coalesce(c.target, b.target, a.target, host) AS final, concat_ws('|', a.target, b.target, c.target) AS chain
        FROM m LEFT JOIN alias a ON a.name = m.host LEFT JOIN alias b ON b.name = a.target
        LEFT JOIN alias c ON c.name = b.target),
    h AS (SELECT f.*, CASE WHEN final LIKE '%.example.com' THEN regexp_extract(final, '([^.]+\\.example\\.com)$', 1)
            ELSE regexp_extract(final, '([^.]+\\.[^.]+)$', 1) END AS regdom FROM f),
    mp AS (SELECT h.name, ip, p.host, regexp_extract(p.host, '([^.]+\\.[^.]+)$', 1) AS regdom
        FROM (SELECT h.name, unnest(string_split(t, '|')) AS ip FROM h JOIN g ON g.name = final AND rtype = 'A') h
        JOIN ptrs p USING (ip)),
    mptr AS (SELECT name, arg_min(host, ip) AS mail_ptr_host, min(regdom) AS mail_ptr_regdom FROM mp GROUP BY name),
    w AS (SELECT z.domain, ns.t AS ns, soa.t AS soa, a.t AS a, split_part(a.t, '|', 1) AS a1, q.t AS aaaa, raw.* EXCLUDE (name),
            txt.t AS txt, coalesce(caa.t, '') AS caa, coalesce(naptr.t, '') AS naptr, cn.t AS cname, dk.t AS dnskey,
            lower(split_part(ns.t, '|', 1)) AS ns_host, h.host AS mx, h.pref, h.final, h.chain, h.regdom,
            split_part(wa.t, '|', 1) AS www_a, wc.t AS www_cname, split_part(ma.t, '|', 1) AS mail_a, mc.t AS mail_cname,
            dm.t AS dmarc, bi.t AS bimi, replace(st.t, '|', '') AS sts, tl.t AS rpt, pf.policy_text,
            CASE WHEN z.k % 4 < 3 THEN concat_ws('|', nullif(replace(concat(xm.t, '|'), '.|', '|')[:-2], ''), si.t) ELSE '' END AS srv,
            coalesce(raw.ns_rcode, 'NODATA') = 'NXDOMAIN' AND soa_rcode = 'NXDOMAIN' AND a_rcode = 'NXDOMAIN' AS gone,
            ns.t IS NOT NULL OR soa.t IS NOT NULL OR a.t IS NOT NULL AS usable
        FROM zone_domains z LEFT JOIN raw ON raw.name = z.domain {_of('ns', 'z.domain', 'NS')} {_of('soa', 'z.domain', 'SOA')}
        {_of('a', 'z.domain', 'A')} {_of('q', 'z.domain', 'AAAA')} {_of('txt', 'z.domain', 'TXT')}
        {_of('caa', 'z.domain', 'CAA')} {_of('naptr', 'z.domain', 'NAPTR')} {_of('cn', 'z.domain', 'CNAME')}
        {_of('dk', 'z.domain', 'DNSKEY')} LEFT JOIN h ON h.name = z.domain
        {_of('wa', "concat('www.', z.domain)", 'A')} {_of('wc', "concat('www.', z.domain)", 'CNAME')}
        {_of('ma', "concat('mail.', z.domain)", 'A')} {_of('mc', "concat('mail.', z.domain)", 'CNAME')}
        {_of('dm', "concat('_dmarc.', z.domain)", 'TXT')} {_of('bi', "concat('default._bimi.', z.domain)", 'TXT')}
        {_of('st', "concat('_mta-sts.', z.domain)", 'TXT')} {_of('tl', "concat('_smtp._tls.', z.domain)", 'TXT')}
        {_of('xm', "concat('_xmpp._tcp.', z.domain)", 'SRV')} {_of('si', "concat('_sip._tcp.', z.domain)", 'SRV')}
        LEFT JOIN policy_files pf ON pf.regdom = z.domain),
    x AS (SELECT w.*, CASE WHEN gone THEN 'dormant' WHEN usable THEN 'alive' ELSE 'needs_retry' END AS state,
            CASE WHEN txt IS NOT NULL THEN list_filter(string_split(txt, '|'), lambda s: contains(lower(s), 'v=spf1'))[1] END AS spf_text,
            CASE WHEN txt IS NOT NULL THEN list_filter(string_split(txt, '|'), lambda s: starts_with(lower(s), 'v=dmarc'))[1]
                ELSE dmarc END AS dmarc_text,
            CASE WHEN txt IS NULL THEN bimi END AS bimi_text,
            string_split(soa, ' ') AS s, CASE WHEN www_a <> '' THEN www_a END AS www, CASE WHEN mail_a <> '' THEN mail_a END AS mail FROM w)
    SELECT x.domain, x.domain AS registered_domain, replace(ns, '|', ',') AS ns1, rtrim(s[1], '.') AS soa, state AS status,
        CASE WHEN usable AND ns IS NULL THEN ns_rcode END AS ns_error, CASE WHEN usable AND soa IS NULL THEN soa_rcode END AS soa_error,
        CASE WHEN usable AND a IS NULL THEN a_rcode END AS a_error, replace(a, '|', ',') AS a, replace(aaaa, '|', ',') AS aaaa,
        i.n AS ip_int, coalesce(a_ttl, 0) AS a_ttl, p.host AS ptr, lower(rtrim(cname, '.')) AS cname,
        coalesce(concat_ws('|', na.t, nq.t), '') AS ns_ips, ni.n AS ns_ip_int, mx, regdom AS mx_domain,
        split_part(regdom, '.', -1) AS mx_tld, coalesce(pref, 0) AS mx_priority, final AS mx_host_final, regdom AS mx_regdom_final,
        coalesce(chain, '') AS mx_cname_chain, coalesce(regdom = x.domain, FALSE) AS mx_under_customer,
        coalesce(concat_ws('|', xa.t, xq.t), '') AS mx_ips, mail_ptr_host AS mx_ptr, mail_ptr_regdom AS mx_ptr_regdom,
        spf_text AS spf, dmarc_text AS dmarc, bimi_text AS bimi, concat('www.', x.domain) AS www, x.www AS www_a, wi.n AS www_int,
        wp.host AS www_ptr, CASE WHEN x.www IS NOT NULL THEN rtrim(www_cname, '.') END AS www_cname, mail AS mail_a, mi.n AS mail_int,
        lp.host AS mail_ptr, CASE WHEN mail IS NOT NULL THEN rtrim(mail_cname, '.') END AS mail_cname, final AS mail_mx,
        regdom AS mail_mx_domain, split_part(regdom, '.', -1) AS mail_mx_tld, spf_text AS mail_spf, dmarc_text AS mail_dmarc,
        sts IS NOT NULL AS has_mta_sts, sts AS mta_sts_txt, CASE WHEN policy_text IS NOT NULL THEN 'enforce' END AS mta_sts_mode,
        cast(split_part(policy_text, 'max_age: ', 2) AS bigint) AS mta_sts_max_age, split_part(sts, 'id=', 2) AS mta_sts_id,
        split_part(rpt, 'rua=', 2) AS tlsrpt_rua, dnskey IS NOT NULL AS dnssec, cast(s[3] AS bigint) AS soa_serial,
        cast(NULL AS varchar) AS refresh_date, nullif(caa, '') AS caa, nullif(naptr, '') AS naptr, nullif(replace(srv, '|', ','), '') AS srv,
        CASE WHEN soa IS NULL THEN '[]' ELSE concat('[{{"mname":"', rtrim(s[1], '.'), '","rname":"', rtrim(s[2], '.'), '","serial":', s[3],
            ',"refresh":', s[4], ',"retry":', s[5], ',"expire":', s[6], ',"minimum":', s[7], '}}]') END AS soa_records,
        CASE WHEN caa = '' THEN '[]' ELSE concat('[{{"flags":0,"tag":"issue","value":"', split_part(caa, '"', 2), '"}}]') END
            AS caa_records,
        CASE WHEN naptr = '' THEN '[]' ELSE concat('[{{"order":10,"preference":20,"flags":"s","services":"SIP+D2U","regexp":"",',
            '"replacement":"', rtrim(split_part(naptr, '" ', 4), '.'), '"}}]') END AS naptr_records,
        concat('[', array_to_string(list_transform(list_filter(string_split(srv, '|'), lambda r: r <> ''), lambda r:
            concat('{{"priority":', split_part(r, ' ', 1), ',"weight":', split_part(r, ' ', 2), ',"port":', split_part(r, ' ', 3),
                ',"target":"', split_part(r, ' ', 4), '"}}')), ','), ']') AS srv_records, coalesce(aaaa_ttl, 0) AS aaaa_ttl, coalesce(mx_ttl, 0) AS mx_ttl, coalesce(txt_ttl, 0) AS txt_ttl,
        coalesce(caa_ttl, 0) AS caa_ttl, coalesce(naptr_ttl, 0) AS naptr_ttl,
        {", ".join(f"cast(NULL AS {'boolean' if k == 'boolean' else 'integer' if k == 'int' else 'varchar'}) AS {c}" for c, k in DOMAIN_PROFILE.items() if c in _PROBED)}
    FROM x {_ints('i', 'a1')} {_of('na', 'ns_host', 'A')} {_of('nq', 'ns_host', 'AAAA')} {_ints('ni', "split_part(na.t, '|', 1)")}
    {_of('xa', 'final', 'A')} {_of('xq', 'final', 'AAAA')} LEFT JOIN mptr ON mptr.name = x.domain LEFT JOIN ptrs p ON p.ip = a1
    {_ints('wi', 'x.www')} LEFT JOIN ptrs wp ON wp.ip = x.www {_ints('mi', 'mail')} LEFT JOIN ptrs lp ON lp.ip = mail"""


def _shown(name: str, kind: str):
    """Lists as joined text and records as JSON, everything else as it is."""
    if kind == "array<string>":
        return F.coalesce(F.array_join(name, "|"), F.lit("")).alias(name)
    if kind.startswith("array<"):
        return F.to_json(name).alias(name)
    return F.col(name).cast("string").alias(name) if kind == "timestamp" else F.col(name)


@query("domain_profile_whole", _SQL, "zone_domains", "zone_facts", "policy_files")
def domain_profile_whole(spark, sf):
    """All columns of the profile of every customer's zone."""
    obs, domains = seq_observations(spark, sf, "zone_facts"), load(spark, sf, "zone_domains")
    changed = domains.select("domain", (F.col("k") % 4 < 3).alias("changed"))
    wide = batch.domain_wide(domains.select("domain"), obs, suffixes(spark, sf), load(spark, sf, "policy_files"), changed=changed)
    return rows.to_domain_profile(wide).select(*[_shown(c, k) for c, k in DOMAIN_PROFILE.items()])
