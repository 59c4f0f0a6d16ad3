"""Inputs that Spark and the oracle derive from the given tables with the same SQL text.

The given tables hold no DNS data.  Each input below turns whole tables into observations, hosts, mail domains,
lookups and so on, row by row, so that its size follows the tables.  ``{name}`` stands for a table or for another
input.  Lists are written as pipe-joined text and split by each engine.
"""

from __future__ import annotations

import string
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# All times in the event table lie in January 2024.
NOW = "2024-01-20 00:00:00"
CUT = "2024-01-16 00:00:00"

INPUTS: dict[str, str] = {
    "suffix_list": """
        SELECT * FROM (VALUES ('com', 1), ('net', 1), ('org', 1), ('uk', 1), ('co.uk', 2), ('example.com', 2),
            ('example.net', 2), ('example.org', 2), ('example.co.uk', 3)) AS t(suffix, n_labels)""",
    "page_hosts": """
        SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM {pages}""",
    "obs": """
        SELECT event_id, name, rtype, rcode, ttl, observed_ts,
            CASE WHEN rcode <> 'NOERROR' OR event_id % 11 = 0 THEN ''
                 WHEN rtype = 'A' AND event_id % 2 = 0 THEN concat(a1, '|', a2)
                 WHEN rtype = 'A' THEN concat(a2, '|', a1)
                 WHEN rtype = 'NS' THEN concat('ns', cast(event_id % 2 AS string), '.host', cast(u % 5 AS string),
                     '.net|NS9.dns.org.')
                 WHEN rtype = 'SOA' THEN concat('ns1.host', cast(u % 5 AS string), '.net. hostmaster.example.com. ',
                     cast(2024000000 + event_id % 4 AS string), ' 7200 900 x 300')
                 WHEN rtype = 'MX' THEN concat(cast(10 + 10 * (event_id % 3) AS string), ':mx',
                     cast(u % 6 AS string), '.mail.net.|20:backup.mail.org')
                 WHEN event_id % 3 = 0 THEN 'v=spf1 include:mail.net -all|site-check=1'
                 WHEN event_id % 3 = 1 THEN 'v=DMARC1; p=none|note v=spf1'
                 ELSE 'hello' END AS answers_txt
        FROM (SELECT event_id, user_id AS u,
                concat('u', cast(user_id AS string), '.example.',
                    CASE user_id % 4 WHEN 0 THEN 'com' WHEN 1 THEN 'net' WHEN 2 THEN 'org' ELSE 'co.uk' END) AS name,
                CASE event_type WHEN 'view' THEN 'A' WHEN 'click' THEN 'NS' WHEN 'signup' THEN 'SOA'
                    WHEN 'purchase' THEN 'MX' ELSE 'TXT' END AS rtype,
                CASE WHEN user_id % 7 = 0 THEN 'NXDOMAIN' WHEN user_id % 7 = 1 THEN 'SERVFAIL'
                     WHEN user_id % 7 = 2 THEN 'TIMEOUT' WHEN event_id % 10 < 6 THEN 'NOERROR'
                     WHEN event_id % 10 = 6 THEN 'NXDOMAIN' WHEN event_id % 10 = 7 THEN 'SERVFAIL'
                     WHEN event_id % 10 = 8 THEN 'TIMEOUT' ELSE 'NODATA' END AS rcode,
                concat('10.', cast(user_id % 250 AS string), '.', cast(event_id % 3 AS string), '.7') AS a1,
                concat('192.0.2.', cast(user_id % 200 AS string)) AS a2,
                cast(floor(value * 10000) AS int) AS ttl, ts AS observed_ts
            FROM {events}) e""",
    "mail_facts": """
        SELECT c_custkey,
            concat('c', cast(c_custkey AS string), '.example.com') AS domain,
            concat('c', cast(c_custkey AS string), '.example.com') AS registered_domain,
            concat('MX', cast(c_custkey % 3 AS string), '.mail', cast(c_nationkey AS string), '.net') AS mx_host_norm,
            concat('mail', cast(c_nationkey AS string), '.net') AS mx_regdom_norm,
            concat('ns1.', c_mktsegment, '.net|NS2.brand', cast(c_custkey % 31 AS string), '.com.| ,ns1.',
                c_mktsegment, '.net') AS ns,
            (c_custkey * 104729 * 37) % 4294967296 AS ip_int,
            (c_custkey * 15485863) % 4294967296 AS mx_ip_int
        FROM {customer}""",
    "mx_catalog": """
        SELECT CASE WHEN n_nationkey % 2 = 0 THEN concat('mail', cast(n_nationkey AS string), '.net')
                    ELSE concat('mx', cast(n_nationkey % 3 AS string), '.mail', cast(n_nationkey AS string), '.net')
                    END AS key,
            CASE WHEN n_nationkey % 2 = 0 THEN 'regdom' ELSE 'host' END AS src,
            concat('P', n_name) AS provider_name,
            CASE n_nationkey % 5 WHEN 0 THEN 'CDN/UGC' WHEN 1 THEN 'Mailbox Provider' WHEN 2 THEN 'DynamicDNS'
                WHEN 3 THEN 'Security' ELSE 'Platform' END AS category,
            cast(n_nationkey - 12 AS double) / 8 AS risk_bias
        FROM {nation}
        UNION ALL
        SELECT concat('mx1.mail', cast(n_nationkey AS string), '.net'), 'host', concat('H', n_name), 'Hosting',
            cast(0 AS double) FROM {nation} WHERE n_regionkey = 2""",
    "provider_catalog": """
        SELECT 'ns_brand' AS key_type,
            CASE WHEN n_nationkey % 2 = 0 THEN concat('NS2.Brand', cast(n_nationkey AS string), '.com')
                 ELSE concat('ns2.brand', cast(n_nationkey AS string), '.com') END AS key,
            concat('B', n_name) AS provider, concat('note ', cast(n_regionkey AS string)) AS notes,
            cast(n_nationkey - 12 AS double) / 4 AS risk_bias
        FROM {nation}
        UNION ALL
        SELECT 'ns_brand', concat('brand', cast(r_regionkey + 1 AS string)), r_name, 'short',
            cast(-1 AS double) FROM {region}
        UNION ALL
        SELECT 'ns_brand', lower(c_mktsegment), c_mktsegment, 'segment', cast(2 AS double) / 4
        FROM {customer} GROUP BY c_mktsegment
        UNION ALL
        SELECT 'mx_host', 'ns1', 'other', 'other', cast(9 AS double) FROM {region}""",
    "asn_ranges": """
        SELECT (p_partkey * 2147483) % 4294967296 AS start_int,
            least((p_partkey * 2147483) % 4294967296 + p_size * 100003, 4294967295) AS end_int,
            cast(p_partkey AS int) AS asn, concat('isp ', p_brand) AS isp, p_type AS isp_country,
            cast(p_size AS double) / 4 AS risk_bias
        FROM {part}""",
    "prefixes": """
        SELECT ((((p_partkey * 104729 * 37) % 4294967296) >> (24 - p_size % 17)) << (24 - p_size % 17)) AS start_int,
            ((((p_partkey * 104729 * 37) % 4294967296) >> (24 - p_size % 17)) << (24 - p_size % 17))
                + (cast(1 AS bigint) << (24 - p_size % 17)) - 1 AS end_int,
            8 + p_size % 17 AS plen, p_partkey % 97 AS asn
        FROM {part}""",
    "moas": """
        SELECT s_suppkey AS asn, s_suppkey % 7 AS moas_prefix_count, s_suppkey % 100 + 1 AS asn_total_prefix_count,
            s_acctbal / 16384 AS asn_moas_ratio FROM {supplier}""",
    "churn": "SELECT cast(n_nationkey AS bigint) AS asn, cast(n_regionkey * 10 AS bigint) AS prefixes_churn_total FROM {nation}",
    "asn_risk": """
        SELECT cast(n_nationkey * 3 AS bigint) AS asn,
            CASE n_regionkey WHEN 0 THEN 'suspicious' WHEN 1 THEN 'malicious' WHEN 2 THEN 'critical' ELSE 'good' END
                AS asn_risk_level,
            n_nationkey % 2 = 0 AS in_drop FROM {nation}""",
    "tld_risk": "SELECT * FROM (VALUES ('com', cast(1.5 AS double)), ('xyz', cast(4 AS double))) AS t(tld, tld_risk_points)",
    "mx_dnsbl": "SELECT (c_custkey * 15485863) % 4294967296 AS mx_ip_int, c_custkey % 13 AS flagged_domains_30d FROM {customer} WHERE c_acctbal > 5000",
    "crawl_list": """
        SELECT page_id, concat('  ', CASE WHEN page_id % 3 = 0 THEN upper(h) ELSE h END, '.', tld, '. ') AS domain
        FROM (SELECT page_id, replace(replace(replace(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '.example.com', ''),
                '.example.net', ''), '.example.org', '') AS h,
            CASE page_id % 8 WHEN 0 THEN 'com' WHEN 1 THEN 'net' WHEN 2 THEN 'co.uk' WHEN 3 THEN 'de'
                WHEN 4 THEN 'xyz' WHEN 5 THEN 'org' WHEN 6 THEN 'com' ELSE 'tk' END AS tld FROM {pages}) p""",
    "crawl_orders": """
        SELECT o_orderkey, concat('d', cast(o_custkey AS string), '.',
            CASE o_orderpriority WHEN '1-URGENT' THEN 'com' WHEN '2-HIGH' THEN 'co.uk' WHEN '3-MEDIUM' THEN 'de'
                WHEN '5-LOW' THEN 'org' ELSE 'xyz' END) AS domain FROM {orders}""",
    "probes": """
        SELECT event_id, ts, CASE event_type WHEN 'view' THEN 'com' WHEN 'click' THEN 'net' WHEN 'signup' THEN 'uk'
                WHEN 'purchase' THEN 'de' ELSE 'org' END AS tld,
            CASE WHEN event_id % 13 = 0 AND event_type <> 'view' THEN 'TIMEOUT'
                 WHEN event_id % 3 = 0 AND event_type = 'signup' THEN 'ERROR'
                 WHEN user_id % 40 = 0 AND event_type = 'purchase' THEN 'ERROR' ELSE 'OK' END AS status,
            CASE WHEN user_id % 40 = 0 AND event_type = 'purchase' THEN 'SERVFAIL' ELSE 'NOERROR' END AS rcode,
            value / 16 + 0.0000123 AS response_time
        FROM {events}""",
    "banner_facts": """
        SELECT s_suppkey, concat('mx', cast(s_suppkey AS string), '.',
                CASE s_nationkey % 6 WHEN 0 THEN 'google.com' WHEN 1 THEN 'mail.protection.outlook.com'
                    WHEN 2 THEN 'c1.example.com' WHEN 3 THEN 'pphosted.com' WHEN 4 THEN 'sendgrid.net'
                    ELSE 'host.org' END) AS mx_host,
            concat('c', cast(s_suppkey % 3 AS string), '.example.com') AS registered_domain,
            CASE s_nationkey % 6 WHEN 0 THEN ' ESMTP gv21 - gsmtp' WHEN 1 THEN ' Microsoft ESMTP MAIL Service ready'
                WHEN 2 THEN ' ESMTP Postfix (Debian)' WHEN 3 THEN ' SMTP Proofpoint server'
                WHEN 4 THEN ' esmtp SendGrid' ELSE '' END AS tail,
            s_suppkey % 9 AS shape, s_acctbal FROM {supplier}""",
    "banners": """
        SELECT s_suppkey, mx_host, registered_domain,
            CASE shape WHEN 0 THEN concat('  220 ', upper(mx_host), tail, '  ') WHEN 1 THEN concat('220-', mx_host, tail)
                WHEN 2 THEN concat('220 ', mx_host, ' hello') WHEN 3 THEN '' WHEN 4 THEN '554 no service'
                WHEN 5 THEN concat('220 ', mx_host, ' ESMTP OpenSMTPD') WHEN 6 THEN concat('220 ', mx_host, ' ESMTP Exim 4.9')
                ELSE concat('220 ', mx_host, tail) END AS banner_raw,
            CASE WHEN shape = 3 THEN 'TimeoutError' END AS error, cast(1 + shape % 2 AS int) AS tries
        FROM {banner_facts}""",
    "line_ips": """
        SELECT l_orderkey, l_linenumber, l_suppkey,
            CASE WHEN l_partkey % 17 = 0 THEN concat('2001:DB8:', cast(l_suppkey % 10 AS string), '::', cast(l_linenumber AS string))
                 WHEN l_partkey % 19 = 0 THEN concat('300.1.', cast(l_linenumber AS string), '.2')
                 WHEN l_partkey % 23 = 0 THEN ''
                 ELSE concat(cast(l_partkey % 256 AS string), '.', cast(l_suppkey % 256 AS string), '.',
                    cast(l_linenumber AS string), '.', cast(l_orderkey % 256 AS string)) END AS ip
        FROM {lineitem}""",
    "records": """
        SELECT concat('d', cast(o_orderkey AS string), '.example.com') AS domain,
            CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE concat('d', cast(o_orderkey AS string), '.Example.com') END
                AS registered_domain,
            CASE o_orderstatus WHEN 'F' THEN 'dormant' WHEN 'O' THEN 'alive' ELSE 'needs_retry' END AS status,
            concat('10.0.', cast(o_custkey % 256 AS string), '.1|10.1.', cast(o_orderkey % 50 AS string), '.2') AS a_txt,
            CASE WHEN o_orderkey % 3 = 0 THEN concat('2001:db8::', cast(o_custkey % 100 + 1 AS string)) ELSE '' END
                AS aaaa_txt,
            concat(' mx', cast(o_custkey % 9 AS string), '.mail.net') AS mx_txt,
            cast(o_custkey % 4 * 100 AS int) AS a_ttl, o_orderkey
        FROM {orders}""",
    "alias_obs": """
        SELECT concat('h', cast(p_partkey AS string), '.net') AS name, 'CNAME' AS rtype,
            CASE WHEN p_partkey % 61 = 7 THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode,
            CASE WHEN p_partkey % 61 = 7 THEN '' WHEN p_partkey % 50 = 0 THEN concat('h', cast(p_partkey AS string), '.net.')
                 WHEN p_partkey % 50 = 1 THEN concat('end', cast(p_partkey % 3 AS string), '.org')
                 WHEN p_partkey % 97 = 5 THEN concat('h', cast(p_partkey + 1 AS string), '.net')
                 WHEN p_partkey % 97 = 6 THEN concat('h', cast(p_partkey - 1 AS string), '.net')
                 ELSE concat('h', cast(cast(floor(p_partkey / 2) AS bigint) AS string), '.net.|ignored.org') END AS answers_txt,
            300 AS ttl, 1 AS seq FROM {part}""",
    "zone_obs": """
        SELECT CASE page_id % 5 WHEN 0 THEN host WHEN 1 THEN 'com' WHEN 2 THEN 'example.net' WHEN 3 THEN 'org'
                ELSE concat('no-', host) END AS name,
            'SOA' AS rtype, CASE WHEN page_id % 7 = 0 THEN 'NODATA' ELSE 'NOERROR' END AS rcode,
            CASE WHEN page_id % 7 = 0 THEN '' ELSE concat('ns', cast(page_id % 3 AS string), '. x ', cast(page_id AS string))
                END AS answers_txt,
            cast(page_id % 100 AS int) AS ttl, page_id AS seq FROM {page_hosts}""",
    "reverse_obs": """
        SELECT concat('1.', cast(o_custkey % 256 AS string), '.0.10.in-addr.arpa') AS name, 'PTR' AS rtype,
            CASE WHEN o_custkey % 256 % 5 = 0 THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode,
            CASE WHEN o_custkey % 256 % 5 = 0 THEN ''
                ELSE concat('host', cast(o_custkey % 256 AS string), '.isp', cast(o_custkey % 4 AS string), '.co.uk.') END
                AS answers_txt, 60 AS ttl, 1 AS seq FROM {orders}
        UNION ALL
        SELECT concat('2.', cast(o_orderkey % 50 AS string), '.1.10.in-addr.arpa'), 'PTR', 'NOERROR',
            concat('srv', cast(o_orderkey % 50 % 9 AS string), '.net'), 30, 1 FROM {orders}""",
    "host_obs": """
        SELECT concat('www.', domain) AS name, 'A' AS rtype,
            CASE WHEN c_custkey % 3 = 0 THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode,
            CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('198.51.100.', cast(c_custkey % 250 AS string), '|198.51.101.1')
                END AS answers_txt, 60 AS ttl, 1 AS seq FROM {mail_facts}
        UNION ALL
        SELECT concat('www.', domain), CASE WHEN c_custkey % 2 = 0 THEN 'CNAME' ELSE 'AAAA' END, 'NOERROR',
            CASE WHEN c_custkey % 2 = 0 THEN concat('cdn', cast(c_custkey % 5 AS string), '.net.') ELSE '2001:db8::9' END,
            60, 1 FROM {mail_facts}
        UNION ALL
        SELECT concat('mail.', domain), CASE WHEN c_custkey % 5 = 0 THEN 'A' ELSE 'AAAA' END, 'NOERROR', '203.0.113.77',
            60, 1 FROM {mail_facts}
        UNION ALL
        SELECT lower(mx_host_norm), 'A', 'NOERROR', concat('203.0.113.', cast(c_custkey % 3 AS string), '|203.0.114.1'), 600, 1
        FROM {mail_facts}
        UNION ALL
        SELECT lower(mx_host_norm), 'AAAA', CASE WHEN c_custkey % 3 = 1 THEN 'SERVFAIL' ELSE 'NOERROR' END,
            CASE WHEN c_custkey % 3 = 1 THEN '' ELSE '2001:db8::a' END, 601, 1 FROM {mail_facts}""",
    "text_obs": """
        SELECT CASE c_custkey % 4 WHEN 0 THEN domain WHEN 1 THEN concat('_dmarc.', domain)
                WHEN 2 THEN concat('default._bimi.', domain) ELSE domain END AS name, 'TXT' AS rtype, 'NOERROR' AS rcode,
            CASE c_custkey % 4 WHEN 0 THEN 'V=spf1 a|v=DMARC1 own' WHEN 1 THEN 'x v=DMARC1; p=reject'
                WHEN 2 THEN 'v=BIMI1; l=https' ELSE 'other|v=spf1 -all' END AS answers_txt,
            cast(c_custkey % 50 AS int) AS ttl, 1 AS seq FROM {mail_facts}
        UNION ALL
        SELECT concat('_mta-sts.', domain), 'TXT', CASE WHEN c_custkey % 3 = 0 THEN 'NODATA' ELSE 'NOERROR' END,
            CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat('v=mta-sts: |id=', cast(c_custkey AS string)) END, 5, 1
        FROM {mail_facts}
        UNION ALL
        SELECT concat('_smtp._tls.', domain), 'TXT', 'NOERROR', concat('v=TLSRPT1; rua=mailto:', domain), 5, 1
        FROM {mail_facts}""",
    "asked_names": """
        SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN domain ELSE concat('a.', domain) END AS domain,
            domain AS registered_domain FROM {mail_facts}""",
    "service_obs": """
        SELECT event_id, concat(CASE event_id % 3 WHEN 0 THEN '_xmpp._tcp.' WHEN 1 THEN '_sip._tcp.' ELSE '_ldap._tcp.' END,
                'u', cast(user_id AS string), '.example.com') AS name,
            CASE event_type WHEN 'view' THEN 'A' ELSE 'SRV' END AS rtype,
            CASE WHEN (user_id + event_id % 3) % 4 = 0 THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode,
            CASE WHEN (user_id + event_id % 3) % 4 = 0 THEN '' ELSE '1 1 5060 sip.example.com' END AS answers_txt,
            60 AS ttl, event_id AS seq, user_id FROM {events}""",
    "keyed_obs": """
        SELECT event_id, CASE WHEN rtype = 'TXT' THEN 'DNSKEY' ELSE rtype END AS rtype, name, rcode, answers_txt FROM {obs}""",
    "chunk_runs": """
        SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'com' WHEN '2-HIGH' THEN 'uk' ELSE 'rest' END AS bucket,
            o_custkey % 40 AS chunk,
            CASE o_orderpriority WHEN '1-URGENT' THEN 100 WHEN '2-HIGH' THEN 12 ELSE 200 END AS target_qps,
            o_orderkey % 10 AS start_s, 10 + o_orderkey % 7 + o_custkey % 40 AS end_s FROM {orders}""",
    "zone_domains": """
        SELECT c_custkey AS k, c_nationkey AS n, concat('c', cast(c_custkey AS string), '.example.com') AS domain FROM {customer}""",
    "policy_files": """
        SELECT domain AS regdom, concat('version: STSv1', chr(10), 'mode: Enforce', chr(10), 'max_age: ',
            cast(86400 + k % 5 AS string)) AS policy_text FROM {zone_domains} WHERE k % 4 = 1""",
    "zone_facts": """
        SELECT name, rtype, rcode, CASE WHEN rcode = 'NOERROR' THEN answers_txt ELSE '' END AS answers_txt, ttl, 1 AS seq FROM (
        SELECT domain AS name, 'NS' AS rtype, CASE WHEN k % 7 = 6 THEN 'NXDOMAIN' WHEN k % 9 = 0 THEN 'TIMEOUT' ELSE 'NOERROR' END AS rcode,
            concat('NS1.dns', cast(n AS string), '.net|ns2.dns', cast(n AS string), '.net') AS answers_txt, 300 AS ttl FROM {zone_domains}
        UNION ALL SELECT domain, 'SOA', CASE WHEN k % 7 = 6 THEN 'NXDOMAIN' WHEN k % 3 = 0 THEN 'NODATA' ELSE 'NOERROR' END,
            concat('ns1.dns', cast(n AS string), '.net. hostmaster.example.com. ', cast(2024000000 + k AS string), ' 7200 900 1209600 300'),
            301 FROM {zone_domains}
        UNION ALL SELECT domain, 'A', CASE WHEN k % 7 = 6 THEN 'NXDOMAIN' WHEN k % 18 IN (0, 5) THEN 'SERVFAIL' ELSE 'NOERROR' END,
            concat('192.0.2.', cast(k % 200 AS string), '|198.51.100.', cast(k % 100 AS string)), cast(60 * (k % 4) AS int)
            FROM {zone_domains}
        UNION ALL SELECT domain, 'AAAA', CASE WHEN k % 2 = 0 THEN 'NOERROR' ELSE 'NODATA' END,
            concat('2001:db8::', cast(k % 50 + 1 AS string)), cast(k % 7 AS int)
            FROM {zone_domains}
        UNION ALL SELECT domain, 'MX', CASE WHEN k % 7 = 6 THEN 'NXDOMAIN' ELSE 'NOERROR' END,
            CASE WHEN k % 13 = 0 THEN concat('5:mail.', domain, '.') ELSE concat('20:backup.mail', cast(n AS string), '.net.|10:mx',
                cast(k % 3 AS string), '.mail', cast(n AS string), '.net.|10:later.mail.net') END, cast(k % 9 AS int)
            FROM {zone_domains}
        UNION ALL SELECT domain, 'TXT', 'NOERROR', 'V=spf1 a|note|v=DMARC1 own', 63 FROM {zone_domains} WHERE k % 3 = 0
        UNION ALL SELECT domain, 'CAA', 'NOERROR', CASE WHEN k % 8 = 0 THEN '0 issue "letsencrypt.org"' ELSE '0 issue "ca.example"' END, 64
            FROM {zone_domains} WHERE k % 4 = 0
        UNION ALL SELECT domain, 'NAPTR', 'NOERROR', concat('10 20 "s" "SIP+D2U" "" _sip._udp.', domain, '.'), 65
            FROM {zone_domains} WHERE k % 6 = 0
        UNION ALL SELECT domain, 'CNAME', 'NOERROR', concat('Alias', cast(n AS string), '.net.'), 66 FROM {zone_domains} WHERE k % 17 = 0
        UNION ALL SELECT domain, 'DNSKEY', 'NOERROR', '257 3 8 key', 67 FROM {zone_domains} WHERE k % 2 = 1
        UNION ALL SELECT concat('www.', domain), 'A', CASE WHEN k % 3 = 2 THEN 'NXDOMAIN' ELSE 'NOERROR' END,
            concat('203.0.113.', cast(k % 50 AS string), '|203.0.113.200'), 68 FROM {zone_domains}
        UNION ALL SELECT concat('www.', domain), 'CNAME', 'NOERROR', concat('cdn', cast(k % 5 AS string), '.net.'), 69
            FROM {zone_domains} WHERE k % 2 = 0
        UNION ALL SELECT concat('mail.', domain), 'A', 'NOERROR', concat('203.0.113.', cast(100 + k % 50 AS string)), 70
            FROM {zone_domains} WHERE k % 5 <> 0
        UNION ALL SELECT concat('mail.', domain), 'CNAME', 'NOERROR', concat('pop', cast(k % 3 AS string), '.net.'), 70
            FROM {zone_domains} WHERE k % 3 = 1
        UNION ALL SELECT concat('_xmpp._tcp.', domain), 'SRV', CASE WHEN k % 5 = 0 THEN 'SERVFAIL' ELSE 'NOERROR' END,
            concat('5 0 5222 chat.', domain, '.|6 0 5222 spare.net.'), 84 FROM {zone_domains} WHERE k % 2 = 0
        UNION ALL SELECT concat('_sip._tcp.', domain), 'SRV', 'NOERROR', '1 10 5060 sip.voice.net', 85 FROM {zone_domains} WHERE k % 3 = 0
        UNION ALL SELECT concat('_ldap._tcp.', domain), 'SRV', 'NOERROR', '1 10 389 ldap.net', 86 FROM {zone_domains}
        UNION ALL SELECT concat('_dmarc.', domain), 'TXT', 'NOERROR', 'v=DMARC1; p=reject', 71 FROM {zone_domains} WHERE k % 2 = 0
        UNION ALL SELECT concat('default._bimi.', domain), 'TXT', 'NOERROR', 'v=BIMI1; l=https', 72 FROM {zone_domains} WHERE k % 5 = 1
        UNION ALL SELECT concat('_mta-sts.', domain), 'TXT', CASE WHEN k % 3 = 0 THEN 'NODATA' ELSE 'NOERROR' END,
            concat('v=mta-sts: |id=', cast(k AS string)), 73 FROM {zone_domains}
        UNION ALL SELECT concat('_smtp._tls.', domain), 'TXT', 'NOERROR', concat('v=TLSRPT1; rua=mailto:', domain), 74
            FROM {zone_domains} WHERE k % 4 < 3
        UNION ALL SELECT concat('mx', cast(j AS string), '.mail', cast(n AS string), '.net'), CASE j WHEN 2 THEN 'CNAME' ELSE 'A' END,
            'NOERROR', CASE j WHEN 2 THEN concat('Relay', cast(n AS string), '.org.')
                ELSE concat('10.1.', cast(n AS string), '.', cast(j + 1 AS string), '|10.1.', cast(n AS string), '.9') END, 75
            FROM (SELECT DISTINCT n, k % 3 AS j FROM {zone_domains}) hosts
        UNION ALL SELECT concat('relay', cast(n AS string), '.org'), CASE n % 4 WHEN 0 THEN 'CNAME' ELSE 'A' END, 'NOERROR',
            CASE n % 4 WHEN 0 THEN concat('end', cast(n % 3 AS string), '.org.') ELSE concat('10.2.', cast(n AS string), '.9') END, 76
            FROM (SELECT DISTINCT n FROM {zone_domains}) zones
        UNION ALL SELECT concat('end', cast(n AS string), '.org'), 'A', 'NOERROR', concat('10.3.0.', cast(n + 1 AS string)), 77
            FROM (SELECT DISTINCT n % 3 AS n FROM {zone_domains}) ends
        UNION ALL SELECT concat('ns1.dns', cast(n AS string), '.net'), 'A', 'NOERROR', concat('10.4.', cast(n AS string), '.1'), 78
            FROM (SELECT DISTINCT n FROM {zone_domains}) zones
        UNION ALL SELECT concat('ns1.dns', cast(n AS string), '.net'), 'AAAA', 'NOERROR', concat('2001:db8:4::', cast(n + 1 AS string)), 79
            FROM (SELECT DISTINCT n FROM {zone_domains}) zones
        UNION ALL SELECT concat(cast(j + 1 AS string), '.', cast(n AS string), '.1.10.in-addr.arpa'), 'PTR', 'NOERROR',
            concat('ptr', cast(j AS string), '.mail', cast(n AS string), '.net.'), 80
            FROM (SELECT DISTINCT n, k % 2 AS j FROM {zone_domains}) hosts
        UNION ALL SELECT concat('9.', cast(n AS string), '.1.10.in-addr.arpa'), 'PTR', 'NOERROR', 'shared.hosting.org', 81
            FROM (SELECT DISTINCT n FROM {zone_domains}) zones
        UNION ALL SELECT concat(cast(x AS string), '.113.0.203.in-addr.arpa'), 'PTR', CASE WHEN x % 4 = 1 THEN 'SERVFAIL' ELSE 'NOERROR' END,
            concat('web', cast(x AS string), '.hosting.net.'), 82
            FROM (SELECT DISTINCT k % 50 + 100 * (k % 2) AS x FROM {zone_domains}) webs
        UNION ALL SELECT concat(cast(x AS string), '.2.0.192.in-addr.arpa'), 'PTR', 'NOERROR', concat('a', cast(x AS string), '.isp.net'), 83
            FROM (SELECT DISTINCT k % 200 AS x FROM {zone_domains}) homes WHERE x % 2 = 0) facts""",
}


def parts(sql: str) -> list[str]:
    """Names that an input refers to."""
    return [name for _, name, _, _ in string.Formatter().parse(sql) if name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, streams: tuple[str, ...] = ()) -> DataFrame:
    """A given table or a derived input as a DataFrame; tables named in ``streams`` are read as streams."""
    if name in streams:
        schema = table(spark, sf_dir, name).schema
        # A glob, because a stream takes no plain file as its path; it fits a file and a folder.  The file limit
        # bounds what one key can bring to a stateful function in one trigger.
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
        return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet*")
    if name in TABLES:
        return table(spark, sf_dir, name)
    sql = INPUTS[name]
    return spark.sql(sql, **{p: load(spark, sf_dir, p, streams) for p in dict.fromkeys(parts(sql))})


@lru_cache(maxsize=None)
def _chain(name: str) -> tuple[str, ...]:
    out: list[str] = []
    for p in parts(INPUTS[name]):
        if p not in TABLES:
            out += [x for x in _chain(p) if x not in out]
    return (*out, name) if name not in out else tuple(out)


def oracle(body: str, *names: str) -> str:
    """Oracle SQL: the inputs as common table expressions in front of the body."""
    order: list[str] = []
    for n in names:
        order += [x for x in _chain(n) if x not in order]
    ctes = [f"{n} AS ({INPUTS[n].format(**{p: p for p in parts(INPUTS[n])})})" for n in order]
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ", ".join([*ctes, body[len("WITH RECURSIVE"):].strip()])
    if body.upper().startswith("WITH"):
        return "WITH " + ", ".join([*ctes, body[len("WITH"):].strip()])
    return ("WITH " + ", ".join(ctes) + " " + body) if ctes else body


def listed(c: str):
    """Pipe-joined text as a list, '' as an empty list."""
    return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))


def observations(spark: SparkSession, sf_dir: str, streams: tuple[str, ...] = ()) -> DataFrame:
    """Observation table, or stream, out of the events."""
    raw = load(spark, sf_dir, "obs", streams)
    return raw.select(
        "name", "rtype", "rcode", listed("answers_txt").alias("answers"), "ttl",
        F.col("observed_ts").cast("timestamp").alias("observed_ts"),
    )


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "suffix_list")


def seq_observations(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Observation table out of an input that numbers its rows instead of timing them."""
    return load(spark, sf_dir, name).select(
        "name", "rtype", "rcode", listed("answers_txt").alias("answers"), "ttl",
        F.timestamp_seconds("seq").alias("observed_ts"),
    )
