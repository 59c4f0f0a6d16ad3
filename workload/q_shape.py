"""Names, lists, addresses and record texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.inputs import NOW, load, suffixes, table
from workload.registry import query
from zonelens.functions import hosts as H
from zonelens.functions import ips as I
from zonelens.functions import policies as P
from zonelens.functions import records as R
from zonelens.functions.banners import banner_line
from zonelens.operators import normalize
from zonelens.operators.banners import unique_hosts
from zonelens.operators.suffixes import with_registered_domain


@query("clean_domains", """
    SELECT page_id, lower(regexp_replace(trim(domain), '[.]+$', '')) AS domain FROM crawl_list
    WHERE regexp_replace(trim(domain), '[.]+$', '') <> ''""", "crawl_list")
def clean_domains(spark, sf):
    return normalize.clean_domains(load(spark, sf, "crawl_list"))


@query("normalize_hosts", """
    SELECT p_partkey, lower(concat(regexp_replace(p_name, '[^A-Za-z0-9-]', '', 'g'), '.',
        regexp_replace(p_brand, '[^A-Za-z0-9-]', '', 'g'), '.', regexp_replace(p_type, '[^A-Za-z0-9-]', '', 'g'),
        '.com')) AS host FROM part""")
def normalize_hosts(spark, sf):
    raw = F.concat(F.lit("_"), "p_name", F.lit("."), "p_brand", F.lit("..-"), "p_type", F.lit("-.COM."))
    df = table(spark, sf, "part").select("p_partkey", raw.alias("host"))
    return normalize.normalize_hosts(df, ["host"])


@query("normalize_hosts_idna")
def normalize_hosts_idna(spark, sf):
    words = F.posexplode(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0))).alias("at", "word")
    df = table(spark, sf, "documents").select("doc_id", words)
    df = df.select("doc_id", "at", F.concat("word", F.lit(".Example.com")).alias("host"))
    return normalize.normalize_hosts(df, ["host"])


_TXT = """CASE p_size % 4 WHEN 0 THEN concat('"', p_name, '"') WHEN 1 THEN concat('  "', p_name, '"  ')
    WHEN 2 THEN concat('"', p_name) ELSE concat(' ', p_name, ' ') END"""


@query("normalize_txt", """
    SELECT p_partkey, CASE p_size % 4 WHEN 2 THEN concat('"', p_name) ELSE p_name END AS txt FROM part""")
def normalize_txt(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.expr(_TXT).alias("txt"))
    return df.withColumn("txt", H.normalize_txt(F.col("txt")))


@query("registered_domain", """
    WITH m AS (SELECT page_id, host, max(n_labels) AS k FROM page_hosts
            LEFT JOIN suffix_list ON host = suffix OR ends_with(host, concat('.', suffix)) GROUP BY page_id, host),
        s AS (SELECT page_id, host, coalesce(k, 0) AS k, string_split(host, '.') AS parts FROM m)
    SELECT page_id, host, CASE WHEN len(parts) <= k THEN host
            ELSE array_to_string(list_slice(parts, len(parts) - k, len(parts)), '.') END AS registered_domain,
        CASE WHEN k > 0 THEN parts[len(parts)] ELSE '' END AS tld FROM s""", "page_hosts", "suffix_list")
def registered_domain(spark, sf):
    return with_registered_domain(load(spark, sf, "page_hosts"), suffixes(spark, sf), host="host")


_RULES = ("com", "net", "org", "*.example.com", "!tiontion.example.com", "!blog.tionsh.example.com", "example.net",
          "m.thth.ea.ththth.example.net", "*.on.example.org", "deep.m.tion.ththth.example.net")


@query("registered_domain_rules", f"""
    WITH r AS (SELECT regexp_replace(rule, '^(!|[*][.])', '') AS body, CASE WHEN starts_with(rule, '!') THEN 'except'
                WHEN starts_with(rule, '*.') THEN 'wild' ELSE 'plain' END AS kind FROM (SELECT unnest({list(_RULES)}) AS rule)),
        n AS (SELECT body, kind, len(string_split(body, '.')) AS n FROM r),
        h AS (SELECT page_id, host, len(string_split(host, '.')) AS parts FROM (SELECT page_id, host FROM page_hosts
            UNION ALL SELECT page_id, concat('Deep.x.', host) FROM page_hosts)),
        m AS (SELECT page_id, host, max(CASE WHEN kind = 'except' THEN n - 1 END) AS ex,
                max(CASE WHEN kind = 'plain' THEN n WHEN kind = 'wild' AND parts > n THEN n + 1 END) AS k
            FROM h LEFT JOIN n ON lower(host) = body OR ends_with(lower(host), concat('.', body)) GROUP BY page_id, host),
        s AS (SELECT page_id, host, coalesce(ex, k, 0) AS k, string_split(lower(host), '.') AS parts FROM m)
    SELECT page_id, host, CASE WHEN len(parts) <= k THEN lower(host)
            ELSE array_to_string(list_slice(parts, len(parts) - k, len(parts)), '.') END AS registered_domain,
        CASE WHEN k > 0 THEN parts[len(parts)] ELSE '' END AS tld FROM s""", "page_hosts")
def registered_domain_rules(spark, sf):
    """Plain, wildcard and exception rules, and rules with six labels."""
    hosts = load(spark, sf, "page_hosts").select("page_id", "host")
    hosts = hosts.unionByName(hosts.withColumn("host", F.concat(F.lit("Deep.x."), "host")))
    rules = spark.createDataFrame([(r,) for r in _RULES], "suffix string")
    return with_registered_domain(hosts, rules, host="host")


@query("naive_tld", """
    SELECT page_id, CASE WHEN contains(host, '.') THEN list_last(string_split(host, '.')) ELSE '' END AS tld,
        list_last(string_split(host, '.')) AS mx_tld FROM page_hosts""", "page_hosts")
def naive_tld(spark, sf):
    host = F.col("host")
    return load(spark, sf, "page_hosts").select(
        "page_id", H.naive_tld(host).alias("tld"), H.last_label(host).alias("mx_tld")
    )


_V4 = "'^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])[.]){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$'"
_TO_INT = """CASE WHEN regexp_matches({ip}, """ + _V4 + """) THEN
    cast(split_part({ip}, '.', 1) AS bigint) * 16777216 + cast(split_part({ip}, '.', 2) AS bigint) * 65536
    + cast(split_part({ip}, '.', 3) AS bigint) * 256 + cast(split_part({ip}, '.', 4) AS bigint) END"""


_DOTTED = "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+"


@query("ipv4_to_int", f"""
    WITH x AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_DOTTED}')) AS ip_text FROM documents)
    SELECT doc_id, ip_text, {_TO_INT.replace('{ip}', 'ip_text')} AS ip_int FROM x""")
def ipv4_to_int(spark, sf):
    """Every dotted number of every document."""
    found = F.explode(F.regexp_extract_all("text", F.lit(_DOTTED), F.lit(0))).alias("ip_text")
    return table(spark, sf, "documents").select("doc_id", found).withColumn("ip_int", I.ipv4_to_int(F.col("ip_text")))


@query("line_ip_ints", f"""
    SELECT l_orderkey, l_linenumber, ip, {_TO_INT.replace('{ip}', 'ip')} AS ip_int,
        CASE WHEN regexp_matches(ip, {_V4}) THEN 4 WHEN ip LIKE '%:%' THEN 6 END AS version,
        CASE WHEN regexp_matches(ip, {_V4}) THEN concat(split_part(ip, '.', 4), '.', split_part(ip, '.', 3), '.',
                split_part(ip, '.', 2), '.', split_part(ip, '.', 1), '.in-addr.arpa')
             WHEN ip LIKE '%:%' THEN concat(split_part(ip, '::', 2), repeat('.0', 19), '.',
                regexp_extract(ip, ':([0-9]):', 1), '.0.0.0.8.b.d.0.1.0.0.2.ip6.arpa') END AS pointer,
        lower(CASE WHEN ip LIKE '2001:DB8:0::%' THEN concat('2001:db8::', split_part(ip, '::', 2)) ELSE ip END)
            AS canonical
    FROM line_ips""", "line_ips")
def line_ip_ints(spark, sf):
    ip = F.col("ip")
    return load(spark, sf, "line_ips").select(
        "l_orderkey", "l_linenumber", "ip", I.ipv4_to_int(ip).alias("ip_int"), I.ip_version(ip).alias("version"),
        I.reverse_pointer(ip).alias("pointer"), I.canonical_ip(ip).alias("canonical"),
    )


@query("valid_ips", f"""
    WITH x AS (SELECT l_orderkey, ip FROM line_ips WHERE ip LIKE '%:%' OR regexp_matches(ip, {_V4}))
    SELECT i.l_orderkey, i.l_linenumber, CASE WHEN ip LIKE '%:%' OR regexp_matches(ip, {_V4})
        THEN concat('10.0.0.1|', ip) ELSE '10.0.0.1' END AS good FROM line_ips i""", "line_ips")
def valid_ips(spark, sf):
    both = F.array(F.lit(" 10.0.0.1 "), F.col("ip"), F.lit("10.0.0.256"), F.lit("1::2::3"))
    return load(spark, sf, "line_ips").select(
        "l_orderkey", "l_linenumber", F.array_join(I.valid_ips(both), "|").alias("good")
    )


@query("all_ips", """
    SELECT o_orderkey, concat(a_txt, CASE WHEN aaaa_txt = '' THEN '' ELSE concat('|', aaaa_txt) END, '|10.9.9.9') AS ips
    FROM records""", "records")
def all_ips(spark, sf):
    from zonelens.operators.topology import all_ips as union_of

    a, aaaa = F.split("a_txt", r"\|"), F.filter(F.array("aaaa_txt"), lambda x: x != "")
    ips = union_of(a, aaaa, F.array(F.lit("10.9.9.9")), F.slice(a, 1, 1))
    return load(spark, sf, "records").select("o_orderkey", F.array_join(ips, "|").alias("ips"))


@query("first_token", """
    SELECT o_orderkey, split_part(a_txt, '|', 1) AS first_text, split_part(a_txt, '|', 1) AS first_item
    FROM records""", "records")
def first_token(spark, sf):
    items = F.concat(F.array(F.lit("")), F.split("a_txt", r"\|"))
    return load(spark, sf, "records").select(
        "o_orderkey", H.first_token(F.col("a_txt")).alias("first_text"), H.first_item(items).alias("first_item")
    )


@query("ns_normalize", """
    WITH p AS (SELECT c_custkey, ns AS ns_raw, list_filter(list_transform(regexp_split_to_array(ns, '[ |,]+'),
            lambda x: lower(rtrim(x, '.'))), lambda x: x <> '') AS l FROM mail_facts)
    SELECT c_custkey, ns_raw, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS ns,
        cast(len(list_distinct(l)) AS integer) AS n FROM p""", "mail_facts")
def ns_normalize(spark, sf):
    out = normalize.normalize_ns(load(spark, sf, "mail_facts").select("c_custkey", "ns"))
    return out.select("c_custkey", "ns_raw", "ns", F.size("ns_list_norm").alias("n"))


@query("split_tokens", """
    SELECT c_custkey, array_to_string(list_transform(list_filter(regexp_split_to_array(ns, '[ |,]+'),
        lambda x: x <> ''), lambda x: rtrim(x, '.')), ';') AS tokens FROM mail_facts""", "mail_facts")
def split_tokens(spark, sf):
    return load(spark, sf, "mail_facts").select(
        "c_custkey", F.array_join(H.raw_tokens(F.col("ns")), ";").alias("tokens")
    )


@query("list_join", """
    SELECT p_partkey, concat(p_name, '|', p_type) AS joined, concat(replace(p_name, ' ', ':'), ',', p_type) AS csv,
        concat(cast(p_size AS varchar), ':', lower(p_type), ',0:', lower(regexp_replace(p_brand, '#', ''))) AS mx,
        concat(p_name, ' ', p_type) AS fragments, concat(p_name, p_type) AS records FROM part""")
def list_join(spark, sf):
    both = F.array("p_name", F.lit(None).cast("string"), "p_type")
    mx = R.parse_mx(F.array(F.concat_ws(":", F.col("p_size").cast("string"), "p_type"), F.col("p_brand")), 0)
    return table(spark, sf, "part").select(
        "p_partkey",
        H.join_list(both).alias("joined"),
        H.hosts_csv(F.array(F.replace("p_name", F.lit(" "), F.lit(",")), "p_type")).alias("csv"),
        R.mx_to_string(mx).alias("mx"),
        H.join_txt_fragments(both).alias("fragments"),
        H.join_txt_records(both).alias("records"),
    )


@query("parse_mx", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE cast(l_suppkey % 90 AS integer) END AS first_pref,
        CASE WHEN l_partkey % 10 = 0 THEN concat('mx', cast(l_suppkey AS varchar), '.net')
             ELSE concat('mx', cast(l_suppkey AS varchar), '.net') END AS first_host,
        CASE WHEN l_partkey % 10 = 0 OR l_suppkey % 90 <= 40 THEN concat('mx', cast(l_suppkey AS varchar), '.net')
             ELSE 'b:c.org' END AS primary_host,
        CASE WHEN l_partkey % 10 = 0 THEN 0 WHEN l_suppkey % 90 <= 40 THEN cast(l_suppkey % 90 AS integer) ELSE 40 END
            AS primary_pref
    FROM lineitem""")
def parse_mx(spark, sf):
    host = F.concat(F.lit("mx"), F.col("l_suppkey").cast("string"), F.lit(".net."))
    pref = (F.col("l_suppkey") % 90).cast("string")
    first = F.when(F.col("l_partkey") % 10 == 0, host).otherwise(F.concat_ws(":", pref, host))
    items = F.array(first, F.lit("40:b:c.org."), F.lit("40:later.org"))
    parsed, sortable = R.parse_mx(items), R.parse_mx(items, 0)
    best = R.primary_mx(sortable)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", parsed[0]["preference"].alias("first_pref"),
        parsed[0]["exchange"].alias("first_host"), best["exchange"].alias("primary_host"),
        best["preference"].alias("primary_pref"),
    )


@query("parse_srv", """
    SELECT l_orderkey, l_linenumber, '_sip' AS service, '_tcp' AS proto,
        CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_linenumber END AS priority,
        CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE cast(l_quantity AS integer) END AS weight,
        CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 5060 END AS port,
        CASE WHEN l_partkey % 7 = 0 THEN concat('bad ', l_returnflag) ELSE concat('sip', cast(l_suppkey AS varchar), '.org') END
            AS target,
        CASE WHEN l_partkey % 7 = 0 THEN concat('None None None bad ', l_returnflag)
             ELSE concat(cast(l_linenumber AS varchar), ' ', cast(cast(l_quantity AS integer) AS varchar), ' 5060 sip',
                cast(l_suppkey AS varchar), '.org') END AS shown,
        60 AS ttl FROM lineitem""")
def parse_srv(spark, sf):
    good = F.concat_ws(
        " ", F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string"), F.lit("5060"),
        F.concat(F.lit("sip"), F.col("l_suppkey").cast("string"), F.lit(".org.")),
    )
    text = F.when(F.col("l_partkey") % 7 == 0, F.concat(F.lit("bad "), "l_returnflag", F.lit("."))).otherwise(good)
    parsed = R.parse_srv(F.array(text), F.lit("_sip._tcp.example.com"), F.lit(60))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.inline(parsed), R.format_srv(parsed)[0].alias("shown")
    )


@query("parse_caa", """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_linenumber END AS flags,
        CASE WHEN l_partkey % 7 = 0 THEN '' ELSE 'issue' END AS tag,
        CASE WHEN l_partkey % 7 = 0 THEN 'plain' WHEN l_partkey % 7 < 3 THEN 'LetsEncrypt.org' ELSE 'other.ca' END AS value,
        CASE WHEN l_partkey % 7 = 0 THEN 'None  "plain"' ELSE concat(cast(l_linenumber AS varchar), ' issue "',
            CASE WHEN l_partkey % 7 < 3 THEN 'LetsEncrypt.org' ELSE 'other.ca' END, '"') END AS shown,
        CASE WHEN l_partkey % 7 IN (1, 2) THEN 'letsencrypt,zerossl' ELSE 'zerossl' END AS issuers
    FROM lineitem""")
def parse_caa(spark, sf):
    ca = F.when(F.col("l_partkey") % 7 < 3, F.lit("LetsEncrypt.org")).otherwise(F.lit("other.ca"))
    good = F.concat(F.col("l_linenumber").cast("string"), F.lit(' issue "'), ca, F.lit('"'))
    text = F.when(F.col("l_partkey") % 7 == 0, F.lit("plain")).otherwise(good)
    parsed = R.parse_caa(F.array(text))
    issuers = R.caa_free_issuers(F.array(text, F.lit("0 iodef ZeroSSL"), F.lit("0 issue zerossl")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.inline(parsed), R.format_caa(parsed)[0].alias("shown"),
        F.array_join(issuers, ",").alias("issuers"),
    )


@query("parse_naptr", """
    SELECT l_orderkey, l_linenumber, l_linenumber AS "order", cast(l_quantity AS integer) AS preference, 's' AS flags,
        concat('SIP+', l_returnflag) AS services, '' AS regexp, concat('s', cast(l_suppkey AS varchar), '.org') AS replacement,
        concat(cast(l_linenumber AS varchar), ' ', cast(cast(l_quantity AS integer) AS varchar), ' "s" "SIP+', l_returnflag,
            '" "" s', cast(l_suppkey AS varchar), '.org') AS shown FROM lineitem""")
def parse_naptr(spark, sf):
    text = F.concat(
        F.col("l_linenumber").cast("string"), F.lit(" "), F.col("l_quantity").cast("int").cast("string"),
        F.lit(' "s" "SIP+'), "l_returnflag", F.lit('" "" s'), F.col("l_suppkey").cast("string"), F.lit(".org."),
    )
    parsed = R.parse_naptr(F.array(text))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.inline(parsed), R.format_naptr(parsed)[0].alias("shown")
    )


@query("parse_soa", """
    SELECT event_id, rtrim(split_part(answers_txt, ' ', 1), '.') AS mname, rtrim(split_part(answers_txt, ' ', 2), '.') AS rname,
        try_cast(nullif(split_part(answers_txt, ' ', 3), '') AS bigint) AS serial,
        try_cast(nullif(split_part(answers_txt, ' ', 4), '') AS bigint) AS refresh,
        try_cast(nullif(split_part(answers_txt, ' ', 5), '') AS bigint) AS retry, cast(NULL AS bigint) AS expire,
        try_cast(nullif(split_part(answers_txt, ' ', 7), '') AS bigint) AS minimum
    FROM obs WHERE rtype = 'SOA'""", "obs")
def parse_soa(spark, sf):
    obs = load(spark, sf, "obs").filter("rtype = 'SOA'")
    return obs.select("event_id", R.parse_soa(F.col("answers_txt")).alias("s")).select("event_id", "s.*")


_POLICY = """CASE c_custkey % 5 WHEN 0 THEN concat('v=mta-sts: id=', cast(c_custkey AS string), '; x')
    WHEN 1 THEN concat('v = STSv1; id=', cast(c_custkey AS string)) WHEN 2 THEN 'V=MTA_STS' WHEN 3 THEN '' ELSE 'v=spf1' END"""
_RPT = """CASE c_custkey % 3 WHEN 0 THEN concat('v=TLSRPT1; rua=mailto:a', cast(c_custkey AS string), '@x.org ;z')
    WHEN 1 THEN concat('v=TLSRPTv1; rua=mailto:b', cast(c_custkey AS string), '@x.org') ELSE '' END"""


@query("mta_sts_texts", f"""
    WITH p AS (SELECT c_custkey, {_POLICY} AS t, {_RPT} AS r FROM customer)
    SELECT c_custkey, regexp_matches(t, '(?i)v *= *(stsv1|mta[-_]?sts)') AS has_mta_sts,
        nullif(regexp_extract(t, '(?i)^v *= *mta-sts: *id=([^; ]+)', 1), '') AS sts_id,
        nullif(regexp_extract(t, '(?i)^v *= *stsv1 *; *id=([^; ]+)', 1), '') AS sts_id_strict,
        CASE WHEN c_custkey % 2 = 0 THEN 'enforce' ELSE '' END AS mode,
        CASE WHEN c_custkey % 2 = 0 THEN 86400 + c_custkey END AS max_age,
        CASE c_custkey % 3 WHEN 0 THEN concat('mailto:a', cast(c_custkey AS varchar), '@x.org') ELSE r END AS rua,
        CASE c_custkey % 3 WHEN 1 THEN concat('mailto:b', cast(c_custkey AS varchar), '@x.org') ELSE r END AS rua_strict
    FROM p""")
def mta_sts_texts(spark, sf):
    body = F.concat(
        F.lit("version: STSv1\nmode: Enforce\nmx: *.x.org\nMAX_AGE : "), (86400 + F.col("c_custkey")).cast("string")
    )
    df = table(spark, sf, "customer").select(
        "c_custkey", F.expr(_POLICY).alias("t"), F.expr(_RPT).alias("r"),
        F.when(F.col("c_custkey") % 2 == 0, body).otherwise(F.lit("nothing")).alias("policy"),
    )
    t, r, policy = F.col("t"), F.col("r"), F.col("policy")
    return df.select(
        "c_custkey", P.has_mta_sts(t).alias("has_mta_sts"), P.mta_sts_id(t).alias("sts_id"),
        P.mta_sts_id(t, strict=True).alias("sts_id_strict"), P.mta_sts_mode(policy).alias("mode"),
        P.mta_sts_max_age(policy).alias("max_age"), P.tlsrpt_rua(r).alias("rua"),
        P.tlsrpt_rua(r, strict=True).alias("rua_strict"),
    )


@query("txt_policies", """
    SELECT event_id, CASE WHEN answers_txt LIKE 'v=spf1%' THEN 'v=spf1 include:mail.net -all'
            WHEN answers_txt LIKE 'v=DMARC%' THEN 'note v=spf1' ELSE '' END AS spf,
        CASE WHEN answers_txt LIKE 'v=DMARC%' THEN 'v=DMARC1; p=none' ELSE '' END AS dmarc, '' AS bimi
    FROM obs WHERE rtype = 'TXT'""", "obs")
def txt_policies(spark, sf):
    txts = F.split("answers_txt", r"\|")
    return load(spark, sf, "obs").filter("rtype = 'TXT'").select(
        "event_id", P.first_containing(txts, "v=spf1").alias("spf"), P.first_starting(txts, "v=dmarc").alias("dmarc"),
        P.first_containing(txts, "v=bimi").alias("bimi"),
    )


@query("banner_line", """
    SELECT s_suppkey, CASE WHEN starts_with(trim(banner_raw), '220') THEN trim(banner_raw) END AS line FROM banners""",
       "banners")
def reply_line(spark, sf):
    raw = F.concat(F.lit("\r\nnoise\r\n"), "banner_raw", F.lit("\r\n220 second"))
    first = banner_line(raw)
    df = load(spark, sf, "banners").select("s_suppkey", first.alias("line"))
    return df.withColumn("line", F.when(F.col("line") != "220 second", F.col("line")))


@query("cert_features", f"""
    SELECT o_orderkey, cast(floor((epoch(o_orderdate) + o_custkey - epoch(TIMESTAMP '{NOW}')) / 86400) AS integer)
            AS days_left,
        concat('countryName=US, organizationName=', o_orderpriority) AS issuer, cast(o_custkey % 3 AS integer) AS san_count
    FROM orders""")
def cert_features(spark, sf):
    end = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.col("o_custkey"))
    pad = F.when(F.dayofmonth(end) < 10, F.lit(" ")).otherwise(F.lit(""))
    text = F.concat(F.date_format(end, "MMM "), pad, F.date_format(end, "d HH:mm:ss yyyy"), F.lit(" GMT"))
    pair = "array<struct<k:string,v:string>>"
    issuer = F.array(
        F.struct(F.lit("countryName").alias("k"), F.lit("US").alias("v")),
        F.struct(F.lit("organizationName").alias("k"), F.col("o_orderpriority").alias("v")),
    ).cast(pair)
    names = F.slice(F.array(F.lit("a"), F.lit("b")), F.lit(1), (F.col("o_custkey") % 3).cast("int"))
    now = F.lit(NOW).cast("timestamp")
    features = P.certificate_features(text, issuer, names, now)
    return table(spark, sf, "orders").select("o_orderkey", features.alias("f")).select("o_orderkey", "f.*")


@query("high_risk_tld", """
    SELECT o_orderkey, domain, list_last(string_split(domain, '.')) IN ('tk','ml','ga','gq','pw','cn','xyz','top','click',
        'buzz','win','site','club','icu','bid','cam','date','monster','quest','xin') AS high_risk FROM crawl_orders""",
       "crawl_orders")
def high_risk_tld(spark, sf):
    return load(spark, sf, "crawl_orders").withColumn("high_risk", H.is_high_risk_tld(F.col("domain")))


@query("blank_to_null", """
    SELECT s_suppkey, mx_host, registered_domain, nullif(banner_raw, '') AS banner_raw, error, tries FROM banners""",
       "banners")
def blank_to_null(spark, sf):
    return normalize.blank_to_null(load(spark, sf, "banners"))


@query("conform_columns", """
    SELECT c_custkey, domain, ns, ip_int, '' AS mx_host_final, cast(NULL AS bigint) AS ns_ip_int,
        try_cast(mx_host_norm AS bigint) AS mx_host_norm, cast(0 AS integer) AS n_missing FROM mail_facts""",
       "mail_facts")
def conform_columns(spark, sf):
    df = load(spark, sf, "mail_facts").select("c_custkey", "domain", "ns", "ip_int", "mx_host_norm")
    wanted = {"domain": "string", "mx_host_final": "string", "ns_ip_int": "bigint", "mx_host_norm": "bigint"}
    out = normalize.conform(df, wanted)
    return out.withColumn("n_missing", F.lit(len(normalize.missing_columns(out, list(wanted)))))


@query("unique_hosts", """
    SELECT DISTINCT lower(mx_host_norm) AS mx_host FROM mail_facts""", "mail_facts")
def distinct_hosts(spark, sf):
    df = load(spark, sf, "mail_facts").select(F.concat(F.lit(" "), "mx_host_norm").alias("mx_host"))
    return unique_hosts(df).orderBy("mx_host")
