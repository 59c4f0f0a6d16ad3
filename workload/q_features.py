"""Name features, scores, greetings, entities, crawl plans and penalties (H1-H17, H21-H23, E, F, C5, C7, D24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.inputs import NOW, listed, load, table
from workload.registry import query
from zonelens.functions import banners as B
from zonelens.functions.identity import entity_key
from zonelens.operators import banners, crawl, graph, penalty
from zonelens.operators.dga import with_dga_features
from zonelens.operators.scoring import rule_predicate, score
from zonelens.plans.profiles import PROFILES

# --- name features ---------------------------------------------------------------------------------------------


def dga_rows(spark, sf):
    """Hosts of pages and lines with made-up registered domains of many shapes."""
    line = load(spark, sf, "lineitem")
    key = F.concat(
        F.col("l_orderkey").cast("string"), F.lit("q"), F.col("l_partkey").cast("string"), F.lit("zx"),
        F.repeat(F.lit("k"), (F.col("l_linenumber") * 3).cast("int")),
    )
    regdom = F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(F.concat(key, F.lit(".com")))
    host = (
        F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("a.b.c."), regdom))
        .when(F.col("l_suppkey") % 5 == 1, F.concat(F.lit("not"), regdom))
        .when(F.col("l_suppkey") % 5 == 2, F.concat(F.lit("very-long-label-of-some-host-x.y.z.w.other."), "l_returnflag"))
        .when(F.col("l_suppkey") % 5 == 3, regdom)
    )
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", regdom.alias("registered_domain"),
        F.upper(host).alias("www"), F.concat(F.lit("m."), regdom, F.lit(".")).alias("mx_host_norm"),
    )


_DGA = """
    base AS (SELECT *, CASE WHEN l_linenumber = 1 THEN '' ELSE concat(cast(l_orderkey AS varchar), 'q',
            cast(l_partkey AS varchar), 'zx', repeat('k', l_linenumber * 3), '.com') END AS rd FROM lineitem),
    hosts AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rd, rtrim(split_part(rd, '.', 1), '.') AS sld,
            lower(CASE l_suppkey % 5 WHEN 0 THEN concat('a.b.c.', rd) WHEN 1 THEN concat('not', rd)
                WHEN 2 THEN concat('very-long-label-of-some-host-x.y.z.w.other.', l_returnflag) WHEN 3 THEN rd ELSE '' END) AS www,
            concat('m.', rd, '.') AS mx FROM base),
    ent AS (SELECT sld, -sum(p * log2(p)) AS e FROM (SELECT s.sld, count(*) / length(s.sld) AS p
            FROM (SELECT DISTINCT sld FROM hosts WHERE sld <> '') s, unnest(string_split(s.sld, '')) AS u(ch)
            GROUP BY s.sld, u.ch) GROUP BY sld),
    lab AS (SELECT *, list_filter(string_split(rtrim(www, '.'), '.'), lambda x: x <> '') AS wl,
            list_filter(string_split(rtrim(left(www, length(www) - length(rd)), '.'), '.'), lambda x: x <> '') AS wp,
            list_filter(string_split(rtrim(mx, '.'), '.'), lambda x: x <> '') AS ml FROM hosts),
    depth AS (SELECT *,
            CASE WHEN www = '' OR rd = '' THEN 0 WHEN NOT ends_with(www, rd) THEN greatest(len(wl) - 2, 0) ELSE len(wp) END AS d1,
            CASE WHEN www = '' OR rd = '' THEN 0 WHEN NOT ends_with(www, rd)
                THEN coalesce(list_max(list_transform(wl, lambda x: length(x))), 0)
                ELSE coalesce(list_max(list_transform(wp, lambda x: length(x))), 0) END AS m1,
            CASE WHEN rd = '' THEN 0 ELSE greatest(len(ml) - 2, 0) END AS d2,
            CASE WHEN rd = '' THEN 0 ELSE coalesce(list_max(list_transform(ml, lambda x: length(x))), 0) END AS m2 FROM lab),
    feat AS (SELECT d.l_orderkey, d.l_linenumber, d.l_partkey, d.l_suppkey, d.rd AS registered_domain, d.sld AS dga_sld,
            cast(length(d.sld) AS integer) AS dga_sld_length, coalesce(e.e, 0.0) AS ent,
            CASE WHEN d.sld = '' THEN 0.0 ELSE length(regexp_replace(d.sld, '[^0-9]', '', 'g')) / length(d.sld) END AS dig,
            CASE WHEN d.sld = '' THEN 0.0 ELSE length(regexp_replace(d.sld, '[^aeiou]', '', 'g')) / length(d.sld) END AS vow,
            cast(greatest(d1, d2) AS integer) AS subdomain_depth, cast(greatest(m1, m2) AS integer) AS subdomain_max_label
        FROM depth d LEFT JOIN ent e ON d.sld = e.sld),
    pts AS (SELECT *, cast(greatest(0, least(10, (CASE WHEN ent > 4.0 THEN 5 WHEN ent > 3.5 THEN 3 ELSE 0 END)
            + (CASE WHEN dga_sld_length > 20 THEN 3 WHEN dga_sld_length > 15 THEN 2 ELSE 0 END)
            + (CASE WHEN dig > 0.30 THEN 2 ELSE 0 END) + (CASE WHEN vow < 0.20 AND dga_sld_length > 6 THEN 1 ELSE 0 END)
            + (CASE WHEN subdomain_depth >= 5 THEN 4 WHEN subdomain_depth >= 3 THEN 2 ELSE 0 END)
            + (CASE WHEN subdomain_max_label >= 25 THEN 2 WHEN subdomain_max_label >= 18 THEN 1 ELSE 0 END))) AS integer)
            AS subdomain_points FROM feat)"""


@query("dga_features", f"""
    WITH {_DGA}
    SELECT l_orderkey, l_linenumber, dga_sld, dga_sld_length, round(ent, 6) AS dga_sld_entropy, round(dig, 6) AS dga_sld_digit_ratio,
        round(vow, 6) AS dga_sld_vowel_ratio, subdomain_depth, subdomain_max_label FROM pts""")
def dga_features(spark, sf):
    ratios = ["dga_sld_entropy", "dga_sld_digit_ratio", "dga_sld_vowel_ratio"]
    return with_dga_features(dga_rows(spark, sf)).select(
        "l_orderkey", "l_linenumber", "dga_sld", "dga_sld_length", *[F.round(c, 6).alias(c) for c in ratios],
        "subdomain_depth", "subdomain_max_label",
    )


@query("dga_points", f"""
    WITH {_DGA}
    SELECT l_orderkey, l_linenumber, subdomain_points, subdomain_points >= 6 AS is_dga_suspect,
        '2025.10.20-rc1' AS dga_features_version FROM pts""")
def dga_points(spark, sf):
    return with_dga_features(dga_rows(spark, sf)).select(
        "l_orderkey", "l_linenumber", "subdomain_points", "is_dga_suspect", "dga_features_version"
    )


# --- scores ----------------------------------------------------------------------------------------------------

# Score inputs: the feature rows with flags that follow from the keys.
_FLAGS = {
    "is_phishing": "l_partkey % 11 = 0",
    "is_malware": "CASE WHEN l_partkey % 13 = 0 THEN 'true' WHEN l_partkey % 13 = 1 THEN 'junk' ELSE 'no' END",
    "is_new_domain": "CASE WHEN l_suppkey % 3 = 0 THEN l_suppkey % 2 END",
    "ns_changed": "l_suppkey % 4 = 0",
    "ip_changed": "l_suppkey % 4 = 1",
    "is_dynamic_dns": "l_suppkey % 10 = 0",
    "is_cdn_ugc": "l_suppkey % 9 = 0",
    "mx_self_hosted_candidate": "CASE WHEN l_suppkey % 6 < 4 THEN l_suppkey % 2 = 0 END",
    "mx_banner_inferred": "l_suppkey % 5 <> 0",
    "mx_trust_nudge": "cast(l_suppkey % 3 - 1 AS double)",
    "provider_trust_nudge": "cast(l_suppkey % 2 AS double)",
    "is_top_100k": "l_partkey % 17 = 0",
    "is_top_1m": "l_partkey % 5 = 0",
    "mx_banner_category": "CASE l_partkey % 4 WHEN 0 THEN 'enterprise' WHEN 1 THEN 'seg' WHEN 2 THEN 'esp' END",
    "asn_risk_level": "CASE l_suppkey % 5 WHEN 0 THEN 'suspicious' WHEN 1 THEN 'malicious' WHEN 2 THEN 'critical' WHEN 3 THEN '' END",
    "parking_points": "CASE WHEN l_suppkey % 2 = 0 THEN cast(l_suppkey % 8 AS integer) END",
    "dmarc": "CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'v=DMARC1' END",
    "mx_mbp_category": "CASE WHEN l_suppkey % 7 = 0 THEN 'self_hosted_mail' END",
}


def _flagged(spark, sf):
    return with_dga_features(dga_rows(spark, sf)).withColumns({n: F.expr(e) for n, e in _FLAGS.items()})


def _truth(column: str) -> str:
    if column in ("is_malware",):
        return f"coalesce(try_cast({column} AS boolean), FALSE)"
    if column in ("is_new_domain", "mx_trust_nudge", "provider_trust_nudge"):
        return f"coalesce({column} <> 0, FALSE)"
    return f"coalesce({column}, FALSE)"


def _score_sql(name: str) -> str:
    """Oracle of a profile: one CASE per rule, written out from the rule table."""
    profile = PROFILES[name]
    known = set(_FLAGS) | {"subdomain_points"}
    terms, reasons = [], []
    for rule in [*profile["positive_rules"], *profile["trust_rules"]]:
        test = rule.get("when", {"column": rule.get("column")})
        column = test["column"]
        if column not in known:
            continue
        if "equals" in test:
            value = test["equals"]
            met = f"coalesce({column} = {str(value).upper() if isinstance(value, bool) else repr(value)}, FALSE)"
        elif "in" in test:
            met = f"coalesce({column} IN ({', '.join(repr(v) for v in test['in'])}), FALSE)"
        else:
            met = _truth(column)
        terms.append(f"CASE WHEN {met} THEN {rule['points']} ELSE 0 END")
        reasons.append(f"CASE WHEN {met} THEN '{rule['name']}({rule['points']})' END")
    for rule in profile["mapped_rules"]:
        arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in rule["map"].items())
        points = f"(CASE {rule['column']} {arms} ELSE 0 END)"
        terms.append(points)
        reasons.append(f"CASE WHEN {points} <> 0 THEN concat('{rule['name']}(', {points}, ')') END")
    terms += [f"coalesce({c}, 0)" for c in profile["direct_add_columns"]]
    flags = ", ".join(f"{e} AS {n}" for n, e in _FLAGS.items())
    limit = profile["thresholds"]
    return f"""
    WITH {_DGA}, fl AS (SELECT *, {flags} FROM pts),
    sc AS (SELECT *, cast(least(greatest({' + '.join(terms)}, 0), 100) AS integer) AS risk_score,
        concat_ws(', ', {', '.join(reasons)}) AS risk_reasons FROM fl)
    SELECT l_orderkey, l_linenumber, risk_score, CASE WHEN risk_score >= {limit['critical']} THEN 'critical'
        WHEN risk_score >= {limit['high']} THEN 'high' WHEN risk_score >= {limit['medium']} THEN 'medium' ELSE 'low' END
        AS risk_level, risk_reasons, '2025.10.20-rc1' AS score_version FROM sc"""


def _register_score(name: str) -> None:
    @query(f"risk_score_{name}", _score_sql(name))
    def run(spark, sf):
        return score(_flagged(spark, sf), name).select(
            "l_orderkey", "l_linenumber", "risk_score", "risk_level", "risk_reasons", "score_version"
        )


for _profile in PROFILES:
    _register_score(_profile)


@query("risk_breakdown", f"""
    WITH {_DGA}, fl AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _FLAGS.items())} FROM pts)
    SELECT l_orderkey, l_linenumber, cast(greatest(coalesce(is_phishing, FALSE)::INT * 90 + coalesce(parking_points, 0) - subdomain_points, 5)
            AS integer) AS risk_score,
        cast(coalesce(is_phishing, FALSE)::INT + (coalesce(parking_points, 0) <> 0)::INT + (subdomain_points <> 0)::INT AS integer)
            AS n_parts,
        cast(coalesce(is_phishing, FALSE)::INT * 90 + coalesce(parking_points, 0) - subdomain_points AS double) AS parts_sum FROM fl""")
def risk_breakdown(spark, sf):
    profile = {
        "min_score": 5,
        "max_score": 1000,
        "positive_rules": [{"name": "p", "column": "is_phishing", "points": 90}, {"name": "gone", "column": "nope", "points": 3}],
        "direct_add_columns": ["parking_points", "absent_column"],
        "direct_sub_columns": ["subdomain_points"],
    }
    out = score(_flagged(spark, sf), profile)
    total = F.aggregate("risk_breakdown", F.lit(0.0), lambda acc, x: acc + x["points"])
    return out.select(
        "l_orderkey", "l_linenumber", "risk_score", F.size("risk_breakdown").alias("n_parts"), total.alias("parts_sum")
    )


@query("rule_predicates", """
    SELECT l_orderkey, l_linenumber, l_quantity > 25 AS gt, l_quantity < 10 AS lt, l_returnflag IN ('A', 'R') AS is_in,
        l_linestatus = 'F' AS equals, l_partkey % 2 <> 0 AS truthy, FALSE AS missing FROM lineitem""")
def rule_predicates(spark, sf):
    line = table(spark, sf, "lineitem").withColumn("odd", F.col("l_partkey") % 2)
    rules = {
        "gt": {"when": {"column": "l_quantity", "gt": 25}},
        "lt": {"when": {"column": "l_quantity", "lt": 10}},
        "is_in": {"when": {"column": "l_returnflag", "in": ["A", "R"]}},
        "equals": {"when": {"column": "l_linestatus", "equals": "F"}},
        "truthy": {"column": "odd"},
        "missing": {"column": "no_such_column"},
    }
    return line.select(
        "l_orderkey", "l_linenumber", *[rule_predicate(r, line.schema).alias(n) for n, r in rules.items()]
    )


# --- greetings -------------------------------------------------------------------------------------------------

_PARSED = """
    parsed AS (SELECT *, trim(banner_raw) AS line,
        regexp_extract(trim(banner_raw), '(?i)^[ ]*220[ ]+([^ ]+)(?:[ ]+(?:E?SMTP)[ ]*(.*))?$', 1) AS host_a,
        trim(regexp_extract(trim(banner_raw), '(?i)^[ ]*220[ ]+([^ ]+)(?:[ ]+(?:E?SMTP)[ ]*(.*))?$', 2)) AS details_a,
        regexp_extract(trim(banner_raw), '(?i)^220[ ]+([^ ]+)(?:[ ]+(?:E?SMTP)[ ]*(.*))?', 1) AS host_o,
        trim(regexp_extract(trim(banner_raw), '(?i)^220[ ]+([^ ]+)(?:[ ]+(?:E?SMTP)[ ]*(.*))?', 2)) AS details_o
        FROM banners)"""


def _rules_sql(rules, host: str, details: str, field: str, unknown: str, flag: str = "(?i)") -> str:
    arms = []
    for r in rules:
        tests = [f"regexp_matches({c}, '{flag}{p}')" for c, p in ((host, r.host), (details, r.details)) if p]
        value = getattr(r, field)
        arms.append(f"WHEN {' AND '.join(tests)} THEN {value if isinstance(value, int) else repr(value)}")
    return f"CASE {' '.join(arms)} ELSE {unknown} END"


@query("banner_parse", f"""
    WITH {_PARSED}
    SELECT s_suppkey, nullif(host_a, '') AS host_anchored, CASE WHEN host_a <> '' THEN details_a END AS details_anchored,
        nullif(host_o, '') AS host_open, CASE WHEN host_o <> '' THEN details_o END AS details_open FROM parsed""", "banners")
def banner_parse(spark, sf):
    raw = F.col("banner_raw")
    (ha, da), (ho, do) = B.parse_banner(raw, True), B.parse_banner(raw, False)
    return load(spark, sf, "banners").select(
        "s_suppkey", ha.alias("host_anchored"), da.alias("details_anchored"), ho.alias("host_open"), do.alias("details_open")
    )


@query("banner_features", f"""
    WITH {_PARSED}, f AS (SELECT *, lower(host_a) AS h, lower(details_a) AS d FROM parsed),
    v AS (SELECT s_suppkey, h, details_a, mx_host, registered_domain,
        {_rules_sql(B.FINGERPRINTS, 'h', 'd', 'provider', "'Unknown'", '')} AS mx_banner_provider,
        {_rules_sql(B.FINGERPRINTS, 'h', 'd', 'category', "'unknown'", '')} AS mx_banner_category,
        {_rules_sql(B.FINGERPRINTS, 'h', 'd', 'confidence', '0', '')} AS mx_banner_confidence FROM f)
    SELECT s_suppkey, h AS mx_banner_host, details_a AS mx_banner_details, mx_banner_provider, mx_banner_category,
        cast(mx_banner_confidence AS integer) AS mx_banner_confidence, mx_banner_provider <> 'Unknown' AS mx_banner_inferred,
        mx_host = registered_domain OR ends_with(mx_host, concat('.', registered_domain)) AS mx_self_hosted_candidate,
        '2025.10.21-rc1' AS banner_features_version FROM v""", "banners")
def banner_features(spark, sf):
    df = load(spark, sf, "banners").select(
        "s_suppkey", "registered_domain", F.col("mx_host").alias("mx_host_norm"), F.col("banner_raw").alias("mx_banner_raw")
    )
    return banners.banner_features(df).drop("registered_domain", "mx_host_norm", "mx_banner_raw")


def _classified(rules) -> str:
    return f"""
    WITH {_PARSED}
    SELECT 1705708800::BIGINT AS ts_unix, mx_host, banner_raw, host_o AS banner_host, details_o AS banner_details,
        {_rules_sql(rules, 'host_o', 'details_o', 'provider', "'Unknown'")} AS provider,
        {_rules_sql(rules, 'host_o', 'details_o', 'category', "'Unknown'")} AS category,
        cast({_rules_sql(rules, 'host_o', 'details_o', 'confidence', '0')} AS integer) AS confidence,
        coalesce(error, '') AS error, tries FROM parsed"""


@query("banner_classify", _classified(B.CLASSIFIER), "banners")
def banner_classify(spark, sf):
    return banners.classify_banners(load(spark, sf, "banners"), 1705708800)


@query("banner_classify_rule_file", _classified(B.RULE_FILE), "banners")
def banner_classify_rule_file(spark, sf):
    return banners.classify_banners(load(spark, sf, "banners"), 1705708800, B.RULE_FILE)


@query("banner_hints", f"""
    WITH {_PARSED}, t AS (SELECT s_suppkey, concat(host_o, ' ', details_o) AS txt FROM parsed)
    SELECT s_suppkey, {_rules_sql(B.HINTS, 'txt', 'txt', 'provider', 'NULL')} AS provider,
        {_rules_sql(B.HINTS, 'txt', 'txt', 'category', 'NULL')} AS category FROM t""", "banners")
def banner_hints(spark, sf):
    host, details = B.parse_banner(F.col("banner_raw"), anchored=False)
    hint = B.infer_provider(host, details)
    return load(spark, sf, "banners").select("s_suppkey", hint["provider"].alias("provider"), hint["category"].alias("category"))


_CACHE = """
    cache AS (SELECT concat('host', cast(c_custkey AS varchar), '.net') AS host,
        CASE WHEN c_custkey % 6 = 0 THEN '' ELSE '220 x' END AS banner,
        CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 1705708800.0::DOUBLE - c_custkey * 3600.0::DOUBLE END AS ts_epoch FROM customer)"""


def _banner_cache(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("host"), key.cast("string"), F.lit(".net")).alias("host"),
        F.when(key % 6 == 0, F.lit("")).otherwise(F.lit("220 x")).alias("banner"),
        F.when(key % 9 != 0, F.lit(1705708800.0) - key * 3600.0).alias("ts_epoch"),
    )


@query("fresh_banners", f"""
    WITH {_CACHE} SELECT host FROM cache WHERE banner <> '' AND ts_epoch IS NOT NULL
    AND floor((1705708800 - ts_epoch) / 86400) <= 30""")
def fresh_banners(spark, sf):
    return banners.fresh_banners(_banner_cache(spark, sf), 1705708800).select("host")


@query("banner_worklist", f"""
    WITH {_CACHE}, fresh AS (SELECT host FROM cache WHERE banner <> '' AND ts_epoch IS NOT NULL
        AND floor((1705708800 - ts_epoch) / 86400) <= 30)
    SELECT DISTINCT concat('host', cast(o_custkey AS varchar), '.net') AS mx_host FROM orders
    WHERE concat('host', cast(o_custkey AS varchar), '.net') NOT IN (SELECT host FROM fresh)""")
def banner_worklist(spark, sf):
    hosts = table(spark, sf, "orders").select(
        F.concat(F.lit(" HOST"), F.col("o_custkey").cast("string"), F.lit(".net")).alias("mx_host")
    )
    return banners.banner_worklist(hosts, _banner_cache(spark, sf), 1705708800)


@query("mx_host_list", """
    SELECT DISTINCT lower(mx_host_norm) AS mx_host FROM mail_facts""", "mail_facts")
def mx_host_list(spark, sf):
    df = load(spark, sf, "mail_facts").select(F.concat("mx_host_norm", F.lit("..")).alias("mx_host"))
    return banners.mx_hosts(df)


# --- entities --------------------------------------------------------------------------------------------------


def _entity_records(spark, sf):
    return load(spark, sf, "records").select(
        "domain", "registered_domain", "status", listed("a_txt").alias("a"), listed("aaaa_txt").alias("aaaa"), "a_ttl",
        F.lit(None).cast("int").alias("aaaa_ttl"),
    )


@query("entity_domains", """
    SELECT lower(domain) AS domain, lower(coalesce(nullif(registered_domain, ''), domain)) AS apex, 'com' AS tld,
        concat('{"status":"', status, '"}') AS source_flags, 1 AS id_is_set FROM records""", "records")
def entity_domains(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    out = graph.entity_domains(_entity_records(spark, sf), now)
    return out.select(
        "domain", "apex", "tld", "source_flags", F.col("domain_id").isNotNull().cast("int").alias("id_is_set")
    )


@query("entity_ips", """
    SELECT DISTINCT u.ip, CASE WHEN u.ip LIKE '%:%' THEN 6 ELSE 4 END AS ip_version FROM records r,
        unnest(string_split(concat(a_txt, CASE WHEN aaaa_txt = '' THEN '' ELSE concat('|', aaaa_txt) END), '|')) AS u(ip)""",
       "records")
def entity_ips(spark, sf):
    out = graph.entity_ips(_entity_records(spark, sf), F.lit(NOW).cast("timestamp"))
    return out.select("ip", F.col("ip_version").cast("int").alias("ip_version"))


@query("entity_edges", """
    WITH e AS (SELECT r.domain, u.ip, 'A' AS edge_type, CASE WHEN a_ttl > 0 THEN a_ttl ELSE 300 END AS ttl FROM records r,
            unnest(string_split(a_txt, '|')) AS u(ip)
        UNION ALL SELECT domain, aaaa_txt, 'AAAA', 300 FROM records WHERE aaaa_txt <> '')
    SELECT domain, ip, edge_type, concat('{"ttl":', cast(ttl AS varchar), '}') AS attrs FROM e""", "records")
def entity_edges(spark, sf):
    records = _entity_records(spark, sf)
    now = F.lit(NOW).cast("timestamp")
    edges = graph.entity_edges(records, now).select("src_id", "dst_id", "edge_type", "attrs")
    domains = graph.entity_domains(records, now).select(F.col("domain_id").alias("src_id"), "domain")
    ips = graph.entity_ips(records, now).select(F.col("ip_id").alias("dst_id"), "ip")
    return edges.join(domains, "src_id").join(ips, "dst_id").select("domain", "ip", "edge_type", "attrs")


@query("entity_keys", """
    SELECT l_orderkey, l_linenumber, concat('d', cast(l_partkey AS varchar), '.com') AS domain,
        concat(cast(l_partkey % 256 AS varchar), '.', cast(l_suppkey % 256 AS varchar), '.0.0/16') AS prefix,
        concat('2001:db8:', CASE WHEN l_suppkey % 16 = 0 THEN ':' ELSE concat(substr('0123456789abcdef', cast(l_suppkey % 16 + 1 AS bigint), 1), '::') END,
            '/48') AS prefix6,
        concat('AS', cast(l_suppkey AS varchar)) AS asn, 'ab01cd' AS cert, lower(concat(l_returnflag, 'jarm')) AS jarm,
        concat('feed_', cast(l_orderkey AS varchar), '_', cast(cast(floor(l_quantity) AS bigint) AS varchar)) AS observation
    FROM lineitem""")
def entity_keys(spark, sf):
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    address = F.concat_ws(
        ".", (p % 256).cast("string"), (s % 256).cast("string"), F.col("l_linenumber").cast("string"), F.lit("9/16")
    )
    address6 = F.concat(F.lit("2001:0DB8:"), F.hex(s % 16), F.lit(":7::"), F.col("l_linenumber").cast("string"), F.lit("/48"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        entity_key("domain", F.concat(F.lit(" D"), p.cast("string"), F.lit(".Com "))).alias("domain"),
        entity_key("prefix", address).alias("prefix"),
        entity_key("prefix", address6).alias("prefix6"),
        entity_key("asn", s).alias("asn"),
        entity_key("cert", F.lit(" AB:01 cd")).alias("cert"),
        entity_key("jarm", F.concat("l_returnflag", F.lit("JARM "))).alias("jarm"),
        entity_key("observation", F.lit("feed"), F.col("l_orderkey"), F.col("l_quantity")).alias("observation"),
    )


@query("entity_merge", """
    WITH b AS (SELECT o_custkey AS k, o_orderdate AS ts, concat('d', cast(o_custkey AS varchar), '.com') AS domain FROM orders)
    SELECT domain, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM b GROUP BY domain""")
def entity_merge(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("d"), F.col("o_custkey").cast("string"), F.lit(".com")).alias("domain"),
        F.lit("").alias("registered_domain"), F.lit("alive").alias("status"), F.col("o_orderdate").cast("timestamp").alias("ts"),
    )
    early = graph.entity_domains(orders.filter("ts < '1998-01-01'"), F.col("ts"))
    late = graph.entity_domains(orders.filter("ts >= '1998-01-01'"), F.col("ts"))
    merged = graph.merge_nodes(early, late, "domain_id")
    return merged.select(
        "domain", F.unix_micros("first_seen_ts").alias("first_us"), F.unix_micros("last_seen_ts").alias("last_us")
    )


# --- crawl plans and penalties ---------------------------------------------------------------------------------

_BUCKET = """CASE WHEN list_last(string_split(domain, '.')) IN ('tk','ml','ga','gq','pw','cn','xyz','top','click','buzz','win',
    'site','club','icu','bid','cam','date','monster','quest','xin') THEN 'highrisk' WHEN ends_with(domain, '.uk') THEN 'uk'
    WHEN ends_with(domain, '.de') THEN 'de' WHEN ends_with(domain, '.com') OR ends_with(domain, '.net') THEN 'com' ELSE 'rest' END"""
_CHUNKED = f"""
    b AS (SELECT domain, {_BUCKET} AS bucket FROM crawl_orders),
    numbered AS (SELECT bucket, domain, row_number() OVER (PARTITION BY bucket ORDER BY md5(domain), domain) - 1 AS i,
        CASE bucket WHEN 'com' THEN 5000 WHEN 'uk' THEN 1000 WHEN 'de' THEN 2000 ELSE 10000 END AS size FROM b),
    chunks AS (SELECT bucket, domain, cast(floor(i / size) AS bigint) + 1 AS chunk FROM numbered)"""


@query("tld_buckets", f"SELECT {_BUCKET} AS bucket, count(*) AS domains FROM crawl_orders GROUP BY 1", "crawl_orders")
def tld_buckets(spark, sf):
    return crawl.tld_bucket_counts(load(spark, sf, "crawl_orders"))


@query("crawl_chunks", f"WITH {_CHUNKED} SELECT bucket, domain, chunk FROM chunks", "crawl_orders")
def crawl_chunks(spark, sf):
    return crawl.assign_chunks(load(spark, sf, "crawl_orders"))


@query("crawl_chunks_small", f"""
    WITH {_CHUNKED} SELECT bucket, domain, cast(floor(i / 7) AS bigint) + 1 AS chunk FROM numbered""", "crawl_orders")
def crawl_chunks_small(spark, sf):
    return crawl.assign_chunks(load(spark, sf, "crawl_orders"), size=F.lit(7))


@query("crawl_plan", f"""
    WITH {_CHUNKED}, n AS (SELECT bucket, chunk, count(*) AS domains FROM chunks GROUP BY 1, 2),
    r AS (SELECT *, chunk = 1 AND bucket IN ('com', 'uk', 'de') AS warm_up,
            cast(CASE bucket WHEN 'com' THEN 200 WHEN 'uk' THEN 50 WHEN 'de' THEN 50 ELSE 200 END AS integer) AS base,
            CASE bucket WHEN 'uk' THEN 12 WHEN 'de' THEN 12 WHEN 'highrisk' THEN 128 ELSE 500 END AS cap,
            CASE bucket WHEN 'com' THEN CASE chunk WHEN 1 THEN 1 WHEN 2 THEN 5 ELSE 9 END WHEN 'uk' THEN 2 WHEN 'de' THEN 4
                WHEN 'highrisk' THEN 7 ELSE 8 END AS slot FROM n),
    q AS (SELECT *, CASE WHEN warm_up THEN cast(base / 2 AS integer) ELSE base END AS requested_qps FROM r)
    SELECT bucket, chunk, domains, warm_up, requested_qps, cast(least(cap, 500, requested_qps) AS integer) AS qps,
        cast(least(500, cap, requested_qps) AS integer) AS concurrency, row_number() OVER (ORDER BY slot, bucket, chunk) AS position
    FROM q""", "crawl_orders")
def crawl_plan(spark, sf):
    return crawl.crawl_plan(crawl.assign_chunks(load(spark, sf, "crawl_orders")))


@query("crawl_estimate", f"""
    WITH c AS (SELECT {_BUCKET} AS bucket, count(*) AS domains FROM crawl_orders GROUP BY 1),
    e AS (SELECT bucket, domains, cast(ceil(domains / size) AS bigint) AS chunks, cast(qps AS integer) AS qps,
            domains / qps AS processing_time, 0.0::DOUBLE AS cooldown_time, cast(size AS integer) AS chunk_size, domains / qps AS total_time
        FROM (SELECT *, CASE bucket WHEN 'com' THEN 5000 WHEN 'uk' THEN 1000 WHEN 'de' THEN 2000 ELSE 10000 END AS size,
            CASE bucket WHEN 'uk' THEN 12 WHEN 'de' THEN 12 WHEN 'highrisk' THEN 128 ELSE 200 END AS qps FROM c)),
    t AS (SELECT * FROM e UNION ALL SELECT 'total', cast(sum(domains) AS bigint), cast(sum(chunks) AS bigint), NULL,
        sum(processing_time), sum(cooldown_time), NULL, sum(total_time) FROM e)
    SELECT bucket, domains, chunks, qps, round(processing_time, 9) AS processing_time, cooldown_time, chunk_size,
        round(total_time, 9) AS total_time FROM t""", "crawl_orders")
def crawl_estimate(spark, sf):
    out = crawl.crawl_estimate(crawl.tld_bucket_counts(load(spark, sf, "crawl_orders")))
    return out.withColumns({c: F.round(c, 9) for c in ("processing_time", "total_time")})


@query("batch_metrics", """
    SELECT count(*) AS domains, count(*) - count(*) FILTER (status = 'needs_retry') AS results,
        count(*) FILTER (status = 'needs_retry') AS retries, 50.0::DOUBLE AS elapsed_s, count(*) / 50.0::DOUBLE AS domains_per_s FROM records""",
       "records")
def batch_metrics(spark, sf):
    return crawl.batch_metrics(load(spark, sf, "records"), 50.0)


@query("chunk_performance", """
    WITH c AS (SELECT bucket, chunk, count(*) AS domains, cast(max(target_qps) AS integer) AS target_qps,
            (max(end_s) - min(start_s))::DOUBLE AS elapsed_s FROM chunk_runs GROUP BY 1, 2),
    a AS (SELECT *, domains / elapsed_s AS actual_qps FROM c)
    SELECT bucket, chunk, domains, target_qps, elapsed_s, round(actual_qps, 6) AS actual_qps,
        round(abs(actual_qps - target_qps) / target_qps, 6) AS deviation,
        CASE WHEN actual_qps < target_qps * 0.8 THEN 'slow' WHEN actual_qps > target_qps * 1.2 THEN 'fast' ELSE 'ok' END AS flag
    FROM a""", "chunk_runs")
def chunk_performance(spark, sf):
    runs = load(spark, sf, "chunk_runs").withColumns(
        {"started_ts": F.timestamp_seconds("start_s"), "finished_ts": F.timestamp_seconds("end_s")}
    )
    out = crawl.chunk_performance(runs)
    return out.withColumns({c: F.round(c, 6) for c in ("actual_qps", "deviation")})


def penalty_sql(keys: str, select: str, source: str = "probes") -> str:
    return f"""
    m AS (SELECT {keys}, count(*) AS tested, count(*) FILTER (status IN ('TIMEOUT', 'ERROR')) AS failures,
            avg(response_time) AS avg_response_time, count(*) FILTER (rcode = 'SERVFAIL') AS servfails FROM {source} GROUP BY ALL),
    v AS (SELECT *, failures / tested AS failure_rate, failures / tested > 0.3 OR avg_response_time > 3.0 OR servfails > 0 AS in_penalty,
            concat_ws(' | ',
                CASE WHEN failures / tested > 0.3 THEN concat('High failure rate: ',
                    cast(cast(round_even(failures / tested * 100, 0) AS integer) AS varchar), '%') END,
                CASE WHEN avg_response_time > 3.0 THEN concat('Slow responses: ',
                    cast(cast(round_even(avg_response_time, 1) AS decimal(18,1)) AS varchar), 's avg') END,
                CASE WHEN servfails > 0 THEN 'SERVFAIL detected' END) AS why FROM m)
    SELECT {select}"""


_VERDICT = """tld, tested, failures, round(avg_response_time, 6) AS avg_response_time, round(failure_rate, 6) AS failure_rate,
    in_penalty, CASE WHEN in_penalty THEN why ELSE 'OK' END AS reason FROM v"""


@query("tld_penalty", "WITH " + penalty_sql("tld", _VERDICT), "probes")
def tld_penalty(spark, sf):
    out = penalty.tld_penalty(load(spark, sf, "probes"))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_response_time", "failure_rate")})


@query("penalty_wait", "WITH " + penalty_sql("tld", """
    tld, CASE WHEN tld IN ('com', 'uk') THEN 30 ELSE 15 END AS wait_minutes FROM v WHERE in_penalty"""), "probes")
def penalty_wait(spark, sf):
    return penalty.penalty_wait(penalty.tld_penalty(load(spark, sf, "probes")))


@query("penalty_report", "WITH " + penalty_sql("tld", """
    tld, CASE WHEN in_penalty THEN 'PENALTY' ELSE 'OK' END AS state, concat(cast(failures AS varchar), '/', cast(tested AS varchar))
    AS failures, concat(cast(cast(round_even(avg_response_time, 2) AS decimal(18,2)) AS varchar), 's') AS avg_time,
    CASE WHEN in_penalty THEN why ELSE '' END AS reason FROM v"""), "probes")
def penalty_report(spark, sf):
    return penalty.penalty_report(penalty.tld_penalty(load(spark, sf, "probes")))
