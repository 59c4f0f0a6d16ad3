"""Answers of related names: aliases, parent zones, reverse names, sub-hosts, mail and name-server hosts.

Both sides of these joins grow with the data and their keys concentrate (a mail provider's host, a hosting
address, a top-level zone), so they go through :func:`spread_join`, salted by the unique side's own name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions import hosts as H
from zonelens.functions import policies as P
from zonelens.functions.ips import reverse_pointer
from zonelens.operators.joins import Crowded, cut_lineage, hot_keys, hot_lists, spread_join
from zonelens.operators.resolve import is_positive, latest_observation, newest_order, normal_names
from zonelens.operators.suffixes import SuffixTables, with_registered_domain

# Crowded join keys: a frame of them, a short list, or None for "count them here".
Hot = DataFrame | Sequence | None


def _empty() -> Column:
    return F.array().cast("array<string>")


def positive_answers(obs: DataFrame, rtype: str) -> DataFrame:
    """Latest successful answers of one record type: name, answers, ttl."""
    newest = latest_observation(obs.filter(F.col("rtype") == rtype))
    return newest.filter(is_positive(F.col("rcode"), F.col("answers"))).select("name", "answers", "ttl")


def host_answers(obs: DataFrame) -> DataFrame:
    """A, AAAA and CNAME answers of every name side by side, in one aggregation."""
    obs, order = normal_names(obs), newest_order()
    picks = [
        F.max_by(F.struct("rcode", "answers"), F.when(F.col("rtype") == t, order)).alias(f"__{t}")
        for t in ("A", "AAAA", "CNAME")
    ]
    wide = obs.filter(F.col("rtype").isin("A", "AAAA", "CNAME")).groupBy("name").agg(*picks)

    def good(t: str) -> Column:
        answers = F.col(f"__{t}.answers")
        return F.when(is_positive(F.col(f"__{t}.rcode"), answers), answers).otherwise(_empty())

    return wide.select(
        "name",
        good("A").alias("a"),
        good("AAAA").alias("aaaa"),
        F.coalesce(F.lower(H.strip_dots(F.get(good("CNAME"), F.lit(0)))), F.lit("")).alias("cname"),
    )


def alias_edges(obs: DataFrame, cname: DataFrame | None = None) -> DataFrame:
    """name -> target of the first CNAME answer; self-loops and blanks end a chain and are left out.

    ``cname`` are the positive CNAME answers, where the caller has them.
    """
    target = F.lower(H.strip_dots(F.get("answers", F.lit(0))))
    edges = (positive_answers(obs, "CNAME") if cname is None else cname).select("name", target.alias("target"))
    return edges.filter((F.col("target") != "") & (F.col("target") != F.col("name")))


def _extend(first: DataFrame, second: DataFrame) -> DataFrame:
    """Paths of ``first`` carried on by the paths of ``second``; crowded ends are counted on ``first`` itself."""
    hot = hot_lists(first, {"target": F.col("target")})["target"]
    onward = second.select(
        F.col("name").alias("target"), F.col("target").alias("__target"), F.col("chain").alias("__chain")
    )
    joined = spread_join(first, onward, ["target"], ["name"], hot=hot)
    return joined.select(
        "name",
        F.coalesce("__target", "target").alias("target"),
        F.concat("chain", F.coalesce("__chain", _empty())).alias("chain"),
    )


def alias_paths(edges: DataFrame, max_hops: int = 8) -> DataFrame:
    """End and chain of every aliased name after at most ``max_hops`` hops.

    Path lengths are doubled: eight hops take three joins of the edge table, not eight.
    """
    power = edges.select("name", "target", F.array("target").alias("chain"))
    total, length, left = None, 1, max_hops
    while left:
        if left & length:
            total = power if total is None else _extend(total, power)
            left -= length
        if left:
            power = cut_lineage(_extend(power, power))
            length *= 2
    return total


def cname_chain(
    df: DataFrame,
    edges: DataFrame,
    host: str = "host",
    max_hops: int = 8,
    include_start: bool = False,
    spread_by: Sequence[str] = ("domain",),
    hot: Hot = None,
) -> DataFrame:
    """Final host, chain, hop count and alias flag of a host column."""
    paths = alias_paths(edges, max_hops).select(
        F.col("name").alias(host), F.col("target").alias("__end"), F.col("chain").alias("__chain")
    )
    out = spread_join(df, paths, [host], spread_by, hot=hot).withColumn("__chain", F.coalesce("__chain", _empty()))
    start = F.when(F.coalesce(F.col(host), F.lit("")) != "", F.array(F.col(host))).otherwise(_empty())
    return out.withColumns(
        {
            "final_host": F.coalesce("__end", host),
            "cname_chain": F.concat(start, F.col("__chain")) if include_start else F.col("__chain"),
            "cname_hops": F.size("__chain"),
            "has_cname": F.size("__chain") > 0,
        }
    ).drop("__end", "__chain")


def _ancestors(name: Column) -> Column:
    """(zone, depth) of the name itself and of each parent, down to the last label."""
    parts = F.split(H.strip_dots(name), r"\.")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.struct(F.array_join(F.slice(parts, i + 1, F.size(parts) - i), ".").alias("zone"), i.alias("depth")),
    )


def soa_parent_walk(names: DataFrame, obs: DataFrame, name: str = "name") -> DataFrame:
    """Nearest zone with an SOA record: the name itself, else a parent.

    Every name meets its few parents once; the crowded top-level zones are spread over many tasks.
    """
    zones = positive_answers(obs, "SOA").select(
        F.col("name").alias("zone"), F.get("answers", F.lit(0)).alias("soa"), F.col("ttl").alias("soa_ttl")
    )
    asked = names.select(name).distinct()
    steps = asked.select(name, F.inline(_ancestors(F.col(name))))
    hits = spread_join(steps, zones, ["zone"], [name], how="inner")
    nearest = hits.groupBy(name).agg(F.min_by(F.struct("zone", "soa", "soa_ttl", "depth"), "depth").alias("__z"))
    return names.join(
        nearest.select(name, F.col("__z.zone").alias("soa_zone"), "__z.soa", "__z.soa_ttl",
                       F.col("__z.depth").alias("soa_depth")),
        name,
        "left",
    )


def txt_apex_fallback(df: DataFrame, obs: DataFrame, name: str = "domain", apex: str = "registered_domain") -> DataFrame:
    """TXT answers and TTL of a name, or of its registered domain where the name has none."""
    txt = positive_answers(obs, "TXT")
    own = df.join(
        txt.select(F.col("name").alias(name), F.col("answers").alias("__own"), F.col("ttl").alias("__own_ttl")),
        name,
        "left",
    )
    has_apex = (F.col(apex) != "") & (F.col(apex) != F.col(name))
    asks_apex = F.col("__own").isNull() & has_apex
    side = txt.select(
        F.col("name").alias("__apex"), F.col("answers").alias("__up"), F.col("ttl").alias("__up_ttl")
    )
    keyed = own.withColumn("__apex", F.when(asks_apex, F.col(apex)))
    hot = hot_keys(df.filter(has_apex).select(F.col(apex).alias("__apex")), ["__apex"])
    out = spread_join(keyed, side, ["__apex"], [name], hot=hot)
    return out.withColumns(
        {
            "txt": F.coalesce("__own", "__up", _empty()),
            "txt_ttl": F.coalesce("__own_ttl", "__up_ttl"),
            "txt_from_apex": F.col("__own").isNull() & F.col("__up").isNotNull(),
        }
    ).drop("__own", "__own_ttl", "__apex", "__up", "__up_ttl")




# Owner names below a registered domain whose texts are read, by the column they come in.
_POLICY_OWNERS = {"__spf": "", "__dmarc": "_dmarc.", "__bimi": "default._bimi.", "__sts": "_mta-sts.", "__rpt": "_smtp._tls."}


def _policy_text(column: str, answers: Column) -> Column:
    """What is read of the TXT answers of an owner name."""
    marks = {"__spf": "v=spf1", "__dmarc": "v=dmarc", "__bimi": "v=bimi"}
    return P.first_containing(answers, marks[column]) if column in marks else H.join_txt_records(answers)


def owner_answers(names: DataFrame, prefixes: Sequence[str] = ("www", "mail"), apex: str = "registered_domain") -> DataFrame:
    """Answers of the sub-hosts and policy owner names of every domain that has some, side by side in one aggregation.

    ``names`` has one row per name with the positive answers ``a``, ``aaaa``, ``cname`` (text, as in :func:`host_answers`)
    and ``txt``.  A name says itself whose owner name it is, so one join brings all of them to the domains.
    """
    asked = []
    for kind, prefix in {**{p: f"{p}." for p in prefixes}, **_POLICY_OWNERS}.items():
        # A zone without a name has policy owners, but no sub-hosts.
        says = (F.size("a") > 0) & (F.length("name") > len(prefix)) if kind in prefixes else F.size("txt") > 0
        row = F.struct(F.lit(kind).alias("__kind"), F.substring("name", len(prefix) + 1, 2**31 - 1).alias(apex))
        asked.append(F.when(says & F.startswith("name", F.lit(prefix)), row))
    host = F.when(F.col("__kind").isin(*prefixes), F.struct("a", "aaaa", "cname"))
    text = F.lit(None).cast("string")
    for kind in _POLICY_OWNERS:
        text = F.when(F.col("__kind") == kind, _policy_text(kind, F.col("txt"))).otherwise(text)
    said = names.select("a", "aaaa", "cname", "txt", F.inline(F.array_compact(F.array(*asked))))
    said = said.select(apex, "__kind", host.alias("__host"), text.alias("__text"))
    # Each is one name's, so any value is the only one.
    picks = [F.any_value(F.when(F.col("__kind") == p, F.col("__host")), True).alias(f"__{p}") for p in prefixes]
    picks += [F.any_value(F.when(F.col("__kind") == k, F.col("__text")), True).alias(k) for k in _POLICY_OWNERS]
    found = said.groupBy(apex).agg(*picks)
    fields = {"a": "a_list", "aaaa": "aaaa_list", "cname": "cname"}
    hosts = [F.col(f"__{p}.{field}").alias(f"{p}_{column}") for p in prefixes for field, column in fields.items()]
    return found.select(apex, *hosts, *_POLICY_OWNERS)


def attach_owner_answers(
    df: DataFrame, owners: DataFrame, name: str = "domain", apex: str = "registered_domain", hot: Hot = None
) -> DataFrame:
    """Put :func:`owner_answers` on the domains, for :func:`attach_subhost`, :func:`mail_policies` and :func:`mta_sts`."""
    return spread_join(df, owners, [apex], [name], hot=hot)


def mail_policies(
    df: DataFrame,
    obs: DataFrame,
    name: str = "domain",
    apex: str = "registered_domain",
    hot: Hot = None,
    txt: DataFrame | None = None,
    joined: bool = False,
) -> DataFrame:
    """SPF, DMARC and BIMI texts.

    A name with TXT answers of its own is searched there; other names ask the policy owner names.  ``txt`` are the
    positive TXT answers, where the caller has them.  ``joined``: ``df`` went through :func:`attach_owner_answers`, so
    only the name's own texts are joined.
    """
    txt = positive_answers(obs, "TXT") if txt is None else txt
    own = df.join(txt.select(F.col("name").alias(name), F.col("answers").alias("__txt")), name, "left")
    if joined:
        return _mail_fields(own)
    apex_names = df.select(F.col(apex)).distinct()
    # The owner names depend on the registered domain alone, so they are looked up once per domain.
    wide = apex_names
    for column in ("__spf", "__dmarc", "__bimi"):
        prefix = _POLICY_OWNERS[column]
        side = txt.select(F.col("name").alias("__owner"), F.col("answers").alias(column))
        wide = wide.withColumn("__owner", F.concat(F.lit(prefix), F.col(apex))).join(side, "__owner", "left")
        wide = wide.drop("__owner")
    owners = wide.select(apex, *[_policy_text(c, F.col(c)).alias(c) for c in ("__spf", "__dmarc", "__bimi")])
    return _mail_fields(spread_join(own, owners, [apex], [name], hot=hot_keys(df, [apex]) if hot is None else hot))


def _mail_fields(out: DataFrame) -> DataFrame:
    has_own = F.col("__txt").isNotNull()

    def pick(text: Column, fallback: str) -> Column:
        return F.when(has_own, text).otherwise(F.coalesce(F.col(fallback), F.lit("")))

    return out.withColumns(
        {
            "spf": pick(P.first_containing(F.col("__txt"), "v=spf1"), "__spf"),
            "dmarc": pick(P.first_starting(F.col("__txt"), "v=dmarc"), "__dmarc"),
            "bimi": pick(P.first_containing(F.col("__txt"), "v=bimi"), "__bimi"),
        }
    ).drop("__txt", "__spf", "__dmarc", "__bimi")


def mta_sts(
    df: DataFrame,
    obs: DataFrame,
    policies: DataFrame | None = None,
    strict: bool = False,
    name: str = "domain",
    apex: str = "registered_domain",
    hot: Hot = None,
    txt: DataFrame | None = None,
    joined: bool = False,
) -> DataFrame:
    """MTA-STS and TLS-RPT fields from policy owner names and stored policy files (B21-B23); ``txt`` as above.

    ``joined``: ``df`` went through :func:`attach_owner_answers`, so only the policy files are joined.
    """
    if joined:
        if policies is not None:
            df = spread_join(df, policies.select(F.col("regdom").alias(apex), "policy_text"), [apex], [name], hot=hot)
        else:
            df = df.withColumn("policy_text", F.lit(None).cast("string"))
        # As with the join below, rows without a zone have no fields.
        fields = {c: F.when(F.col(apex).isNotNull(), field) for c, field in _mta_sts_fields(strict).items()}
        return df.withColumns(fields).drop("__sts", "__rpt", "policy_text")
    txt = positive_answers(obs, "TXT") if txt is None else txt
    apexes = df.select(apex).distinct()
    for column in ("__sts", "__rpt"):
        side = txt.select(F.col("name").alias("__owner"), _policy_text(column, F.col("answers")).alias(column))
        owner = F.concat(F.lit(_POLICY_OWNERS[column]), F.col(apex))
        apexes = apexes.withColumn("__owner", owner).join(side, "__owner", "left").drop("__owner")
    if policies is not None:
        apexes = apexes.join(policies.select(F.col("regdom").alias(apex), "policy_text"), apex, "left")
    else:
        apexes = apexes.withColumn("policy_text", F.lit(None).cast("string"))
    fields = [field.alias(c) for c, field in _mta_sts_fields(strict).items()]
    return spread_join(df, apexes.select(apex, *fields), [apex], [name], hot=hot)


def _mta_sts_fields(strict: bool) -> dict[str, Column]:
    text = F.coalesce("__sts", F.lit(""))
    return {
        "has_mta_sts": P.has_mta_sts(text),
        "mta_sts_txt": text,
        "mta_sts_id": P.mta_sts_id(text, strict),
        "mta_sts_mode": P.mta_sts_mode(F.col("policy_text")),
        "mta_sts_max_age": P.mta_sts_max_age(F.col("policy_text")),
        "tlsrpt_rua": P.tlsrpt_rua(F.col("__rpt"), strict),
    }


def attach_subhost(
    df: DataFrame,
    answers: DataFrame | None,
    prefix: str,
    name: str = "domain",
    apex: str = "registered_domain",
    hot: Hot = None,
) -> DataFrame:
    """Addresses and alias of ``prefix.registered_domain``, only where it has an A record.

    ``answers`` comes from :func:`host_answers`, or is None where ``df`` went through :func:`attach_owner_answers`;
    ``hot`` lists crowded registered domains.
    """
    if answers is None:
        return _subhost_fields(df, prefix)
    owner = f"__{prefix}"
    side = answers.filter(F.size("a") > 0).select(
        F.col("name").alias(owner),
        F.col("a").alias(f"{prefix}_a_list"),
        F.col("aaaa").alias(f"{prefix}_aaaa_list"),
        F.col("cname").alias(f"{prefix}_cname"),
    )
    key = F.when(F.col(apex) != "", F.concat(F.lit(prefix + "."), F.col(apex))).alias(owner)
    if hot is None:
        hot = hot_keys(df, [apex])
    if isinstance(hot, DataFrame):
        crowded = hot.select(key, "__ways")
    elif isinstance(hot, Crowded):
        crowded = Crowded((f"{prefix}.{value}", ways) for value, ways in hot.ways.items())
    else:
        crowded = [f"{prefix}.{value}" for value in hot]
    return _subhost_fields(spread_join(df.withColumn(owner, key), side, [owner], [name], hot=crowded), prefix).drop(owner)


def _subhost_fields(out: DataFrame, prefix: str) -> DataFrame:
    return out.withColumns(
        {
            f"{prefix}_a": F.coalesce(F.get(f"{prefix}_a_list", F.lit(0)), F.lit("")),
            f"{prefix}_cname": F.coalesce(f"{prefix}_cname", F.lit("")),
            f"{prefix}_exists": F.col(f"{prefix}_a_list").isNotNull(),
        }
    )


def attach_host_ips(
    df: DataFrame,
    answers: DataFrame,
    host: str,
    into: str,
    spread_by: Sequence[str] = ("domain",),
    hot: Hot = None,
) -> DataFrame:
    """A and AAAA addresses of a host column, A first."""
    side = answers.select(F.col("name").alias(host), F.concat("a", "aaaa").alias(into))
    out = spread_join(df, side, [host], spread_by, hot=hot)
    return out.withColumn(into, F.coalesce(into, _empty()))


def mx_host_table(hosts: DataFrame, obs: DataFrame, host: str = "host") -> DataFrame:
    """Batch resolution table: one row per distinct mail host with addresses, outcomes and TTLs."""
    obs, order = normal_names(obs), newest_order()
    picks = [
        F.max_by(F.struct("rcode", "answers", "ttl"), F.when(F.col("rtype") == t, order)).alias(t.lower())
        for t in ("A", "AAAA")
    ]
    wide = obs.filter(F.col("rtype").isin("A", "AAAA")).groupBy(F.col("name").alias(host)).agg(*picks)
    asked = hosts.select(H.clean_domain(F.col(host)).alias(host)).filter(F.col(host).isNotNull()).distinct()
    out = [F.col(host)]
    for t in ("a", "aaaa"):
        good = F.when(F.col(f"{t}.rcode") == "NOERROR", F.col(f"{t}.answers"))
        out += [
            F.coalesce(good, _empty()).alias(f"{t}_ips"),
            F.coalesce(f"{t}.rcode", F.lit("ERROR")).alias(f"{t}_rcode"),
            F.coalesce(f"{t}.ttl", F.lit(0)).alias(f"{t}_ttl"),
        ]
    return asked.join(wide, host, "left").select(*out)


def all_ips(*lists: Column) -> Column:
    """Distinct addresses of several lists (G1)."""
    out = F.coalesce(lists[0], _empty())
    for c in lists[1:]:
        out = F.array_union(out, F.coalesce(c, _empty()))
    return F.array_distinct(out)


def ptr_results(ips: DataFrame, obs: DataFrame, ip: str = "ip") -> DataFrame:
    """ip, ptr, rcode, ttl for every distinct address (D19 as a table); text that is no address gives ERROR."""
    reverse = latest_observation(obs.filter(F.col("rtype") == "PTR")).select(
        F.col("name").alias("__rev"), F.col("rcode").alias("__rcode"), "answers", "ttl"
    )
    asked = ips.select(F.col(ip).alias("ip")).filter(F.coalesce(F.col("ip"), F.lit("")) != "").distinct()
    joined = asked.withColumn("__rev", reverse_pointer(F.col("ip"))).join(reverse, "__rev", "left")
    return joined.select(
        "ip",
        F.when(is_positive(F.col("__rcode"), F.col("answers")), H.strip_dots(F.get("answers", F.lit(0))))
        .otherwise(F.lit(""))
        .alias("ptr"),
        F.coalesce("__rcode", F.lit("ERROR")).alias("rcode"),
        F.coalesce("ttl", F.lit(0)).alias("ttl"),
    )


def attach_ptr(df: DataFrame, obs: DataFrame, suffixes: DataFrame | SuffixTables, name: str = "domain") -> DataFrame:
    """PTR map of all addresses, and PTR hosts and registered domains of the mail and name-server addresses.

    ``df`` has the lists ``a``, ``aaaa``, ``mx_ips`` and ``ns_ips``, and may have the sub-host addresses ``www_a`` and
    ``mail_a``.  Pairs of domain and address are made distinct before they are shuffled, then only the found hosts come
    back to the domain.  The reverse name, taken once per distinct address, tells which texts are addresses: the others
    have none and find nothing.
    """
    lists = [F.col(c) for c in ("a", "aaaa", "mx_ips", "ns_ips")]
    lists += [F.array_compact(F.array(c)) for c in ("www_a", "mail_a") if c in df.columns]
    pairs = df.select(name, F.explode(F.transform(all_ips(*lists), H.strip)).alias("ip")).filter("ip <> ''").distinct()
    pairs = cut_lineage(pairs)  # read three times below
    table = ptr_results(pairs, obs).filter(F.col("ptr") != "").select("ip", "ptr")
    table = with_registered_domain(table, suffixes, host="ptr", regdom="ptr_regdom", tld=None)
    found = spread_join(pairs, table, ["ip"], [name], how="inner", hot=hot_lists(pairs, {"ip": F.col("ip")})["ip"])
    per_domain = found.groupBy(name).agg(
        F.sort_array(F.collect_set(F.struct("ip", "ptr", "ptr_regdom"))).alias("__p")
    )
    out = df.join(cut_lineage(per_domain), name, "left")
    none = F.array().cast("array<struct<ip:string,ptr:string,ptr_regdom:string>>")
    known = F.coalesce(F.col("__p"), none)

    def of(ips: str, field: str) -> Column:
        mine = F.filter(known, lambda p: F.array_contains(F.coalesce(F.col(ips), _empty()), p["ip"]))
        return F.filter(F.transform(mine, lambda p: p[field]), lambda x: x != "")

    return out.withColumns(
        {
            "ptr": F.map_from_entries(F.transform(known, lambda p: F.struct(p["ip"], p["ptr"]))),
            "mx_ptr": of("mx_ips", "ptr"),
            "mx_ptr_regdom": F.sort_array(F.array_distinct(of("mx_ips", "ptr_regdom"))),
            "ns_ptr": of("ns_ips", "ptr"),
            "ns_ptr_regdom": F.sort_array(F.array_distinct(of("ns_ips", "ptr_regdom"))),
        }
    ).drop("__p")


def ptr_summary(ptr_pairs: DataFrame, key: str = "mx_host") -> DataFrame:
    """Sorted distinct PTR hosts and registered domains per mail host, and the first of each (E5).

    ``ptr_pairs`` has the key, ``ptr`` and ``ptr_regdom``; rows are made distinct before they are grouped.
    """
    rows = ptr_pairs.filter(F.coalesce(F.col("ptr"), F.lit("")) != "").select(key, "ptr", "ptr_regdom").distinct()
    lists = rows.groupBy(key).agg(
        F.sort_array(F.collect_set("ptr")).alias("ptr_hosts"),
        F.sort_array(F.collect_set(F.nullif("ptr_regdom", F.lit("")))).alias("ptr_regdoms"),
    )
    return lists.withColumns(
        {
            "ptr_host_first": F.get("ptr_hosts", F.lit(0)),
            "ptr_regdom_first": F.get("ptr_regdoms", F.lit(0)),
        }
    )


def mx_ownership(df: DataFrame) -> DataFrame:
    """Mail host under the customer's own domain, and mail addresses without PTR."""
    regdom = F.coalesce(F.col("mx_regdom_final"), F.lit(""))
    return df.withColumns(
        {
            "mx_under_customer": (regdom != "") & F.coalesce(regdom == F.col("registered_domain"), F.lit(False)),
            "mx_ptr_missing": (F.size(F.coalesce("mx_ips", _empty())) > 0)
            & (F.size(F.coalesce("mx_ptr", _empty())) == 0),
        }
    )
