"""Registered domains from a suffix table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions.hosts import strip_dots
from zonelens.functions.ips import is_ipv4
from zonelens.operators.joins import cut_lineage

_FLAGS = ("plain", "wild", "except")


class SuffixTables(NamedTuple):
    """The two lookup tables of a suffix list: rules of one label, and lists of all others by their last two labels."""

    single: DataFrame
    longer: DataFrame


def suffix_rules(suffixes: DataFrame) -> DataFrame:
    """body, plain, wild, except: list rules by the name they are about.

    ``co.uk`` is a plain rule about ``co.uk``, ``*.ck`` a wild one about ``ck``, ``!www.ck`` an exception about
    ``www.ck``.  Case and dots at the ends do not matter; blank rows are no rules.
    """
    text = F.lower(strip_dots(F.trim("suffix")))
    kind = F.when(text.startswith("!"), "except").when(text.startswith("*."), "wild").otherwise("plain")
    body = F.regexp_replace(text, r"^(!|\*\.|\.)", "")
    rules = suffixes.select(body.alias("body"), kind.alias("kind")).filter("body <> ''")
    return rules.groupBy("body").agg(*[F.max(F.col("kind") == k).alias(k) for k in ("plain", "wild", "except")])


def suffix_tables(suffixes: DataFrame) -> SuffixTables:
    """The lookup tables of :func:`with_registered_domain`."""
    rules = suffix_rules(suffixes).withColumn("n", F.size(F.split("body", r"\.")))
    single = rules.filter("n = 1").select(F.col("body").alias("__one"), *[F.col(x).alias(f"__{x}") for x in _FLAGS])
    longer = rules.filter("n > 1").groupBy(F.substring_index("body", ".", -2).alias("__two"))
    return SuffixTables(single, longer.agg(F.collect_list(F.struct("body", "n", *_FLAGS)).alias("__rules")))


def kept_suffix_tables(suffixes: DataFrame) -> SuffixTables:
    """:func:`suffix_tables` worked out once, for plans that look up several hosts."""
    return SuffixTables(*[cut_lineage(t) for t in suffix_tables(suffixes)])


def with_registered_domain(
    df: DataFrame, suffixes: DataFrame | SuffixTables, host: str = "domain", regdom: str = "registered_domain", tld: str | None = "tld"
) -> DataFrame:
    """Suffix plus one label, and the last label of the suffix.

    Two left joins, whatever the length of the rules, and no job while planning: rules of one label are joined by the
    last label, all others by their last two labels, where they are lists of a few rules that end alike.  The rule with
    most labels wins, and an exception outranks every other rule.  A suffix list is small, so Catalyst turns the joins
    into hash probes and the hosts are never shuffled, however unevenly they spread over the suffixes.
    A caller with several hosts passes the tables of the list, so that they are not planned for each.
    """
    single, longer = suffixes if isinstance(suffixes, SuffixTables) else suffix_tables(suffixes)
    name = F.lower(F.ltrim(strip_dots(F.coalesce(F.col(host), F.lit(""))), F.lit(".")))
    out = df.withColumn("__h", name).withColumn("__n", F.size(F.split("__h", r"\.")))
    out = out.join(single, F.substring_index("__h", ".", -1) == F.col("__one"), "left")
    out = out.join(longer, F.when(F.col("__n") > 1, F.substring_index("__h", ".", -2)) == F.col("__two"), "left")
    # Bodies end with the same two labels, so a body is a tail of the host if it is all of it or stands after a dot.
    at_end = F.filter("__rules", lambda r: (F.col("__h") == r["body"]) | F.endswith(F.col("__h"), F.concat(F.lit("."), r["body"])))
    out = out.withColumn("__rules", at_end)

    def most(kind: str, below: Column | None = None) -> Column:
        held = F.filter("__rules", lambda r: r[kind] & (F.lit(True) if below is None else r["n"] < below))
        one = F.when(F.col(f"__{kind}") & (F.lit(True) if below is None else F.lit(1) < below), F.lit(1))
        return F.coalesce(F.array_max(F.transform(held, lambda r: r["n"])), one)

    longest = F.greatest(F.lit(0), most("plain"), most("wild", F.col("__n")) + 1)
    out = out.withColumn("__k", F.coalesce(most("except") - 1, longest))
    whole = F.col("__h")
    registered = (
        F.when(whole == "", F.lit(""))
        .when(F.col("__k") == 0, F.when(is_ipv4(whole), whole).otherwise(F.substring_index(whole, ".", -1)))
        .when(F.col("__n") <= F.col("__k"), whole)
        .otherwise(F.array_join(F.slice(F.split(whole, r"\."), -F.col("__k") - 1, F.col("__k") + 1), "."))
    )
    added = {regdom: registered}
    if tld:
        added[tld] = F.when(F.col("__k") > 0, F.substring_index(whole, ".", -1)).otherwise(F.lit(""))
    return out.withColumns(added).select(*[c for c in df.columns if c not in added], *added)
