"""Text of DNS records <-> structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelens.functions.hosts import ascii_host, strip_dots

_MX = r"^([+-]?\d{1,9}):(.*)$"
_SRV = r"^(\d+)\s+(\d+)\s+(\d+)\s+(\S+)$"
_CAA = r'^(\d+)\s+(\w+)\s+"?(.*?)"?$'
_NAPTR = r'^(\d+)\s+(\d+)\s+"(.*?)"\s+"(.*?)"\s+"(.*?)"\s+(\S+)$'


_SEP = "\x01\x02"  # never part of a record text


def _pieces(items: Column, pattern: str, groups: int) -> Column:
    """Captured groups of every item; an item that does not match is its own single piece.

    One pattern match and one split per item, however many fields are read from it.
    """
    marked = _SEP.join(f"${i}" for i in range(1, groups + 1))
    return F.transform(items, lambda x: F.split(F.regexp_replace(x, pattern, marked), _SEP))


def _text_at(p: Column, i: int, groups: int, default: str | None = "") -> Column:
    return F.when(F.size(p) == groups, F.get(p, F.lit(i))).otherwise(F.lit(default))


def _int_at(p: Column, i: int, groups: int) -> Column:
    return _text_at(p, i, groups, None).try_cast("int")


def _rest_at(p: Column, i: int, groups: int) -> Column:
    """Last field, or the whole item where it did not match."""
    return F.when(F.size(p) == groups, F.get(p, F.lit(i))).otherwise(F.get(p, F.lit(0)))


def parse_mx(items: Column, default_preference: int | None = None) -> Column:
    """``pref:host`` items -> array of (preference, exchange), input order.

    Items without a number keep their whole text as exchange and get the default preference.
    """
    missing = F.lit(default_preference).cast("int")

    def one(p: Column) -> Column:
        return F.struct(
            F.coalesce(_int_at(p, 0, 2), missing).alias("preference"),
            strip_dots(_rest_at(p, 1, 2)).alias("exchange"),
        )

    return F.transform(_pieces(items, _MX, 2), one)


def _ranked(parsed: Column) -> Column:
    return F.transform(
        parsed, lambda m, i: F.struct(F.coalesce(m["preference"], F.lit(0)).alias("p"), i.alias("i"), m.alias("m"))
    )


def sort_mx(parsed: Column) -> Column:
    """Lowest preference first, input order on ties."""
    return F.transform(F.sort_array(_ranked(parsed)), lambda x: x["m"])


def primary_mx(parsed: Column) -> Column:
    """Lowest preference, first on ties."""
    return F.array_min(_ranked(parsed))["m"]


def parse_srv(items: Column, owner: Column | None = None, ttl: Column | None = None) -> Column:
    """``priority weight port target`` items; service and protocol come from the owner name."""
    owner_labels = F.split(owner, r"\.") if owner is not None else None
    service = F.get(owner_labels, F.lit(0)) if owner is not None else F.lit(None).cast("string")
    proto = F.get(owner_labels, F.lit(1)) if owner is not None else F.lit(None).cast("string")
    seconds = ttl.cast("int") if ttl is not None else F.lit(None).cast("int")

    def one(p: Column) -> Column:
        return F.struct(
            _int_at(p, 0, 4).alias("priority"),
            _int_at(p, 1, 4).alias("weight"),
            _int_at(p, 2, 4).alias("port"),
            strip_dots(_rest_at(p, 3, 4)).alias("target"),
            service.alias("service"),
            proto.alias("proto"),
            seconds.alias("ttl"),
        )

    return F.transform(_pieces(items, _SRV, 4), one)


def parse_caa(items: Column) -> Column:
    """``flags tag "value"`` items; other text becomes the value."""

    def one(p: Column) -> Column:
        return F.struct(
            _int_at(p, 0, 3).alias("flags"), _text_at(p, 1, 3).alias("tag"), _rest_at(p, 2, 3).alias("value")
        )

    return F.transform(_pieces(items, _CAA, 3), one)


def parse_naptr(items: Column) -> Column:
    """``order pref "flags" "services" "regexp" replacement`` items."""

    def one(p: Column) -> Column:
        return F.struct(
            _int_at(p, 0, 6).alias("order"),
            _int_at(p, 1, 6).alias("preference"),
            _text_at(p, 2, 6).alias("flags"),
            _text_at(p, 3, 6).alias("services"),
            _text_at(p, 4, 6).alias("regexp"),
            strip_dots(_rest_at(p, 5, 6)).alias("replacement"),
        )

    return F.transform(_pieces(items, _NAPTR, 6), one)


def parse_soa(text: Column) -> Column:
    """Full SOA text -> struct; parts that are no digits become null."""
    part = F.split(F.trim(text), r"\s+")

    def digits(i: int) -> Column:
        piece = F.get(part, F.lit(i))
        return F.when(piece.rlike(r"^\d+$"), piece.try_cast("bigint"))

    return F.struct(
        strip_dots(F.coalesce(F.get(part, F.lit(0)), F.lit(""))).alias("mname"),
        strip_dots(F.coalesce(F.get(part, F.lit(1)), F.lit(""))).alias("rname"),
        *[digits(i + 2).alias(n) for i, n in enumerate(["serial", "refresh", "retry", "expire", "minimum"])],
    )


def mx_to_string(parsed: Column) -> Column:
    """``prio:host,prio:host`` with normalised ASCII hosts."""
    text = F.transform(
        parsed,
        lambda m: F.concat_ws(":", F.coalesce(m["preference"], F.lit(0)).cast("string"), ascii_host(m["exchange"])),
    )
    return F.coalesce(F.array_join(text, ","), F.lit(""))


def _show(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def format_caa(records: Column) -> Column:
    """Canonical CAA text per struct."""
    return F.transform(
        records, lambda r: F.concat(_show(r["flags"]), F.lit(" "), r["tag"], F.lit(' "'), r["value"], F.lit('"'))
    )


def format_naptr(records: Column) -> Column:
    """Canonical NAPTR text per struct."""
    return F.transform(
        records,
        lambda r: F.concat(
            _show(r["order"]), F.lit(" "), _show(r["preference"]), F.lit(' "'), r["flags"], F.lit('" "'),
            r["services"], F.lit('" "'), r["regexp"], F.lit('" '), r["replacement"],
        ),
    )


def format_srv(records: Column) -> Column:
    """Canonical SRV text per struct."""
    return F.transform(
        records,
        lambda r: F.concat_ws(" ", _show(r["priority"]), _show(r["weight"]), _show(r["port"]), r["target"]),
    )


FREE_ISSUERS = ("letsencrypt", "zerossl")  # fixed values


def caa_free_issuers(caa_texts: Column) -> Column:
    """Free certificate authorities named in CAA texts, each once."""
    named = [
        F.when(F.exists(caa_texts, lambda x: F.contains(F.lower(x), F.lit(name))), F.lit(name)) for name in FREE_ISSUERS
    ]
    return F.array_compact(F.array(*named))
