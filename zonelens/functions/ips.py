"""IPv4 and IPv6 text as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelens.functions import let
from zonelens.functions.hosts import strip

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_QUAD_TAIL = rf":{_OCTET}(\.{_OCTET}){{3}}$"


def is_ipv4(c: Column) -> Column:
    return c.rlike(IPV4)


def _hex_text(text: Column) -> Column:
    """IPv6 text with a dotted tail written as two hex groups."""

    def convert(quad: Column) -> Column:
        byte = [F.coalesce(F.get(quad, F.lit(i)).try_cast("int"), F.lit(0)) for i in range(4)]
        two = F.concat_ws(":", F.lower(F.hex(byte[0] * 256 + byte[1])), F.lower(F.hex(byte[2] * 256 + byte[3])))
        return F.concat(F.regexp_replace(text, r"\d+\.\d+\.\d+\.\d+$", ""), two)

    quad = F.split(F.regexp_extract(text, r"(\d+\.\d+\.\d+\.\d+)$", 1), r"\.")
    dotted = F.when(text.rlike(_QUAD_TAIL), let(quad, convert)).otherwise(F.lit(""))
    return F.when(F.contains(text, F.lit(".")), dotted).otherwise(text)


def _expand(text: Column) -> Column:
    """Groups of lower-case IPv6 text without leading zeros, '::' filled up to eight; null for a bad shape."""
    present = F.size(F.array_remove(F.split(text, ":"), ""))
    gap = F.contains(text, F.lit("::"))
    shape = text.rlike("^[0-9a-f:]+$") & ~text.rlike(r":::|::.*::|^:[^:]|[^:]:$|[0-9a-f]{5}")
    fill = F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.greatest(F.lit(8) - present, F.lit(0))))
    full = F.trim(F.replace(text, F.lit("::"), fill), F.lit(":"))
    groups = F.split(F.regexp_replace(full, r"\b0+(?=[0-9a-f])", ""), ":")
    counted = F.when(gap, present <= 7).otherwise(present == 8)
    return F.when(shape & counted, groups)


def ipv6_groups(c: Column) -> Column:
    """The eight groups of an IPv6 address, or null."""
    return F.when(F.contains(c, F.lit(":")), let(let(F.lower(c), _hex_text), _expand))


def is_ipv6(c: Column) -> Column:
    """Eight groups, or fewer around one '::'; the last two groups may be a dotted quad."""
    return F.coalesce(ipv6_groups(c).isNotNull(), F.lit(False))


def valid_ips(c: Column) -> Column:
    """Items of a list that are addresses, blanks trimmed."""
    return F.filter(F.transform(c, strip), lambda x: is_ipv4(x) | is_ipv6(x))


def ipv4_to_int(c: Column) -> Column:
    """Dotted quad as a number; anything else is null."""
    ip = strip(c)
    octet = F.split(ip, r"\.")
    number = sum(
        (F.get(octet, F.lit(i)).cast("bigint") * F.lit(256 ** (3 - i)).cast("bigint") for i in range(1, 4)),
        F.get(octet, F.lit(0)).cast("bigint") * F.lit(256**3).cast("bigint"),
    )
    return F.when(is_ipv4(ip), number)


def int_to_ipv4(c: Column) -> Column:
    """Number back to dotted quad."""
    return F.concat_ws(".", *[(F.shiftright(c, 24 - 8 * i).bitwiseAND(F.lit(255))).cast("string") for i in range(4)])


def _compress(joined: Column) -> Column:
    """Replace the first longest run of two or more zero groups by '::'."""

    def shorten(text: Column) -> Column:
        framed = F.concat(F.lit(":"), text, F.lit(":"))
        out = text
        for run in range(2, 9):  # the longest run is tried first because it becomes the outermost branch
            zeros = ":" + "0:" * run
            before = F.substring_index(framed, zeros, 1)
            after = F.substring(framed, F.length(before) + F.lit(len(zeros) + 1), F.length(framed))
            short = F.concat(F.trim(before, F.lit(":")), F.lit("::"), F.trim(after, F.lit(":")))
            out = F.when(F.contains(framed, F.lit(zeros)), short).otherwise(out)
        return F.when(F.contains(framed, F.lit(":0:0:")), out).otherwise(text)

    return let(joined, shorten)


def canonical_ip(c: Column) -> Column:
    """One spelling per address; text that is no address is only trimmed."""
    ip = strip(c)
    v6 = let(ipv6_groups(ip), lambda g: F.when(g.isNotNull(), _compress(F.array_join(g, ":"))))
    return F.when(F.contains(ip, F.lit(":")), F.coalesce(v6, ip)).otherwise(ip)


def ip_version(c: Column) -> Column:
    """4, 6 or null."""
    ip = strip(c)
    return F.when(is_ipv4(ip), F.lit(4)).when(is_ipv6(ip), F.lit(6))


def reverse_pointer(c: Column) -> Column:
    """Owner name of the PTR record; null for text that is no address."""
    ip = strip(c)
    v4 = F.concat(F.array_join(F.reverse(F.split(ip, r"\.")), "."), F.lit(".in-addr.arpa"))

    def v6(groups: Column) -> Column:
        nibbles = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")
        name = F.concat(F.array_join(F.reverse(F.split(nibbles, "")), "."), F.lit(".ip6.arpa"))
        return F.when(groups.isNotNull(), name)

    return F.when(F.contains(ip, F.lit(":")), let(ipv6_groups(ip), v6)).when(is_ipv4(ip), v4)


def _block_start(number: Column, bits: Column) -> Column:
    return number - F.pmod(number, F.pow(F.lit(2.0), bits).cast("bigint"))


_PREFIX4 = rf"\A{_OCTET}(\.{_OCTET}){{3}}/([12]?[0-9]|3[0-2])\z"


def _network4(text: Column) -> Column:
    """Network form of a plain IPv4 prefix, octet by octet."""
    plen = F.substring_index(text, "/", -1).cast("int")

    def masked(i: int) -> Column:
        octet = F.substring_index(F.substring_index(F.substring_index(text, "/", 1), ".", i + 1), ".", -1).cast("int")
        free = F.lit(8) - F.greatest(F.least(plen - 8 * i, F.lit(8)), F.lit(0))
        return octet.bitwiseAND(F.call_function("shiftleft", F.lit(255), free)).cast("string")

    return F.concat_ws("/", F.concat_ws(".", *[masked(i) for i in range(4)]), plen.cast("string"))


def canonical_prefix(c: Column) -> Column:
    """Network form of a CIDR text: host bits cleared; a bare address gets its full length.

    A plain IPv4 prefix, the usual text, takes generated code alone; everything else goes through lambdas.
    """
    text = strip(c)
    pieces = F.split(text, "/", 2)

    def network(p: Column) -> Column:
        bare = F.size(p) == 1
        plen = F.get(p, F.lit(1)).try_cast("int")
        addr = F.get(p, F.lit(0))
        len4 = F.when(bare, F.lit(32)).otherwise(plen)
        len6 = F.when(bare, F.lit(128)).otherwise(plen)

        def v6(groups: Column) -> Column:
            # Groups before the end of the prefix stay, the one it ends in is masked, the others are 0.
            whole, rest = F.floor(len6 / 16).cast("int"), len6 % 16
            edge = F.conv(F.get(groups, whole), 16, 10).cast("bigint")
            ends = F.when(rest > 0, F.array(F.lower(F.hex(_block_start(edge, 16 - rest))))).otherwise(
                F.array().cast("array<string>")
            )
            filled = F.concat(F.slice(groups, F.lit(1), whole), ends, F.array_repeat(F.lit("0"), F.lit(8)))
            kept = F.array_join(F.slice(filled, 1, 8), ":")
            shown = F.concat_ws("/", _compress(kept), len6.cast("string"))
            return F.when(groups.isNotNull() & len6.between(0, 128), shown)

        v4 = F.concat_ws("/", let(_block_start(ipv4_to_int(addr), 32 - len4), int_to_ipv4), len4.cast("string"))
        return F.when(F.contains(addr, F.lit(":")), let(ipv6_groups(addr), v6)).when(
            is_ipv4(addr) & len4.between(0, 32), v4
        )

    return F.when(text.rlike(_PREFIX4), _network4(text)).otherwise(F.coalesce(let(pieces, network), text))
