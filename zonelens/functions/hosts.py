"""Host names, lists of hosts and plain text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r\x0b\x0c"

# Ending labels that mark a name as high risk.
HIGH_RISK_TLDS = (
    "tk", "ml", "ga", "gq", "pw", "cn", "xyz", "top", "click", "buzz", "win",
    "site", "club", "icu", "bid", "cam", "date", "monster", "quest", "xin",
)


def strip(c: Column) -> Column:
    """Trim blanks of every kind, not only spaces."""
    return F.trim(c, F.lit(BLANKS))


def strip_dots(c: Column) -> Column:
    return F.rtrim(c, F.lit("."))


def clean_domain(c: Column) -> Column:
    """Trimmed, lower-case, without trailing dots; null and blank become null (B1)."""
    return F.nullif(F.lower(strip_dots(strip(c))), F.lit(""))


def labels(c: Column) -> Column:
    """Non-empty labels of a host, lower case."""
    host = F.lower(strip_dots(strip(F.coalesce(c, F.lit("")))))
    return F.filter(F.split(host, r"\."), lambda x: x != "")


def last_labels(c: Column, n: int) -> Column:
    """The last n labels, or null where the host has fewer."""
    parts = F.split(c, r"\.")
    return F.when(F.size(parts) >= n, F.substring_index(c, ".", -n))


def is_ascii(c: Column) -> Column:
    """True where every character takes one byte; null counts as ''."""
    return F.coalesce(F.octet_length(c) == F.length(c), F.lit(True))


# A host that is in LDH form but for upper case, and the ASCII characters that no host in this form has.
_LDH_LABEL = "[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
_LDH_HOST = rf"\A{_LDH_LABEL}(?:\.{_LDH_LABEL})*\z"
_NOT_LDH = "".join(chr(i) for i in range(1, 128) if not (chr(i).isalnum() or chr(i) in ".-"))


def ascii_host(c: Column) -> Column:
    """Host of ASCII labels in LDH form: other characters dropped, hyphens trimmed, 63 characters at most (B2).

    An ASCII label that IDNA accepts is already in this form, so no lookup is needed; rows with other
    characters go through :func:`idna_host` (see ``operators.normalize.normalize_hosts``).  Most hosts are in this
    form, or once characters are dropped; replacements by pattern cost several times a test and are for the others.
    """
    dropped = F.translate(c, _NOT_LDH, "")
    kept = F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9.-]+", "")
    joined = F.trim(F.regexp_replace(kept, r"-*\.[.-]*", "."), F.lit(".-"))
    cut = F.regexp_replace(F.regexp_replace(joined, r"([^.]{63})[^.]+", "$1"), r"-+(?=\.|\z)", "")
    return F.lower(F.when(c.rlike(_LDH_HOST), c).when(dropped.rlike(_LDH_HOST), dropped).otherwise(cut))


def idna_host(c: Column) -> Column:
    """Punycode form of hosts with non-ASCII labels; used on the rare rows that need it.

    A worker remembers the labels it met last, as labels recur.  The helpers are nested so that they travel with the
    job and executors need no copy of this package.
    """

    def encode_hosts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import re
        from functools import lru_cache

        import idna  # a missing package must end the job: else hosts would differ from executor to executor

        never = re.compile(r"[\x00-,./:-@\[-`{-\x7f]")

        @lru_cache(maxsize=1 << 17)
        def encode_label(label: str) -> str:
            try:
                if never.search(label):  # no mapping takes such a character away, so IDNA would refuse it
                    raise UnicodeError
                return idna.encode(label, uts46=True, std3_rules=False).decode("ascii")
            except UnicodeError:  # not encodable: keep the LDH characters
                kept = "".join(ch for ch in label if ch.isascii() and (ch.isalnum() or ch == "-"))
                return kept.strip("-")[:63].strip("-")

        def encode(host: str | None) -> str:
            parts = (host or "").strip().strip(".").split(".")
            return ".".join(filter(None, (encode_label(p) for p in parts if p))).lower()

        for hosts in batches:
            yield hosts.map(encode)

    return F.pandas_udf(encode_hosts, T.StringType())(c)


def normalize_txt(c: Column) -> Column:
    """Trim, then drop one pair of wrapping quotes; case is kept."""
    t = strip(F.coalesce(c, F.lit("")))
    quoted = (F.length(t) >= 2) & t.startswith('"') & t.endswith('"')
    return F.when(quoted, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def naive_tld(c: Column) -> Column:
    """Last label where the name has a dot, else '' (B5)."""
    return F.when(F.contains(c, F.lit(".")), F.substring_index(c, ".", -1)).otherwise(F.lit(""))


def last_label(c: Column) -> Column:
    """Last label of a registered domain; '' stays '' (B37)."""
    return F.substring_index(F.coalesce(c, F.lit("")), ".", -1)


def is_high_risk_tld(c: Column) -> Column:
    """True where the last label is on the high-risk list (C4)."""
    return F.coalesce(F.lower(F.substring_index(c, ".", -1)).isin(*HIGH_RISK_TLDS), F.lit(False))


def raw_tokens(c: Column) -> Column:
    """Pieces between blanks, pipes, commas and newlines, case kept, duplicates kept (B9, string form)."""
    pieces = F.filter(F.split(F.coalesce(c, F.lit("")), r"[\s|,]+"), lambda x: x != "")
    return F.transform(pieces, strip_dots)


def list_tokens(c: Column) -> Column:
    """List form of :func:`raw_tokens`: items are trimmed, not split."""
    return F.transform(F.array_compact(F.coalesce(c, F.array().cast("array<string>"))), lambda x: strip_dots(strip(x)))


def _tidy_names(names: Column) -> Column:
    tidy = F.transform(names, lambda x: F.lower(strip_dots(strip(x))))
    return F.array_distinct(F.filter(tidy, lambda x: x != ""))


def ns_list(c: Column) -> Column:
    """Name servers out of free text: split, strip dots, lower, first occurrence kept."""
    return _tidy_names(raw_tokens(c))


def ns_list_from_array(c: Column) -> Column:
    """The same for a list of names."""
    return _tidy_names(F.array_compact(F.coalesce(c, F.array().cast("array<string>"))))


def join_list(c: Column, sep: str = "|") -> Column:
    """Joined text of a list, nulls skipped, null list -> '' (B10)."""
    return F.coalesce(F.array_join(c, sep), F.lit(""))


def hosts_csv(c: Column) -> Column:
    """Comma-joined hosts with commas inside an item written as colons."""
    return F.coalesce(F.array_join(F.transform(c, lambda x: F.replace(x, F.lit(","), F.lit(":"))), ","), F.lit(""))


def first_token(c: Column) -> Column:
    """First piece of pipe-joined text."""
    return F.substring_index(F.coalesce(c, F.lit("")), "|", 1)


def first_item(c: Column) -> Column:
    """First non-blank item of a list."""
    return F.get(F.filter(c, lambda x: x.isNotNull() & (x != "")), F.lit(0))


def join_txt_fragments(fragments: Column) -> Column:
    """One TXT record out of its character strings."""
    return F.array_join(fragments, " ")


def join_txt_records(records: Column) -> Column:
    """One text out of all TXT records of a name."""
    return F.coalesce(F.array_join(records, ""), F.lit(""))


def under_domain(host: Column, regdom: Column) -> Column:
    """Label-aware suffix test: equal, or ends with a dot and the domain."""
    h = F.lower(strip_dots(strip(F.coalesce(host, F.lit("")))))
    rd = F.lower(strip_dots(strip(F.coalesce(regdom, F.lit("")))))
    return (h != "") & (rd != "") & ((h == rd) | h.endswith(F.concat(F.lit("."), rd)))


def blank_to_null(names: Iterable[str]) -> list[Column]:
    """Projection that turns '' into null for the named string columns."""
    return [F.nullif(F.col(n), F.lit("")).alias(n) for n in names]
