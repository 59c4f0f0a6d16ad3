"""Features of algorithmically generated names (H1-H8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelens.functions.hosts import strip, strip_dots

DGA_VERSION = "2025.10.20-rc1"


def second_level_label(regdom: Column) -> Column:
    """Leftmost label of a registered domain, '' where there is none (H1)."""
    return F.regexp_extract(tidy_host(regdom), r"([^.]+)", 1)


def entropy(s: Column) -> Column:
    """Shannon entropy of the characters, base 2; '' -> 0 (H3).

    Characters are sorted, so that equal ones form runs; only runs of two or more add to the sum of c * log2(c).
    """
    n = F.length(s).cast("double")
    in_order = F.array_join(F.sort_array(F.split(s, "")), "")
    runs = F.regexp_extract_all(in_order, F.lit(r"(?s)(.)\1+"), F.lit(0))
    repeats = F.aggregate(runs, F.lit(0.0), lambda total, r: total + F.length(r) * F.log2(F.length(r).cast("double")))
    return F.when(n > 0, F.log2(n) - repeats / n).otherwise(F.lit(0.0))


def share_of(s: Column, characters: str) -> Column:
    """Share of the given characters; '' -> 0 (H4, H5)."""
    hits = F.length(s) - F.length(F.translate(s, characters, ""))
    return F.when(F.length(s) > 0, hits / F.length(s)).otherwise(F.lit(0.0))


def tidy_host(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit(""))))


def subdomain_labels(host: Column, regdom: Column) -> Column:
    """Struct of the labels that count as subdomain, and whether the host is a foreign one.

    Both inputs are tidy.  The suffix test is a plain text test; a foreign host gives all its labels.
    """
    own = host.endswith(regdom)
    front = F.when(own, F.substring(host, F.lit(1), F.length(host) - F.length(regdom))).otherwise(host)
    blank = (host == "") | (regdom == "")
    found = F.array_remove(F.split(strip_dots(front), r"\."), "")
    return F.struct(
        F.when(blank, F.array().cast("array<string>")).otherwise(found).alias("labels"), (~own).alias("is_foreign")
    )


def subdomain_depth(labels: Column) -> Column:
    """Number of subdomain labels; a foreign host is taken to have a two-label domain (H6)."""
    n = F.size(labels["labels"])
    return F.when(labels["is_foreign"], F.greatest(n - 2, F.lit(0))).otherwise(n)


def subdomain_max_label(labels: Column) -> Column:
    """Length of the longest subdomain label (H7)."""
    return F.coalesce(F.array_max(F.transform(labels["labels"], F.length)), F.lit(0))


def row_max(values: Sequence[Column]) -> Column:
    """Largest of the columns; 0 where there are none."""
    if not values:
        return F.lit(0)
    return values[0] if len(values) == 1 else F.greatest(*values)


def _steps(c: Column, ladder: Sequence[tuple[Column, int]]) -> Column:
    out = None
    for test, points in ladder:
        out = F.when(test, F.lit(points)) if out is None else out.when(test, F.lit(points))
    return out.otherwise(F.lit(0))


def dga_points(e: Column, length: Column, digits: Column, vowels: Column, depth: Column, longest: Column) -> Column:
    """Points 0..10 out of the features (H8); the thresholds are fixed values."""
    total = (
        _steps(e, [(e > 4.0, 5), (e > 3.5, 3)])
        + _steps(length, [(length > 20, 3), (length > 15, 2)])
        + _steps(digits, [(digits > 0.30, 2)])
        + _steps(vowels, [((vowels < 0.20) & (length > 6), 1)])
        + _steps(depth, [(depth >= 5, 4), (depth >= 3, 2)])
        + _steps(longest, [(longest >= 25, 2), (longest >= 18, 1)])
    )
    return F.greatest(F.least(total, F.lit(10)), F.lit(0))


SUSPECT_FROM = 6  # fixed value
