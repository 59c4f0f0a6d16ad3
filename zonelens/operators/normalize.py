"""Operators that tidy names and shapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.functions import hosts as H


def clean_domains(df: DataFrame, column: str = "domain") -> DataFrame:
    """Rows with a usable domain, tidied (B1)."""
    return df.withColumn(column, H.clean_domain(F.col(column))).filter(F.col(column).isNotNull())


def normalize_hosts(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """IDNA form of host columns (B2).

    Rows of plain ASCII stay in native code.  The rare other rows take a branch of their own with an
    Arrow-batched helper, so that no row of the common branch crosses into Python.
    """
    plain = F.lit(True)
    for c in columns:
        plain = plain & H.is_ascii(F.col(c))
    native = df.filter(plain).withColumns({c + suffix: H.ascii_host(F.col(c)) for c in columns})
    other = df.filter(~plain).withColumns({c + suffix: H.idna_host(F.col(c)) for c in columns})
    return native.unionByName(other)


def normalize_ns(df: DataFrame, column: str = "ns") -> DataFrame:
    """``ns`` (pipe-joined), ``ns_raw`` and ``ns_list_norm`` out of text or a list."""
    is_list = isinstance(df.schema[column].dataType, T.ArrayType)
    raw = H.join_list(F.col(column)) if is_list else F.coalesce(F.col(column), F.lit(""))
    listed = H.ns_list_from_array(F.col(column)) if is_list else H.ns_list(F.col(column))
    return (
        df.withColumns({"ns_raw": raw, "ns_list_norm": listed})
        .withColumn("ns", F.array_join("ns_list_norm", "|"))
    )


def blank_to_null(df: DataFrame) -> DataFrame:
    """Every string column with '' turned into null."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that the frame lacks."""
    return sorted(set(required) - set(df.columns))


def conform(
    df: DataFrame,
    wanted: Mapping[str, str],
    may_be_absent: Sequence[str] | None = None,
) -> DataFrame:
    """Give a frame the wanted columns and types.

    Absent columns come in as '' (string) or typed null.  With ``may_be_absent`` every other absent column
    is an error that names all of them.  Values that do not fit the type become null.
    """
    if may_be_absent is not None:
        lacking = [c for c in missing_columns(df, list(wanted)) if c not in may_be_absent]
        if lacking:
            raise ValueError(f"missing columns {lacking}")
    have = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for name, kind in wanted.items():
        blank = F.lit("") if kind == "string" else F.lit(None)
        if name not in have or isinstance(have[name], T.NullType):
            out[name] = blank.cast(kind)
        elif have[name].simpleString() != kind:
            out[name] = F.col(name).try_cast(kind)
    return df.withColumns(out) if out else df


# Columns that the provider lookups need.
ENRICH_COLUMNS = {
    "domain": "string",
    "registered_domain": "string",
    "mx_host_norm": "string",
    "mx_regdom_norm": "string",
    "ns": "string",
    "ip_int": "bigint",
}
