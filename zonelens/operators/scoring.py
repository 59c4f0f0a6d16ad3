"""Risk scores from declarative profiles, compiled to native columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.plans.profiles import PROFILES, SCORE_VERSION


def _truthy(name: str, kind: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(kind, T.NumericType):
        c = c != 0
    elif not isinstance(kind, T.BooleanType):
        c = c.try_cast("boolean")
    return F.coalesce(c, F.lit(False))


def comparable(c: Column, kind: T.DataType, literal: Any) -> Column:
    """The column as a type that compares with the literal; a value that has no such form is null, never an error."""
    if isinstance(literal, str):
        return c if isinstance(kind, T.StringType) else c.cast("string")
    if isinstance(literal, bool):
        return c if isinstance(kind, T.BooleanType) else c.try_cast("boolean")
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    return c if isinstance(kind, T.NumericType) else c.try_cast("double")


def rule_predicate(rule: Mapping[str, Any], schema: T.StructType) -> Column | None:
    """Condition of one rule; an absent column never fires, an unknown test gives None."""
    kinds = {f.name: f.dataType for f in schema.fields}
    if "when" not in rule:
        if "column" not in rule:
            return None
        name = rule["column"]
        return _truthy(name, kinds[name]) if name in kinds else F.lit(False)
    test = rule["when"]
    name = test["column"]
    if name not in kinds:
        return F.lit(False)
    c = F.col(name)
    if "equals" in test:
        met = comparable(c, kinds[name], test["equals"]) == F.lit(test["equals"])
    elif "in" in test:
        met = reduce(or_, [comparable(c, kinds[name], x) == F.lit(x) for x in test["in"]], F.lit(False))
    elif "gt" in test:
        met = comparable(c, kinds[name], test["gt"]) > F.lit(test["gt"])
    elif "lt" in test:
        met = comparable(c, kinds[name], test["lt"]) < F.lit(test["lt"])
    else:
        return None
    return F.coalesce(met, F.lit(False))


def mapped_points(rule: Mapping[str, Any]) -> Column:
    """Points that a value maps to, 0 for every other value."""
    value = F.col(rule["column"]).cast("string")
    out = F.lit(0)
    for key, points in rule["map"].items():
        out = F.when(value == F.lit(str(key)), F.lit(points)).otherwise(out)
    return out


def profile_named(name: str, profiles: Mapping[str, Any] | None = None) -> Mapping[str, Any]:
    """A profile, or the default one for an unknown name."""
    known = profiles or PROFILES
    if "default" not in known:
        raise ValueError("a 'default' profile is needed")
    return known.get(name) or known["default"]


def score(
    df: DataFrame,
    profile: str | Mapping[str, Any] = "default",
    profiles: Mapping[str, Any] | None = None,
    version: str = SCORE_VERSION,
) -> DataFrame:
    """Add risk_score, risk_level, risk_reasons, risk_breakdown and score_version in one projection."""
    chosen = profile_named(profile, profiles) if isinstance(profile, str) else profile
    schema = df.schema
    fired: list[tuple[str, Column, Column]] = []  # name, condition, points
    for rule in [*chosen.get("positive_rules", []), *chosen.get("trust_rules", [])]:
        met = rule_predicate(rule, schema)
        if met is not None:
            fired.append((rule["name"], met, F.lit(rule.get("points", 0))))
    for rule in chosen.get("mapped_rules", []):
        if rule["column"] in df.columns:
            points = mapped_points(rule)
            fired.append((rule["name"], points != 0, points))

    terms = [F.when(met, points).otherwise(F.lit(0)) for _, met, points in fired]
    direct: list[tuple[str, Column]] = []
    for sign, key in ((1, "direct_add_columns"), (-1, "direct_sub_columns")):
        for name in chosen.get(key, []):
            if name in df.columns:
                direct.append((name, F.coalesce(comparable(F.col(name), schema[name].dataType, 0), F.lit(0)) * F.lit(sign)))
    terms += [points for _, points in direct]
    total = reduce(add, terms, F.lit(0))
    clamped = F.greatest(F.least(total, F.lit(chosen.get("max_score", 100))), F.lit(chosen.get("min_score", 0)))

    limits = chosen.get("thresholds", {})
    value = F.col("risk_score")
    level = (
        F.when(value >= limits.get("critical", 80), F.lit("critical"))
        .when(value >= limits.get("high", 60), F.lit("high"))
        .when(value >= limits.get("medium", 30), F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    reasons = [
        F.when(met, F.concat(F.lit(name + "("), points.cast("string"), F.lit(")"))) for name, met, points in fired
    ]
    parts = [
        F.when(met, F.struct(F.lit(name).alias("rule"), points.cast("double").alias("points")))
        for name, met, points in fired
    ] + [
        F.when(points != 0, F.struct(F.lit(name).alias("rule"), points.cast("double").alias("points")))
        for name, points in direct
    ]
    empty_parts = F.array().cast("array<struct<rule:string,points:double>>")
    return df.withColumn("risk_score", clamped.cast("int")).withColumns(
        {
            "risk_level": level,
            "risk_reasons": F.array_join(F.array_compact(F.array(*reasons)), ", ") if reasons else F.lit(""),
            "risk_breakdown": F.array_compact(F.array(*parts)) if parts else empty_parts,
            "score_version": F.lit(version),
        }
    )
