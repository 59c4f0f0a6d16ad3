"""What changed against earlier answers and earlier activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zonelens.functions.identity import dns_signature
from zonelens.operators.resolve import KEY, latest_observation, normal_names

ZONE_TYPES = ("NS", "SOA")
TTL_DROP = 0.5  # a TTL that fell to half of the earlier one, or below, counts as a big drop


def _sorted(c: Column) -> Column:
    return F.sort_array(F.coalesce(c, F.array().cast("array<string>")))


def differs(rcode: Column, answers: Column, old_rcode: Column, old_answers: Column) -> Column:
    """Other outcome, or other answers regardless of their order."""
    same = rcode.eqNullSafe(old_rcode) & (_sorted(answers) == _sorted(old_answers))
    return ~same


def detect_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Newest answers against earlier ones, per record type and name."""
    old = latest_observation(previous).select(
        *KEY,
        F.col("rcode").alias("prev_rcode"),
        F.col("answers").alias("prev_answers"),
        F.col("ttl").alias("prev_ttl"),
        F.lit(True).alias("__known"),
    )
    joined = latest_observation(current).join(old, list(KEY), "left")
    new_key = F.col("__known").isNull()
    changed = new_key | differs(F.col("rcode"), F.col("answers"), F.col("prev_rcode"), F.col("prev_answers"))
    return joined.withColumns({"is_new": new_key, "changed": changed}).drop("__known")


def domain_changes(changes: DataFrame) -> DataFrame:
    """Per domain: did its NS or SOA change."""
    zone = changes.filter(F.col("rtype").isin(*ZONE_TYPES))
    return zone.groupBy(F.col("name").alias("domain")).agg(F.max("changed").alias("changed"))


def change_flags(changes: DataFrame, ttl_drop: float = TTL_DROP) -> DataFrame:
    """Score inputs per domain: name server, address and SOA changed, TTL fell sharply.

    A key that was not known before is no change here.
    """
    real = F.col("changed") & ~F.col("is_new")

    def any_of(test: Column) -> Column:
        return F.coalesce(F.max(test), F.lit(False))

    drop = (F.col("prev_ttl") > 0) & (F.col("ttl") <= F.col("prev_ttl") * F.lit(ttl_drop))
    return changes.groupBy(F.col("name").alias("domain")).agg(
        any_of(real & (F.col("rtype") == "NS")).alias("ns_changed"),
        any_of(real & F.col("rtype").isin("A", "AAAA")).alias("ip_changed"),
        any_of(real & (F.col("rtype") == "SOA")).alias("soa_changed"),
        any_of(F.coalesce(drop & (F.col("rtype") == "A"), F.lit(False))).alias("ttl_drop_big"),
    )


def with_previous(
    obs: DataFrame, payload: Sequence[str], keys: Sequence[str] = KEY, order: str = "observed_ts", slot: str = "day"
) -> DataFrame:
    """Add ``prev``: the payload of the row before, per key in time order.

    A key is cut into time slots, so that a key with very many rows is ordered by many tasks; the first row of
    a slot takes the last row of the slot before, which is found on one row per key and slot.
    """
    own = F.struct(*payload)
    slotted = obs.withColumn("__slot", F.date_trunc(slot, F.col(order)))
    inside = F.lag(own).over(Window.partitionBy(*keys, "__slot").orderBy(order, *payload_order(payload)))
    last = F.max_by(own, F.struct(order, *payload_order(payload)))
    tails = slotted.groupBy(*keys, "__slot").agg(last.alias("__tail"))
    before = F.lag("__tail").over(Window.partitionBy(*keys).orderBy("__slot"))
    heads = tails.withColumn("__before", before).drop("__tail")
    joined = slotted.withColumn("__inside", inside).join(heads, [*keys, "__slot"], "left")
    return joined.withColumn("prev", F.coalesce("__inside", "__before")).drop("__inside", "__before", "__slot")


def payload_order(payload: Sequence[str]) -> list[Column]:
    """What breaks ties in time, as :func:`zonelens.operators.resolve.newest_order` does: outcome, lifetime, sorted answers."""
    known = {"rcode": F.col("rcode"), "ttl": F.col("ttl"), "answers": F.array_sort("answers")}
    return [known[c] for c in known if c in payload] + [F.col(c) for c in ("answers",) if c in payload]


def change_history(obs: DataFrame, slot: str = "day") -> DataFrame:
    """Every observation that differs from the one before it for its key; the first one counts as new (I3, batch)."""
    seen = with_previous(normal_names(obs), ["rcode", "answers", "ttl"], slot=slot)
    new_key = F.col("prev").isNull()
    changed = new_key | differs(F.col("rcode"), F.col("answers"), F.col("prev.rcode"), F.col("prev.answers"))
    return seen.withColumns({"is_new": new_key, "prev_rcode": F.col("prev.rcode")}).filter(changed).drop("prev")


def is_active(status: Column) -> Column:
    """Anything but a vanished domain is active; both spellings of vanished are known."""
    return ~F.upper(F.coalesce(status, F.lit(""))).isin("NXDOMAIN", "DORMANT")


def activity_flags(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``needs_enrich`` and ``reactivated`` against the stored activity state.

    ``rows`` has domain, ns, a, mx_regdom, status and mx_ips; the state has domain, is_active, dns_sig.
    """
    tidy = rows.withColumns(
        {
            "domain": F.lower(F.coalesce("domain", F.lit(""))),
            "mx_regdom": F.lower(F.coalesce("mx_regdom", F.lit(""))),
            "mx_ips": F.coalesce("mx_ips", F.lit("")),
        }
    )
    signed = tidy.withColumns(
        {"dns_sig": dns_signature(F.col("ns"), F.col("a"), F.col("mx_regdom")), "is_active": is_active(F.col("status"))}
    )
    old = state.select(
        "domain",
        F.coalesce("is_active", F.lit(True)).alias("__was_active"),
        F.col("dns_sig").alias("__old_sig"),
        F.lit(True).alias("__known"),
    )
    joined = signed.join(old, "domain", "left")
    known = F.coalesce("__known", F.lit(False))
    back = known & ~F.coalesce("__was_active", F.lit(True)) & F.col("is_active")
    changed = known & ~F.col("dns_sig").eqNullSafe(F.col("__old_sig"))
    return joined.withColumns({"reactivated": back, "needs_enrich": ~known | back | changed}).drop(
        "__was_active", "__old_sig", "__known"
    )


def activity_delta(flagged: DataFrame, now_epoch: int) -> DataFrame:
    """Rows to append to the activity log, all text (H19); unchanged domains give none."""
    return flagged.filter("needs_enrich").select(
        "domain",
        F.when(F.col("is_active"), F.lit("true")).otherwise(F.lit("false")).alias("is_active"),
        F.lit(str(now_epoch)).alias("last_seen_ts"),
        "dns_sig",
        "mx_regdom",
        "mx_ips",
    )
