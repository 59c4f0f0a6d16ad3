"""Rules around cached and live answers, per (record type, name)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.functions import records as R
from zonelens.functions.hosts import strip, strip_dots
from zonelens.operators.joins import cut_lineage

KEY = ("rtype", "name")
BACKFILL_TYPES = ("NS", "SOA", "A", "AAAA", "TXT")
MIN_POSITIVE_TTL = 5
# Parts that observations are dealt to; Spark writes up to 200 without holding rows in memory.
DEALT_PARTS = 200
NEGATIVE_TTL = 60


def _no_answers() -> Column:
    return F.array().cast("array<string>")


def _answers(name: str = "answers") -> Column:
    return F.coalesce(F.col(name), _no_answers())


def is_positive(rcode: Column, answers: Column) -> Column:
    return F.coalesce((rcode == "NOERROR") & (F.size(answers) > 0), F.lit(False))


def normal_names(obs: DataFrame) -> DataFrame:
    """Observation names in lower case without dots at the end, as all joins on names expect them."""
    return obs.withColumn("name", F.lower(strip_dots(strip(F.col("name")))))


def newest_order() -> Column:
    """Order of observations of one key; rows of one instant are told apart by their content, so that the newest row
    does not depend on the order in which rows arrive."""
    return F.struct("observed_ts", "rcode", "ttl", F.array_sort("answers").alias("sorted"), "answers")


def dealt(obs: DataFrame) -> DataFrame:
    """Observations dealt by name to parts of even size, before an aggregation that sorts them.

    A scan gives a whole row group to one task, which would sort all of it.  The parts follow a hash of the name: rows of
    a name meet, yet the adaptive plan may split a crowded part, because no grouping counts on it.
    """
    keyed = obs.withColumn("__deal", F.xxhash64("name"))
    return keyed.hint("rebalance", DEALT_PARTS, F.col("__deal")).drop("__deal")


def latest_observation(obs: DataFrame) -> DataFrame:
    """Newest row per record type and name (F7); partial maxima are taken before the shuffle."""
    rest = [c for c in obs.columns if c not in KEY]
    obs, order = normal_names(obs), newest_order()
    newest = obs.groupBy(*KEY).agg(F.max_by(F.struct(*rest), order).alias("__o"))
    return newest.select(*KEY, "__o.*").select(*obs.columns)


def effective_ttl(
    rcode: Column,
    ttl: Column,
    rtype: Column | None = None,
    floors: Mapping[str, int] | None = None,
    negative_ttl: int = NEGATIVE_TTL,
) -> Column:
    """Lifetime of an answer: at least five seconds and the floor of its type, fixed for failures."""
    floor = F.lit(MIN_POSITIVE_TTL)
    for kind, seconds in (floors or {}).items():
        floor = F.when(rtype == kind, F.lit(max(seconds, MIN_POSITIVE_TTL))).otherwise(floor)
    return F.when(rcode == "NOERROR", F.greatest(F.coalesce(ttl, F.lit(0)), floor)).otherwise(F.lit(negative_ttl))


def valid_cached(
    cache: DataFrame,
    now: datetime,
    only_positive: bool = True,
    include_expired: bool = False,
    keep_equal_age: bool = False,
    types: Sequence[str] | None = None,
    bypass_negative: Sequence[str] = (),
) -> DataFrame:
    """Cached rows that still answer (C2): younger than their TTL, positive if asked for.

    ``keep_equal_age`` also keeps an age equal to the TTL; ``types`` limits the cached record types;
    ``bypass_negative`` names types whose negative answers are looked up again.
    """
    age = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("observed_ts").cast("timestamp"))
    life = F.col("ttl").cast("bigint") * 1_000_000
    positive = is_positive(F.col("rcode"), _answers())
    keep = F.lit(True)
    if not include_expired:
        keep = keep & ((age <= life) if keep_equal_age else (age < life))
    if only_positive:
        keep = keep & positive
    if types is not None:
        keep = keep & F.col("rtype").isin(*types)
    if bypass_negative:
        keep = keep & (positive | ~F.col("rtype").isin(*bypass_negative))
    return cache.filter(keep)


def cache_first(live: DataFrame, cache: DataFrame, now: datetime, only_positive: bool = True) -> DataFrame:
    """A valid cached answer wins, else the live one.

    ``risk_cache_miss`` marks address answers that only the live lookup could give.
    """
    cached = valid_cached(latest_observation(cache), now, only_positive)
    payload = ["rcode", "answers", "ttl", "observed_ts"]
    old = cached.select(*KEY, F.struct(*payload).alias("__cached"))
    new = latest_observation(live).select(*KEY, F.struct(*payload).alias("__live"))
    both = new.join(old, list(KEY), "full")
    out = both.select(
        *KEY,
        F.coalesce("__cached", "__live").alias("__o"),
        F.when(F.col("__cached").isNotNull(), F.lit("cache")).otherwise(F.lit("live")).alias("answered_from"),
    ).select(*KEY, "__o.*", "answered_from")
    miss = (
        (F.col("answered_from") == "live")
        & F.col("rtype").isin("A", "AAAA")
        & is_positive(F.col("rcode"), _answers())
    )
    return out.withColumn("risk_cache_miss", miss)


def cache_backfill(
    live: DataFrame, cache: DataFrame, now: datetime, types: Sequence[str] = BACKFILL_TYPES
) -> DataFrame:
    """Live rows without answers take the valid cached answers and their TTL."""
    old = valid_cached(latest_observation(cache), now, types=types).select(
        *KEY, F.col("answers").alias("__answers"), F.col("ttl").alias("__ttl")
    )
    joined = latest_observation(live).join(old, list(KEY), "left")
    fill = (F.size(_answers()) == 0) & F.col("__answers").isNotNull()
    return joined.withColumns(
        {
            "backfilled": fill,
            "answers": F.when(fill, F.col("__answers")).otherwise(_answers()),
            "ttl": F.when(fill, F.col("__ttl")).otherwise(F.col("ttl")),
        }
    ).drop("__answers", "__ttl")


CORE = ("NS", "SOA", "A")


def core_pivot(obs: DataFrame, name: str = "domain") -> DataFrame:
    """Latest NS, SOA and A answer of every name side by side."""
    obs, order = normal_names(obs), newest_order()
    payload = F.struct("rcode", _answers().alias("answers"), "ttl")
    picks = [
        F.max_by(payload, F.when(F.col("rtype") == kind, order)).alias(f"__{kind.lower()}") for kind in CORE
    ]
    wide = obs.filter(F.col("rtype").isin(*CORE)).groupBy(F.col("name").alias(name)).agg(*picks)
    out = [F.col(name)]
    for kind in CORE:
        k = kind.lower()
        out += [
            F.coalesce(f"__{k}.rcode", F.lit("NODATA")).alias(f"{k}_rcode"),
            F.coalesce(f"__{k}.answers", _no_answers()).alias(f"{k}_answers"),
            F.coalesce(f"__{k}.ttl", F.lit(0)).alias(f"{k}_ttl"),
        ]
    return wide.select(*out)


def core_status(pivoted: DataFrame) -> DataFrame:
    """Status and error map of a domain from its NS, SOA and A outcomes."""
    codes = [F.col(f"{k.lower()}_rcode") for k in CORE]

    def all_are(code: str) -> Column:
        return (codes[0] == code) & (codes[1] == code) & (codes[2] == code)

    usable = {k: is_positive(F.col(f"{k.lower()}_rcode"), F.col(f"{k.lower()}_answers")) for k in CORE}
    any_usable = usable["NS"] | usable["SOA"] | usable["A"]
    status = (
        F.when(all_are("NXDOMAIN"), F.lit("dormant"))
        .when(any_usable, F.lit("alive"))
        .otherwise(F.lit("needs_retry"))
    )
    # Texts of the core error.
    core = (
        F.when(all_are("NXDOMAIN"), F.lit("All core lookups failed (NXDOMAIN)"))
        .when(all_are("SERVFAIL"), F.lit("All core lookups SERVFAIL"))
        .when(all_are("TIMEOUT"), F.lit("All core lookups timed out"))
        .when(~any_usable, F.lit("All core lookups failed after retries"))
    )

    def entry(key: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), value.alias("value")))

    entries = [entry("core", core)] + [
        entry(k, F.when(core.isNull() & (F.size(F.col(f"{k.lower()}_answers")) == 0), F.col(f"{k.lower()}_rcode")))
        for k in CORE
    ]
    errors = F.map_from_entries(F.array_compact(F.array(*entries)))
    return pivoted.withColumns({"status": status, "errors": errors})


def overall_status(pivoted: DataFrame) -> DataFrame:
    """One status per domain by priority, and the smallest non-zero TTL."""
    codes = [F.col(f"{k.lower()}_rcode") for k in CORE]
    bad = ("SERVFAIL", "REFUSED", "ERROR")
    nx = F.contains(codes[0], F.lit("NXDOMAIN")) | F.contains(codes[1], F.lit("NXDOMAIN")) | F.contains(
        codes[2], F.lit("NXDOMAIN")
    )
    first_bad = F.coalesce(*[F.when(c.isin(*bad), c) for c in codes])
    status = F.when(nx, F.lit("NXDOMAIN")).otherwise(F.coalesce(first_bad, F.lit("NOERROR")))
    ttls = [F.when(F.col(f"{k.lower()}_ttl") > 0, F.col(f"{k.lower()}_ttl")) for k in CORE]
    return pivoted.withColumns({"overall_status": status, "ttl": F.coalesce(F.least(*ttls), F.lit(0))})


def core_gate(pivoted: DataFrame) -> DataFrame:
    """Domains with at least one usable core answer; all-NXDOMAIN domains are out."""
    usable = F.lit(False)
    for k in CORE:
        usable = usable | is_positive(F.col(f"{k.lower()}_rcode"), F.col(f"{k.lower()}_answers"))
    return pivoted.filter(usable)


def split_retries(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that are done, and records to look up again.

    Rows with an ``exception`` entry among their errors count as needs_retry.
    """
    failed = F.coalesce(F.element_at("errors", "exception").isNotNull(), F.lit(False))
    marked = records.withColumn("status", F.when(failed, F.lit("needs_retry")).otherwise(F.col("status")))
    again = F.coalesce(F.col("status") == "needs_retry", F.lit(False))
    return marked.filter(~again), marked.filter(again)


RETRY_PARTS = ("done", "queued", "used_up")


def retry_parts(records: DataFrame, retry_limit: int = 1) -> DataFrame:
    """All records with the part they go to, the attempt counted up and the pause before the next one.

    Done rows stay as they are; rows to look up again are queued until their attempts are used up.
    """
    failed = F.coalesce(F.element_at("errors", "exception").isNotNull(), F.lit(False))
    again = failed | F.coalesce(F.col("status") == "needs_retry", F.lit(False))
    attempt = F.coalesce(F.col("attempt"), F.lit(0)) if "attempt" in records.columns else F.lit(0)
    marked = records.withColumns(
        {
            "status": F.when(again, F.lit("needs_retry")).otherwise(F.col("status")),
            "attempt": F.when(again, attempt + 1).otherwise(attempt),
        }
    )
    part = (
        F.when(F.col("status") != "needs_retry", F.lit("done"))
        .when(F.col("status").isNull(), F.lit("done"))
        .when(F.col("attempt") <= retry_limit, F.lit("queued"))
        .otherwise(F.lit("used_up"))
    )
    # The first repeat goes out at once, each later one waits 0.2 s more per attempt.
    pause = F.when(F.col("attempt") > 1, F.lit(0.2) * F.col("attempt")).otherwise(F.lit(0.0))
    return marked.withColumn("part", part).withColumn("pause_s", F.when(F.col("part") == "queued", pause))


def retry_round(records: DataFrame, retry_limit: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Done rows, rows for another attempt with a longer pause, and rows that used up their attempts."""
    parts = retry_parts(records, retry_limit)
    done, queued, used_up = (parts.filter(F.col("part") == p).drop("part") for p in RETRY_PARTS)
    return done.drop("pause_s"), queued, used_up.drop("pause_s")


def dnssec_flag(obs: DataFrame, name: str = "domain") -> DataFrame:
    """True for names with a DNSKEY answer."""
    hit = (F.col("rtype") == "DNSKEY") & is_positive(F.col("rcode"), _answers())
    return obs.groupBy(F.col("name").alias(name)).agg(F.max(hit).alias("dnssec"))


SRV_SERVICES = ("_xmpp._tcp", "_sip._tcp")  # fixed values


def srv_scope(obs: DataFrame, changed: DataFrame | None, mode: str = "new_only") -> DataFrame:
    """SRV rows of the watched services, for changed domains only unless the mode is ``always``.

    ``changed`` has ``domain`` and ``changed`` columns.
    """
    rows = obs.filter(F.col("rtype") == "SRV").withColumns(
        {
            "service": F.substring_index("name", ".", 2),
            "domain": F.regexp_replace("name", r"^[^.]*\.[^.]*\.", ""),
        }
    ).filter(F.col("service").isin(*SRV_SERVICES))
    if mode == "always":
        return rows
    if mode != "new_only" or changed is None:
        return rows.filter(F.lit(False))
    return rows.join(changed.filter("changed").select("domain").distinct(), "domain", "left_semi")


def srv_errors(srv: DataFrame) -> DataFrame:
    """Failed services per domain as a map and as text."""
    failed = srv.filter(~is_positive(F.col("rcode"), _answers())).select("domain", "service", "rcode").distinct()
    newest = failed.groupBy("domain", "service").agg(F.max("rcode").alias("rcode"))
    pairs = newest.groupBy("domain").agg(F.sort_array(F.collect_set(F.struct("service", "rcode"))).alias("__e"))
    return pairs.select(
        "domain",
        F.map_from_entries("__e").alias("srv_errors"),
        F.array_join(F.transform("__e", lambda e: F.concat_ws(":", e["service"], e["rcode"])), ", ").alias("srv_error"),
    )


def attach_srv(df: DataFrame, obs: DataFrame, changed: DataFrame | None, mode: str = "new_only") -> DataFrame:
    """Texts of the watched services in their fixed order as the list ``srv``, failed services under ``SRV`` in ``errors``.

    ``df`` has one row per ``domain`` and the map ``errors``.  A domain out of scope, or without SRV observations, has an
    empty list and no error.  Without a scope nothing is joined.
    """
    none = F.array().cast("array<string>")
    if mode != "always" and (mode != "new_only" or changed is None):
        return df.withColumn("srv", none)
    newest = latest_observation(obs.filter(F.col("rtype") == "SRV"))
    scope = cut_lineage(srv_scope(newest, changed, mode))  # read twice below
    texts = F.when(is_positive(F.col("rcode"), _answers()), R.format_srv(R.parse_srv(_answers())))
    # One newest row per service, so any value is the only one.
    picks = [F.any_value(F.when(F.col("service") == s, texts), True).alias(f"__{i}") for i, s in enumerate(SRV_SERVICES)]
    found = scope.groupBy("domain").agg(*picks)
    lists = [F.coalesce(f"__{i}", none) for i in range(len(SRV_SERVICES))]
    found = found.select("domain", F.concat(*lists).alias("srv"))
    failed = srv_errors(scope).select("domain", F.create_map(F.lit("SRV"), "srv_error").alias("__failed"))
    # A failed service is one of the scope's, so wide rows meet both in one join.
    out = df.join(cut_lineage(found.join(failed, "domain", "left")), "domain", "left")
    errors = F.when(F.col("__failed").isNotNull(), F.map_concat("errors", "__failed")).otherwise(F.col("errors"))
    return out.withColumns({"srv": F.coalesce("srv", none), "errors": errors}).drop("__failed")


def want_cert_probe(df: DataFrame) -> DataFrame:
    """Domains whose certificates are worth a look: own mail host, or a published mail policy."""
    has_mx = F.coalesce(F.col("mx_host_final"), F.lit("")) != ""
    reason = F.coalesce(F.col("mx_under_customer"), F.lit(False)) | F.coalesce(F.col("has_mta_sts"), F.lit(False))
    return df.filter(has_mx & reason)
