"""Streams of observations, records and probes.

Stateful functions are defined inside their operator: they travel with the job, executors need no copy of this
package.  One call sees the rows that one key, or bucket of keys, brought in one trigger, so the trigger's file limit bounds it.
Buckets: see :mod:`zonelens.streaming.ordered`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from zonelens.functions.identity import dns_signature, entity_id, entity_key
from zonelens.operators.change import is_active
from zonelens.operators.penalty import penalty_measures, penalty_verdict
from zonelens.operators.resolve import KEY, normal_names, retry_parts
from zonelens.plans.scored import scored_hosts
from zonelens.sources.writers import append_activity_delta
from zonelens.streaming.ordered import BUCKETS
from zonelens.streaming.sinks import COMPACT_EVERY, each_batch, merge_batch, merged_table


def dedupe_lookups(obs: DataFrame, horizon: str = "1 hour", keys: Sequence[str] = KEY) -> DataFrame:
    """One row per key within the horizon; rows behind the watermark are dropped."""
    timed = normal_names(obs).withColumn("observed_ts", F.col("observed_ts").cast("timestamp"))
    return timed.withWatermark("observed_ts", horizon).dropDuplicatesWithinWatermark(list(keys))


def _compact(obs: DataFrame) -> DataFrame:
    """Observation columns that the state functions need; answers as sorted JSON text, time in microseconds."""
    answers = F.sort_array(F.coalesce("answers", F.array().cast("array<string>")))
    return normal_names(obs).select(
        *KEY,
        F.coalesce("rcode", F.lit("")).alias("rcode"),
        F.to_json(answers).alias("answers_json"),
        F.coalesce("ttl", F.lit(0)).cast("bigint").alias("ttl"),
        F.unix_micros(F.col("observed_ts").cast("timestamp")).alias("ts_us"),
    )


def _as_they_arrive(
    obs: DataFrame, output: str, step: Callable[[list | None, list], tuple[list, tuple | None]], buckets: int,
) -> DataFrame:
    """Fold every key's rows in the order of their triggers, and by time within a trigger.

    ``step`` takes the stored value (or None) and the next row (ts_us, rcode, ttl, answers_json) and gives the new value
    and an output row (or None).
    """
    columns = [part.split()[0] for part in output.split(", ")]

    def fold(bucket: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {(rtype, name): value for rtype, name, value in json.loads(state.get[0])} if state.exists else {}
        rows = []
        for part in chunks:
            rows += zip(*[part[c].tolist() for c in ("ts_us", "rcode", "ttl", "answers_json", "rtype", "name")])
        rows.sort(key=lambda row: row[:4])
        out = []
        for ts, rcode, ttl, answers, *key in rows:
            key = tuple(key)
            held[key], found = step(held.get(key), [int(ts), rcode, int(ttl), answers])
            if found is not None:
                out.append((*key, *found))
        state.update((json.dumps([(*key, value) for key, value in held.items()]),))
        if out:
            yield pd.DataFrame(dict(zip(columns, map(list, zip(*out)))), columns=columns)

    rows = _compact(obs).withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(buckets)))
    return rows.groupBy("bucket").applyInPandasWithState(fold, output, "held string", "append", GroupStateTimeout.NoTimeout)


def ttl_state(obs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Answer lookups as they arrive from the last stored answer while that is valid, else store the new one.

    Output per observation that is not older than the state: the answer served, where it came from, and its age.
    :func:`zonelens.streaming.ordered.ttl_answers` waits for late rows instead and removes state that has expired.
    """

    def serve(stored: list | None, row: list) -> tuple[list, tuple | None]:
        ts = row[0]
        if stored is not None and ts < stored[0]:
            return stored, None  # older than the state
        valid = stored is not None and ts - stored[0] < stored[2] * 1_000_000
        kept = stored if valid else row
        return kept, (ts, kept[1], kept[3], valid, ts - kept[0])

    output = "rtype string, name string, ts_us bigint, rcode string, answers_json string, from_cache boolean, age_us bigint"
    return _as_they_arrive(obs, output, serve, buckets)


def change_detect(obs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Observations, in the order of their arrival, that differ from the one before for their key.

    :func:`zonelens.streaming.ordered.changes` puts late rows in their place instead.
    """

    def compare(last: list | None, row: list) -> tuple[list, tuple | None]:
        ts, rcode, _, answers = row
        if last is not None and ts < last[2]:
            return last, None  # older than the state
        found = None
        if last is None:
            found = (ts, rcode, None, True)
        elif [rcode, answers] != last[:2]:
            found = (ts, rcode, last[0], False)
        return [rcode, answers, ts], found

    output = "rtype string, name string, ts_us bigint, rcode string, prev_rcode string, is_new boolean"
    return _as_they_arrive(obs, output, compare, buckets)


def activity(rows: DataFrame) -> DataFrame:
    """Activity deltas of signature rows: new, changed or reactivated domains (I4).

    ``rows`` has domain, ns, a, mx_regdom, status, mx_ips and ``seen_ts``.
    """
    schema = (
        "domain string, is_active string, last_seen_ts string, dns_sig string, mx_regdom string, mx_ips string, "
        "reactivated boolean"
    )
    state_schema = "is_active boolean, dns_sig string, ts_us bigint"

    def judge(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(chunks)).sort_values(["ts_us", "dns_sig"], kind="stable")
        last = tuple(state.get) if state.exists else None
        out = []
        for active, sig, ts, mx, ips in zip(rows.active, rows.dns_sig, rows.ts_us, rows.mx_regdom, rows.mx_ips):
            active, ts = bool(active), int(ts)
            if last is not None and ts < last[2]:
                continue  # older than the state
            back = last is not None and not last[0] and active
            if last is None or back or sig != last[1]:
                seen = str(ts // 1_000_000)
                out.append((key[0], "true" if active else "false", seen, sig, mx, ips, back))
            last = (active, sig, ts)
        if last is not None:
            state.update(last)
        columns = ["domain", "is_active", "last_seen_ts", "dns_sig", "mx_regdom", "mx_ips", "reactivated"]
        yield pd.DataFrame(out, columns=columns)

    regdom = F.lower(F.coalesce("mx_regdom", F.lit("")))
    compact = rows.select(
        F.lower("domain").alias("domain"),
        is_active(F.col("status")).alias("active"),
        dns_signature(F.col("ns"), F.col("a"), regdom).alias("dns_sig"),
        F.unix_micros(F.col("seen_ts").cast("timestamp")).alias("ts_us"),
        regdom.alias("mx_regdom"),
        F.coalesce("mx_ips", F.lit("")).alias("mx_ips"),
    )
    return compact.groupBy("domain").applyInPandasWithState(
        judge, schema, state_schema, "append", GroupStateTimeout.NoTimeout
    )


def activity_log(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append the activity deltas of arriving signature rows to a CSV log (I4); ``rows`` as for :func:`activity`.

    The rows of a batch lie below its number, so a batch that runs again replaces its own rows.
    """

    def add(batch: DataFrame, number: int) -> None:
        append_activity_delta(batch.drop("reactivated"), path, number)

    each_batch(activity(rows), add, checkpoint)


def penalty_windows(probes: DataFrame, seconds: int = 300, delay: str = "1 hour") -> DataFrame:
    """Penalty verdict per zone and time window (I5); the same code serves streams and batches."""
    timed = probes.withColumn("ts", F.col("ts").cast("timestamp"))
    if probes.isStreaming:
        timed = timed.withWatermark("ts", delay)
    measured = timed.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "tld").agg(*penalty_measures())
    return penalty_verdict(measured).select(F.col("w.start").alias("window_start"), "*").drop("w")


def entity_nodes(edges: DataFrame) -> DataFrame:
    """Domain and address nodes with first and last sight.

    ``edges`` has domain, ip and ``seen_ts``; both node kinds come from one pass.
    """
    seen = F.col("seen_ts").cast("timestamp")
    nodes = F.array(
        F.struct(
            F.lit("domain").alias("kind"),
            entity_id("domain", F.col("domain")).alias("id"),
            entity_key("domain", F.col("domain")).alias("key"),
        ),
        F.struct(
            F.lit("ip").alias("kind"),
            entity_id("ip", F.col("ip")).alias("id"),
            entity_key("ip", F.col("ip")).alias("key"),
        ),
    )
    rows = edges.select(seen.alias("seen_ts"), F.inline(nodes)).filter(F.coalesce(F.col("key"), F.lit("")) != "")
    return rows.groupBy("kind", "id", "key").agg(
        F.min("seen_ts").alias("first_seen_ts"), F.max("seen_ts").alias("last_seen_ts")
    )


def entity_edges(edges: DataFrame) -> DataFrame:
    """Domain-address edges with first and last sight."""
    seen = F.col("seen_ts").cast("timestamp")
    rows = edges.filter(F.coalesce(F.col("ip"), F.lit("")) != "")
    keys = [
        entity_key("domain", F.col("domain")).alias("domain"),
        entity_key("ip", F.col("ip")).alias("ip"),
        F.col("edge_type"),
    ]
    return rows.groupBy(*keys).agg(F.min(seen).alias("first_seen_ts"), F.max(seen).alias("last_observed_ts"))


# Keys and folded columns of the merged entity tables.
SEEN = {"first_seen_ts": F.min, "last_seen_ts": F.max}
EDGE_SEEN = {"first_seen_ts": F.min, "last_observed_ts": F.max}
NODE_KEYS = ("kind", "id", "key")
EDGE_KEYS = ("domain", "ip", "edge_type")


def merge_entities(sightings: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY) -> None:
    """Merge arriving sightings into a node and an edge table below ``path``.

    No state is kept between batches but the tables; a batch that runs again changes nothing.
    """

    def add(batch: DataFrame, number: int) -> None:
        merge_batch(entity_nodes(batch), number, f"{path}/nodes", NODE_KEYS, SEEN, compact_every)
        merge_batch(entity_edges(batch), number, f"{path}/edges", EDGE_KEYS, EDGE_SEEN, compact_every)

    each_batch(sightings, add, checkpoint)


def merged_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The merged node table."""
    schema = "kind string, id bigint, key string, first_seen_ts timestamp, last_seen_ts timestamp"
    return merged_table(spark, f"{path}/nodes", schema, NODE_KEYS, SEEN)


def merged_edges(spark: SparkSession, path: str) -> DataFrame:
    """The merged edge table."""
    schema = "domain string, ip string, edge_type string, first_seen_ts timestamp, last_observed_ts timestamp"
    return merged_table(spark, f"{path}/edges", schema, EDGE_KEYS, EDGE_SEEN)


def retry_requeue(records: DataFrame, out: str, checkpoint: str, retry_limit: int = 1) -> None:
    """Split arriving records into done, queued for another attempt, and used up, in one write per batch.

    Rows lie below ``batch_id=<n>/part=<part>``; a batch that runs again replaces its own folder.  The next run
    reads the queued part as its source, see :func:`queued_records`.
    """

    def split(batch: DataFrame, number: int) -> None:
        parts = retry_parts(batch, retry_limit)
        parts.write.mode("overwrite").partitionBy("part").parquet(f"{out}/batch_id={number}")

    each_batch(records, split, checkpoint)


def queued_records(spark: SparkSession, out: str) -> DataFrame:
    """Rows that wait for another attempt; only their folders are read."""
    return spark.read.option("basePath", out).parquet(out).filter(F.col("part") == "queued").drop("batch_id", "part")


def score_stream(hosts: DataFrame, suffixes: DataFrame, host: str = "host", profile: str = "default") -> DataFrame:
    """Score every arriving host; lookups are static tables (I8)."""
    return scored_hosts(hosts, suffixes, host, profile)
