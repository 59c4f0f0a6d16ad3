"""Streams drained to tables.

Each query reads a whole given table as a stream, runs until all of it is processed, and returns what the sink
holds.  Sinks and checkpoints lie in the shared folder that the cluster names.
"""

from __future__ import annotations

import math
from datetime import datetime, timezone

from pyspark.sql import functions as F

from workload.inputs import listed, load, observations, suffixes
from workload.q_features import penalty_sql
from workload.q_observations import HISTORY_SQL
from workload.q_plans import SCORED_SQL
from workload.registry import query
from zonelens.schemas import ACTIVITY_DELTA
from zonelens.session import shared_dir
from zonelens.sources import readers
from zonelens.streaming import jobs, ordered, sinks


# A trigger brings rows of most keys here, so the state lies in few buckets.
_BUCKETS = 1024
# Rows of one input file, on average: a task of a trigger takes a file or a few, whatever the size of the table.
_FILE_ROWS = 100_000


def _drain(spark, df, purpose):
    base = shared_dir(spark, purpose)
    sinks.append_to(df, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def _drain_updates(spark, df, purpose, keys):
    base = shared_dir(spark, purpose)
    sinks.update_log(df, f"{base}/out", f"{base}/checkpoint")
    return sinks.latest_of_log(spark, f"{base}/out", keys)


@query("stream_dedupe", "SELECT DISTINCT rtype, name FROM obs", "obs")
def stream_dedupe(spark, sf):
    # The horizon is longer than the table, so a key comes out once in all.
    once = jobs.dedupe_lookups(observations(spark, sf, ("events",)), "36500 days")
    return _drain(spark, once.select("rtype", "name"), "dedupe")


@query("stream_change", HISTORY_SQL, "obs")
def stream_change(spark, sf):
    return _drain(spark, jobs.change_detect(observations(spark, sf, ("events",)), _BUCKETS), "change")


_TTL_SQL = """
    WITH RECURSIVE o AS (SELECT rtype, name, epoch_us(observed_ts) AS ts_us, rcode, answers_txt, ttl::BIGINT AS ttl,
            row_number() OVER (PARTITION BY rtype, name ORDER BY observed_ts) AS rn FROM obs),
        served AS (SELECT rtype, name, rn, ts_us, rcode, answers_txt, ttl, ts_us AS stored_us, FALSE AS from_cache FROM o WHERE rn = 1
            UNION ALL
            SELECT o.rtype, o.name, o.rn, o.ts_us,
                CASE WHEN o.ts_us - s.stored_us < s.ttl * 1000000 THEN s.rcode ELSE o.rcode END,
                CASE WHEN o.ts_us - s.stored_us < s.ttl * 1000000 THEN s.answers_txt ELSE o.answers_txt END,
                CASE WHEN o.ts_us - s.stored_us < s.ttl * 1000000 THEN s.ttl ELSE o.ttl END,
                CASE WHEN o.ts_us - s.stored_us < s.ttl * 1000000 THEN s.stored_us ELSE o.ts_us END,
                o.ts_us - s.stored_us < s.ttl * 1000000
            FROM served s JOIN o ON s.rtype = o.rtype AND s.name = o.name AND o.rn = s.rn + 1)
    SELECT rtype, name, ts_us, rcode, from_cache, ts_us - stored_us AS age_us,
        CASE WHEN answers_txt = '' THEN 0 ELSE len(string_split(answers_txt, '|')) END::INT AS n_answers FROM served"""


@query("stream_ttl", _TTL_SQL, "obs")
def stream_ttl(spark, sf):
    out = _drain(spark, jobs.ttl_state(observations(spark, sf, ("events",)), _BUCKETS), "ttl")
    n = F.size(F.from_json("answers_json", "array<string>")).alias("n_answers")
    return out.select("rtype", "name", "ts_us", "rcode", "from_cache", "age_us", n)


def _disordered(spark, sf, purpose):
    """The observations as a stream of eight arrivals: a row arrives up to 36 hours after its time, and a mark closes the last one.

    An arrival is one trigger of equally many files, so that its rows are many tasks' work.  Names come in other spellings,
    as resolvers give them.
    """
    rows = load(spark, sf, "obs")
    late = F.make_interval(hours=F.col("event_id") % 7 * 6)
    name = F.when(F.col("event_id") % 2 == 0, F.concat(F.upper("name"), F.lit("."))).otherwise(F.col("name"))
    rows = rows.withColumns({"name": name, "answers": listed("answers_txt"), "observed_ts": F.col("observed_ts").cast("timestamp")})
    rows = rows.withColumn("arrival", F.col("observed_ts") + late)
    ends = rows.agg(F.min("arrival").alias("first"), F.max("arrival").alias("last"), F.count("*").alias("n")).first()
    files = max(1, math.ceil(ends["n"] / 8 / _FILE_ROWS))
    base = shared_dir(spark, purpose)
    path, slots = f"{base}/in", f"{base}/slots"
    columns = ["name", "rtype", "rcode", "answers", "ttl", "observed_ts"]
    step = (ends["last"] - ends["first"]) / 8
    # All tasks deal the rows to their arrivals in one pass; these are then written one after the other, as files come in order.
    slot = sum((F.col("arrival") >= F.lit(ends["first"] + k * step)).cast("int") for k in range(1, 8))
    rows.withColumn("slot", slot).select(*columns, "slot").write.partitionBy("slot").parquet(slots)
    dealt = spark.read.parquet(slots)
    for k in range(8):
        part = dealt.filter(F.col("slot") == k).select(*columns)
        part.repartition(files, "name", "observed_ts").write.mode("append").parquet(path)
        # A part without rows is no file; an empty one keeps the next arrival out of this trigger.
        for _ in range(len(spark.read.schema(part.schema).parquet(path).inputFiles()), (k + 1) * files):
            part.limit(0).coalesce(1).write.mode("append").parquet(path)
    ordered.closing_mark(spark, datetime(2100, 1, 1, tzinfo=timezone.utc)).select(*columns).coalesce(1).write.mode("append").parquet(path)
    return readers.read_observation_stream(spark, path, files_per_trigger=files)


@query("stream_change_disorder", HISTORY_SQL, "obs")
def stream_change_disorder(spark, sf):
    return _drain(spark, ordered.changes(_disordered(spark, sf, "change-in"), "2 days", _BUCKETS), "change")


@query("stream_dedupe_horizon", """
    WITH RECURSIVE o AS (SELECT rtype, name, epoch_us(observed_ts) AS ts_us,
            row_number() OVER (PARTITION BY rtype, name ORDER BY observed_ts) AS rn FROM obs),
        s AS (SELECT rtype, name, rn, ts_us, ts_us AS sent_us FROM o WHERE rn = 1
            UNION ALL
            SELECT o.rtype, o.name, o.rn, o.ts_us, CASE WHEN o.ts_us - s.sent_us < 259200000000 THEN s.sent_us ELSE o.ts_us END
            FROM s JOIN o ON s.rtype = o.rtype AND s.name = o.name AND o.rn = s.rn + 1)
    SELECT rtype, name, ts_us FROM s WHERE sent_us = ts_us""", "obs")
def stream_dedupe_horizon(spark, sf):
    """A key is asked at most once in three days."""
    return _drain(spark, ordered.first_lookups(_disordered(spark, sf, "dedupe-in"), 3 * 86400, "2 days", _BUCKETS), "dedupe")


@query("stream_ttl_expiry", _TTL_SQL, "obs")
def stream_ttl_expiry(spark, sf):
    out = _drain(spark, ordered.ttl_answers(_disordered(spark, sf, "ttl-in"), "2 days", _BUCKETS), "ttl")
    n = F.size(F.from_json("answers_json", "array<string>")).alias("n_answers")
    return out.select("rtype", "name", "ts_us", "rcode", "from_cache", "age_us", n)


def _signature_stream(spark, sf):
    obs = load(spark, sf, "obs", ("events",))
    kind = F.col("event_id")
    return obs.select(
        F.upper("name").alias("domain"), F.concat(F.lit("ns"), (kind % 2).cast("string")).alias("ns"),
        F.concat(F.lit("10.0.0."), (kind % 3).cast("string")).alias("a"), F.lit("Mail.Net").alias("mx_regdom"),
        F.col("rcode").alias("status"), F.lit(None).cast("string").alias("mx_ips"), F.col("observed_ts").alias("seen_ts"),
    )


_ACTIVITY_SQL = """
    WITH s AS (SELECT name AS domain, observed_ts, rcode <> 'NXDOMAIN' AS active,
            concat('sha1:', sha1(concat('ns', cast(event_id % 2 AS varchar), '|10.0.0.', cast(event_id % 3 AS varchar), '|mail.net')))
            AS dns_sig FROM obs),
        l AS (SELECT *, lag(active) OVER w AS was, lag(dns_sig) OVER w AS old FROM s WINDOW w AS (PARTITION BY domain ORDER BY observed_ts))
    SELECT domain, CASE WHEN active THEN 'true' ELSE 'false' END AS is_active,
        cast(cast(floor(epoch_us(observed_ts) / 1000000) AS bigint) AS varchar) AS last_seen_ts, dns_sig, 'mail.net' AS mx_regdom,
        '' AS mx_ips {more}
    FROM l WHERE was IS NULL OR (NOT was AND active) OR old <> dns_sig"""


@query("stream_activity", _ACTIVITY_SQL.replace("{more}", ", coalesce(NOT was AND active, FALSE) AS reactivated"), "obs")
def stream_activity(spark, sf):
    return _drain(spark, jobs.activity(_signature_stream(spark, sf)), "activity")


@query("stream_activity_log", _ACTIVITY_SQL.replace("{more}", ""), "obs")
def stream_activity_log(spark, sf):
    base = shared_dir(spark, "activity-log")
    jobs.activity_log(_signature_stream(spark, sf), f"{base}/out", f"{base}/checkpoint")
    log = spark.read.option("header", True).schema(ACTIVITY_DELTA + ", batch_id INT").csv(f"{base}/out")
    return log.drop("batch_id").withColumn("mx_ips", F.coalesce("mx_ips", F.lit("")))


_WINDOWS = "WITH t AS (SELECT *, time_bucket(INTERVAL 300 SECONDS, ts) AS w FROM probes), " + penalty_sql(
    "w, tld", """epoch_us(w) AS window_us, tld, tested, failures, round(avg_response_time, 6) AS avg_response_time,
    round(failure_rate, 6) AS failure_rate, in_penalty, CASE WHEN in_penalty THEN why ELSE 'OK' END AS reason FROM v""", "t")


def _shown(out):
    rounded = out.withColumns({c: F.round(c, 6) for c in ("avg_response_time", "failure_rate")})
    return rounded.withColumn("window_us", F.unix_micros("window_start")).drop("window_start")


@query("penalty_windows", _WINDOWS, "probes")
def penalty_windows(spark, sf):
    return _shown(jobs.penalty_windows(load(spark, sf, "probes")))


@query("stream_penalty", _WINDOWS, "probes")
def stream_penalty(spark, sf):
    out = jobs.penalty_windows(load(spark, sf, "probes", ("events",)))
    return _shown(_drain_updates(spark, out, "penalty", ["window_start", "tld"]))


def _sightings(spark, sf, streams=("events",)):
    obs = load(spark, sf, "obs", streams).filter("rtype = 'A' AND answers_txt <> ''")
    return obs.select(
        F.upper("name").alias("domain"), F.explode(listed("answers_txt")).alias("ip"), F.lit("A").alias("edge_type"),
        F.col("observed_ts").alias("seen_ts"),
    )


_SEEN = "s AS (SELECT name AS domain, u.ip, observed_ts FROM obs, unnest(string_split(answers_txt, '|')) AS u(ip) WHERE rtype = 'A' AND answers_txt <> '')"


@query("stream_entity_nodes", f"""
    WITH {_SEEN}, n AS (SELECT 'domain' AS kind, domain AS key, observed_ts FROM s UNION ALL SELECT 'ip', ip, observed_ts FROM s)
    SELECT kind, key, epoch_us(min(observed_ts)) AS first_us, epoch_us(max(observed_ts)) AS last_us FROM n GROUP BY kind, key""",
       "obs")
def stream_entity_nodes(spark, sf):
    out = _drain_updates(spark, jobs.entity_nodes(_sightings(spark, sf)), "nodes", ["kind", "id", "key"])
    return out.select(
        "kind", "key", F.unix_micros("first_seen_ts").alias("first_us"), F.unix_micros("last_seen_ts").alias("last_us")
    )


@query("stream_entity_edges", f"""
    WITH {_SEEN} SELECT domain, ip, 'A' AS edge_type, epoch_us(min(observed_ts)) AS first_us, epoch_us(max(observed_ts)) AS last_us
    FROM s GROUP BY domain, ip""", "obs")
def stream_entity_edges(spark, sf):
    keys = ["domain", "ip", "edge_type"]
    out = _drain_updates(spark, jobs.entity_edges(_sightings(spark, sf)), "edges", keys)
    return out.select(
        *keys, F.unix_micros("first_seen_ts").alias("first_us"), F.unix_micros("last_observed_ts").alias("last_us")
    )


def _merged(spark, sf, purpose):
    """Sightings in eight files, one a trigger, merged into tables that are compacted every three batches."""
    obs = _disordered(spark, sf, f"{purpose}-in").filter("rtype = 'A' AND size(answers) > 0")
    sightings = obs.select(
        F.col("name").alias("domain"), F.explode("answers").alias("ip"), F.lit("A").alias("edge_type"), F.col("observed_ts").alias("seen_ts")
    )
    sightings = sightings.withColumn("domain", F.rtrim("domain", F.lit(".")))
    base = shared_dir(spark, purpose)
    jobs.merge_entities(sightings, f"{base}/out", f"{base}/checkpoint", compact_every=3)
    return f"{base}/out"


@query("stream_nodes_merged", f"""
    WITH {_SEEN}, n AS (SELECT 'domain' AS kind, domain AS key, observed_ts FROM s UNION ALL SELECT 'ip', ip, observed_ts FROM s)
    SELECT kind, key, epoch_us(min(observed_ts)) AS first_us, epoch_us(max(observed_ts)) AS last_us FROM n GROUP BY kind, key""",
       "obs")
def stream_nodes_merged(spark, sf):
    out = jobs.merged_nodes(spark, _merged(spark, sf, "nodes-merged"))
    return out.select(
        "kind", "key", F.unix_micros("first_seen_ts").alias("first_us"), F.unix_micros("last_seen_ts").alias("last_us")
    )


@query("stream_edges_merged", f"""
    WITH {_SEEN} SELECT domain, ip, 'A' AS edge_type, epoch_us(min(observed_ts)) AS first_us, epoch_us(max(observed_ts)) AS last_us
    FROM s GROUP BY domain, ip""", "obs")
def stream_edges_merged(spark, sf):
    out = jobs.merged_edges(spark, _merged(spark, sf, "edges-merged"))
    return out.select(
        "domain", "ip", "edge_type", F.unix_micros("first_seen_ts").alias("first_us"), F.unix_micros("last_observed_ts").alias("last_us")
    )


@query("stream_retry", """
    SELECT domain, CASE WHEN status <> 'needs_retry' THEN 'done' WHEN o_orderkey % 3 = 0 THEN 'queued' ELSE 'used_up' END AS part,
        cast(CASE WHEN status <> 'needs_retry' THEN o_orderkey % 3 ELSE o_orderkey % 3 + 1 END AS integer) AS attempt FROM records""",
       "records")
def stream_retry(spark, sf):
    rows = load(spark, sf, "records", ("orders",)).select(
        "domain", "status", F.create_map().cast("map<string,string>").alias("errors"),
        (F.col("o_orderkey") % 3).cast("int").alias("attempt"),
    )
    base = shared_dir(spark, "retry")
    jobs.retry_requeue(rows, f"{base}/out", f"{base}/checkpoint", retry_limit=1)
    out = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out")
    return out.select("domain", "part", "attempt")


@query("stream_score", SCORED_SQL, "page_hosts", "suffix_list")
def stream_score(spark, sf):
    hosts = load(spark, sf, "page_hosts", ("pages",))
    out = jobs.score_stream(hosts, suffixes(spark, sf))
    columns = ["page_id", "registered_domain", "dga_sld", "subdomain_points", "risk_score", "risk_level", "risk_reasons"]
    return _drain(spark, out.select(*columns), "score")


