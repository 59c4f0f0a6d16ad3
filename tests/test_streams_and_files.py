"""Streams over several files and restarts, readers and writers, and the batch plan on a small fixture."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from workload.inputs import listed, load, observations, suffixes
from zonelens import schemas as S
from zonelens.functions import banners as B
from zonelens.operators import change
from zonelens.operators.rows import to_signature_rows
from zonelens.plans import batch
from zonelens.sources import readers, writers
from zonelens.streaming import jobs, sinks

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def slices(spark, tmp_path):
    """The observations as four files in time order, with a later modification time each."""
    import os

    obs = observations(spark, SF).coalesce(1)
    cuts = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2025-01-01"]
    folder = tmp_path / "obs"
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = obs.filter((F.col("observed_ts") >= lo) & (F.col("observed_ts") < hi)).coalesce(1)
        part.write.mode("append").parquet(str(folder))
        for f in folder.glob("part-*.parquet"):
            if f.stat().st_mtime > 1_600_000_000 + 10:
                os.utime(f, (1_500_000_000 + i, 1_500_000_000 + i))
    return str(folder)


def test_change_stream_over_many_batches(spark, slices, tmp_path):
    stream = readers.read_observation_stream(spark, slices, files_per_trigger=1)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    df = jobs.change_detect(stream)
    sinks.append_to(df, out, check)
    sinks.append_to(df, out, check)  # a restart finds nothing new
    want = change.change_history(readers.read_observations(spark, slices))
    cols = ["rtype", "name", "ts_us", "rcode", "prev_rcode", "is_new"]
    got = spark.read.parquet(out).select(*cols)
    assert got.count() > 100
    assert bag(got) == bag(want.withColumn("ts_us", F.unix_micros("observed_ts")).select(*cols))


def test_late_rows_are_ignored(spark, tmp_path):
    import os

    t = lambda s: datetime.fromtimestamp(1_700_000_000 + s, tz=timezone.utc)
    batches = [[("n", "A", "NOERROR", ["1"], 100, t(0))], [("n", "A", "NODATA", [], 9, t(-50)), ("n", "A", "NOERROR", ["2"], 9, t(50))],
               [("n", "A", "NOERROR", ["3"], 9, t(100))]]
    folder = tmp_path / "obs"
    seen = set()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, S.OBSERVATIONS).coalesce(1).write.mode("append").parquet(str(folder))
        for f in set(folder.glob("part-*.parquet")) - seen:
            os.utime(f, (1_500_000_000 + i, 1_500_000_000 + i))
            seen.add(f)
    stream = readers.read_observation_stream(spark, str(folder), 1)
    sinks.append_to(jobs.ttl_state(stream), str(tmp_path / "o"), str(tmp_path / "c"))
    got = sorted((r.ts_us // 1_000_000 - 1_700_000_000, r.answers_json, r.from_cache) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == [(0, '["1"]', False), (50, '["1"]', True), (100, '["3"]', False)]


def test_update_log_keeps_the_newest(spark, slices, tmp_path):
    obs = readers.read_observation_stream(spark, slices, 1).filter("rtype = 'A' AND size(answers) > 0")
    seen = obs.select(F.col("name").alias("domain"), F.explode("answers").alias("ip"), F.lit("A").alias("edge_type"), F.col("observed_ts").alias("seen_ts"))
    sinks.update_log(jobs.entity_edges(seen), str(tmp_path / "o"), str(tmp_path / "c"))
    got = sinks.latest_of_log(spark, str(tmp_path / "o"), ["domain", "ip", "edge_type"])
    batch_seen = readers.read_observations(spark, slices).filter("rtype = 'A' AND size(answers) > 0").select(
        F.col("name").alias("domain"), F.explode("answers").alias("ip"), F.lit("A").alias("edge_type"), F.col("observed_ts").alias("seen_ts"))
    want = jobs.entity_edges(batch_seen)
    assert bag(got.select(*want.columns)) == bag(want)
    assert spark.read.parquet(str(tmp_path / "o")).select("batch_id").distinct().count() > 1


def test_retry_queue_feeds_the_next_round(spark, tmp_path):
    from zonelens.operators import resolve

    schema = S.DNS_RECORDS + ", attempt int"
    rows = [("a", "alive", {}, {}, {}, 0), ("b", "needs_retry", {}, {}, {}, None), ("c", "alive", {}, {"exception": "x"}, {}, 1), ("d", None, {}, None, {}, 0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.retry_requeue(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), out, str(tmp_path / "c"), retry_limit=1)
    got = {(r.domain, r.part, r.attempt) for r in spark.read.parquet(out).select("domain", "part", "attempt").collect()}
    assert got == {("a", "done", 0), ("b", "queued", 1), ("c", "used_up", 2), ("d", "done", 0)}
    queued = jobs.queued_records(spark, out)
    assert [(r.domain, r.attempt, r.pause_s) for r in queued.collect()] == [("b", 1, 0.0)]
    done, again, used_up = resolve.retry_round(queued.drop("pause_s"), retry_limit=3)
    assert (done.count(), [(r.attempt, r.pause_s) for r in again.collect()], used_up.count()) == (0, [(2, 0.4)], 0)


def test_readers_and_writers(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    spark.createDataFrame([("a.com", "n", "1.1.1.1", "de", 5)], "domain string, ns string, ip string, country_dm string, x int").write.parquet(p("crawl.parquet"))
    assert readers.read_crawl_list(spark, p("crawl.parquet")).columns == ["domain", "ns", "ip", "country_dm"]
    spark.createDataFrame([("MX.a.com.",), ("mx.a.com",), (None,), ("",)], "mx_host string").coalesce(1).write.option("header", True).csv(p("mx"))
    assert [r.mx_host for r in readers.read_mx_hosts(spark, p("mx")).collect()] == ["mx.a.com"]
    (tmp_path / "rules.csv").write_text('Host_Regex,details_regex,provider,category,confidence\n"(mx|smtp)\\.google",,G,C,950\n,exim,E,M,x\n')
    got = readers.read_banner_rules(spark, p("rules.csv"))
    assert got == [B.Rule(r"(mx|smtp)\.google", "", "G", "C", 100), B.Rule("", "exim", "E", "M", 80)]
    (tmp_path / "none.csv").write_text("host_regex,details_regex,provider,category,confidence\n")
    assert readers.read_banner_rules(spark, p("none.csv")) == list(B.CLASSIFIER) == readers.read_banner_rules(spark, None)
    (tmp_path / "rib.dat").write_text("; comment\n1.0.0.0/24\t13335\n10.0.0.7/8\t5\nbad\t7\n")
    rib = sorted((r.start_int, r.end_int, r.plen, r.asn) for r in readers.read_ip_prefixes(spark, p("rib.dat")).collect())
    assert rib == [(16777216, 16777471, 24, 13335), (167772160, 184549375, 8, 5)]
    assert readers.read_brand_catalog(spark, p("nowhere"), "ns") is None
    with pytest.raises(ValueError):
        readers.read_brand_catalog(spark, p("nowhere"), "zz")
    spark.createDataFrame([("7", 0.5), ("x", 1.0)], "asn string, asn_moas_ratio double").write.parquet(p("moas"))
    routing = readers.read_routing(spark, {"moas": p("moas"), "churn": p("moas"), "asn_risk": p("gone")})
    assert [r.asn for r in routing["moas"].orderBy("asn_moas_ratio").collect()] == [7, None] and routing["asn_risk"] is None
    delta = spark.createDataFrame([("a.com", "true", "5", "sha1:x", "m", "")], S.ACTIVITY_DELTA)
    writers.append_activity_delta(delta, p("delta"))
    writers.append_activity_delta(delta, p("delta"))
    writers.append_activity_delta(delta.filter("false"), p("delta2"))
    assert spark.read.option("header", True).csv(p("delta")).count() == 2 and not (tmp_path / "delta2").exists()
    for _ in range(2):  # a batch that runs again replaces its rows
        writers.append_activity_delta(delta, p("delta3"), 7)
    writers.append_activity_delta(delta, p("delta3"), 8)
    assert spark.read.option("header", True).csv(p("delta3")).count() == 2
    cert = spark.createDataFrame([("h", "Jun  1 00:00:00 2024 GMT", [("k", "v")], ["a"])], S.CERTIFICATES)
    cert.write.json(p("certs.json"))
    assert readers.read_certificates(spark, p("certs.json")).first().issuer[0].k == "k"
    writers.write_ptr(spark.createDataFrame([("1.1.1.1", "p", "NOERROR", 5)], S.PTR_RESULTS), p("ptr"))
    assert spark.read.parquet(p("ptr")).count() == 1


def test_batch_plan_writes_all_outputs(spark, tmp_path):
    obs = observations(spark, SF)
    domains = obs.select(F.upper("name").alias("domain"))
    state = spark.createDataFrame([], S.ACTIVITY_STATE)
    out = str(tmp_path / "out")
    metrics = batch.run_batch(domains, obs, suffixes(spark, SF), state, out, datetime(2024, 2, 1, tzinfo=timezone.utc)).first()
    n = domains.distinct().count()
    assert metrics.domains == n and metrics.results + metrics.retries == n and metrics.retries > 0
    read = spark.read.parquet
    assert read(f"{out}/results").count() == metrics.results == read(f"{out}/entity_domain").count()
    assert read(f"{out}/retries").count() == metrics.retries
    expanded = read(f"{out}/expanded")
    assert len(expanded.columns) == 44 and expanded.filter("size(mx_records) > 0").count() > 0
    edges, ips = read(f"{out}/entity_edge"), read(f"{out}/entity_ip")
    assert edges.count() > 0 and edges.join(ips, edges.dst_id == ips.ip_id, "left_anti").count() == 0
    assert spark.read.option("header", True).csv(f"{out}/activity_delta").count() == metrics.results
    assert len(to_signature_rows(read(f"{out}/records")).columns) == 48


def test_shared_folder_comes_from_the_session(spark):
    from zonelens.operators.joins import cut_lineage
    from zonelens.session import shared_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    df = spark.range(5)
    assert cut_lineage(df).count() == 5
    if named:
        assert shared_dir(spark, "x").startswith(f"{named}/x-")
    else:
        assert cut_lineage(df) is df


def test_inputs_are_whole_tables(spark):
    assert load(spark, SF, "obs").count() == spark.read.parquet(f"{SF}/events.parquet").count()
    assert load(spark, SF, "records").select(listed("a_txt")).count() == spark.read.parquet(f"{SF}/orders.parquet").count()
