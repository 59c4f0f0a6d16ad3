"""Streams in event-time order, state that ends, and merged tables over several triggers and replays."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from zonelens import schemas as S
from zonelens.operators import change
from zonelens.sources import readers
from zonelens.streaming import jobs, ordered, sinks

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def files(spark, folder, batches):
    """One file per batch, with later modification times."""
    import os

    seen = set()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, S.OBSERVATIONS).coalesce(1).write.mode("append").parquet(str(folder))
        for f in set(folder.glob("part-*.parquet")) - seen:
            os.utime(f, (1_500_000_000 + i, 1_500_000_000 + i))
            seen.add(f)
    return readers.read_observation_stream(spark, str(folder), 1)


def closing():
    return [("", ordered.MARK, None, None, None, at(10**7))]


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_do_not_depend_on_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):  # many rows of one second, answers in any order, names in any spelling, nulls
        name = rng.choice(["a.com", "A.com.", "b.net", "B.NET"])
        answers = rng.choice([None, [], ["1"], ["1", "2"], ["2", "1"], ["3"]])
        rows.append((name, rng.choice(["A", "NS"]), rng.choice(["NOERROR", "NODATA"]), answers, rng.choice([5, 9]), at(rng.randrange(0, 60))))
    late = sorted(rows, key=lambda r: (r[5] + timedelta(seconds=rng.randrange(0, 10)), rng.random()))
    batches = [late[i : i + 60] for i in range(0, 400, 60)] + [closing()]
    stream = files(spark, tmp_path / "in", batches)
    out = str(tmp_path / "out")
    sinks.append_to(ordered.changes(stream, "20 seconds"), out, str(tmp_path / "check"))
    want = change.change_history(spark.createDataFrame(rows, S.OBSERVATIONS))
    cols = ["rtype", "name", "ts_us", "rcode", "prev_rcode", "is_new"]
    got = spark.read.parquet(out).select(*cols)
    assert got.count() > 100
    assert bag(got) == bag(want.withColumn("ts_us", F.unix_micros("observed_ts")).select(*cols))


def test_late_rows_are_answered_and_state_shrinks(spark, tmp_path):
    a = lambda t, x, ttl=100: ("n.com", "A", "NOERROR", [x], ttl, at(t))
    others = [(f"n{k}.com", "A", "NOERROR", ["x"], 30, at(k % 7)) for k in range(50)]
    batches = [others + [a(0, "1")], [a(60, "2")], [a(50, "3"), a(110, "4")], [a(400, "5")], closing()]
    out = str(tmp_path / "out")
    query = (
        ordered.ttl_answers(files(spark, tmp_path / "in", batches), "30 seconds").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(out).filter("name = 'n.com'").select("ts_us", "answers_json", "from_cache", "age_us").collect()
    base = int(START.timestamp() * 1_000_000)
    assert sorted(((r[0] - base) // 1_000_000, r[1], r[2], r[3] // 1_000_000) for r in got) == [
        (0, '["1"]', False, 0), (50, '["1"]', True, 50), (60, '["1"]', True, 60), (110, '["4"]', False, 0), (400, '["5"]', False, 0),
    ]
    assert spark.read.parquet(out).count() == 55
    sizes = [p["stateOperators"][0]["customMetrics"].get("numValueStateVars", 0) for p in query.recentProgress if p["stateOperators"]]
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert sizes and max(totals) > 50 and totals[-1] < 5


def test_keys_of_one_bucket_share_a_state_and_stay_apart(spark, tmp_path):
    rng = random.Random(9)
    rows = [(f"n{rng.randrange(20)}.com", "A", rng.choice(["NOERROR", "NODATA"]), [rng.choice("ab")], 5, at(rng.randrange(600))) for _ in range(200)]
    late = sorted(rows, key=lambda r: r[5] + timedelta(seconds=rng.randrange(15)))
    out = str(tmp_path / "out")
    stream = files(spark, tmp_path / "in", [late[:100], late[100:], closing()])
    query = (
        ordered.changes(stream, "20 seconds", buckets=1).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = change.change_history(spark.createDataFrame(rows, S.OBSERVATIONS)).withColumn("ts_us", F.unix_micros("observed_ts"))
    cols = ["rtype", "name", "ts_us", "rcode", "prev_rcode", "is_new"]
    assert bag(spark.read.parquet(out).select(*cols)) == bag(want.select(*cols))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) == 1


def test_streams_by_arrival_keep_one_state_a_bucket(spark, tmp_path):
    rows = [(f"n{i % 12}.com", "A", "NOERROR", ["ab"[i % 5 % 2]], 5, at(i)) for i in range(60)]
    out = str(tmp_path / "out")
    query = (
        jobs.change_detect(files(spark, tmp_path / "in", [rows[:30], rows[30:]]), buckets=1).writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = change.change_history(spark.createDataFrame(rows, S.OBSERVATIONS)).withColumn("ts_us", F.unix_micros("observed_ts"))
    cols = ["rtype", "name", "ts_us", "rcode", "prev_rcode", "is_new"]
    assert bag(spark.read.parquet(out).select(*cols)) == bag(want.select(*cols))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) == 1


def sightings(spark, folder):
    rng = random.Random(3)
    batches = [[(f"D{rng.randrange(30)}.com", "A", "NOERROR", [f"10.0.0.{rng.randrange(9)}"], 1, at(rng.randrange(10**5))) for _ in range(40)] for _ in range(11)]
    stream = files(spark, folder, batches)
    select = lambda df: df.select(F.col("name").alias("domain"), F.explode("answers").alias("ip"), F.lit("A").alias("edge_type"), F.col("observed_ts").alias("seen_ts"))
    return select(stream), select(spark.read.schema(S.OBSERVATIONS).parquet(str(folder)))


def test_merged_tables_equal_the_batch_and_survive_replays(spark, tmp_path):
    stream, batch = sightings(spark, tmp_path / "in")
    out = str(tmp_path / "out")
    jobs.merge_entities(stream, out, str(tmp_path / "check"), compact_every=3)
    for got, want in ((jobs.merged_nodes(spark, out), jobs.entity_nodes(batch)), (jobs.merged_edges(spark, out), jobs.entity_edges(batch))):
        assert bag(got.select(*want.columns)) == bag(want)
    found = sinks._folders(spark, f"{out}/edges")
    assert found["base"] == [5, 8] and found["run"] == [3, 4, 5, 6, 7, 8, 9, 10]
    assert sinks._parts(spark, f"{out}/edges") == [f"{out}/edges/base=8", f"{out}/edges/run=9", f"{out}/edges/run=10"]
    # The whole stream again, without its checkpoint: every batch runs twice and nothing changes.
    before = bag(jobs.merged_edges(spark, out))
    jobs.merge_entities(stream, out, str(tmp_path / "check2"), compact_every=3)
    assert bag(jobs.merged_edges(spark, out)) == before
    # A batch that died before it finished its run leaves a folder without a mark, which nobody reads.
    (tmp_path / "out" / "edges" / "run=11").mkdir()
    assert bag(jobs.merged_edges(spark, out)) == before


def test_merged_table_of_nothing(spark, tmp_path):
    assert jobs.merged_nodes(spark, str(tmp_path / "none")).collect() == []


def test_an_arrival_is_one_trigger_of_many_files(spark, tmp_path, monkeypatch):
    from workload import q_streams

    names = [(i, f"n{i % 40}.com", "A", "NOERROR", "1.1.1.1", 60, START.replace(tzinfo=None) + timedelta(hours=i if i < 90 else 700)) for i in range(100)]
    obs = spark.createDataFrame(names, "event_id long, name string, rtype string, rcode string, answers_txt string, ttl int, observed_ts timestamp_ntz")
    monkeypatch.setattr(q_streams, "load", lambda *_: obs)
    monkeypatch.setattr(q_streams, "shared_dir", lambda _, purpose: f"{tmp_path}/{purpose}")
    monkeypatch.setattr(q_streams, "_FILE_ROWS", 4, raising=False)
    stream = q_streams._disordered(spark, "", "in")
    assert len(list((tmp_path / "in" / "in").glob("part-*.parquet"))) == 8 * 4 + 1  # also where an arrival has few rows or none
    times = []
    sinks.each_batch(stream, lambda batch, n: times.append([r.observed_ts for r in batch.collect()]), f"{tmp_path}/c")
    assert len(times) == 9 and sum(map(len, times)) == 101 and [] in times
    full = [t for t in times[:8] if t]
    assert all(min(later) > max(t) - timedelta(days=2) for t, later in zip(full, full[1:]))
