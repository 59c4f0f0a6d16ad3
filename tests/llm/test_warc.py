"""WARC: round trips, records owned by byte ranges of every size, false magic, edge rows."""

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from zonelens.llm import queries, warc


def plain(spark, tmp_path, rows, schema="page_id long, url string, html string", **options):
    pages = spark.createDataFrame(rows, schema)
    manifest = warc.write_archives(pages, str(tmp_path / "out"), **options)
    return manifest, warc.read_archives(manifest, range_bytes=300)


def test_round_trip_and_revisits(spark, tmp_path):
    long, other = "x" * 150 + "é\r\n\r\n", "y" * 100
    rows = [
        (5, "http://a/1", long), (3, "http://a/2 \n", long), (9, None, long), (3, "http://a/2", long), (None, "u", long),
        (7, "u", "short"), (6, "u", "short"), (8, "u", None), (10, "u", ""), (11, "u", other),
    ]
    manifest, read = plain(spark, tmp_path, rows, file_bytes=400)
    got = read.withColumn("page", warc.page_ids(spark, LongType())(F.col("record_id"))).collect()
    assert sum(r["records"] for r in manifest.collect()) == len(rows) == len(got)
    assert manifest.count() > 1
    want = sorted(
        (str(p), hashlib.sha256((h or "").encode()).hexdigest(), len((h or "").encode()), "response" if h != long or p == 3 else "revisit") for p, _, h in rows
    )
    assert sorted((str(r["page"]), r["payload_digest"], r["payload_bytes"], r["record_type"]) for r in got) == want
    for r in got:
        if r["record_type"] == "revisit":
            assert r["refers_to"] == "urn:page:3" and r["payload"] == b""
        else:
            assert r["refers_to"] is None and hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]
    assert {r["target_uri"] for r in got if r["page"] == 3} == {"http://a/2%20%0A", "http://a/2"}
    assert [r["target_uri"] for r in got if r["page"] == 9] == [None]
    with gzip.open(manifest.first()["path"]) as f:
        assert f.read().startswith(b"WARC/1.1\r\n")


class Source(io.BytesIO):
    def read_at(self, n, at):
        self.seek(at)
        return self.read(n)


def test_every_range_size_gives_every_record_once(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(warc, "BLOCK", 37)
    members, offsets, at = [], [], 0
    for i in range(12):
        payload = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 90)))
        if i % 3 == 0:  # stored bytes that look like the start of a member
            payload += warc.MAGIC + rng.randbytes(20) + gzip.compress(b"WARC of no kind") + warc.MAGIC
        member = warc.record("response", f"urn:page:{i}", "u", "d", len(payload), payload, None)
        offsets.append(at)
        members.append(member)
        at += len(member)
        if i == 5:
            members.append(b"garbage" + warc.MAGIC + b"\x00\x00")
            at += len(members[-1])
    data = b"".join(members)
    for length in [1, 2, 7, 50, 133, 1000, len(data)]:
        got = [o for s in range(0, len(data), length) for o, _, _ in warc.records_in(Source(data), len(data), s, min(s + length, len(data)))]
        assert got == offsets, length


def test_stored_member_hides_a_whole_record():
    """A range that begins inside a stored payload must not be fooled by bytes that are no record."""
    inner = warc.MAGIC + bytes(40)
    member = warc.record("response", "urn:page:1", None, "d", len(inner), inner, None)
    assert [o for o, _, _ in warc.records_in(Source(member[:-5]), len(member) - 5, 0, len(member))] == []
    assert [o for o, _, _ in warc.records_in(Source(b"\x1f\x8b" + member), len(member) + 2, 0, len(member))] == [2]


def test_headers_of_any_length(rows):
    import random

    rng = random.Random(5)
    url = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=3_000_000))
    pages = rows("page_id long, url string, html string", (1, "u", "one"), (2, url, "two"), (3, "u", "three"))
    assert sorted((warc.page_of(r.record_id), len(r.target_uri)) for r in warc.round_trip(pages).collect()) == [("1", 1), ("2", 3_000_000), ("3", 1)]


def test_files_that_lost_records_are_told(rows):
    manifest = rows("path string, bytes long, records long", ("a", 1, 2), ("b", 1, 1), ("c", 1, 3))
    read = rows("path string", ("a",), ("a",), ("b",), ("b",))
    assert sorted(map(tuple, warc.differing(manifest, read).collect())) == [("b", 1, 2), ("c", 3, 0)]


def test_ids():
    assert warc.page_of(warc.id_of("a b/é", "")) == "a b/é" and warc.page_of(warc.id_of(None, "x")) is None and warc.page_of(None) is None


def test_files_listed_by_spark(spark, tmp_path):
    _, read = plain(spark, tmp_path, [(i, "u", f"page {i}") for i in range(20)])
    n = read.count()
    listed = warc.archive_files(spark, f"{tmp_path}/out/*.warc.gz")
    assert n == 20 == warc.read_archives(listed).count()


def test_empty_table_and_other_columns(spark, tmp_path):
    manifest, read = plain(spark, tmp_path, [])
    assert manifest.count() == 0 and read.count() == 0
    _, read = plain(spark, tmp_path, [(1, "u", "h", "z", 4)], "page_id long, url string, html string, digest string, size int")
    assert read.count() == 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_keeps_types(spark, sf):
    got = queries.op3_warc(spark, sf)
    assert dict(got.dtypes) == {
        "page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint",
    }
