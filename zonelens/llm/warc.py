"""WARC archives: a writer with revisit records, and a splittable reader.

Every record is a gzip member of its own.  The writer gives each task its files below a folder and returns a manifest
of them; only files of the manifest count, so a task that is run again leaves nothing behind that would be read.

The reader cuts files into byte ranges.  A task looks for gzip magic in its range, tests every candidate by decoding
the start of the member as a WARC header, and owns the records that *start* inside its range, reading past the end of
the range where the last one does.  From a record it goes on to the byte after it, and looks for magic again only
where no member begins.

Files are opened through ``pyarrow.fs``, so folders may be local mounts or object stores that it knows.

Defined results: a null html is an empty payload; payloads below ``min_revisit`` bytes are always responses; rows with
the least id of their payload are all responses where that id repeats; a null id never is the least one, unless all
are null; a null url gives a record without target; control characters of a url are percent-encoded; an empty table
gives no files and no records; other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelens.llm.common import pick, ship, stage
from zonelens.session import shared_dir

MAGIC = b"\x1f\x8b\x08"
LEVEL = 4
# A file is closed when it has this many bytes; a range is this long.
FILE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
BLOCK = 1 << 18
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT = 100
# Fixed value: the profile that the format names for revisits of equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a path without scheme is on a mount that all executors share."""
    plain = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), plain) if plain.startswith("/") else fs.FileSystem.from_uri(path)


def record(kind: str, record_id: str, uri: str | None, digest: str, size: int, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member.  A revisit keeps the length of the full payload in its HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), uri))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + pack.flush()


def id_of(page: str | None, name: str) -> str:
    """Record id of a page; pages without an id get a random-looking one made from where they are written."""
    return f"urn:page:{quote(page, safe='')}" if page is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}"


def page_of(record_id: str | None) -> str | None:
    return unquote(record_id[len("urn:page:") :]) if record_id and record_id.startswith("urn:page:") else None


def with_revisits(pages: DataFrame, page_id: str, url: str, html: str, min_revisit: int) -> DataFrame:
    """page, url, payload, size, digest, first: the id of the response that a row revisits, or null."""
    rows = pick(pages, page=page_id, url=url, html=html).select(
        "page", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))
    long = rows.filter(F.col("size") >= min_revisit)
    copies = long.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(copies, "digest", "left")
    own = F.col("first").isNull() | F.col("page").eqNullSafe(F.col("first"))
    return joined.select("page", "url", "payload", "size", "digest", F.when(~own, F.col("first")).alias("first"))


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write one record per row below ``folder``; the manifest (path, bytes, records) is written and returned."""
    ship(pages.sparkSession)
    rows = with_revisits(pages, page_id, url, html, min_revisit)
    rows = rows.select(F.col("page").cast("string"), "url", "payload", "size", "digest", F.col("first").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        out, name, size, n = None, "", 0, 0
        done = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page, uri, payload, length, digest, first = row
                if out is None:
                    name, size, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(name, compression=None)
                own = id_of(page, f"{name}/{n}")
                kind = "response" if first is None else "revisit"
                member = record(kind, own, uri, digest, length, payload, None if first is None else id_of(first, ""))
                out.write(member)
                size += len(member)
                n += 1
                if size >= file_bytes:
                    out.close()
                    done.append((name, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, n))
        if not done:
            return
        prefix = folder[: folder.rfind(root)] if folder.endswith(root) else ""
        columns = [pa.array([prefix + d[0] for d in done], pa.string()), *(pa.array([d[k] for d in done], pa.int64()) for k in (1, 2))]
        yield pa.RecordBatch.from_arrays(columns, ["path", "bytes", "records"])

    return stage(rows.mapInArrow(run, "path string, bytes long, records long"), "warc-manifest")


class Window:
    """Bytes of a file from any offset on, read block by block; only the block at hand is kept."""

    def __init__(self, source, size: int) -> None:
        self.source, self.size = source, size
        self.start, self.data = 0, b""

    def at(self, offset: int, length: int = 1) -> bytes:
        """At least ``length`` bytes from ``offset`` on, fewer at the end of the file."""
        if offset < self.start or offset + length > self.start + len(self.data):
            self.start = offset
            self.data = self.source.read_at(min(max(length, BLOCK), max(0, self.size - offset)), offset)
        return self.data[offset - self.start :]


def header_of(data: bytes) -> dict[str, str] | None:
    """Header fields if the bytes begin a record, else None."""
    if not data.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n")):
        return None
    fields = {}
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields if "warc-type" in fields and "content-length" in fields else None


def member_at(window: Window, offset: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header fields, block and end of the record whose gzip member begins at ``offset``; None if none does."""
    if window.at(offset, len(MAGIC))[: len(MAGIC)] != MAGIC:
        return None
    unpack = zlib.decompressobj(31)
    parts: list[bytes] = []
    head = bytearray()
    fields = None
    at = offset
    try:
        while not unpack.eof:
            data = window.at(at)
            if not data:
                return None  # the file ends inside the member
            data = data[:BLOCK]
            got = unpack.decompress(data)
            at += len(data)
            if fields is None:
                seen = max(0, len(head) - 3)
                head += got
                cut = head.find(b"\r\n\r\n", seen)
                if cut < 0:
                    if not b"WARC/1.".startswith(head[:7]):
                        return None
                    continue  # a header has no greatest length
                fields = header_of(bytes(head[: cut + 2]))
                if fields is None:
                    return None
                got = bytes(head[cut + 4 :])
            parts.append(got)
    except zlib.error:
        return None
    if fields is None or not fields["content-length"].isdecimal():
        return None
    block = b"".join(parts)
    length = int(fields["content-length"])
    return (fields, block[:length], at - len(unpack.unused_data)) if len(block) >= length else None


def records_in(source, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of every record that starts in [start, end)."""
    window = Window(source, size)
    at = start
    while at < end:
        found = member_at(window, at)
        if found is not None:
            fields, block, after = found
            yield at, fields, block
            at = after
            continue
        # Look for the next magic; the last two bytes of a block may begin one.
        at += 1
        while at < end:
            data = window.at(at, len(MAGIC))
            place = data.find(MAGIC)
            if place >= 0:
                at += place
                break
            at += max(1, len(data) - len(MAGIC) + 1)


READ = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def parsed(path: str, offset: int, fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of :data:`READ`.  Length and digest of a revisit are what its headers say of the full payload."""
    kind = fields["warc-type"].lower()
    bare = lambda x: x[1:-1] if x and x.startswith("<") and x.endswith(">") else x
    head, _, payload = block.partition(b"\r\n\r\n") if "application/http" in fields.get("content-type", "") else (b"", b"", block)
    if kind == "revisit":
        said = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        size, digest = int(said[1]) if said else None, fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    ids = bare(fields.get("warc-record-id")), fields.get("warc-target-uri"), bare(fields.get("warc-refers-to"))
    return (path, offset, kind, *ids, size, digest, payload if with_payload else None)


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """All records of the files (path, bytes), one row each."""
    ship(files.sparkSession)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.filter("bytes > 0").select("path", F.col("bytes"), starts.alias("start"))
    # Ranges are a few numbers each; spread them so that every task has few.
    total = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    ranges = ranges.repartition(int(min(total, 100_000)), "path", "start")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, name = opened(path)
                rows, held = [], 0
                with system.open_input_file(name) as source:
                    for offset, fields, block in records_in(source, size, start, min(start + range_bytes, size)):
                        rows.append(parsed(path, offset, fields, block, with_payload))
                        held += len(block) if with_payload else 1000
                        if held >= 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:  # an empty batch would end the task's output
                    yield batch_of(rows)

    return ranges.mapInArrow(run, READ)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, READ.names)


def archive_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, bytes of existing archives, listed by Spark without reading them."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.col("length").alias("bytes"))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write archives to a fresh shared folder and read their records back, without payloads.

    An error if the records read from a file are not as many as were written to it.
    """
    folder = shared_dir(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, page_id, url, html, min_revisit)
    read = stage(read_archives(manifest, with_payload=False), "warc-read")
    missing = differing(manifest, read).limit(3).collect()
    if missing:
        raise ValueError(f"records written and read differ: {missing}")
    return read


def differing(manifest: DataFrame, read: DataFrame) -> DataFrame:
    """path, records, found: the files of a manifest from which another number of records was read."""
    found = read.groupBy("path").agg(F.count("*").alias("found"))
    both = manifest.join(found, "path", "left").select("path", "records", F.coalesce("found", F.lit(0)).alias("found"))
    return both.filter(F.col("records") != F.col("found"))


def page_ids(spark: SparkSession, kind: T.DataType):
    """A column function: record id -> page id of the given type; null for records of pages without an id."""
    ship(spark)

    @F.pandas_udf("string")
    def pages(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield pd.Series([page_of(x) for x in ids], dtype=object)

    return lambda c: pages(c).cast(kind)
