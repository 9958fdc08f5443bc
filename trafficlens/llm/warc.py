"""WARC records in ZIP-packaged archives: writer, and a reader by byte ranges.

Each task writes its pages as archives of about ``ARCHIVE_BYTES``: a ZIP
container with two stored members, ``archive/data.warc.gz`` (one gzip member a
record) and ``indexes/index.cdxj`` (one JSON line a record with its offset and
length). The reader parses the central directory, ZIP64 records included,
locates both members and reads every record by its range; nothing is extracted.

Equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the record of
the smallest ``page_id`` is a response, the others revisit it (same payload
digest, HTTP head with the full length, no body). The groups are aggregated
map-side to one row a digest; only groups of several pages join back.

Archives go to the folder given, which executors and driver share, through
``pyarrow.fs`` (local or mounted folders, HDFS, object stores). A file's name
carries the task attempt and only files in the written manifest are read, so a
lost executor leaves no wrong archive behind.

Defined cases: a null html is an empty payload; a null ``page_id`` is written
without an id and never referred to; repeated rows of one ``page_id`` are all
responses if it is the smallest of its payload; null urls are written empty.
Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.llm import zip_archive
from trafficlens.llm.tables import Scratch

MIN_REVISIT = 100
ARCHIVE_BYTES = 16 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of ``refers_to`` without the body."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record: id, type, payload (None for a revisit), length, digest, refers_to."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[:int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    lengths = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    page = lambda name: int(fields[name][10:-1]) if fields.get(name, "")[10:-1] else None
    revisit = fields["warc-type"] == "revisit"
    return {"page_id": page("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "payload": None if revisit else body, "http_length": lengths[0] if lengths else len(body),
            "stated_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
            "refers_to": page("warc-refers-to") if revisit else None}


def open_fs(path: str):
    """File system and path of a folder or file, by its URI. The archives are written
    and range-read through Arrow's file systems (file, hdfs, s3, gs, abfs); a scheme that
    only Hadoop knows, such as s3a, is an error."""
    try:
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
        raise ValueError(f"archives cannot be kept in {path}: set spark.checkpoint.dir to a folder whose scheme "
                         f"Arrow's file systems know ({error})") from error


def with_revisits(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages with ``payload`` and ``digest``; and per digest of several pages the
    ``original`` (smallest page)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = (rows.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull())
             .groupBy("digest").agg(F.min("page_id").alias("original"), F.max("page_id").alias("last"))
             .where(F.col("original") < F.col("last")).select("digest", "original"))
    return rows, first


def write_archives(pages: DataFrame, folder: str, first: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; returns the manifest plan (``path, records``). Evaluate it once."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(folder)
        fs.create_dir(base, recursive=True)
        task = TaskContext.get()
        parts: list[bytes] = []
        index: list[str] = []
        size = written = 0

        def flush() -> pa.RecordBatch:
            nonlocal parts, index, size, written
            name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{written:04d}.wacz"
            data = zip_archive.write_stored([(DATA, b"".join(parts)), (INDEX, "".join(index).encode())], zip64=True)
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            done = pa.RecordBatch.from_pydict({"path": pa.array([f"{folder}/{name}"]),
                                               "records": pa.array([len(index)], pa.int64())})
            parts, index, size, written = [], [], 0, written + 1
            return done

        for batch in batches:
            for row in batch.to_pylist():
                same = row["original"] is None or row["original"] == row["page_id"] or row["page_id"] is None
                raw = gzip.compress(record(row["page_id"], row["url"], row["payload"], row["digest"],
                                           None if same else row["original"]), 4, mtime=0)
                index.append(json.dumps({"offset": size, "length": len(raw), "id": row["page_id"],
                                         "digest": row["digest"]}) + "\n")
                parts.append(raw)
                size += len(raw)
                if size >= archive_bytes:
                    yield flush()
        if index:
            yield flush()

    return pages.join(first, "digest", "left").mapInArrow(write, "path string, records long")


def archive_ranges(file) -> Iterator[tuple[int, int]]:
    """Offset and length of every record of an archive, by its index; without an
    index member the records are found by walking the gzip members."""
    members = {m.name: m for m in zip_archive.read_directory(file)}
    for name, member in members.items():
        if not name.endswith((".warc.gz", ".warc")):
            continue
        start = zip_archive.data_start(file, member)
        if INDEX in members and name == DATA:
            at = zip_archive.data_start(file, members[INDEX])
            for line in file.read_at(members[INDEX].size, at).splitlines():
                entry = json.loads(line)
                yield start + entry["offset"], entry["length"]
        else:
            yield from _walk(file, start, member.size)


def _walk(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of the gzip members of a stored member."""


    at, end = start, start + size
    while at < end:
        unpack, n = zlib.decompressobj(31), 0
        while not unpack.eof and at + n < end:
            part = file.read_at(min(65536, end - at - n), at + n)
            unpack.decompress(part)
            n += len(part) - len(unpack.unused_data)
        yield at, n
        at += n


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives in ``path``: ``page_id, url, record_type,
    payload, http_length, stated_digest, refers_to``. One archive is one bounded unit of work."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload", pa.binary()), ("http_length", pa.int64()), ("stated_digest", pa.string()),
                        ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = open_fs(path)
                with fs.open_input_file(name) as file:
                    rows, size = [], 0
                    for offset, length in archive_ranges(file):
                        rows.append(parse_record(gzip.decompress(file.read_at(length, offset))))
                        size += len(rows[-1]["payload"] or b"")
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.select("path").mapInArrow(
        read, "page_id long, url string, record_type string, payload binary, http_length long, "
              "stated_digest string, refers_to long")


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives, read them back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to`` of every record."""
    pages = pages.select("page_id", "url", "html")
    scratch = Scratch(pages.sparkSession, "warc")
    rows, first = with_revisits(pages)
    first = scratch.keep(first, "originals")
    manifest = scratch.keep(write_archives(rows, scratch.path("archives"), first), "manifest")
    spark = pages.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    records = read_archives(manifest.repartition(max(1, min(manifest.count(), parts)), "path"))
    full = F.col("record_type") == "response"
    return scratch.result(records.select(
        "page_id", F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http_length"))
        .alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type", "refers_to"))


def warc_sql(source: str = "pages") -> str:
    """DuckDB SQL for the rows of ``warc_round_trip``."""
    return f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM {source}),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""
