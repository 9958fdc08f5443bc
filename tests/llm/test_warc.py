from __future__ import annotations

import gzip
import hashlib
import io
import struct
import zipfile

import pytest

from trafficlens.llm import warc
from trafficlens.llm import zip_archive as za

SCHEMA = "page_id long, url string, html string, payload string, digest string, record_type string"


class Memory:
    def __init__(self, data):
        self.data, self.reads = data, 0

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.reads += n
        return self.data[at:at + n]


def members(data):
    file = Memory(data)
    return [(m.name, file.read_at(m.size, za.data_start(file, m))) for m in za.read_directory(file)]


@pytest.mark.parametrize("zip64", [False, True])
def test_containers_read_by_both_readers(zip64):
    parts = [("a.txt", b"x" * 1000), ("dir/é.bin", b""), ("b", bytes(range(256)))]
    data = za.write_stored(parts, zip64)
    assert members(data) == parts
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == parts


def test_library_containers_with_comment_and_many_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):  # more than 65535: the directory needs its ZIP64 record
            z.writestr(f"{i}", str(i))
        z.comment = b"PK\x05\x06 not the end" * 20
    got = members(out.getvalue())
    assert len(got) == 66_000 and got[65_999] == ("65999", b"65999")


def test_broken_containers_raise():
    good = za.write_stored([("a", b"1")], True)
    for bad in (b"", b"PK", good[:-1], good[:40], good.replace(b"PK\x06\x07", b"PK\x00\x00")):
        with pytest.raises(ValueError):
            za.read_directory(Memory(bad))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "1" * 100)
    file = Memory(packed.getvalue())
    with pytest.raises(ValueError):
        za.data_start(file, za.read_directory(file)[0])


def test_records_are_found_with_and_without_an_index():
    records = [warc.record(i, f"http://h/{i}", b"p" * i * 900, hashlib.sha256(b"p").hexdigest(), None) for i in range(5)]
    packed = [gzip.compress(r) for r in records]
    plain = Memory(za.write_stored([("archive/other.warc.gz", b"".join(packed))]))
    ranges = list(warc.archive_ranges(plain))
    assert [gzip.decompress(plain.data[a:a + n]) for a, n in ranges] == records
    assert [n for _, n in ranges] == [len(p) for p in packed]


def expected(rows):
    pages = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in pages:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in pages:
        again = len(p) >= 100 and i is not None and first[p] < i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response",
                    first[p] if again else None))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://h{i % 3}.example/{i}", ["é" * 60, "short", "<p>x</p>" * 300, None, ""][i % 5])
            for i in range(60)]
    rows += [(70, None, "Z" * 99), (71, "u\r\nWARC-Type: revisit", "Z" * 100), (72, "u", "Z" * 100), (72, "u", "Z" * 100),
             (None, "u", "Z" * 100), (80, "u", "y" * 3_000_000), (81, "u", "\r\n\r\n" * 50)]
    df = spark.createDataFrame([r + ("a", "b", "c") for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in warc.warc_round_trip(df).collect()), key=str)
    assert got == expected(rows)
    assert warc.warc_round_trip(df.limit(0)).collect() == []


def test_archives_are_valid_containers_and_payloads_come_back(spark, scratch):
    rows = [(i, "http://h.example/", f"<p>{i}</p>" * 40) for i in range(20)]
    folder = scratch("archives")
    pages, first = warc.with_revisits(spark.createDataFrame(rows, "page_id long, url string, html string"))
    manifest = warc.write_archives(pages, folder, first).collect()
    assert sum(r["records"] for r in manifest) == 20
    fs, path = warc.open_fs(manifest[0]["path"])
    with fs.open_input_file(path) as f:
        data = f.read()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.namelist() == [warc.DATA, warc.INDEX]
    assert struct.pack("<I", 0x06064B50) in data
    back = warc.read_archives(spark.createDataFrame([(r["path"],) for r in manifest], "path string")).collect()
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in back) == [(i, h) for i, _, h in rows]


def test_a_scheme_that_arrow_does_not_know_is_a_clear_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        warc.open_fs("s3a://bucket/folder")
