import base64
import hashlib

import pytest
import zstandard
from cases import rows_of

from barmill.llm import warc as ops
from barmill.plans.workspace import work_dir

PAGES = [
    (5, "http://a.example/x", "<html>one</html>"),
    (3, "http://a.example/y y\r\nWARC-Type: forged", "<html>one</html>"),
    (9, None, None),
    (7, "http://b.example/é%20", ""),
    (None, "http://c.example", "<html>one</html>"),
    (11, "http://d.example", "naïve 你好 🙂\r\n\r\nP*M\x18\0\0\0\0" * 3),
    (12, "http://d.example", "x" * 3_000_000),
    (12, "http://d.example", "x" * 3_000_000),
    (-1, "http://e.example", "WARC/1.1\r\n\r\n"),
]
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages(spark, rows):
    full = [(*r, "z", "z") for r in rows]
    return spark.createDataFrame(full, "page_id bigint, url string, html string, digest string, refers_to string")


def expected(rows, least=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same, default=i)
        revisit = len(data) >= least and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    path = work_dir(spark, "warc_test")
    ops.write_archives(pages(spark, PAGES), path, least)
    read = ops.read_archives(spark, path)
    assert sorted(rows_of(read, *COLUMNS), key=str) == expected(PAGES, least)
    got = {(i, bytes(p)) for i, p in rows_of(read.where("record_type = 'response'"), "page_id", "payload")}
    assert got == {(i, (h or "").encode()) for i, _, h in PAGES if (i, "response") in {(e[0], e[3]) for e in expected(PAGES, least)}}


def test_no_pages(spark):
    path = work_dir(spark, "warc_test")
    ops.write_archives(pages(spark, []), path)
    assert ops.read_archives(spark, path).collect() == []


def test_archives_are_of_bounded_size(spark):
    """Each file has a dictionary of its own at its head and no more records than were asked for."""
    rows = [(i, f"http://x.example/{i}", f"<p>page {i % 90}</p>" * 20) for i in range(330)]
    path = work_dir(spark, "warc_test")
    ops.write_archives(pages(spark, rows), path, archive_records=40)
    sizes = []
    for row in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        magics = [m for m, _, _ in ops.frames_of(bytes(row.content))]
        assert magics[0] == ops.DICTIONARY_MAGIC and magics.count(ops.DICTIONARY_MAGIC) == 1
        sizes.append(magics.count(ops.ZSTD_MAGIC))
    assert sum(sizes) == 330 and max(sizes) <= 40 and len(sizes) >= 9
    assert sorted(rows_of(ops.read_archives(spark, path), *COLUMNS), key=str) == expected(rows)


def archive(n=300):
    records = (ops.record(i, f"http://x.example/{i}", b"<p>page</p>" * (i % 9), ops.base32_sha1(b"<p>page</p>" * (i % 9)), None, False) for i in range(n))
    return ops.SEPARATOR.encode().join(ops.archive_frames(records))


def test_frames_and_dictionary():
    data = archive()
    magic, start, end = next(ops.frames_of(data))
    assert magic == ops.DICTIONARY_MAGIC and start == 0
    kinds = [m for m, _, _ in ops.frames_of(data)]
    assert kinds.count(ops.ZSTD_MAGIC) == 300 and kinds[2:].count(ops.SKIPPABLE_MAGIC) == 299
    assert [r["page_id"] for r in ops.records_of(data)] == list(range(300))
    # Records cannot be read without the dictionary.
    at = next((a, b) for m, a, b in ops.frames_of(data) if m == ops.ZSTD_MAGIC)
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(data[slice(*at)])


def test_faults_stop_the_reader():
    data = archive(20)
    for broken in (data[:-3], b"junk" + data, data[:60] + data[70:]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(ops.records_of(broken))
    good = ops.record(1, None, b"abc", ops.base32_sha1(b"abc"), None, False)
    for old, new in ((b"abc", b"abd"), (b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: 3", b"Content-Length: 4"), (b"\r\n\r\nHTTP", b"\r\nHTTP")):
        with pytest.raises((ValueError, KeyError)):
            ops.parse_record(good.replace(old, new))
