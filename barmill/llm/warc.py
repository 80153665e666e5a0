"""Web archives (WARC 1.1) compressed by Zstandard, one frame per record.

An archive starts with a skippable frame that holds its dictionary; then comes a frame for each
record. Spark's text writer puts the frames into files, so they are committed by task and may lie
in any store: a frame is a line, and the line separator is itself an empty skippable frame, which
every reader passes over. Equal payloads are stored once; the other pages revisit the first.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.llm.common import prepare, table
from barmill.plans.workspace import work_dir

#: Fixed values of the formats.
ZSTD_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
SKIPPABLE_MASK = 0xFFFFFFF0
VERSION = b"WARC/1.1"

#: An empty skippable frame in ASCII characters.
SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode("ascii")
#: Records of an archive, which a reader holds whole (2 GB at most); the next begins with a dictionary of its own.
ARCHIVE_RECORDS = 10_000
#: The dictionary of an archive is made from so many of its first records, cut to so many bytes.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 128, 1 << 13, 1 << 15
LEVEL = 3
#: Least payload that is replaced by a revisit.
LEAST_REVISIT_BYTES = 0
DATE = "2025-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _clean(value: str) -> str:
    """A header value on one line: blanks and control characters escaped."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with the page, or a revisit with its HTTP header alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", _clean(url)))
    if revisit:
        lines.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        lines.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head = b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in lines)])
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves if they are too few to train on."""
    samples = [s[:SAMPLE_BYTES] for s in samples]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def archive_frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive; the first comes with the dictionary frame before it."""
    first = list(islice(records, SAMPLE_RECORDS))
    if not first:
        return
    content = _dictionary(first)
    shared = zstandard.ZstdCompressionDict(content)
    shared.precompute_compress(level=LEVEL)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(content)
    start = struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
    for r in chain(first, records):
        yield start + compressor.compress(r)
        start = b""


def _frame_rows(archive_records: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in batch.to_pylist():
                    payload = row["payload"]
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode("ascii")
                    yield record(row["page_id"], row["url"], payload, digest, row["refers_to"], row["revisit"])

        stream = records()

        def frames() -> Iterator[bytes]:
            while True:  # the writer begins another file after as many
                archive = archive_frames(islice(stream, archive_records))
                first = next(archive, None)
                if first is None:
                    return
                yield first
                yield from archive

        held: list[bytes] = []
        size = 0
        for frame in frames():
            held.append(frame)
            size += len(frame)
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])

    return rows


def write_archives(
    pages: DataFrame,
    path: str,
    least_revisit_bytes: int = LEAST_REVISIT_BYTES,
    archive_records: int = ARCHIVE_RECORDS,
) -> None:
    """Write a record for every row of ``page_id``, ``url``, ``html``.

    Of rows with equal payloads of at least ``least_revisit_bytes``, those with the least page_id
    are responses (more than one only if rows repeat that id), the others revisit it. A null html
    is an empty payload, a null url leaves its header out, a null page_id comes last. Other columns
    are not read. An empty table gives an empty folder. A task writes an archive for each
    ``archive_records`` of its records; equal payloads are split over tasks by adaptive execution, as the
    sides of any join.
    """
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint"),
        F.col("url").cast("string"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    firsts = (
        rows.where(F.octet_length("payload") >= least_revisit_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .select("digest", "refers_to")
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    joined = rows.join(firsts, "digest", "left").withColumn("revisit", revisit)
    frames = joined.mapInArrow(_frame_rows(archive_records), "frame binary")
    lines = frames.select(F.col("frame").cast("string").alias("value"))
    writer = lines.write.mode("overwrite").option("lineSep", SEPARATOR)
    writer.option("maxRecordsPerFile", archive_records).text(path)


def frames_of(data: bytes) -> Iterator[tuple[int, int, int]]:
    """Magic number, start and end of each frame, told from frame and block headers alone."""
    at = 0
    while at < len(data):
        if len(data) - at < 8:
            raise ValueError(f"archive: {len(data) - at} bytes left over at {at}")
        (magic,) = struct.unpack_from("<I", data, at)
        if magic & SKIPPABLE_MASK == SKIPPABLE_MAGIC:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == ZSTD_MAGIC:
            head = data[at : at + 18]
            end = at + zstandard.frame_header_size(head)
            last = False
            while not last:
                block = int.from_bytes(data[end : end + 3], "little")
                last, kind = bool(block & 1), block >> 1 & 3
                if kind == 3 or end + 3 > len(data):
                    raise ValueError(f"archive: bad block at {end}")
                end += 3 + (1 if kind == 1 else block >> 3)
            end += 4 * zstandard.get_frame_parameters(head).has_checksum
        else:
            raise ValueError(f"archive: no frame at {at}")
        if end > len(data):
            raise ValueError(f"archive: frame at {at} is cut off")
        yield magic, at, end
        at = end


def parse_record(data: bytes) -> dict:
    """Headers of a record, checked: version, lengths, digests of the block and of a whole payload."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError("record: no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"record: bad header {line[:80]!r}")
        headers[name.decode().lower()] = value.strip().decode()
    length = int(headers["content-length"])
    block = rest[:length]
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("record: content length does not fit")
    if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("record: block digest does not fit")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.decode().lower().split(": ", 1) for line in http.split(b"\r\n")[1:])
    size, kind = int(fields["content-length"]), headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("record: payload does not fit its length or digest")

    def page(name: str) -> int | None:
        value = headers.get(name, "<urn:page:none>")[len("<urn:page:") : -1]
        return None if value == "none" else int(value)

    return {
        "page_id": page("warc-record-id"),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
        "payload": payload if kind == "response" else None,
    }


def records_of(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    reader = zstandard.ZstdDecompressor()
    for magic, start, end in frames_of(data):
        if magic == DICTIONARY_MAGIC:
            content = data[start + 8 : end]
            if content[:4] == struct.pack("<I", ZSTD_MAGIC):
                content = zstandard.ZstdDecompressor().decompress(content)
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        elif magic == ZSTD_MAGIC:
            yield parse_record(reader.decompress(data[start:end]))


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _record_rows(names: list[str]):
    schema = pa.schema([_RECORD.field(n) for n in names])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["content"]:
                held = []
                for found in records_of(data.as_py()):
                    held.append({n: found[n] for n in names})
                    if len(held) == 1000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema)

    return rows


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives under ``path``; a revisit has no payload of its own.

    Frames, headers, lengths and digests are checked; a fault stops the job.
    """
    prepare(spark)
    kinds = {"page_id": "bigint", "payload_bytes": "bigint", "refers_to": "bigint", "payload": "binary"}
    names = [n for n in _RECORD.names if payloads or n != "payload"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_record_rows(names), ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names))


def op6_warc(spark, sf_dir):
    path = work_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).drop("url")


OP6_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least
  FROM pages),
bits AS (
  SELECT page_id, payload, least, unhex(sha1(payload)) AS digest FROM p),
digits AS (
  SELECT page_id, payload, least,
         list_reduce(
           list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + CAST(('0b' || substr(bitstring, 1 + 5 * i, 5))  AS INTEGER), 1)),
           lambda a, b: a || b) AS text
  FROM (SELECT *, CAST(digest AS BIT)::VARCHAR AS bitstring FROM bits))
SELECT page_id, strlen(payload) AS payload_bytes, text AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
FROM digits
"""
