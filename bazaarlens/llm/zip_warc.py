"""WARC records in ZIP-packaged archives, read back by ranges.

An archive is a ZIP file of stored members: ``archive/data.warc.gz`` with the records, each a gzip member of its own, and
``indexes/index.cdx`` with one line (page id, offset, length) per record. ``ZipReader`` takes anything that can seek and read: it finds the end record,
the ZIP64 end record where there is one, and the central directory, and reads ranges of stored members in place;
nothing is extracted. Spark writes each archive as a file of its own (its text writer ends a file with a line feed, which
the end record declares as the comment), and a reading task opens the file where it lies and reads the directory, the
index and then one record after the other by its range. Every second archive of a task is written with ZIP64 fields.

Which page is the response and which pages revisit it is decided before writing, by digests: (SHA-256, length) of a
payload is the group key. Payloads of 1000 bytes and more move once, to meet the digests that repeat; shorter ones, which
never revisit, don't move at all.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.session import prefer_skew_handling, scratch_path

LEAST_REVISIT = 1000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
LEVEL = 1  # of compression
COMMENT = b"\n"  # what the text writer puts behind an archive

# fixed values of the ZIP format: signatures and struct layouts
LOCAL, CENTRAL, END64, LOCATOR64, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x06\x06", b"PK\x06\x07", b"PK\x05\x06"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def zip_stored(members: list[tuple[str, bytes]], zip64: bool = False, comment: bytes = b"") -> bytes:
    """A ZIP file of stored members; with ``zip64`` sizes, offsets and counts stand in ZIP64 fields only."""
    out, directory = io.BytesIO(), []
    for name, body in members:
        at, key, crc = out.tell(), name.encode(), zlib.crc32(body)
        big = zip64 or len(body) >= FULL32
        extra = struct.pack("<HHQQ", 1, 16, len(body), len(body)) if big else b""
        size = FULL32 if big else len(body)
        out.write(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x800, 0, 0, 0x21, crc, size, size, len(key), len(extra)) + key + extra)
        out.write(body)
        far = zip64 or big or at >= FULL32
        extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), at) if far else b""
        size, place = (FULL32, FULL32) if far else (len(body), at)
        directory.append(
            CENTRAL
            + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 0x21, crc, size, size, len(key), len(extra), 0, 0, 0, 0, place)
            + key
            + extra
        )
    at, body, n = out.tell(), b"".join(directory), len(directory)
    out.write(body)
    if zip64 or n >= FULL16 or at + len(body) >= FULL32:
        where = out.tell()
        out.write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(body), at))
        out.write(LOCATOR64 + struct.pack("<IQI", 0, where, 1))
        n, size, at = FULL16, FULL32, FULL32
    else:
        size = len(body)
    out.write(END + struct.pack("<HHHHIIH", 0, 0, n, n, size, at, len(comment)) + comment)
    return out.getvalue()


class ZipReader:
    """The directory of a ZIP file and range reads of its stored members; ``file`` has seek and read."""

    def __init__(self, file):
        self.file = file
        self.members: dict[str, tuple[int, int]] = {}
        size = file.seek(0, io.SEEK_END)
        tail_at = max(0, size - 65_557)  # an end record and the longest comment
        tail = self._at(tail_at, size - tail_at)
        end = tail.rfind(END)
        while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
            end = tail.rfind(END, 0, end)  # those bytes can also stand in a comment
        if end < 0:
            raise ValueError("no ZIP end record")
        n, length, start = struct.unpack_from("<HII", tail, end + 10)
        if FULL16 == n or FULL32 in (length, start):
            locator = self._at(tail_at + end - 20, 20)
            if locator[:4] != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            record = self._at(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != END64:
                raise ValueError("no ZIP64 end record")
            n, length, start = struct.unpack_from("<QQQ", record, 32)
        self._directory(self._at(start, length), n)

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def _directory(self, body: bytes, n: int) -> None:
        at = 0
        for _ in range(n):
            if body[at : at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            method, packed, size, n_name, n_extra, n_comment, offset = (
                *struct.unpack_from("<H", body, at + 10),
                *struct.unpack_from("<IIHHH", body, at + 20),
                *struct.unpack_from("<I", body, at + 42),
            )
            name = body[at + 46 : at + 46 + n_name].decode()
            extra = body[at + 46 + n_name : at + 46 + n_name + n_extra]
            size, packed, offset = self._long_fields(extra, size, packed, offset)
            if method != 0 or packed != size:
                raise ValueError(f"{name} is not stored")
            self.members[name] = (offset, size)
            at += 46 + n_name + n_extra + n_comment

    @staticmethod
    def _long_fields(extra: bytes, *values: int) -> list[int]:
        """Values that are all ones stand in the ZIP64 extra field, in this order."""
        out, at = list(values), 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                place = at + 4
                for i, v in enumerate(out):
                    if v == FULL32:
                        out[i] = struct.unpack_from("<Q", extra, place)[0]
                        place += 8
            at += 4 + n
        return out

    def read(self, name: str, offset: int = 0, n: int | None = None) -> bytes:
        """A range of a stored member; the local header says where its bytes begin."""
        at, size = self.members[name]
        local = self._at(at, 30)
        if local[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        n_name, n_extra = struct.unpack_from("<HH", local, 26)
        n = size - offset if n is None else n
        if offset < 0 or n < 0 or offset + n > size:
            raise ValueError(f"range outside {name}")
        return self._at(at + 30 + n_name + n_extra + offset, n)


def warc_record(page: str, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record; a revisit keeps the HTTP header with the payload's length, and the payload's digest, but not its bytes."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    target = "".join(c for c in url if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[4:4] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if ": " in line)}


def parsed(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload bytes of one record."""
    head, rest = record.split(b"\r\n\r\n", 1)
    warc = headers(head)
    http, payload = rest[: int(warc["content-length"])].split(b"\r\n\r\n", 1)
    return warc, headers(http), payload


def with_targets(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to: pages with equal payloads of at least 1000 bytes revisit the largest page_id."""
    known = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    known = known.withColumn("size", F.octet_length("payload")).withColumn(
        "print", F.when((F.col("size") >= LEAST_REVISIT) & F.col("page_id").isNotNull(), F.sha2("payload", 256))
    )
    groups = known.where("print is not null").groupBy("print", "size").agg(F.max("page_id").alias("target"), F.count(F.lit(1)).alias("n"))
    repeated = groups.where("n > 1").drop("n", "size")
    marked = known.where("print is not null").join(repeated, "print", "left")
    revisits = F.when(F.col("target") != F.col("page_id"), F.col("target"))
    first = known.where("print is null").select("page_id", "url", "payload", F.lit(None).cast("long").alias("refers_to"))
    return marked.select("page_id", "url", "payload", revisits.alias("refers_to")).unionByName(first)


def write_archives(pages: DataFrame, path: str, archive_bytes: int = 4 << 20) -> None:
    """Archive files of about ``archive_bytes`` below ``path``; a longer page gets one of its own."""
    archives = zipped(pages, archive_bytes)
    # a text that was bytes is written as these bytes, one archive a file
    archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").option("compression", "none").text(path)


def zipped(pages: DataFrame, archive_bytes: int) -> DataFrame:
    """Archives, without the line feed that is their comment."""

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index, n = io.BytesIO(), [], 0

        def archive() -> pa.RecordBatch:
            nonlocal n
            body = zip_stored([(DATA, data.getvalue()), (INDEX, "".join(index).encode())], n % 2 == 1, COMMENT)[: -len(COMMENT)]
            n += 1
            data.seek(0)
            data.truncate()
            index.clear()
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["archive"])

        for batch in batches:
            ids, urls, targets = (batch[c].to_pylist() for c in ("page_id", "url", "refers_to"))
            for page, url, payload, target in zip(ids, urls, batch["payload"], targets, strict=True):
                refers = None if target is None else str(target)
                record = gzip.compress(warc_record("" if page is None else str(page), url or "", payload.as_py(), refers), LEVEL, mtime=0)
                index.append(f"{'-' if page is None else page} {data.tell()} {len(record)}\n")
                data.write(record)
                if data.tell() >= archive_bytes:
                    yield archive()
        if index:
            yield archive()

    return pages.select("page_id", "url", "payload", "refers_to").mapInArrow(written, "archive binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archive files below ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Spark lists the files, tasks open them; a task holds one record at a time. A response's length and digest are taken from its bytes and must agree with its headers; those of a revisit are
    the ones in its headers.
    """
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def page(urn: str | None) -> int | None:
        return int(urn[len("<urn:page:") : -1]) if urn and urn != "<urn:page:>" else None

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch["path"].to_pylist():
                out: list[tuple] = []
                store, place = fs.FileSystem.from_uri(uri)
                with store.open_input_file(place) as file:
                    archive = ZipReader(file)
                    for line in archive.read(INDEX).decode().splitlines():
                        _, offset, length = line.split()
                        warc, http, payload = parsed(gzip.decompress(archive.read(DATA, int(offset), int(length))))
                        digest = warc["warc-payload-digest"].removeprefix("sha1:")
                        n, target = int(http["content-length"]), page(warc.get("warc-refers-to"))
                        if warc["warc-type"] == "response" and (n, digest) != (len(payload), hashlib.sha1(payload).hexdigest()):
                            raise ValueError(f"damaged record {warc['warc-record-id']}")
                        out.append((page(warc["warc-record-id"]), n, digest, warc["warc-type"], target))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                columns = zip(*out, strict=True) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    found = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    return found.load(path).select("path").mapInArrow(records, kind)  # the files' content is not read here


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back.

    NULL html is an empty payload, a NULL url an empty one. Pages with a NULL page_id are responses that nothing
    refers to. Rows that repeat a page_id with the same payload are all responses where it is the largest id. Other
    columns are ignored, an empty table gives no rows.
    """
    prefer_skew_handling(pages.sparkSession)
    path = scratch_path(pages.sparkSession, "warc-archives")
    write_archives(with_targets(pages), path)
    return read_archives(pages.sparkSession, path)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
g AS (SELECT body, max(page_id) AS target FROM p WHERE octet_length(body) >= 1000 GROUP BY body)
SELECT p.page_id, octet_length(p.body) AS payload_bytes, sha1(p.body) AS payload_digest,
  CASE WHEN target <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN target <> p.page_id THEN target END AS refers_to
FROM p LEFT JOIN g ON p.body = g.body
"""
