"""WARC records in ZIP-packaged archives, read by ranges without extraction.

An archive is a ZIP file whose members are stored, not deflated: archive/data.warc.gz holds the records, each a gzip
member of its own, and indexes/index.cdx one line for each record with its place in it. A reader fetches the end of
the file, finds the central directory there (by the ZIP64 records where the plain ones are full), finds the members
in it, reads the index, and then reads records, each from its own range of bytes.

Records with equal payloads: that of the smallest id is a response, the others are revisits that refer to it.

Defined results: a null payload is empty; payloads shorter than the bound are all responses; of rows that share the
smallest id of an equal payload one is the response, and the others are revisits that refer to that id; a null id is
greater than any other, and a revisit of a record without an id refers to null; an empty table gives an empty result; archives are written under an attempt's own
name and then renamed, so that a task that runs again leaves one archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import new_path, text_or_empty, written

#: Parts that the rows of one payload are dealt to.
SALTS = 4_096
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes of payload that a reading task holds at a time; the end of a file that is read first.
READ_BYTES, TAIL = 8 << 20, 1 << 16
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
_FULL = 0xFFFFFFFF


def filesystem(uri: str):
    """The file system of a URI and the path in it, as pyarrow knows them (local, HDFS, object stores)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class ZipWriter:
    """Writes stored members in order; every size and place is also in ZIP64 form where the plain field is too small."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, parts: Iterator[bytes]) -> None:
        """A member whose size isn't known before: sizes follow the data, in ZIP64 form."""
        encoded, start, crc, size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<IHHHHHIIIHH", _LOCAL, 45, 0x0808, 0, 0, 0x21, 0, _FULL, _FULL, len(encoded), len(extra)) + encoded + extra)
        for part in parts:
            crc, size = zlib.crc32(part, crc), size + len(part)
            self._put(part)
        self._put(struct.pack("<IIQQ", 0x08074B50, crc, size, size))
        self.members.append((encoded, crc, size, start))

    def close(self) -> None:
        first = self.at
        for name, crc, size, start in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, _FULL, _FULL, len(name), len(extra), 0, 0, 0, 0, _FULL) + name + extra)
        length, end64 = self.at - first, self.at
        n = len(self.members)
        self._put(struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, length, first))
        self._put(struct.pack("<IIQI", _LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", _END, 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), min(length, _FULL), min(first, _FULL), 0))


class ZipReader:
    """Members of a ZIP file by range reads: members maps a name to the place and size of its stored bytes."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.members = {}
        count, length, first = self._directory()
        data, at = self.read(first, length), 0
        for _ in range(count):
            head = struct.unpack_from("<IHHHHHHIIIHHHHHII", data, at)
            if head[0] != _CENTRAL:
                raise ValueError("central directory: wrong signature")
            method, packed, full, n_name, n_extra, n_comment, start = head[4], head[8], head[9], head[10], head[11], head[12], head[16]
            name = data[at + 46 : at + 46 + n_name].decode()
            extra = data[at + 46 + n_name : at + 46 + n_name + n_extra]
            full, packed, start = _zip64(extra, full, packed, start)
            if method == 0 and full == packed:
                self.members[name] = (start, packed)
            at += 46 + n_name + n_extra + n_comment

    def read(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(length)
        if len(data) != length:
            raise EOFError(f"{length} bytes at {at} of {self.size}: got {len(data)}")
        return data

    def _directory(self) -> tuple[int, int, int]:
        tail_at = max(0, self.size - TAIL - 22)
        tail = self.read(tail_at, self.size - tail_at)
        end = tail.rfind(struct.pack("<I", _END))
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(struct.pack("<I", _END), 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        count, length, first = struct.unpack_from("<HII", tail, end + 10)
        if end >= 20 and struct.unpack_from("<I", tail, end - 20)[0] == _LOCATOR64:
            at = struct.unpack_from("<Q", tail, end - 12)[0]
            record = self.read(at, 56)
            if struct.unpack_from("<I", record)[0] != _END64:
                raise ValueError("ZIP64 end of central directory: wrong signature")
            count, length, first = struct.unpack_from("<QQQ", record, 32)
        return count, length, first

    def place(self, name: str) -> tuple[int, int]:
        """Where a member's own bytes begin, and how many there are."""
        start, size = self.members[name]
        head = struct.unpack("<IHHHHHIIIHH", self.read(start, 30))
        if head[0] != _LOCAL:
            raise ValueError("local header: wrong signature")
        return start + 30 + head[9] + head[10], size


def _zip64(extra: bytes, full: int, packed: int, start: int) -> tuple[int, int, int]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            place, got = at + 4, []
            for value in (full, packed, start):
                if value == _FULL:
                    value, place = struct.unpack_from("<Q", extra, place)[0], place + 8
                got.append(value)
            return tuple(got)
        at += 4 + n
    return full, packed, start


def warc_record(page_id: int | None, url: str, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record, compressed; a revisit has no payload but the digest and the id that it refers to."""
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:plumbline:page:{_named(page_id)}>", f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {len(payload)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:plumbline:page:{_named(refers_to)}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 1, mtime=0)


def _named(page_id: int | None) -> str:
    return "-" if page_id is None else str(page_id)


def _numbered(name: str) -> int | None:
    return None if name == "-" else int(name)


def read_record(packed: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers and its payload (what follows the HTTP header)."""
    data = gzip.decompress(packed)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def assign_types(pages: DataFrame, least_bytes: int) -> DataFrame:
    """pages (page_id, url, payload: string) with first, the smallest id of an equal payload, and long, whether it counts.

    Equal payloads may be a third of all rows: ids are reduced within SALTS parts of a digest first, and each part is
    then joined with its own result.
    """
    keyed = pages.withColumn("_d", F.sha1(F.encode("payload", "UTF-8"))).withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    parts = written(keyed.groupBy("_d", "_salt").agg(F.min("page_id").alias("first")), "warc-digests")
    firsts = parts.groupBy("_d").agg(F.min("first").alias("first"))
    table = parts.select("_d", "_salt").join(firsts, "_d")
    out = keyed.join(table, ["_d", "_salt"])
    return out.select("page_id", "url", "payload", "first", (F.octet_length("payload") >= least_bytes).alias("long"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes records (page_id, url, payload, first, long), an archive for each partition; a table of (uri, n_bytes, n_records).

    Rows of one payload and id are in one partition, so that the writer sees which of them is the first.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, at = filesystem(folder)
        name = f"part-{task.partitionId():06d}.wacz"
        own = f"{at}/.{name}.{task.taskAttemptId()}"
        system.create_dir(at, recursive=True)
        index, place, responses = [], 0, set()

        def packed() -> Iterator[bytes]:
            nonlocal place
            for batch in batches:
                for i in range(batch.num_rows):
                    page_id, url, payload, first, long = (c[i].as_py() for c in batch.columns)
                    payload = payload.encode()
                    digest = sha1_base32(payload)
                    revisit = long and (page_id != first or digest in responses)
                    if long and not revisit:
                        responses.add(digest)
                    record = warc_record(page_id, url or "", payload, digest, "revisit" if revisit else "response", first)
                    index.append(f"{_named(page_id)} {place} {len(record)}\n")
                    place += len(record)
                    yield record

        with system.open_output_stream(own) as out:
            archive = ZipWriter(out)
            archive.member(DATA, packed())
            archive.member(INDEX, (line.encode() for line in index))
            archive.close()
            size = archive.at
        if index:
            system.move(own, f"{at}/{name}")
            yield pa.RecordBatch.from_pydict({"uri": [f"{folder}/{name}"], "n_bytes": [size], "n_records": [len(index)]})
        else:
            system.delete_file(own)

    return written(records.select("page_id", "url", "payload", "first", "long").mapInArrow(write, "uri string, n_bytes long, n_records long"), "warc-manifest")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives (uri, n_bytes): page_id, payload_bytes, payload_digest, record_type, refers_to, payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, at = filesystem(uri)
                with system.open_input_file(at) as source:
                    yield from _records(ZipReader(source, size))

    return archives.select("uri", "n_bytes").mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def _records(archive: ZipReader) -> Iterator[pa.RecordBatch]:
    at, size = archive.place(INDEX)
    base = archive.place(DATA)[0]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for line in archive.read(at, size).decode().splitlines():
        name, place, length = line.split()
        page_id, place, length = _numbered(name), int(place), int(length)
        head, payload = read_record(archive.read(base + place, length))
        own = lambda name, h=head: _numbered(h[name].rpartition(":")[2].rstrip(">"))
        if own("WARC-Record-ID") != page_id:
            raise ValueError(f"index and record differ: {page_id}")
        revisit = head["WARC-Type"] == "revisit"
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if not revisit and sha1_base32(payload) != digest:
            raise ValueError(f"digest of page {page_id}")
        rows.append((page_id, int(head["X-Payload-Bytes"]), digest, head["WARC-Type"], own("WARC-Refers-To") if revisit else None, None if revisit else payload))
        held += len(payload)
        if held >= READ_BYTES or len(rows) >= 10_000:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def archive_pages(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes pages (page_id, url, html) to archives in folder; their manifest."""
    slim = pages.select("page_id", "url", text_or_empty("html").alias("payload"))
    return write_archives(assign_types(slim, least_bytes), folder)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = archive_pages(pages, new_path(spark, "warc"))
    return read_archives(manifest.repartition(max(1, spark.sparkContext.defaultParallelism))).drop("payload")
