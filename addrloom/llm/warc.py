"""WARC records in ZIP-packaged archives, written and read back by byte ranges.

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (one gzip member a record) and
``indexes/index.cdxj`` (a line for each record with its offset and length). The reader finds the end record
and, where there is one, the ZIP64 end record, reads the central directory, locates the stored members and
fetches records by range; nothing is extracted. Files are opened through ``pyarrow.fs`` by URI, so archives
can lie in any store that driver and executors share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.shared import fresh_path, write_table

from .common import small_batches, table

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"
#: Archives of some 24 MB that one task reads at most.
ARCHIVES_EACH = 16


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# --- ZIP ------------------------------------------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header is
    crc: int


class ZipReader:
    """Members of a ZIP file, read by range. ``file`` has size(), and read_at(length, offset)."""

    def __init__(self, file):
        self.file = file
        self.members = {m.name: m for m in self._directory()}

    def _at(self, start: int, length: int) -> bytes:
        got = self.file.read_at(length, start)
        if len(got) != length:
            raise ValueError("the archive ends too early")
        return bytes(got)

    def _directory(self) -> list[Member]:
        size = self.file.size()
        tail_at = max(0, size - 22 - 65535)
        tail = self._at(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(b"PK\x05\x06", 0, end)  # the mark inside a comment is not the record
        if end < 0:
            raise ValueError("not a ZIP file")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if 0xFFFF == count or 0xFFFFFFFF in (length, start):
            locator = self._at(tail_at + end - 20, 20)
            if locator[:4] == b"PK\x06\x07":
                record = self._at(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != b"PK\x06\x06":
                    raise ValueError("no ZIP64 end record where its locator points")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        entries, at, found = self._at(start, length), 0, []
        for _ in range(count):
            sign, method, crc, packed, plain, n, x, c, header = struct.unpack_from("<4s6xH4xIIIHHH8xI", entries, at)
            if sign != b"PK\x01\x02":
                raise ValueError("broken central directory")
            name = entries[at + 46 : at + 46 + n].decode("utf-8", "replace")
            extra = entries[at + 46 + n : at + 46 + n + x]
            sizes = [plain, packed, header]
            while len(extra) >= 4:
                kind, size_ = struct.unpack_from("<HH", extra)
                if kind == 1:  # 64-bit values, of those fields only that are full, in this order
                    more = io.BytesIO(extra[4 : 4 + size_])
                    sizes = [struct.unpack("<Q", more.read(8))[0] if v == 0xFFFFFFFF else v for v in sizes]
                extra = extra[4 + size_ :]
            found.append(Member(name, method, sizes[1], sizes[2], crc))
            at += 46 + n + x + c
        return found

    def start_of(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        m = self.members[name]
        if m.method != 0:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self._at(m.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError("no local header where the directory points")
        n, x = struct.unpack_from("<HH", head, 26)
        return m.header + 30 + n + x

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        m = self.members[name]
        length = m.size - offset if length is None else length
        if offset < 0 or offset + length > m.size:
            raise ValueError("the range lies outside the member")
        return self._at(self.start_of(name) + offset, length)


# --- WARC -----------------------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit has the response's headers, with the payload's full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~')}" if url.isascii() and url.isprintable() and " " not in url else f"WARC-Target-URI: {quote(url)}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """What a record says: its headers, and of the HTTP message the payload and its full length."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((int(x[15:]) for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")), len(payload))
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != length or f"sha1:{digest(payload)}" != fields["warc-payload-digest"]):
        raise ValueError("the payload is not what its record says")
    return {
        "page_id": page_of(fields["warc-record-id"]), "record_type": fields["warc-type"],
        "refers_to": page_of(fields["warc-refers-to"]) if revisit else None, "payload_bytes": length,
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"), "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "payload": None if revisit else payload,
    }


class ArchiveWriter:
    """Archives of bounded size in a folder. A file has its final name only when it is whole."""

    def __init__(self, folder: str, most: int, level: int):
        self.store, self.folder = open_store(folder)
        self.uri, self.most, self.level = folder.rstrip("/"), most, level
        self.store.create_dir(self.folder, recursive=True)
        self._begin()

    def _begin(self) -> None:
        self.data, self.index = io.BytesIO(), []

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> Iterator[tuple[str, int]]:
        packed = gzip.compress(build_record(page_id, url, payload, refers_to, revisit), self.level, mtime=0)
        entry = {"url": url, "offset": self.data.tell(), "length": len(packed), "filename": "data.warc.gz", "digest": f"sha1:{digest(payload)}", "status": 200}
        self.index.append(f"{quote(url or '-', safe='')} {DATE} {json.dumps(entry)}")
        self.data.write(packed)
        if self.data.tell() >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[str, int]]:
        if not self.index:
            return
        name = f"pages-{uuid.uuid4().hex}.wacz"
        with self.store.open_output_stream(f"{self.folder}/{name}.part", compression=None) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as z:
            for member, content in ((DATA, self.data.getbuffer()), (INDEX, "\n".join(self.index).encode())):
                info = zipfile.ZipInfo(member, (2024, 1, 1, 0, 0, 0))
                with z.open(info, "w", force_zip64=True) as f:
                    f.write(content)
        self.store.move(f"{self.folder}/{name}.part", f"{self.folder}/{name}")
        n = len(self.index)
        self._begin()
        yield f"{self.uri}/{name}", n


def read_archive(uri: str, at_once: int = 4 << 20) -> Iterator[dict]:
    """Every record of an archive, by the ranges of its index; neighbouring ranges are fetched together."""
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        z = ZipReader(file)
        entries = [json.loads(line.split(" ", 2)[2]) for line in z.read(INDEX).decode().split("\n") if line]
        entries.sort(key=lambda e: e["offset"])
        i = 0
        while i < len(entries):
            j, start = i, entries[i]["offset"]
            while j < len(entries) and (j == i or entries[j]["offset"] + entries[j]["length"] - start <= at_once):
                j += 1
            got = z.read(DATA, start, entries[j - 1]["offset"] + entries[j - 1]["length"] - start)
            for e in entries[i:j]:
                a = e["offset"] - start
                yield parse_record(zlib.decompress(got[a : a + e["length"]], 31))
            i = j


# --- tables ---------------------------------------------------------------------------------------------


def with_record_types(pages: DataFrame, id_col: str = "page_id", payload_col: str = "payload", least_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to`` and ``revisit``: of equal payloads of at least ``least_bytes`` bytes the smallest id is the response.

    Rows that repeat the response's id are responses too; rows with a null id revisit another's response, or are
    all responses where no row of theirs has an id.
    """
    keyed = pages.withColumn("_sha", F.sha2(payload_col, 256))
    groups = keyed.where(F.octet_length(payload_col) >= least_bytes).groupBy(F.substring("_sha", 1, 8).alias("_head"), "_sha")
    groups = groups.agg(F.min(id_col).alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("_sha", "_first")
    # Keyed otherwise than the aggregate, so that adaptive execution can split the rows of a frequent payload.
    out = keyed.join(groups, "_sha", "left").drop("_sha")
    revisit = F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return out.withColumn("revisit", revisit).withColumn("refers_to", F.when(revisit, F.col("_first"))).drop("_first")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, most_bytes: int = 24 << 20, level: int = 4) -> DataFrame:
    """Write one record a row and return the archives, ``(path, records)``.

    The payload is the html in UTF-8 (null: empty), whole, however long. The list of archives is written down before it
    is returned: an executor's second try at a partition leaves other files behind that no list names. Repeated rows are
    records of their own, a null id is kept as ``null``; other columns are not read, so their names don't matter. No
    pages, no archives.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = with_record_types(rows, least_bytes=least_bytes).select("page_id", "url", "payload", "refers_to", "revisit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, most_bytes, level)
        done: list[tuple[str, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                done += writer.add(*row)
        done += writer.flush()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    return write_table(small_batches(rows).mapInArrow(run, "path string, records long"), "archives")


RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives named in column ``path``, by the ranges of their indexes.

    The archives, counted here, are dealt to tasks of at most ``ARCHIVES_EACH``, fewer while there are cores to spare.
    No archives, no records; other columns are not read.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(some: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in some], k) for n, k in zip(names, kinds, strict=True)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                some: list[dict] = []
                for record in read_archive(path):
                    some.append(record if payloads else record | {"payload": None})
                    if len(some) == 500:
                        yield batch_of(some)
                        some = []
                if some:
                    yield batch_of(some)

    paths = archives.select("path")
    n = paths.count()
    tasks = max(-(-n // ARCHIVES_EACH), min(n, 4 * archives.sparkSession.sparkContext.defaultParallelism), 1)
    return paths.repartition(tasks).mapInArrow(run, RECORD)


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` as records, read back from the archives; null html is an empty payload. See :func:`write_archives`."""
    archives = write_archives(table(spark, sf_dir, "pages"), fresh_path(spark, "wacz"))
    return read_archives(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
