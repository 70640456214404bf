"""WARC records in ZIP-packaged archives, read by range without extraction.

Writing: pages meet the winner of their payload digest, and each partition
writes one archive: a stored member of gzipped WARC records (one gzip member
per record) and a stored index of their offsets. The archive is streamed, so
its central directory comes last; ZIP64 fields are used where sizes need them
or ``zip64`` asks for them.

Reading: the end record, the ZIP64 end record if there is one, and the central
directory are parsed; local headers give where stored members begin; the index
lists the records, and each record is one range read, dealt over all tasks.

Of records with equal payloads the one with the largest id is the response and
the others revisit it. Null payloads count as empty, null ids as the smallest,
and null addresses as empty. Rows that share id and payload are written as
often as they come. Payloads of any length are taken whole, and an empty table gives
no rows. Other columns are ignored. Archives lie in the folder that
all executors share; names are unique per task attempt, and only those of
finished tasks are read.
"""

from __future__ import annotations

import base64
import gzip
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha1
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import keep_table, split_by_size, type_of

#: ZIP signatures and the mark of a field that ZIP64 replaces, fixed values.
LOCAL, DESCRIPTOR, CENTRAL = b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02"
END, END64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.tsv"
#: Payload bytes after which a partition begins the next archive.
ARCHIVE_BYTES = 256 << 20
#: Index entries per range-read batch, and bytes of archives that a task reads (about).
ENTRIES, READ_BYTES = 256, 64 << 20


class Member(NamedTuple):
    name: str
    offset: int  # of the local header
    size: int
    crc: int
    method: int


# -- ZIP ---------------------------------------------------------------------

class ZipWriter:
    """Stored members, streamed: sizes follow the data in descriptors."""

    def __init__(self, file, zip64: bool = False):
        self.file, self.zip64 = file, zip64
        self.at, self.members = 0, []

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.offset, self.crc, self.size = name, self.at, 0, 0
        raw = name.encode()
        # Sizes unknown (flag bit 3); a ZIP64 field says the descriptor has 8-byte sizes.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.write(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x0808, 0, 0, 0x21, 0, FULL32, FULL32,
                                       len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self.write(data)

    def finish(self) -> None:
        self.write(DESCRIPTOR + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append(Member(self.name, self.offset, self.size, self.crc, 0))

    def close(self) -> None:
        begin = self.at
        for member in self.members:
            raw = member.name.encode()
            wide = self.zip64 or member.size >= FULL32 or member.offset >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, member.size, member.size,
                                member.offset) if wide else b""
            size, offset = (FULL32, FULL32) if wide else (member.size, member.offset)
            self.write(CENTRAL + struct.pack(
                "<HHHHHHIIIHHHHHII", 45, 45, 0x0808, 0, 0, 0x21, member.crc, size, size,
                len(raw), len(extra), 0, 0, 0, 0, offset) + raw + extra)
        length, count = self.at - begin, len(self.members)
        wide = self.zip64 or begin >= FULL32 or length >= FULL32 or count >= FULL16
        if wide:
            end64 = self.at
            self.write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, length,
                                           begin))
            self.write(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
            count, length, begin = FULL16, FULL32, FULL32
        self.write(END + struct.pack("<HHHHIIH", 0, 0, count, count, length, begin, 0))


def read_range(file, offset: int, size: int) -> bytes:
    file.seek(offset)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"archive ends early: {size} bytes at {offset}")
    return data


def central_directory(file, size: int) -> list[Member]:
    """Members by the central directory, ZIP64 or not."""
    tail_at = max(0, size - 22 - FULL16)
    tail = read_range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("no ZIP archive")
    count, length, begin = struct.unpack("<H", tail[at + 10:at + 12]) + struct.unpack(
        "<II", tail[at + 12:at + 20])
    if FULL16 == count or FULL32 in (length, begin):
        if tail[at - 20:at - 16] != LOCATOR64:
            raise ValueError("ZIP64 locator missing")
        end64 = struct.unpack("<Q", tail[at - 12:at - 4])[0]
        count, length, begin = struct.unpack("<QQQ", read_range(file, end64, 56)[32:56])
    directory, members, at = read_range(file, begin, length), [], 0
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("central directory is damaged")
        method, crc, size, full = struct.unpack("<H4xIII", directory[at + 10:at + 28])
        name_size, extra_size, comment_size = struct.unpack("<HHH", directory[at + 28:at + 34])
        offset = struct.unpack("<I", directory[at + 42:at + 46])[0]
        name_at = at + 46
        extra = directory[name_at + name_size:name_at + name_size + extra_size]
        while len(extra) >= 4:
            kind, length = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4:4 + length // 8 * 8]))
                full = next(wide) if full == FULL32 else full
                size = next(wide) if size == FULL32 else size
                offset = next(wide) if offset == FULL32 else offset
            extra = extra[4 + length:]
        members.append(Member(directory[name_at:name_at + name_size].decode(), offset, size, crc,
                              method))
        at = name_at + name_size + extra_size + comment_size
    return members


def data_offset(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed, so it has no ranges")
    header = read_range(file, member.offset, 30)
    if header[:4] != LOCAL:
        raise ValueError(f"{member.name}: local header is damaged")
    name_size, extra_size = struct.unpack("<HH", header[26:30])
    return member.offset + 30 + name_size + extra_size


# -- WARC --------------------------------------------------------------------

def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(sha1(payload).digest()).decode()


def record_bytes(page: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and no payload."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = head + (payload if refers_to is None else b"")
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
              f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Target-URI: {target}",
              "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        fields += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                   "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                   "identical-payload-digest"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[str, int, str, str, str | None]:
    """(page, payload bytes, digest, type, page referred to); a response's digest is verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = int(next(line for line in http.decode().split("\r\n")
                      if line.startswith("Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
            len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload is damaged")

    def page(name: str) -> str | None:
        return fields[name][10:-1] if name in fields else None
    return page("WARC-Record-ID"), length, digest, fields["WARC-Type"], page("WARC-Refers-To")


# -- the operator ------------------------------------------------------------

def with_winners(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """Pages with the id of the response of their payload; null where that is their own."""
    rows = pages.withColumn("digest", F.sha1(F.coalesce(payload_col, F.lit("")).cast("binary")))
    # Digests only: the pages themselves are shuffled once, by the join.
    winners = rows.groupBy("digest").agg(F.max(id_col).alias("winner"))
    return rows.join(winners, "digest").withColumn(
        "refers_to", F.when(~F.col("winner").eqNullSafe(F.col(id_col)), F.col("winner")))


def _write(folder: str, zip64: bool):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        pieces = (piece for batch in batches for piece in split_by_size(batch))
        piece = next(pieces, None)
        while piece is not None:
            name = f"{path}/{uuid.uuid4().hex}.wacz"
            size, index = 0, []
            with system.open_output_stream(name) as file:
                archive = ZipWriter(file, zip64)
                archive.begin(RECORDS)
                while piece is not None and size < ARCHIVE_BYTES:
                    for page, url, payload, refers_to in zip(
                            *(column.to_pylist() for column in piece.columns), strict=True):
                        raw = (payload or "").encode()
                        data = gzip.compress(
                            record_bytes(page, url or "", raw, base32_sha1(raw), refers_to), 1,
                            mtime=0)
                        index.append(f"{archive.size}\t{len(data)}\n")
                        archive.add(data)
                        size += len(raw)
                    piece = next(pieces, None)
                archive.finish()
                archive.begin(INDEX)
                archive.add("".join(index).encode())
                archive.finish()
                archive.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": name, "size": archive.at, "records": len(index)}])
    return over


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", zip64: bool = False) -> DataFrame:
    """Archives in ``folder`` (a URI); their path, size and number of records, written once."""
    rows = with_winners(
        pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"),
                     F.col(payload_col).alias("payload")), "page", "payload")
    texts = rows.select(F.coalesce(F.col("page").cast("string"), F.lit("")).alias("page"), "url",
                        "payload", F.col("refers_to").cast("string"))
    return keep_table(texts.mapInArrow(
        _write(folder, zip64), "path string, size long, records long"))


def _entries(folder: str):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size in zip(batch["path"].to_pylist(), batch["size"].to_pylist(),
                                  strict=True):
                with system.open_input_file(path) as file:
                    members = {m.name: m for m in central_directory(file, size)}
                    begin = data_offset(file, members[RECORDS])
                    index = members[INDEX]
                    data = read_range(file, data_offset(file, index), index.size)
                    if zlib.crc32(data) != index.crc:
                        raise ValueError(f"{path}: index is damaged")
                spans = [tuple(map(int, line.split(b"\t"))) for line in data.splitlines()]
                for first in range(0, len(spans), ENTRIES):
                    part = spans[first:first + ENTRIES]
                    yield pa.RecordBatch.from_pylist([{
                        "path": path, "offset": begin + part[0][0],
                        "sizes": [length for _, length in part]}])
    return over


def _read(folder: str):
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, offset, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                with system.open_input_file(path) as file:
                    for size in sizes:
                        with gzip.open(io.BytesIO(read_range(file, offset, size))) as record:
                            rows.append(parse_record(record.read()))
                        offset += size
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, (
                        pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()),
                        strict=True)],
                    ["page", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return over


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """All records: page, payload_bytes, payload_digest, record_type and refers_to (texts)."""
    # The index is far smaller than the records, so its own size says nothing about the
    # work: the number of tasks follows the bytes of the archives.
    size = archives.agg(F.sum("size")).first()[0] or 0
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, -(-size // READ_BYTES))
    entries = archives.select("path", "size").mapInArrow(
        _entries(folder), "path string, offset long, sizes array<long>")
    return entries.repartition(tasks, "path", "offset").mapInArrow(
        _read(folder), "page string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to string")


def round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html") -> DataFrame:
    """Per page what its record says after writing and reading: ids have their own type again."""
    kind = type_of(pages, id_col)
    records = read_archives(write_archives(pages, folder, id_col, url_col, payload_col), folder)
    return records.select(
        F.when(F.col("page") != "", F.col("page")).cast(kind).alias(id_col), "payload_bytes",
        "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
