"""WARC archives inside ZIP packages: written with stored members, read by range without extraction.

Each package holds ``archive/data.warc`` (all records, one after the other) and ``indexes/index.cdx`` (a line per record with
offset and length), both stored without compression, a central directory with ZIP64 fields, the ZIP64 end records and the classic end
record. The reader fetches the tail of the file, follows the end record (and the ZIP64 locator where it says so) to the central directory,
finds the stored members, range-reads the index, and then each record by its own range. Nothing is unpacked.

Packages lie below ``spark.checkpoint.dir``, reached by pyarrow's file systems from every executor. A task writes packages of bounded size under
names of its own and returns a manifest row for each; only the written manifest names packages, so what a lost or repeated attempt has left is
never read. The record of the largest id among equal payloads (of at least ``min_revisit_bytes``) is the response, the others are revisits
that refer to it; equal payloads are found by an aggregation on the digest, so no group meets in one task.

Cases: a null payload is empty; a null URL becomes ``urn:page:<id>``, white space in one is percent-encoded; a null id is written as an empty id and comes back null (such rows can't be a
response others refer to, and are responses themselves); repeated rows each get a record; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.session import scratch_path

from .common import materialize, whole_texts

#: A package is closed when its WARC member has this many bytes.
PACKAGE_BYTES = 32 << 20
#: Records that one reading task takes from a package at a time.
RECORDS_PER_READ = 2000
MAX_READ_TASKS = 10_000
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc", "indexes/index.cdx"
_TAIL = 1 << 16
_MAX32 = 0xFFFFFFFF
_BLANK = re.compile(r"[\s\x00-\x1f]")
_DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column, by built-in functions: each 5 hex digits are 4 base32 digits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexa = F.sha1(payload)
    digits = []
    for block in range(8):  # 40 hex digits
        value = F.conv(F.substring(hexa, 5 * block + 1, 5), 16, 10).cast("long")
        for k in (15, 10, 5, 0):
            digits.append(F.substring(F.lit(alphabet), (F.shiftright(value, k).bitwiseAND(31) + 1).cast("int"), F.lit(1)))
    return F.concat(*digits)


def _record(rid: str, url: str, kind: str, refers: str, digest: str, payload: bytes) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if kind == "revisit" else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{rid} {url}')}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {rid}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class PackageWriter:
    """One ZIP package: records are streamed into the first stored member, the index is the second."""

    def __init__(self, stream):
        self.out, self.at = stream, 0
        self.members: list[tuple[bytes, int, int, int]] = []
        self.index: list[str] = []
        self._open(WARC_MEMBER)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _open(self, name: str) -> None:
        self.name, self.start, self.crc = name.encode(), self.at, 0
        # sizes and checksum follow in a ZIP64 data descriptor (flag bit 3), so that the member can be streamed
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0x0808, 0, 0, 0x5821, 0, _MAX32, _MAX32, len(self.name), len(extra)))
        self._write(self.name + extra)
        self.data = self.at

    def _close(self) -> None:
        size = self.at - self.data
        self._write(struct.pack("<IIQQ", 0x08074B50, self.crc, size, size))
        self.members.append((self.name, self.crc, size, self.start))

    def add(self, record: bytes, page: str, url: str) -> None:
        self.index.append(f"{page} {self.at - self.data} {len(record)} {url}")
        self.crc = zlib.crc32(record, self.crc)
        self._write(record)

    @property
    def size(self) -> int:
        return self.at

    def close(self) -> None:
        self._close()
        self._open(INDEX_MEMBER)
        body = "".join(x + "\n" for x in self.index).encode()
        self.crc = zlib.crc32(body)
        self._write(body)
        self._close()
        begin = self.at
        for name, crc, size, start in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._write(struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0x0808, 0, 0, 0x5821, crc, _MAX32, _MAX32, len(name), len(extra), 0, 0, 0, 0, _MAX32))
            self._write(name + extra)
        size, end = self.at - begin, self.at
        n = len(self.members)
        self._write(struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, begin))
        self._write(struct.pack("<IIQI", 0x07064B50, 0, end, 1))
        self._write(struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, n, n, _MAX32, _MAX32, 0))
        self.out.close()


def read_at(f, offset: int, length: int) -> bytes:
    f.seek(offset)
    data = f.read(length)
    if len(data) != length:
        raise ValueError(f"the package ends early: {length} bytes at {offset}, got {len(data)}")
    return data


def stored_members(f, size: int) -> dict[str, tuple[int, int]]:
    """Name to (offset of its data, length) of all stored members, from the central directory."""
    tail_at = max(0, size - _TAIL - 22)
    tail = read_at(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature may stand in the comment
    if end < 0:
        raise ValueError("no end record: not a ZIP package")
    n, length, begin = struct.unpack_from("<HII", tail, end + 10)
    if _MAX32 in (length, begin) or n == 0xFFFF:
        sig, _, at, _ = struct.unpack("<IIQI", read_at(f, tail_at + end - 20, 20))
        if sig != 0x07064B50:
            raise ValueError("no ZIP64 locator before the end record")
        sig, _, _, _, _, _, _, n, length, begin = struct.unpack("<IQHHIIQQQQ", read_at(f, at, 56))
        if sig != 0x06064B50:
            raise ValueError("no ZIP64 end record where the locator points")
    directory, at, out = read_at(f, begin, length), 0, {}
    for _ in range(n):
        sig, _, _, flags, method, _, _, _, packed, plain, ln, lx, lc, _, _, _, start = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if sig != 0x02014B50:
            raise ValueError("broken central directory")
        name = directory[at + 46 : at + 46 + ln].decode("utf-8")
        extra, x = directory[at + 46 + ln : at + 46 + ln + lx], 0
        while x + 4 <= len(extra):
            tag, length_x = struct.unpack_from("<HH", extra, x)
            if tag == 1:  # 64-bit values, in order, of the fields that are full
                p = x + 4
                if plain == _MAX32:
                    plain, p = struct.unpack_from("<Q", extra, p)[0], p + 8
                if packed == _MAX32:
                    packed, p = struct.unpack_from("<Q", extra, p)[0], p + 8
                if start == _MAX32:
                    start = struct.unpack_from("<Q", extra, p)[0]
            x += 4 + length_x
        if method == 0:
            own_name, own_extra = struct.unpack("<HH", read_at(f, start + 26, 4))
            out[name] = (start + 30 + own_name + own_extra, packed)
        at += 46 + ln + lx + lc
    return out


def _write_batches(root: str, package_bytes: int):
    def run(batches):
        fs, folder = pafs.FileSystem.from_uri(root)
        fs.create_dir(folder, recursive=True)
        writer, name, n = None, "", 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                page, url, html, digest, kind, refers = row
                if writer is None:
                    name, n = f"{folder}/{uuid.uuid4().hex}.wacz", 0
                    writer = PackageWriter(fs.open_output_stream(name))
                page = "" if page is None else str(page)
                url = f"urn:page:{page}" if url is None else _BLANK.sub(lambda m: quote(m[0]), url)
                writer.add(_record(page, url, kind, "" if refers is None else str(refers), digest, html), page or "-", url)
                n += 1
                if writer.size >= package_bytes:
                    writer.close()
                    yield _manifest(name, n, writer.size)
                    writer = None
        if writer is not None:
            writer.close()
            yield _manifest(name, n, writer.size)

    return run


def _manifest(name: str, n: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])


def write_packages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0,
                   package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes the packages; returns their manifest (path, records, bytes), itself a written table."""
    whole_texts(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.withColumn("digest", sha1_base32(F.col("payload")))
    # ids by digest, without the payloads: the largest one is the response
    tops = materialize(keyed.filter("id is not null").groupBy("digest").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "top"), "responses")
    revisit = F.col("top").isNotNull() & F.col("id").isNotNull() & (F.col("id") < F.col("top")) & (F.length("payload") >= min_revisit_bytes)
    # the side with the payloads is joined by its digest alone where the repeated digests are few enough to broadcast
    small = tops.count() <= 500_000
    joined = keyed.join(F.broadcast(tops) if small else tops, "digest", "left")
    records = joined.select(
        "id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("top")).alias("refers")
    )
    root = _uri(scratch_path(pages.sparkSession, "llm-warc"))
    return materialize(records.mapInArrow(_write_batches(root, package_bytes), "path string, records long, bytes long"), "manifest")


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")


def _read_batches(root: str):
    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for path, size, first, count in zip(*(batch.column(i).to_pylist() for i in range(4))):
                with fs.open_input_file(path) as f:
                    members = stored_members(f, size)
                    warc, _ = members[WARC_MEMBER]
                    index = read_at(f, *members[INDEX_MEMBER]).decode().split("\n")[:-1][first : first + count]
                    out, held = [], 0
                    for line in index:
                        _, offset, length, _ = line.split(" ", 3)
                        out.append(parse_record(read_at(f, warc + int(offset), int(length))))
                        held += int(length)
                        if held > 4 << 20:
                            yield _parsed(out)
                            out, held = [], 0
                    if out:
                        yield _parsed(out)

    return run


_RECORD = "id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def _parsed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=[x.split()[0] for x in _RECORD.split(", ")])


def parse_record(raw: bytes) -> tuple:
    """(id, url, type, payload digest, payload bytes, refers to, payload); a response's digest and length are those of the bytes read."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    _, _, payload = block.partition(b"\r\n\r\n")
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if kind == "response":
        got = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if got != digest or len(payload) != size:
            raise ValueError(f"damaged payload of page {fields.get('X-Page-ID')}")
    whole = lambda k: int(fields[k]) if fields.get(k) else None
    return whole("X-Page-ID"), fields["WARC-Target-URI"], kind, digest, size, whole("X-Refers-To-Page-ID"), payload if kind == "response" else None


def read_packages(manifest: DataFrame) -> DataFrame:
    """All records of the packages: id, url, record_type, payload_digest, payload_bytes, refers_to, payload (null for revisits)."""
    spark = manifest.sparkSession
    parts = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("records") - 1) / RECORDS_PER_READ))).alias("k"))
    parts = parts.select("path", "bytes", (F.col("k") * RECORDS_PER_READ).alias("first"), F.lit(RECORDS_PER_READ).cast("long").alias("count"))
    # a fixed number of partitions: these few small rows stand for large reads, and must not be put together
    parts = parts.repartition(min(max(parts.count(), 1), MAX_READ_TASKS), "path", "first")
    root = _uri(scratch_path(spark, "llm-warc"))
    return parts.mapInArrow(_read_batches(root), _RECORD)
