"""WARC records inside ZIP packages: writer, central-directory reader, range-read records.

``write_archives`` writes one ZIP per task: a stored member ``archive/data.warc.gz`` (one gzip
member per record) and a stored member ``indexes/index.cdx`` (a line per record: record id, offset
and length inside the archive member). ``read_archives`` never extracts: it reads the end records
and the central directory (with the ZIP64 ones where sizes, offsets or counts need them), finds
the members' data behind their local headers and reads each record by its range.

Cases: a null html is an empty payload; a null page_id is written as ``null`` and ranks below every
number; of repeated rows of the largest page_id all are responses; rows of an empty table give
nothing; texts of any length are streamed record by record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, steps, written

# Fixed values of the ZIP format: signatures and sizes of the records.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"


# ---------------------------------------------------------------- writing


class ZipWriter:
    """Stored members in a row; sizes follow the data, so nothing is rewritten. Always ZIP64."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.name, self.start, self.size, self.crc = raw, self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<4sHHHHHIIIHH", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, FULL32, FULL32, len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> int:
        """Offset of ``data`` inside the member."""
        at = self.size
        self._put(data)
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        return at

    def end(self) -> None:
        self._put(struct.pack("<4sIQQ", b"PK\x07\x08", self.crc, self.size, self.size))
        self.members.append((self.name, self.start, self.size, self.crc))

    def close(self) -> None:
        first = self.at
        for raw, start, size, crc in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start)
            self._put(struct.pack("<4sHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32) + raw + extra)
        end64, n = self.at, len(self.members)
        self._put(struct.pack("<4sQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, end64 - first, first))
        self._put(struct.pack("<4sIQI", LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<4sHHHHIIH", END, FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0))


def warc_record(kind: str, page_id: str, url: str, digest: str, size: int, refers: str | None, payload: bytes) -> bytes:
    """One WARC record; header values lose their line breaks."""
    url = url.replace("\r", " ").replace("\n", " ")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {url}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if kind == "revisit" else payload
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def with_verdicts(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """Each page with its payload's SHA-1 and the largest page_id of equal payloads.

    The largest id per digest is summed up before the shuffle and written out, so that the join
    back may split the rows of a payload that a large share of the pages have.
    """
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    best = written(p.groupBy("digest").agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "digests")
    j = p.join(best, "digest", "left")
    revisit = F.col("best").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("best"))) & (F.octet_length("html") >= min_bytes)
    return j.select("page_id", "url", "html", F.when(revisit, F.col("best")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write all ``pages`` below the URI ``path``; one row (file, records) per ZIP written.

    Of pages with equal payloads of ``min_bytes`` or more, the one with the largest id is a
    response and the others revisit it. Tasks write under a name of their own and rename.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        disk, base = pafs.FileSystem.from_uri(path)
        zipped, index, n = None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if zipped is None:
                disk.create_dir(base, recursive=True)
                own = f"{base}/.{part}-{uuid.uuid4().hex}"
                zipped = ZipWriter(disk.open_output_stream(own))
                zipped.begin(DATA)
            ids, urls, refs = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()
            for t in steps(b.column(2)):
                raw, at = t.buf.tobytes(), t.bounds.tolist()
                for k in range(len(t)):
                    payload, i = raw[at[k] : at[k + 1]], t.first + k
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    key = "null" if ids[i] is None else str(ids[i])
                    ref = refs[i]
                    record = gzip_member(warc_record("response" if ref is None else "revisit", key, urls[i] or "", digest, len(payload), None if ref is None else str(ref), payload))
                    index.append(f"{key} {zipped.add(record)} {len(record)}\n")
                    n += 1
        if zipped is None:
            return
        zipped.end()
        zipped.begin(INDEX)
        for k in range(0, len(index), 4096):
            zipped.add("".join(index[k : k + 4096]).encode())
        zipped.end()
        zipped.close()
        zipped.out.close()
        name = f"part-{part:06d}.zip"
        disk.move(own, f"{base}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

    rows = with_verdicts(pages, page_id, url, html, min_bytes)
    return written(rows.mapInArrow(run, "file string, records long"), "archives")


# ---------------------------------------------------------------- reading


@dataclass
class Member:
    name: str
    data_at: int
    size: int


class ZipReader:
    """Members of a ZIP by range reads; ``read(offset, length)`` is all it needs of the store."""

    TAIL = 65_557  # the end record and the longest comment

    def __init__(self, read, size: int):
        self.read = read
        base = max(0, size - self.TAIL)
        tail = read(base, size - base)
        at = tail.rfind(END)
        while at >= 0 and len(tail) >= at + 22 and struct.unpack_from("<H", tail, at + 20)[0] != len(tail) - at - 22:
            at = tail.rfind(END, 0, at)
        if at < 0 or len(tail) < at + 22:
            raise ValueError("no end record: not a ZIP archive")
        _, _, _, _, n, length, first, _ = struct.unpack_from("<4sHHHHIIH", tail, at)
        if FULL16 == n or FULL32 in (length, first):
            where = base + at - 20
            sig, _, end64, _ = struct.unpack("<4sIQI", read(where, 20)) if where >= 0 else (b"", 0, 0, 0)
            if sig == LOCATOR64:
                sig, _, _, _, _, _, _, n, length, first = struct.unpack("<4sQHHIIQQQQ", read(end64, 56))
                if sig != END64:
                    raise ValueError("broken ZIP64 end record")
        self.members = list(self._directory(read(first, length), n))

    def _directory(self, raw: bytes, n: int) -> Iterator[tuple[str, int, int, int]]:
        at = 0
        for _ in range(n):
            sig, _, _, _, method, _, _, _, packed, size, a, b, c, _, _, _, local = struct.unpack_from("<4sHHHHHHIIIHHHHHII", raw, at)
            if sig != CENTRAL:
                raise ValueError("broken central directory")
            name = raw[at + 46 : at + 46 + a].decode()
            extra = raw[at + 46 + a : at + 46 + a + b]
            k = 0
            while k + 4 <= len(extra):
                kind, width = struct.unpack_from("<HH", extra, k)
                if kind == 1:  # holds only the fields that are full in the record, in this order
                    longs = list(struct.unpack_from(f"<{width // 8}Q", extra, k + 4))
                    size = longs.pop(0) if size == FULL32 else size
                    packed = longs.pop(0) if packed == FULL32 else packed
                    local = longs.pop(0) if local == FULL32 else local
                k += 4 + width
            if method == 0:
                yield name, local, packed, method
            at += 46 + a + b + c

    def member(self, name: str) -> Member:
        """A stored member's place; its local header may have other extra fields than the directory."""
        for got, local, size, _ in self.members:
            if got == name:
                head = self.read(local, 30)
                if head[:4] != LOCAL:
                    raise ValueError("broken local header")
                a, b = struct.unpack_from("<HH", head, 26)
                return Member(name, local + 30 + a + b, size)
        raise KeyError(name)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def read_archives(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes, payload_digest, intact, payload.

    ``files`` names the packages; each is read by a task of its own, a record at a time. ``intact``: the
    payload's digest is the one that its header has (a revisit has no payload of its own).
    """
    n_files = files.count()
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, base = pafs.FileSystem.from_uri(path)
        number = lambda x: None if x in (None, "null") else int(x)
        for b in batches:
            for name in b.column(0).to_pylist():
                with disk.open_input_file(f"{base}/{name}") as f:
                    z = ZipReader(lambda at, n, f=f: f.read_at(n, at), f.size())
                    index, data = z.member(INDEX), z.member(DATA)
                    rows, held = [], 0
                    for line in f.read_at(index.size, index.data_at).decode().splitlines():
                        _, at, n = line.split()
                        fields, payload = parse_record(zlib.decompress(f.read_at(int(n), data.data_at + int(at)), 31))
                        page = fields["WARC-Record-ID"][len("<urn:page:") : -1]
                        ref = fields.get("WARC-Refers-To")
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:]
                        intact = kind == "revisit" or base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
                        rows.append((number(page), fields["WARC-Target-URI"], kind, ref and number(ref[len("<urn:page:") : -1]), int(fields["X-Payload-Length"]), digest, intact, payload))
                        held += len(payload)
                        if held > 4 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return files.select("file").repartitionByRange(max(n_files, 1), "file").mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, intact boolean, payload binary")


def zip_warc(pages: DataFrame) -> DataFrame:
    """Write all pages, read the packages back and check each response's payload against its header.

    ``payload_bytes`` is null for a record whose payload is not the one that its header tells.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    got = read_archives(spark, path, write_archives(pages, path))
    whole = F.col("intact") & ((F.col("record_type") == "revisit") | (F.octet_length("payload") == F.col("payload_bytes")))
    return got.select("page_id", F.when(whole, F.col("payload_bytes")).alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


#: DuckDB: base 32 of a SHA-1 is 32 groups of five bits, cut from four runs of ten hex digits.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(h, CAST(i // 8 AS INTEGER) * 10 + 1, 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = best OR best IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = best OR best IS NULL THEN NULL ELSE best END AS refers_to
FROM g
"""
