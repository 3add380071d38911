"""WARC records in ZIP-packaged archives, read by range.

Pages are written as gzip members of WARC files, which stand stored (not compressed again) in a ZIP archive beside an index of their records, as web archive collections do. The reader takes the archive's size and a function that reads a range of it. It finds the end record and, where sizes or counts ask for it, the ZIP64 end record, parses the central directory, locates the stored members by their local headers, and reads each record by its range in the index; nothing is unpacked to disk.

Archives of this module's tables are rows (name, content) of bounded size, written as Parquet in the shared folder, so any store that Spark writes to will do and a lost executor's work is done anew.

Defined cases: a null html is an empty payload; a null or malformed url is written as it is, null as `about:blank`; a null page_id keeps a response of its own and is nobody's target; pages repeated under one id are records of their own; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, stored
from tessera.llm.registry import query

#: Bytes of records in one archive, about (a larger record has an archive of its own), and of records in a batch.
ARCHIVE_BYTES, BATCH_BYTES = 2 << 20, 1 << 20
#: Payloads under so many bytes are never revisits.
REVISIT_BYTES = 0

# Fixed values of the formats.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2020-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MEMBER, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def digest(payload: bytes) -> str:
    """The bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _framed(page_id: int | None, url: str | None, sha1: str, n: int, kind: str, more: dict[str, str], body: bytes) -> bytes:
    """A record. Line breaks in a url would end its header, so they are escaped."""
    uri = (url if url is not None else "about:blank").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "WARC-Payload-Length": str(n),
        "Content-Type": "application/http; msgtype=response",
    } | more
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def revisit(page_id: int | None, url: str | None, sha1: str, n: int, refers_to: int) -> bytes:
    """A revisit of another page's response, whose payload (sha1, n bytes) it doesn't hold."""
    return _framed(page_id, url, sha1, n, "revisit", {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}, _HTTP)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit of another page's response."""
    if refers_to is not None:
        return revisit(page_id, url, digest(payload), len(payload), refers_to)
    return _framed(page_id, url, digest(payload), len(payload), "response", {}, _HTTP + payload)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the payload behind the HTTP head."""
    version, _, rest = raw.partition(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    head, _, block = rest.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n"):
        k, _, v = line.partition(": ")
        fields[k] = v
    body = block[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def write_zip(members: Iterable[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """An archive of stored members. ZIP64 fields are used where a size, place or count asks for them, or everywhere if told."""
    out, central, n = io.BytesIO(), [], 0
    for name, data in members:
        at, crc, raw = out.tell(), zlib.crc32(data), name.encode()
        big = zip64 or len(data) >= _FULL32 or at >= _FULL32
        size, place = (_FULL32, _FULL32) if big else (len(data), at)
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        out.write(struct.pack("<4s5H3I2H", _LOCAL, 45 if big else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra)) + raw + extra)
        out.write(data)
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if big else b""
        central.append(struct.pack("<4s6H3I5H2I", _CENTRAL, 45, 45 if big else 20, 0x800, 0, 0, 33, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, place) + raw + extra)
        n += 1
    at = out.tell()
    for entry in central:
        out.write(entry)
    size = out.tell() - at
    if zip64 or n >= _FULL16 or at >= _FULL32 or size >= _FULL32:
        end = out.tell()
        out.write(struct.pack("<4sQ2H2I4Q", _END64, 44, 45, 45, 0, 0, n, n, size, at))
        out.write(struct.pack("<4sIQI", _LOCATOR64, 0, end, 1))
        out.write(struct.pack("<4s4H2IH", _END, 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0))
    else:
        out.write(struct.pack("<4s4H2IH", _END, 0, 0, n, n, size, at, 0))
    return out.getvalue()


class ZipReader:
    """Stored members of an archive that is read by ranges: read(start, size) gives bytes."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        tail_at = max(0, size - 22 - _FULL16 - 20)
        tail = read(tail_at, size - tail_at)
        k = tail.rfind(_END)
        while k >= 0 and k + 22 + struct.unpack_from("<H", tail, k + 20)[0] != len(tail):
            k = tail.rfind(_END, 0, k)
        if k < 0:
            raise ValueError("no end of a central directory")
        _, _, _, n, dir_size, dir_at, _ = struct.unpack_from("<4H2IH", tail, k + 4)
        if k >= 20 and tail[k - 20 : k - 16] == _LOCATOR64 and (n == _FULL16 or dir_size == _FULL32 or dir_at == _FULL32):
            (at,) = struct.unpack_from("<Q", tail, k - 12)
            end = read(at, 56)
            if end[:4] != _END64:
                raise ValueError("no ZIP64 end record where its locator points")
            n, dir_size, dir_at = struct.unpack_from("<3Q", end, 32)
        self.members: dict[str, tuple[int, int, int]] = {}
        entries, at = read(dir_at, dir_size), 0
        for _ in range(n):
            if entries[at : at + 4] != _CENTRAL:
                raise ValueError("no central directory entry")
            method, _, _, crc, packed, full, name_n, extra_n, note_n = struct.unpack_from("<3H3I3H", entries, at + 10)
            (place,) = struct.unpack_from("<I", entries, at + 42)
            name = entries[at + 46 : at + 46 + name_n].decode()
            extra = entries[at + 46 + name_n : at + 46 + name_n + extra_n]
            full, packed, place = self._wide(extra, full, packed, place)
            if method or full != packed:
                raise ValueError(f"{name} is not stored")
            self.members[name] = place, full, crc
            at += 46 + name_n + extra_n + note_n

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """The values with the ZIP64 field's numbers in place of those that are all ones, in order."""
        at, wide = 0, []
        while at + 4 <= len(extra):
            tag, size = struct.unpack_from("<HH", extra, at)
            if tag == 1:
                wide = list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            at += 4 + size
        return [wide.pop(0) if v == _FULL32 and wide else v for v in values]

    def start(self, name: str) -> int:
        """Where a member's data begin, by its local header."""
        place = self.members[name][0]
        head = self.read(place, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        name_n, extra_n = struct.unpack_from("<2H", head, 26)
        return place + 30 + name_n + extra_n

    def range(self, name: str, start: int, size: int) -> bytes:
        """A range of a member."""
        if start < 0 or start + size > self.members[name][1]:
            raise ValueError(f"range outside {name}")
        return self.read(self.start(name) + start, size)


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A record as a gzip member."""
    return gzip.compress(record(page_id, url, payload, refers_to), 1, mtime=0)


def pack_members(members: list[tuple[int | None, bytes]], zip64: bool = False) -> bytes:
    """An archive of gzip members (page_id, bytes) and their index."""
    index, at = [], 0
    for page_id, raw in members:
        index.append(json.dumps({"page": page_id, "offset": at, "length": len(raw)}))
        at += len(raw)
    return write_zip([(MEMBER, b"".join(m for _, m in members)), (INDEX, "\n".join(index).encode())], zip64)


def pack(records: list[tuple[int | None, str | None, bytes, int | None]], zip64: bool = False) -> bytes:
    """An archive of records (page_id, url, payload, refers_to) and their index."""
    return pack_members([(r[0], member(*r)) for r in records], zip64)


def read_records(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[int | None, dict[str, str], bytes]]:
    """(page_id, headers, payload) of each record of an archive, by the ranges of its index."""
    reader = ZipReader(read, size)
    start = reader.start(MEMBER)
    for line in reader.range(INDEX, 0, reader.members[INDEX][1]).splitlines():
        entry = json.loads(line)
        fields, payload = parse_record(gzip.decompress(read(start + entry["offset"], entry["length"])))
        yield entry["page"], fields, payload


def _responses(batches):
    """Of pages (page_id, url, html): their digests and records as responses, some bytes at a time."""
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "same", "sha1", "n", "member"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        rows, size = [], 0
        for page_id, url, html in zip(*batch.columns, strict=True):
            page_id, url = page_id.as_py(), url.as_py()
            payload = html.as_buffer().to_pybytes() if html.is_valid else b""
            rows.append((page_id, url, hashlib.sha256(payload).digest(), digest(payload), len(payload), member(page_id, url, payload, None)))
            size += len(rows[-1][-1])
            if size > BATCH_BYTES:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)


def _write(most: int):
    """Archives of records of so many bytes, about; a row with a target is written anew as a revisit."""

    def archive(held: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f"{held[0][0]}.wacz"]), pa.array([pack_members(held)], pa.binary())], ["name", "content"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for page_id, url, sha1, n, target, raw in zip(*batch.columns, strict=True):
                page_id, target = page_id.as_py(), target.as_py()
                raw = raw.as_buffer().to_pybytes() if target is None else gzip.compress(revisit(page_id, url.as_py(), sha1.as_py(), n.as_py(), target), 1, mtime=0)
                if held and size + len(raw) > most:
                    yield archive(held)
                    held, size = [], 0
                held.append((page_id, raw))
                size += len(raw)
        if held:
            yield archive(held)

    return run


def archives(pages: DataFrame) -> DataFrame:
    """Rows (name, content) of archives: of pages with equal payloads the one with the smallest id is a response, the others refer to it.

    Records are compressed where their pages are read. Ids and digests alone find each payload's first page; records then meet their targets by id and digest, so each goes through one shuffle, compressed, and the many pages of one payload through no common task.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.col("html").cast("string"), "UTF-8").alias("html"))
    payload = F.coalesce("html", F.lit(b""))
    ids = own.where(F.length(payload) >= REVISIT_BYTES).select("page_id", F.unhex(F.sha2(payload, 256)).alias("same"))
    first = cut(ids.groupBy("same").agg(F.min("page_id").alias("target"), F.count(F.lit(1)).alias("times")).where("times > 1").select("same", "target"))
    # one row for each id and payload, so that pages of one payload are spread by their ids
    targets = cut(ids.join(first, "same").where("page_id > target").distinct())
    made = own.mapInArrow(_responses, "page_id long, url string, same binary, sha1 string, n long, member binary")
    told = made.join(targets, ["page_id", "same"], "left").select("page_id", "url", "sha1", "n", "target", F.when(F.col("target").isNull(), F.col("member")).alias("member"))
    return told.mapInArrow(_write(ARCHIVE_BYTES), "name string, content binary")


def records(packed: DataFrame, with_payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload (null of a revisit) of every record of archives (name, content). A response's payload is held against its digest."""
    sql = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if with_payload:
        sql, kinds = sql + ", payload binary", [*kinds, pa.binary()]
    names = [c.split()[0] for c in sql.split(", ")]

    def page(urn: str | None) -> int | None:
        return int(urn[10:-1]) if urn else None

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                view = content.as_buffer()
                rows, size = [], 0
                for page_id, fields, payload in read_records(lambda a, n, view=view: view.slice(a, n).to_pybytes(), view.size):
                    again = fields["WARC-Type"] == "revisit"
                    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not again and digest(payload) != said:
                        raise ValueError(f"payload of page {page_id} differs from its digest")
                    uri = fields["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                    row = page_id, uri, int(fields["WARC-Payload-Length"]) if again else len(payload), said, fields["WARC-Type"], page(fields.get("WARC-Refers-To"))
                    rows.append((*row, None if again else payload) if with_payload else row)
                    size += len(payload) if with_payload else 0
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return packed.mapInArrow(read, sql)


ORACLE = """
WITH own AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
firsts AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM own),
letters AS (
    SELECT page_id, 4 * g + k AS place, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * g, 5))::BIGINT >> (15 - 5 * k)) & 31)::INT, 1) AS letter
    FROM firsts, range(8) AS a(g), range(4) AS b(k)),
digests AS (SELECT page_id, string_agg(letter, '' ORDER BY place) AS payload_digest FROM letters GROUP BY page_id)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM firsts JOIN digests USING (page_id)
"""


@query("op8_warc", ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = stored(archives(spark.read.parquet(f"{sf_dir}/pages.parquet")), "archives")
    return records(packed, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
