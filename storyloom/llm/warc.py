"""Web archives in ZIP packages: written by executors, read by ranges without extraction.

A package is a ZIP file of stored members: ``archive/data.warc.gz``, whose records
are gzip members of their own, ``indexes/index.cdxj``, a line for each record with
its offset and length, and ``datapackage.json``.  The reader looks at the end of
the file for the central directory, or through the ZIP64 locator for the ZIP64
one, finds where the stored archives and indexes begin from their local headers,
and reads runs of records by their offsets inside the package.  An archive
without an index is scanned from one gzip member to the next.

Of pages with equal payloads (UTF-8 bytes of the html) the one with the smallest
page_id is a response record, the others are revisits that refer to it and hold
the HTTP head only; payloads under a least length are all responses.  Payloads
are equal if their lengths and two hashes, SHA-1 and 256-bit SHA-2, are.  Digests
are checked as records are read.

Null html is an empty payload.  Pages without an id are responses and never
referred to.  Rows of one id with the smallest id of their payload are all
responses.  Null urls are left out of the record; other columns aren't looked at.
Very long pages are one record each.  Packages lie in the shared folder; each task
attempt writes files of its own, and only those that a finished task names count,
so a task that is run again does no harm.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.common import Scratch, read, sliced

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcParams:
    #: Payloads of fewer bytes are never revisits.
    least: int = 0
    #: Time of capture of all records, as the table has none.
    date: str = "2000-01-01T00:00:00Z"
    #: Bytes and records of a package, about.
    package_bytes: int = 256 << 20
    package_records: int = 200_000
    #: Bytes that are read at a time, about.
    run: int = 8 << 20


def store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path; Hadoop writes local paths with one slash."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))


# --- records ----------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name_of(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit of the page that it refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", name_of(page_id)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name_of(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def fields(head: bytes) -> dict[str, str]:
    """Named fields below a first line, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


@dataclass(frozen=True)
class Record:
    head: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @classmethod
    def parse(cls, raw: bytes) -> Record:
        """A record; raises if it isn't whole."""
        first, gap, rest = raw.partition(b"\r\n\r\n")
        if not raw.startswith(b"WARC/1.") or not gap:
            raise ValueError("not a WARC record")
        head = fields(first)
        block = rest[: int(head["content-length"])]
        if rest[len(block) :] != b"\r\n\r\n":
            raise ValueError("the record's length is wrong")
        if not head.get("content-type", "").startswith("application/http"):
            return cls(head, {}, block)
        http, _, payload = block.partition(b"\r\n\r\n")
        return cls(head, fields(http), payload)

    def row(self) -> dict:
        """page_id, payload_bytes, payload_digest, record_type, refers_to; raises if a payload isn't what its digest says."""
        kind, said = self.head["warc-type"], self.head.get("warc-payload-digest", "").removeprefix("sha1:")
        size = int(self.http["content-length"]) if "content-length" in self.http else len(self.payload)
        if kind == "response" and (size != len(self.payload) or said != digest(self.payload)):
            raise ValueError(f"the payload of {self.head.get('warc-record-id')} is damaged")
        return {"page_id": page_of(self.head.get("warc-record-id")), "payload_bytes": size, "payload_digest": said, "record_type": kind, "refers_to": page_of(self.head.get("warc-refers-to"))}


# --- packages ---------------------------------------------------------------


class Package:
    """A ZIP file under way: records are added to the archive, the index follows at its end."""

    def __init__(self, uri: str):
        files, path = store(uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.lines, self.at = uri, [], 0
        self.out = files.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Stream(self.out), "w", zipfile.ZIP_STORED)
        self.archive = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, raw: bytes, url: str | None, kind: str) -> None:
        body = gzip.compress(raw, mtime=0)
        self.archive.write(body)
        key = re.sub(r"\s", "", (url or "-").lower())
        self.lines.append(f"{key} {json.dumps({'offset': str(self.at), 'length': str(len(body)), 'filename': ARCHIVE.rpartition('/')[2], 'type': kind})}\n")
        self.at += len(body)

    def close(self) -> dict:
        self.archive.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(sorted(self.lines)))
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "resources": [{"path": ARCHIVE, "bytes": self.at}, {"path": INDEX}]}))
        self.zip.close()
        self.out.close()
        return {"uri": self.uri, "records": len(self.lines), "bytes": self.at}


class _Stream(io.RawIOBase):
    """What a store lets one write, front to back, as the ZIP writer wants it."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, body) -> int:
        self.out.write(body)
        return len(body)

    def flush(self) -> None:
        pass


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    size: int
    #: Where its local header is.
    header: int


EOCD, LOCATOR, EOCD64 = struct.Struct("<4s4H2IH"), struct.Struct("<4sIQI"), struct.Struct("<4sQ2H2I4Q")
CENTRAL, LOCAL = struct.Struct("<4s6H3I5H2I"), struct.Struct("<4s5H3I2H")


def ranged(file, at: int, size: int) -> bytes:
    file.seek(at)
    body = file.read(size)
    if len(body) != size:
        raise ValueError("the package ends too early")
    return body


def directory(file, size: int) -> list[Member]:
    """The members of a ZIP file by its central directory, ZIP64 or not; what stands before the first is passed over."""
    tail = ranged(file, max(0, size - EOCD.size - 0xFFFF), min(size, EOCD.size + 0xFFFF))
    at = len(tail) - EOCD.size
    while at >= 0 and not (tail[at : at + 4] == b"PK\x05\x06" and EOCD.unpack_from(tail, at)[7] == len(tail) - at - EOCD.size):
        at = tail.rfind(b"PK\x05\x06", 0, at + 3) if at else -1
    if at < 0:
        raise ValueError("not a ZIP file")
    *_, entries, length, start, _ = EOCD.unpack_from(tail, at)
    end = size - len(tail) + at
    if end >= LOCATOR.size and (locator := ranged(file, end - LOCATOR.size, LOCATOR.size)).startswith(b"PK\x06\x07"):
        # a file with something in front has its record right before the locator
        near = end - LOCATOR.size - EOCD64.size
        told = LOCATOR.unpack(locator)[2]
        end = next((x for x in (told, near) if 0 <= x <= near and ranged(file, x, 4) == b"PK\x06\x06"), -1)
        if end < 0:
            raise ValueError("the ZIP64 directory isn't where its locator says")
        *_, entries, length, start = EOCD64.unpack(ranged(file, end, EOCD64.size))
    shift = end - length - start  # bytes before the first member
    body, out, at = ranged(file, start + shift, length), [], 0
    for _ in range(entries):
        magic, _, _, flags, method, _, _, _, packed, full, n, extra, comment, _, _, _, header = CENTRAL.unpack_from(body, at)
        if magic != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        at += CENTRAL.size
        name = body[at : at + n].decode("utf-8" if flags & 0x800 else "cp437")
        full, packed, header = wide(body[at + n : at + n + extra], [full, packed, header])
        out.append(Member(name, method, bool(flags & 1), packed, header + shift))
        at += n + extra + comment
    return out


def wide(extra: bytes, values: list[int]) -> list[int]:
    """Values that stand in the ZIP64 field if they are too large for their own."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            more = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return [next(more) if v == 0xFFFFFFFF else v for v in values]
        at += 4 + n
    return values


def begin(file, member: Member) -> int:
    """Where a stored member's bytes begin; its local header may have other extra fields than the directory."""
    if member.method != zipfile.ZIP_STORED or member.encrypted:
        raise ValueError(f"{member.name} isn't stored")
    magic, *_, n, extra = LOCAL.unpack(ranged(file, member.header, LOCAL.size))
    if magic != b"PK\x03\x04":
        raise ValueError(f"{member.name} isn't where the directory says")
    return member.header + LOCAL.size + n + extra


def indexed(body: bytes) -> Iterator[tuple[str, int, int]]:
    """Archive, offset and length of the records that an index names."""
    for line in body.decode().splitlines():
        if line.strip():
            told = json.loads(line[line.index("{") :])
            yield told["filename"], int(told["offset"]), int(told["length"])


def scanned(file, start: int, size: int, step: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip member, found by inflating one after another."""
    at, first, rest, machine = 0, 0, b"", zlib.decompressobj(31)
    while at < size or rest:
        if not rest:
            rest = ranged(file, start + at, min(step, size - at))
            at += len(rest)
        machine.decompress(rest)
        rest = machine.unused_data
        if machine.eof:
            end = at - len(rest)
            yield first, end - first
            first, machine = end, zlib.decompressobj(31)
    if first != size:
        raise ValueError("the archive's last record isn't whole")


def located(uri: str, run: int) -> Iterator[dict]:
    """Runs of records that lie one after another: uri, at (in the package), sizes."""
    files, path = store(uri)
    with files.open_input_file(path) as file:
        members = directory(file, file.size())
        archives = {m.name.rpartition("/")[2]: (begin(file, m), m.size) for m in members if m.name.startswith("archive/") and not m.name.endswith("/")}
        found: dict[str, list[tuple[int, int]]] = {}
        for m in members:
            if m.name.startswith("indexes/") and m.name.endswith((".cdxj", ".cdx", ".cdx.gz", ".cdxj.gz")):
                body = ranged(file, begin(file, m), m.size)
                for name, offset, length in indexed(gzip.decompress(body) if m.name.endswith(".gz") else body):
                    found.setdefault(name, []).append((offset, length))
        for name, (start, size) in archives.items():
            own, total = [], 0
            for offset, length in sorted(found[name]) if name in found else scanned(file, start, size, run):
                if offset + length > size:
                    raise ValueError(f"the index of {name} names records beyond its end")
                if own and (total >= run or offset != own[-1][0] + own[-1][1]):
                    yield {"uri": uri, "at": start + own[0][0], "sizes": [n for _, n in own]}
                    own, total = [], 0
                own.append((offset, length))
                total += length
            if own:
                yield {"uri": uri, "at": start + own[0][0], "sizes": [n for _, n in own]}


# --- with Spark -------------------------------------------------------------


def marked(pages: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """page_id, url, payload, refers_to (null: a response).

    Rows meet one row for each payload that came more than once, which is written before, so that Spark splits a hot one.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    key = F.struct(F.octet_length(payload).alias("n"), F.sha1(payload.cast("binary")).alias("a"), F.sha2(payload.cast("binary"), 256).alias("b"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), key.alias("key"))
    company = rows.where(F.col("key.n") >= least).groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    company = scratch.table(company.select("key", "first"), "company")
    return rows.join(company, "key", "left").select("page_id", "url", "payload", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def write(pages: DataFrame, scratch: Scratch, params: WarcParams = WarcParams()) -> DataFrame:
    """Packages of all pages in the shared folder: uri, records, bytes."""
    root = scratch.path("packages")
    schema = pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches):
        package = None
        for batch in sliced(batches, 100):
            for page_id, url, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                package = package or Package(f"{root}/{uuid.uuid4().hex}.wacz")
                package.add(record(page_id, url, payload.encode(), refers_to, params.date), url, "response" if refers_to is None else "revisit")
                if package.at >= params.package_bytes or len(package.lines) >= params.package_records:
                    yield pa.RecordBatch.from_pylist([package.close()], schema=schema)
                    package = None
        if package:
            yield pa.RecordBatch.from_pylist([package.close()], schema=schema)

    return scratch.table(marked(pages, scratch, params.least).mapInArrow(run, "uri string, records long, bytes long"), "manifest")


def read_packages(packages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the packages (``uri``)."""
    runs = pa.schema([("uri", pa.string()), ("at", pa.int64()), ("sizes", pa.list_(pa.int64()))])
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def locate(batches):
        for batch in sliced(batches):
            for uri in batch.column("uri").to_pylist():
                for found in located(uri, params.run):
                    yield pa.RecordBatch.from_pylist([found], schema=runs)

    def fetch(batches):
        for batch in sliced(batches, 1):
            (found,) = batch.to_pylist()
            files, path = store(found["uri"])
            with files.open_input_file(path) as file:
                body, at, made = memoryview(ranged(file, found["at"], sum(found["sizes"]))), 0, []
            for size in found["sizes"]:
                made.append(Record.parse(gzip.decompress(body[at : at + size])).row())
                at += size
            yield pa.RecordBatch.from_pylist(made, schema=schema)

    parts = max(1, int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = packages.select("uri").repartition(parts).mapInArrow(locate, "uri string, at long, sizes array<long>").repartition(parts)
    return ranges.mapInArrow(fetch, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op11_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of an archive in a package, read back by ranges."""
    scratch = Scratch(spark, "warc")
    return read_packages(write(read(spark, sf_dir, "pages"), scratch))


def oracle() -> str:
    """The same in DuckDB's SQL; base32 from five hex digits at a time, which are four letters."""
    letters = "".join(f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((v >> {s}) & 31) + 1]" + (" || " if s else "") for s in (15, 10, 5, 0))
    value = " + ".join(f"(strpos('0123456789abcdef', hex[5 * g + {k + 1}]) - 1) * {16 ** (4 - k)}" for k in range(5))
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h),
        d AS (SELECT h, first, sha1(h) AS hex FROM f)
        SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, array_to_string(list_transform(list_transform(range(8), lambda g: CAST({value} AS BIGINT)), lambda v: {letters}), '') AS payload_digest,
          CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN d ON p.h = d.h"""
