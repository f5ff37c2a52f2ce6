"""Packages of web archives: against Python's own ZIP and gzip readers, hand-made files, and SQL."""

import base64
import gzip
import hashlib
import io
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from storyloom.llm import warc
from storyloom.llm.common import Scratch
from storyloom.llm.queries import ORACLES

KIND = "page_id long, url string, html string"
ODD = [(0, "http://a/", "<p>same</p>"), (7, None, "<p>same</p>"), (3, "http://b/\r\nX: y z", "<p>same</p>"), (1, "u", None), (2, "", ""), (4, "é", "é🙂\r\n\r\nWARC/1.1\r\n\r\n"), (5, "x", "x" * 300_000), (None, "n", "<p>same</p>"), (None, None, None), (6, "r", "one"), (6, "r", "one"), (-9, "m", "x")]


def many(seed=1, n=400):
    rng = random.Random(seed)
    return [(100 + i, f"http://h/{i}", rng.choice(["hot", f"page {i}", f"pair {i // 2}"]) + " text" * rng.randrange(50)) for i in range(n)]


def plain(rows):
    first: dict = {}
    for d, _, h in rows:
        if d is not None:
            first[h or ""] = min(d, first.get(h or "", d))
    out = []
    for d, _, h in rows:
        body = (h or "").encode()
        to = first.get(h or "")
        refers = to if d is not None and to != d else None
        out.append((d, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("params", [warc.WarcParams(), warc.WarcParams(package_bytes=1, run=1), warc.WarcParams(package_records=7, run=300)])
def test_pages_come_back(spark, params):
    rows = ODD + many()
    pages = spark.createDataFrame(rows, KIND).withColumns({c: F.lit("own") for c in ("key", "payload", "first", "n", "refers_to")}).repartition(3)
    scratch = Scratch(spark, "test")
    packages = warc.write(pages, scratch, params)
    got = warc.read_packages(packages, params)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)
    # any ZIP reader sees stored members, and any gzip reader the records
    count = 0
    for p in packages.collect():
        files, path = warc.store(p["uri"])
        with zipfile.ZipFile(path) as z:
            assert {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED} and z.testzip() is None
            text = gzip.decompress(z.read(warc.ARCHIVE))
            assert len(z.read(warc.INDEX).splitlines()) == p["records"]
            count += text.count(b"\r\nWARC-Record-ID: ")
    assert count == len(rows)


def test_short_payloads_are_all_responses(spark):
    rows = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")], KIND)
    got = warc.read_packages(warc.write(rows, Scratch(spark, "test"), warc.WarcParams(least=4))).collect()
    assert sorted((r["page_id"], r["refers_to"]) for r in got) == [(1, None), (2, None), (3, None), (4, 3)]


def package(monkeypatch=None, limit=None, front=b"", comment=b"", index=True, method=zipfile.ZIP_STORED, raw=None):
    """A hand-made package of three records, by Python's own writer; below its ``limit`` as ZIP64."""
    if limit is not None:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    out = io.BytesIO()
    out.write(front)
    records = [gzip.compress(warc.record(i, "u", b"p" * i, None, "2000-01-01T00:00:00Z")) for i in (1, 2, 300)]
    with zipfile.ZipFile(out, "a" if front else "w", method) as z:
        z.writestr("readme.txt", "x" * 50)
        z.writestr("archive/a.warc.gz", raw if raw is not None else b"".join(records))
        if index:
            at = [0, len(records[0]), len(records[0]) + len(records[1])]
            z.writestr("indexes/index.cdx.gz", gzip.compress("".join(f'k 2000 {{"offset": "{a}", "length": "{len(r)}", "filename": "a.warc.gz"}}\n' for a, r in reversed(list(zip(at, records)))).encode()))
        z.comment = comment
    if limit is not None:
        monkeypatch.undo()
    return out.getvalue()


def found(tmp_path, body, run=1 << 20):
    path = tmp_path / "p.wacz"
    path.write_bytes(body)
    rows = []
    for r in warc.located(f"file://{path}", run):
        at = r["at"]
        for n in r["sizes"]:
            rows.append(warc.Record.parse(gzip.decompress(body[at : at + n])).row()["payload_bytes"])
            at += n
    return rows


@pytest.mark.parametrize("index", [True, False])
@pytest.mark.parametrize("limit", [None, 10])
@pytest.mark.parametrize(("front", "comment"), [(b"", b""), (b"#!stub\n" * 30, b"PK\x05\x06 in the comment" * 9), (b"", b"c" * 65535)])
def test_directories(tmp_path, monkeypatch, index, limit, front, comment):
    body = package(monkeypatch, limit, front, comment, index)
    assert (b"PK\x06\x06" in body) == (limit is not None)
    for run in (1, 100, 1 << 20):
        assert found(tmp_path, body, run) == [1, 2, 300]
    if b"PK" in comment:  # which Python's own reader doesn't read
        return
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        members = warc.directory(io.BytesIO(body), len(body))
        assert [(m.name, m.size, m.header) for m in members] == [(i.filename, i.compress_size, i.header_offset) for i in z.infolist()]


def test_damage_is_told(tmp_path):
    with pytest.raises(ValueError, match="not a ZIP"):
        found(tmp_path, b"nothing at all")
    with pytest.raises(ValueError, match="isn't stored"):
        found(tmp_path, package(method=zipfile.ZIP_DEFLATED))
    with pytest.raises(ValueError, match="isn't whole"):
        found(tmp_path, package(index=False, raw=gzip.compress(b"x" * 100)[:-9]))
    with pytest.raises(ValueError, match="beyond its end"):
        found(tmp_path, package(raw=gzip.compress(b"short")))
    whole = warc.record(1, "u", b"payload", None, "2000-01-01T00:00:00Z")
    for raw, what in ((whole.replace(b"payload", b"pay1oad"), "damaged"), (whole[:-3], "length"), (b"x", "not a WARC")):
        with pytest.raises(ValueError, match=what):
            warc.Record.parse(raw).row()
    assert found(tmp_path, package(index=False, raw=b"")) == []


def test_archive_query(spark, tmp_path):
    rows = [r for r in ODD + many(2) if r[0] is not None and r[0] != 6]
    for name, some in (("all", rows), ("none", [])):
        spark.createDataFrame(some, KIND).write.parquet(str(tmp_path / name / "pages.parquet"))
        got = warc.op11_web_archives(spark, str(tmp_path / name))
        c = duckdb.connect()
        c.sql(f"create view pages as select * from '{tmp_path / name}/pages.parquet/*.parquet'")
        want = c.sql(ORACLES["op11_web_archives"])
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall())) and got.columns == want.columns
        assert sorted(map(repr, want.fetchall())) == sorted(map(repr, plain(some)))
