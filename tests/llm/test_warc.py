import base64
import hashlib
import io
import json
import struct
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyarrow import fs

from cartflow.llm import warc
from cartflow.llm.common import located, table
from llm_help import SF_SMALL

SCHEMA = "page_id long, url string, html string, payload int, package string, refers_to string, _key int"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, t, 1, "x", "y", 2) for i, u, t in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, min_bytes=0):
    least = {}
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, _, t in rows:
        size = len((t or "").encode())
        first = least.get(t or "") if size >= min_bytes else None
        revisit = first is not None and i != first
        out.append((i, size, digest(t), "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


def found(spark, rows, folder, min_bytes=0):
    got = warc.round_trip(frame(spark, rows), str(folder), min_bytes).collect()
    assert all(r.intact for r in got)
    return sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)


ODD = [
    (1, "https://a.example/x?q=1", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "no scheme", None), (4, "", ""),
    (None, "http://b.example/\r\nInjected: 1", "<p>one</p>"), (None, "http://c", "alone"), (None, "http://d", "alone"),
    (7, "http://[bad", "é\r\n\r\nWARC/1.1 in the text\x00"), (8, "http://ü.example/ä b", "x" * 3_000_000), (8, "http://e", "x" * 3_000_000),
    (9, "http://f", "<p>one</p>"), (9, "http://f", "<p>one</p>"), (1, "https://a.example/x?q=1", "<p>one</p>"),
]


def test_pages(spark, tmp_path):
    rows = [(r.page_id, r.url, r.html) for r in table(spark, SF_SMALL, "pages").collect()]
    assert found(spark, rows, tmp_path / "a") == brute(rows)
    assert not (tmp_path / "a").exists()


def test_odd_rows(spark, tmp_path):
    assert found(spark, ODD, tmp_path / "a") == brute(ODD)
    assert found(spark, ODD, tmp_path / "b", min_bytes=11) == brute(ODD, 11)
    assert found(spark, [], tmp_path / "c") == []


def test_hot_payload_and_many_groups(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h{i % 7}.example/{i}", "hot" if i % 3 == 0 else f"page {i // 2}") for i in range(600)]
    assert found(spark, rows, tmp_path / "a") == brute(rows)
    monkeypatch.setattr(warc, "HOT_SHARE", 5)  # only the hot payload is broadcast, pairs are joined by a shuffle
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", 0)
    assert found(spark, rows, tmp_path / "b") == brute(rows)


def test_packages_follow_the_formats(spark, tmp_path):
    """Another ZIP reader, and gzip and headers by hand, see what was written."""
    rows = ODD[:4] + ODD[7:9]
    packages = warc.write_packages(warc.captures(frame(spark, rows)), str(tmp_path / "p"))
    names = [r.package for r in packages.collect()]
    seen = {}
    for name in names:
        with zipfile.ZipFile(name) as z:
            assert z.testzip() is None
            assert z.namelist() == [warc.ARCHIVE, warc.INDEX, warc.PACKAGE]
            assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            data, lines = z.read(warc.ARCHIVE), z.read(warc.INDEX).decode().splitlines()
            assert lines == sorted(lines) and json.loads(z.read(warc.PACKAGE))["resources"]
        for line in lines:
            told = json.loads(line.split(" ", 2)[2])
            raw = zlib.decompress(data[int(told["offset"]) :][: int(told["length"])], 31)
            head = warc.headers(raw.partition(b"\r\n\r\n")[0])
            assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
            seen[head["warc-record-id"]] = head
    assert len(seen) == len({r[0] for r in rows}) and sum(r.records for r in packages.collect()) == len(rows)
    for head in seen.values():
        if head["warc-type"] == "revisit":
            assert seen[head["warc-refers-to"]]["warc-type"] == "response"
            assert seen[head["warc-refers-to"]]["warc-payload-digest"] == head["warc-payload-digest"]
    # Nothing is lost: payloads come back, those of revisits by way of their responses.
    back = warc.resolved(warc.read_packages(packages, payloads=True)).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in back) == sorted((str(i), t or "") for i, _, t in rows)
    urls = {r.page_id: r.url for r in back}
    assert urls["1"] == ODD[0][1] and urls["2"] is None and "\n" not in "".join(u or "" for u in urls.values())


def test_small_packages_and_runs(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h{i % 5}.example/{i}", f"text {i} " * (i % 40)) for i in range(200)]
    monkeypatch.setattr(warc, "PACKAGE_RECORDS", 7)
    monkeypatch.setattr(warc, "RUN_BYTES", 600)
    packages = warc.write_packages(warc.captures(frame(spark, rows)), str(tmp_path / "p"))
    assert packages.count() >= 200 // 7
    got = warc.read_packages(packages)
    assert sorted(str((int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to))) for r in got.collect()) == brute(rows)


def opened(data):
    return pa.PythonFile(io.BytesIO(data), mode="r")


def zipped(items, comment=b"", kind=zipfile.ZIP_STORED, wide=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", kind) as z:
        for name, data in items:
            with z.open(name, "w", force_zip64=wide) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("before", [b"", b"#!/bin/sh\n" * 9])
def test_directory_agrees_with_another_reader(wide, before):
    items = [("archive/é.warc", b"abc" * 50), ("empty", b""), ("indexes/index.cdxj", b"k 1 {}\n")]
    data = before + zipped(items, b"a comment with PK\x05\x06 inside it", wide=wide)
    file = opened(data)
    found = warc.members(file)
    assert list(found) == [n for n, _ in items]
    for name, raw in items:
        begin = warc.begin_of(file, found[name])
        assert data[begin : begin + found[name].size] == raw


def test_zip64_beyond_four_gigabytes(tmp_path):
    """A package after 5 GB of hole (a sparse file), whose places need 64 bits, and one
    of 70,000 members, whose count does."""
    path = tmp_path / "far.zip"
    raw = [warc.record(str(i), None, f"text {i}".encode(), None, False)[1] for i in range(3)]
    places, lines = 0, []
    for r in raw:
        lines.append(f'k 1 {{"filename": "data.warc", "offset": "{places}", "length": "{len(r)}"}}\n')
        places += len(r)
    with open(path, "wb") as f:
        f.seek(5 << 30)
        with zipfile.ZipFile(f, "w") as z:
            z.writestr("archive/data.warc", b"".join(raw))
            z.writestr("indexes/index.cdxj", "".join(lines))
    with fs.LocalFileSystem().open_input_file(str(path)) as file:
        assert warc.members(file)["archive/data.warc"].header == 5 << 30
        runs = list(warc.record_runs(file))
        assert len(runs) == 1 and runs[0][1] == [len(r) for r in raw]
        whole = file.read_at(places, runs[0][0])
    assert whole == b"".join(raw) and warc.read_record(raw[1])["payload"] == b"text 1"
    many = zipped([(f"m{i}", b"") for i in range(70_000)])
    assert len(warc.members(opened(many))) == 70_000


def test_faulty_packages():
    for data, says in [
        (b"", "not a ZIP"), (b"x" * 100, "not a ZIP"), (zipped([("a", b"1")])[:-30], "not a ZIP"),
        (b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0, 0, 0), "missing"),
        (b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 1, 1, 99, 5, 0), "outside"),
        (b"\0" * 46 + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 1, 1, 46, 0, 0), "cut short"),
    ]:
        with pytest.raises(ValueError, match=says):
            warc.members(opened(data))
    packed = opened(zipped([("archive/a.warc", b"1" * 99)], kind=zipfile.ZIP_DEFLATED))
    with pytest.raises(ValueError, match="not stored"):
        warc.begin_of(packed, warc.members(packed)["archive/a.warc"])
    lost = opened(zipped([("indexes/i.cdxj", b'k 1 {"filename": "none", "offset": "0", "length": "1"}')]))
    with pytest.raises(ValueError, match="not in the package"):
        list(warc.record_runs(lost))
    with pytest.raises(ValueError, match="not a WARC"):
        warc.read_record(b"HTTP/1.1 200 OK\r\n\r\n")
    broken = warc.read_record(warc.record("1", None, b"good", None, False)[1].replace(b"good", b"evil"))
    assert not broken["intact"]


def test_addresses():
    assert located("file:/a/b")[1] == "/a/b" and located("file:///a/b")[1] == "/a/b" and located("/a/b")[1] == "/a/b"
    assert warc.sort_key("https://Www.Example.com/a b?q") == "com,example,www)/a%20b?q"
    assert warc.sort_key(None) and warc.sort_key("http://[bad")
