"""WARC records in ZIP packages: writing captures, and range-reading them in place.

Writing: equal payloads are found by their SHA-256 (partially aggregated; the groups
with a thousandth of all rows, a thousand at most, are broadcast, others joined by size), the
page with the smallest id is the response and the others revisit it.  Every task
packs its rows into packages: a ZIP file with a stored member ``archive/data.warc.gz``
(each record a gzip member of its own), a stored index ``indexes/index.cdxj`` (sorted
by reversed host) and ``datapackage.json``.  A package has a name of its own for each
attempt; the table of packages holds those of the tasks that ended well, so what a lost
executor left is never read.

Reading: a package is opened at its end.  The end record, the ZIP64 locator and record
and the central directory give the members; the local header gives where a stored
member's bytes begin; the index gives each record's place in it.  Runs of neighbouring
records become rows of a table that is dealt to all tasks anew, and each task reads its
runs by range.  No member is extracted and no package read whole.

Files are reached through ``pyarrow.fs`` by the folder's address (file, hdfs, s3, gs,
abfs), from tasks and driver alike.

Defined results: a null payload is empty; rows without id come last, revisit the
smallest id of their payload where there is one, and are responses else; rows that
repeat a response's id and payload are that capture again, and responses too; addresses
have control characters and blanks escaped in the records, a null one is left out; an
empty table gives no package and no record; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import cut, located, remove, small

ARCHIVE, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
#: A package is closed at so many bytes of records, or so many records.
PACKAGE_BYTES, PACKAGE_RECORDS = 256 << 20, 100_000
#: Bytes of a range read, and of records read before they are handed on.
RUN_BYTES = 4 << 20
#: Payload groups that are sent to all tasks besides the hot ones; more are joined by a shuffle.
BROADCAST_GROUPS = 200_000
#: A payload with this share of all rows is hot: there are 1,000 of them at most.
HOT_SHARE = 1000
#: Date of the records, as pages have none.
CAPTURED = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Records


def record_id(page_id: str | None, digest: str) -> str:
    """The same for every capture of a page; of the payload for rows without id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}' if page_id is not None else f'payload:{digest}')}>"


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> tuple[str, bytes]:
    """Payload digest and bytes of a response record, or of a revisit, which has the
    HTTP headers only."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quoted(url)}")
    head += [f"WARC-Date: {CAPTURED}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return digest, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def quoted(url: str) -> str:
    """The address without blanks and control characters, which would end a header."""
    return "".join(quote(c) if c <= " " or c == "\x7f" else c for c in url)


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if v}


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/") or not mark:
        raise ValueError("not a WARC record")
    told = headers(head)
    return told, rest[: int(told["content-length"])]


def sort_key(url: str | None) -> str:
    """Reversed host, then path and query: what the index is ordered by."""
    try:
        at = urlsplit(url or "")
        host = ",".join(reversed((at.hostname or "").split(".")))
    except ValueError:
        return quoted(url or "").lower() or "-"
    return quoted(f"{host}){at.path or '/'}{'?' + at.query if at.query else ''}".lower())


class PackageWriter:
    """One ZIP package, written from front to back (the store need not seek)."""

    def __init__(self, folder: str):
        store, base = located(folder)
        name = f"{uuid.uuid4().hex}.wacz"
        self.address, self.size, self.entries = f"{folder}/{name}", 0, []
        store.create_dir(base, recursive=True)
        self._file = store.open_output_stream(f"{base}/{name}")
        self._zip = zipfile.ZipFile(self._file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self._archive = self._zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> None:
        digest, raw = record(page_id, url, payload, refers_to, revisit)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(raw) + packer.flush()
        told = {"url": url, "mime": "warc/revisit" if revisit else "text/html", "status": "200", "digest": f"sha1:{digest}",
                "length": str(len(packed)), "offset": str(self.size), "filename": ARCHIVE.rpartition("/")[2]}
        self.entries.append(f"{sort_key(url)} {CAPTURED.translate({ord(c): None for c in '-:TZ'})} {json.dumps(told)}\n")
        self._archive.write(packed)
        self.size += len(packed)

    @property
    def full(self) -> bool:
        return self.size >= PACKAGE_BYTES or len(self.entries) >= PACKAGE_RECORDS

    def close(self) -> tuple[str, int, int]:
        """Address, records and bytes of records of the closed package."""
        self._archive.close()
        with self._zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            for line in sorted(self.entries):
                index.write(line.encode())
        resources = [{"name": n.rpartition("/")[2], "path": n} for n in (ARCHIVE, INDEX)]
        self._zip.writestr(zipfile.ZipInfo(PACKAGE), json.dumps({"profile": "data-package", "resources": resources}))
        self._zip.close()
        self._file.close()
        return self.address, len(self.entries), self.size


def captures(pages: DataFrame, min_bytes: int = 0, content: str = "html") -> DataFrame:
    """page_id, url, payload and refers_to (the smallest page_id of an equal payload of
    ``min_bytes`` bytes or more, null for a payload that has no other)."""
    payload = F.coalesce(F.col(content).cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("_key", F.unhex(F.sha2("payload", 256)))
    long = rows.where(F.octet_length("payload") >= min_bytes)
    groups = cut(
        long.groupBy("_key").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    )
    is_hot = F.col("_n") * HOT_SHARE >= pages.count()
    hot = groups.where(is_hot).select("_key", F.col("refers_to").alias("_hot"), F.lit(True).alias("_is_hot"))
    cold = groups.where(~is_hot).select(F.col("_key").alias("_of"), F.col("refers_to").alias("_cold"))
    rows = rows.join(F.broadcast(hot), "_key", "left")
    # Rows of hot payloads meet no cold group; by their own id they spread over all tasks.
    apart = F.when(F.col("_is_hot"), F.xxhash64("page_id", "url").cast("string").cast("binary")).otherwise(F.col("_key"))
    rows = rows.withColumn("_at", apart).join(small(cold, BROADCAST_GROUPS), F.col("_at") == F.col("_of"), "left")
    return rows.select("page_id", "url", "payload", F.coalesce("_hot", "_cold").alias("refers_to"))


def write_packages(captured: DataFrame, folder: str) -> DataFrame:
    """Pack ``captures`` rows into ZIP packages under ``folder``; returns the table of
    packages (package, records, bytes), which lies there too."""

    def pack(batches):
        out, told = None, []
        for batch in batches:
            ids, urls, payloads, refers = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                own, of = ids[i].as_py(), refers[i].as_py()
                out = out or PackageWriter(folder)
                out.add(own, urls[i].as_py(), payloads[i].as_py(), of, of is not None and of != own)
                if out.full:
                    told.append(out.close())
                    out = None
        if out:
            told.append(out.close())
        if told:
            names = ["package", "records", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*told, strict=True)], names)

    rows = captured.select(
        F.col("page_id").cast("string"), F.col("url").cast("string"), "payload", F.col("refers_to").cast("string")
    )
    path = f"{folder}/packages"
    rows.mapInArrow(pack, "package string, records long, bytes long").write.parquet(path)
    return captured.sparkSession.read.parquet(path)


# Reading in place


@dataclass
class Member:
    """A member of a ZIP file: where its local header begins, and its stored size."""

    name: str
    header: int
    size: int
    packed: int
    method: int
    flags: int


_END, _LOCATOR, _END64 = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


def members(file: pa.NativeFile) -> dict[str, Member]:
    """The central directory of a ZIP file, by way of its end records."""
    size = file.size()
    tail_at = max(0, size - 22 - _FULL16)
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)  # these bytes stood in a comment
    if at < 0:
        raise ValueError("no end record: not a ZIP file")
    _, _, _, count, length, begin, _ = struct.unpack_from("<HHHHIIH", tail, at + 4)
    end = tail_at + at
    locator = file.read_at(20, end - 20) if end >= 20 else b""
    if locator[:4] == _LOCATOR:
        where = struct.unpack_from("<Q", locator, 8)[0]
        record64 = file.read_at(56, where)
        if record64[:4] != _END64:  # bytes were put before the archive
            where = end - 20 - 56
            record64 = file.read_at(56, where)
        if record64[:4] != _END64:
            raise ValueError("the ZIP64 locator leads to no ZIP64 end record")
        count, length, begin = struct.unpack_from("<QQQ", record64, 32)
        end = where
    elif count == _FULL16 or _FULL32 in (length, begin):
        raise ValueError("a ZIP64 end record is named but missing")
    shift = end - length - begin
    if shift < 0:
        raise ValueError("the central directory lies outside the file")
    found, raw, at = {}, file.read_at(length, begin + shift), 0
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is cut short")
        (flags, method, _, _, _, packed, plain, n_name, n_extra, n_comment, _, _, _, header) = struct.unpack_from(
            "<HHHHIIIHHHHHII", raw, at + 8
        )
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, header = _wide(extra, plain, packed, header)
        name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        found[name] = Member(name, header + shift, plain, packed, method, flags)
        at += 46 + n_name + n_extra + n_comment
    return found


def _wide(extra: bytes, *fields: int) -> list[int]:
    """Fields whose 32 bits are full are in the ZIP64 extra field, in this order."""
    out, at = list(fields), 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            place = at + 4
            for i, value in enumerate(out):
                if value == _FULL32:
                    if place + 8 > at + 4 + length:
                        raise ValueError("a ZIP64 field is missing")
                    out[i] = struct.unpack_from("<Q", extra, place)[0]
                    place += 8
            return out
        at += 4 + length
    if _FULL32 in out:
        raise ValueError("a ZIP64 field is missing")
    return out


def begin_of(file: pa.NativeFile, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0 or member.flags & 1 or member.size != member.packed:
        raise ValueError(f"{member.name} is not stored: its records cannot be read by range")
    head = file.read_at(30, member.header)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"{member.name} has no local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n_name + n_extra


def index_lines(file: pa.NativeFile, member: Member, step: int = RUN_BYTES) -> Iterator[dict]:
    """The entries of a stored index, read piece by piece."""
    begin, at, rest = begin_of(file, member), 0, b""
    while at < member.size:
        piece = file.read_at(min(step, member.size - at), begin + at)
        if not piece:
            raise ValueError(f"{member.name} is cut short")
        at += len(piece)
        *lines, rest = (rest + piece).split(b"\n")
        yield from (json.loads(line.split(b" ", 2)[2]) for line in lines if line.strip())
    if rest.strip():
        yield json.loads(rest.split(b" ", 2)[2])


def record_runs(file: pa.NativeFile, limit: int = RUN_BYTES) -> Iterator[tuple[int, list[int]]]:
    """(place in the file, lengths of neighbouring records): a range read each, of
    ``limit`` bytes at most or one record."""
    found = members(file)
    archives = {n.rpartition("/")[2]: begin_of(file, m) for n, m in found.items() if n.startswith("archive/") and m.size}
    places = []
    for name, member in found.items():
        if name.startswith("indexes/") and name.endswith(".cdxj"):
            for told in index_lines(file, member):
                if told["filename"] not in archives:
                    raise ValueError(f"{name} names {told['filename']}, which is not in the package")
                places.append((archives[told["filename"]] + int(told["offset"]), int(told["length"])))
    begin, end, lengths = 0, -1, []
    for at, length in sorted(set(places)):
        if lengths and (at != end or end + length - begin > limit):
            yield begin, lengths
            lengths = []
        if not lengths:
            begin = at
        lengths.append(length)
        end = at + length
    if lengths:
        yield begin, lengths


def read_record(raw: bytes) -> dict:
    """What a stored record says, its payload checked against its digest."""
    told, block = parsed(zlib.decompress(raw, 31) if raw[:2] == b"\x1f\x8b" else raw)
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = told.get("warc-type"), told.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = kind == "revisit"
    stated = int(headers(head).get("content-length", len(payload)))
    return {
        "page_id": told.get("page-id"),
        "url": told.get("warc-target-uri"),
        "record_type": kind,
        "payload_bytes": stated if revisit else len(payload),
        "payload_digest": digest if revisit else base32_sha1(payload),
        "refers_to": told.get("refers-to-page-id"),
        "intact": revisit or (digest == base32_sha1(payload) and stated == len(payload)),
        "payload": None if revisit else payload,
    }


_RECORD = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, intact boolean"


def read_packages(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the packages: page_id, url, record_type, payload_bytes and
    payload_digest (of the full payload), refers_to, intact, and with ``payloads`` the
    payload (null for a revisit)."""

    def plan(batches):
        for batch in batches:
            for address in batch.column(0).to_pylist():
                store, path = located(address)
                with store.open_input_file(path) as file:
                    for begin, lengths in record_runs(file):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([address]), pa.array([begin]), pa.array([lengths], pa.list_(pa.int64()))],
                            ["package", "begin", "lengths"],
                        )

    fields = [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("refers_to", pa.string()), ("intact", pa.bool_())]
    schema = pa.schema(fields + ([("payload", pa.binary())] if payloads else []))

    def read(batches):
        for batch in batches:
            for address, begin, lengths in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                store, path = located(address)
                with store.open_input_file(path) as file:
                    raw = file.read_at(sum(lengths), begin)
                at, held, size = 0, [], 0
                for length in lengths:
                    held.append(read_record(raw[at : at + length]))
                    at += length
                    size += 512 + held[-1]["payload_bytes"]
                    if size >= RUN_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    spark = packages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = packages.select("package").mapInArrow(plan, "package string, begin long, lengths array<long>")
    return runs.repartition(parts, "package", "begin").mapInArrow(read, _RECORD + (", payload binary" if payloads else ""))


def resolved(records: DataFrame) -> DataFrame:
    """``read_packages`` rows (with payloads) whose revisits have the payload of the
    response they refer to; the adaptive join splits a response that many revisit."""
    kept = records.where("record_type <> 'revisit'")
    answers = kept.select(F.col("page_id").alias("_of"), F.col("payload").alias("_payload")).dropDuplicates(["_of"])
    again = records.where("record_type = 'revisit'").join(answers, F.col("refers_to") == F.col("_of"), "left")
    return kept.unionByName(again.withColumn("payload", F.col("_payload")).select(*kept.columns))


def round_trip(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as packages under ``folder``, read them back (computed once) and
    delete them; ids have the type of the pages' ids."""
    kind = pages.schema["page_id"].dataType
    rows = read_packages(write_packages(captures(pages, min_bytes), folder))
    rows = cut(rows.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")}))
    remove(folder)
    return rows
