"""WARC records in ZIP packages: writing, and reading by ranges without extraction.

A package is a ZIP archive with stored members below ``archive/`` (WARC records, plain or each
a gzip member of its own) and indexes below ``indexes/``. The reader parses the end record, the
ZIP64 records and the central directory, finds all members of either kind, checks the local
header of each to find its bytes, reads the indexes (CDXJ, or CDX with or without its legend,
also compressed), and then reads each record by its range. A member that no index line names is
read record by record. Nothing is unpacked as a whole. Written packages have one member and
one sorted CDXJ index. Packages of others may have records of other types, headers in any case
and any digest; a payload is checked against a SHA-1 of its own, unless it is encoded.

Tasks write packages of bounded size to a folder that all executors share, under names of
their own; a package counts only if the manifest of the finished job lists it, so a task that
is lost or run twice leaves files that nobody reads. Readers get the manifest's paths.

Equal payloads of at least ``LEAST`` bytes are written once, as the response with the
largest id; the other records are revisits that refer to it. Smaller ones are all
responses. Null payloads are empty. Rows that repeat an id are records of their own: all
rows of the largest id are responses. A null id is smaller than any other. Payloads of any
length are whole records; an empty table gives an empty manifest, and that no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docintake.session import cut, ensure_checkpoint_dir

LEAST = 1000
PACKAGE_BYTES = 32 << 20
PACKAGE_RECORDS = 20_000
READ_TASKS = 10_000  # packages beyond that share tasks
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_DATE = "2000-01-01T00:00:00Z"  # pages have no time of their own


def _open(path: str):
    """File system and path; any store that Arrow knows, or a plain path."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


# --- reading ZIP archives -----------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header is


def _at(source, start: int, length: int) -> bytes:
    source.seek(start)
    found = source.read(length)
    if len(found) != length:
        raise ValueError("the archive is cut short")
    return found


def members(source, size: int) -> list[Member]:
    """Members that the central directory lists; ``source`` has seek and read."""
    tail_at = max(0, size - 22 - 65535)  # the end record, before a comment
    tail = _at(source, tail_at, size - tail_at)
    end = len(tail) - 22
    while end >= 0:
        end = tail.rfind(b"PK\x05\x06", 0, end + 4)
        if end < 0 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
        end -= 1
    if end < 0:
        raise ValueError("no end record: not a ZIP archive")
    total, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == total or 0xFFFFFFFF in (length, start):
        locator = _at(source, tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = _at(source, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        total, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = _at(source, start, length), 0, []
    for _ in range(total):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name]
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        wide = [v == 0xFFFFFFFF for v in (plain, stored, header)]
        plain, stored, header = _zip64(extra, [plain, stored, header], wide)
        out.append(Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, stored, header))
        at += 46 + n_name + n_extra + n_comment
    return out


def _zip64(extra: bytes, values: list[int], wide: list[bool]) -> list[int]:
    """``values`` with those that are too wide for 32 bits from the ZIP64 extra field."""
    at = 0
    while any(wide) and at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            numbers = iter(struct.unpack_from(f"<{sum(wide)}Q", extra, at + 4))
            return [next(numbers) if w else v for v, w in zip(values, wide)]
        at += 4 + length
    return values


def stored_range(source, member: Member) -> tuple[int, int]:
    """Where the bytes of a stored member begin, and how many they are."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; ranges need a stored member")
    return _member_range(source, member)


def _member_range(source, member: Member) -> tuple[int, int]:
    header = _at(source, member.header, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    n_name, n_extra = struct.unpack_from("<HH", header, 26)
    return member.header + 30 + n_name + n_extra, member.size


# --- records ------------------------------------------------------------------------


@dataclass
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _head(fields: list[tuple[str, str]], first: str) -> bytes:
    lines = [first, *(f"{k}: {_one_line(v)}" for k, v in fields)]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(id_: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record as a gzip member; a revisit keeps the HTTP head, not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = _head(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))],
        "HTTP/1.1 200 OK",
    )
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{id_}>"),
        ("WARC-Date", _DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    if refers_to is not None:
        fields += [
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    fields.append(("Content-Length", str(len(block))))
    return gzip.compress(_head(fields, "WARC/1.1") + block + b"\r\n\r\n", 1, mtime=0)


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on the one before."""
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")[1:]:
        name, colon, value = line.partition(":")
        if line[:1] in (" ", "\t") and last is not None:
            out[last] += " " + line.strip()
        elif colon:
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _split(data: bytes) -> tuple[bytes, bytes]:
    """Header and what comes after its empty line."""
    ends = [(at, len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if (at := data.find(mark)) >= 0]
    at, size = min(ends, default=(len(data), 0))
    return data[:at], data[at + size :]


def parse_record(raw: bytes) -> Record:
    """A record, plain or as a gzip member. Only HTTP messages have a header of their own."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    head, rest = _split(data)
    headers = _fields(head)
    block = rest[: int(headers["content-length"])]
    if headers.get("content-type", "").startswith("application/http"):
        http, payload = _split(block)
        return Record(headers, _fields(http), payload)
    return Record(headers, {}, block)


def walk(source, begin: int, size: int) -> Iterator[bytes]:
    """Records of a member one after the other, without an index."""
    at, end, held = begin, begin + size, b""

    def more() -> bytes:
        nonlocal at
        part = _at(source, at, min(1 << 20, end - at))
        at += len(part)
        return part

    while held or at < end:
        held = held or more()
        if held[:2] == b"\x1f\x8b":
            unzip, out = zlib.decompressobj(31), []
            while not unzip.eof:
                out.append(unzip.decompress(held or more()))
                held = unzip.unused_data
            yield b"".join(out)
            continue
        held = held.lstrip(b"\r\n")
        if not held:
            continue
        while len(_split(held)[0]) == len(held) and at < end:
            held += more()
        head, rest = _split(held)
        need = len(held) - len(rest) + int(_fields(head)["content-length"])
        while len(held) < need:
            held += more()
        yield held[:need]
        held = held[need:]


def index_entries(text: bytes) -> Iterator[tuple[str | None, int, int]]:
    """File name (None: not said), offset and length of each line of a CDXJ or CDX index."""
    legend = "N b a m s k r M S V g".split()  # the usual columns
    for line in text.decode("utf-8", "replace").split("\n"):
        brace, parts = line.find("{"), line.split()
        if brace >= 0:
            entry = json.loads(line[brace:])
            if "offset" in entry:
                yield entry.get("filename"), int(entry["offset"]), int(entry["length"])
        elif parts[:1] == ["CDX"]:
            legend = parts[1:]
        elif parts:
            entry = dict(zip(legend, parts))
            yield entry.get("g"), int(entry["V"]), int(entry["S"])


# --- packages -----------------------------------------------------------------------


def index_key(url: str | None) -> str:
    """Sort key of an index line: the host from its end on, then the path."""
    scheme, mark, rest = (url or "").partition("://")
    if not mark:
        return "-"
    host = re.match("[^/?#]*", rest).group()
    key = ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :]
    return re.sub(r"[\s{}]", lambda m: "%" + m.group().encode().hex(), key)


class _Package:
    """A package that is being written; its index is kept until it is closed."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = _open(self.path)
        self.stream = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, id_: str, url: str | None, raw: bytes) -> None:
        entry = {"url": url, "offset": str(self.size), "length": str(len(raw)), "filename": DATA.split("/")[1]}
        stamp = "".join(c for c in _DATE if c.isdigit())
        self.index.append(f"{index_key(url)} {stamp} {json.dumps(entry)}")
        self.data.write(raw)
        self.size += len(raw)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(INDEX, "".join(line + "\n" for line in sorted(self.index)))
        self.zip.close()
        size = self.stream.tell()
        self.stream.close()
        return self.path, size, len(self.index)


def _write_batches(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            columns = (batch.column(c) for c in ("id", "url", "payload", "refers_to"))
            for id_, url, payload, refers_to in zip(*columns):
                if package is None:
                    package = _Package(folder)
                raw = record_bytes(
                    id_.as_py(), url.as_py(), payload.as_py() or b"", refers_to.as_py()
                )
                package.add(id_.as_py(), url.as_py(), raw)
                if package.size >= PACKAGE_BYTES or len(package.index) >= PACKAGE_RECORDS:
                    done.append(package.close())
                    package = None
        if package is not None:
            done.append(package.close())
        if done:
            kinds = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*done), kinds)],
                ["path", "size", "records"],
            )

    return run


def write_packages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``page_id, url, html`` as packages; the manifest: path, size, records."""
    if folder is None:
        folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"),
        F.col("page_id").cast("string").try_cast("bigint").alias("number"),
        "url",
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    # digests first, without the payloads: which of them repeat, and who has the response
    known = rows.select(
        "id", "number", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes")
    ).where(F.col("bytes") >= LEAST)
    largest = F.max(F.struct("number", "id"))["id"].alias("keeper")  # ids that are no numbers as text
    kept = known.groupBy("digest").agg(F.count("*").alias("n"), largest)
    kept = cut(kept.where("n > 1 AND keeper <> ''").select("digest", "keeper"))
    digest = F.when(F.octet_length("payload") >= LEAST, F.sha1("payload"))
    marked = rows.withColumn("digest", digest).join(kept, "digest", "left")
    refers = F.when(F.col("id") != F.col("keeper"), F.col("keeper")).alias("refers_to")
    out = marked.select("id", "url", "payload", refers)
    schema = "path string, size long, records long"
    return cut(out.mapInArrow(_write_batches(folder), schema))


RECORD = (
    "id string, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to string, payload binary"
)


def _read_batches(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from _records(path, with_payload)

    return run


def located(source, size: int) -> list[tuple[Member, list[tuple[int, int]]]]:
    """Every data member of a package, and the ranges that its indexes give for it."""
    found = members(source, size)
    data = {
        m.name.removeprefix("archive/"): (m, set()) for m in found
        if m.name.startswith("archive/") and not m.name.endswith("/")
    }
    for member in found:
        if not member.name.startswith("indexes/") or member.name.endswith(("/", ".idx")):
            continue
        text = _at(source, *_member_range(source, member))
        text = zlib.decompress(text, -15) if member.method == 8 else text
        for name, offset, length in index_entries(gzip.decompress(text) if text[:2] == b"\x1f\x8b" else text):
            if name is None and len(data) == 1:
                (name,) = data
            name = (name or "").removeprefix("archive/")
            if name not in data:
                raise ValueError(f"{member.name} names {name!r}, which is not in the package")
            data[name][1].add((offset, length))
    return [(m, sorted(ranges)) for m, ranges in data.values()]


def _records(path: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    store, plain = _open(path)
    with store.open_input_file(plain) as source:
        rows = []
        for member, ranges in located(source, source.size()):
            begin, size = stored_range(source, member)
            found = (_at(source, begin + at, n) for at, n in ranges) if ranges else walk(source, begin, size)
            for raw in found:
                rows.append(_row(parse_record(raw), with_payload))
                if len(rows) >= 256:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _name(urn: str | None) -> str | None:
    return urn and urn.removeprefix("<").removesuffix(">").removeprefix("urn:page:")


def _sha1(declared: str | None) -> str | None:
    """A declared SHA-1 in hexadecimal; None for another digest."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _row(record: Record, with_payload: bool) -> tuple:
    headers, http = record.headers, record.http
    kind, declared = headers.get("warc-type", ""), headers.get("warc-payload-digest")
    digest, size = _sha1(declared) or declared, len(record.payload)
    if kind == "revisit":
        size = int(http.get("content-length", 0))
    else:
        own = hashlib.sha1(record.payload).hexdigest()
        encoded = "transfer-encoding" in http or "content-encoding" in http
        if kind == "response" and not encoded and (_sha1(declared) or own) != own:
            raise ValueError(f"the payload of {headers.get('warc-record-id')} has another digest")
        digest = own
    return (
        _name(headers.get("warc-record-id")), headers.get("warc-target-uri"), kind, size, digest,
        _name(headers.get("warc-refers-to")),
        record.payload if with_payload and kind != "revisit" else None,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]
             for f in RECORD.split(", ")]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def read_packages(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of packages (``path``, and any other columns), one row each."""
    paths = manifest.select("path")
    tasks = min(max(1, paths.count()), READ_TASKS)  # rows are few, so Spark would join them all
    paths = paths.repartitionByRange(tasks, "path")
    return paths.mapInArrow(_read_batches(with_payload), RECORD)
