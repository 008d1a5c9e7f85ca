"""WARC records in ZIP packages: writer, and a reader that extracts nothing.

A package is a ZIP archive with two stored (uncompressed) members: ``archive/data.warc.gz``,
one gzip member per WARC record, and ``indexes/index.cdx``, a line for each record with
its offset and length.  The reader range-reads the end-of-directory records (ZIP64 ones
too), the central directory, the members' local headers and the index, then each task
range-reads the runs of records it was dealt: record bytes are never unpacked to disk.

Records with equal payloads (SHA-1 and length) of at least ``min_bytes`` bytes: the one with
the largest id is the response, the others are revisits that name it and carry its
headers only.

Paths are those of any store that pyarrow's filesystems open.  A task buffers one package
(``package_bytes``) and writes it under a name of its own; the manifest lists the packages
of the tasks that ended, so a lost or repeated task leaves at most a file that nobody reads.
Hot groups of copies: the largest id of a digest is a partial aggregation, and the join
back is a join that Spark splits when skewed.

Defined results: null html is an empty payload; a null id is written as an empty id and read
back as null (it counts as the smallest; if all ids of a payload are null, each record is a
response, since a revisit would have nothing to name); of repeated rows with
the largest id all are responses; a null url is written as an empty target, and a url's line breaks and
outer blanks, which a header line can't hold, become blanks and go; an empty table
writes nothing and gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import need, ship_by_value
from tidewater.session import scratch_path

PACKAGE_BYTES, RUN_BYTES, READ_BYTES = 32 << 20, 1 << 20, 16 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: All records get the date of the crawl that the caller states: reruns write equal bytes.
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, package_bytes long, n_records long"
RECORDS = ("id long, url string, record_type string, payload_digest string, payload_bytes long, "
           "refers_to long, payload binary")

ship_by_value(__name__)


def opened(path: str):
    """(filesystem, path in it) of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_uri(record_id: str) -> str:
    return f"<urn:page:{record_id}>"


def one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def warc_record(record_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = "" if record_id is None else str(record_id)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_uri(name)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {one_line(url or '')}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_uri(str(refers_to))}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http + payload if refers_to is None else http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def headers_of(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode("utf-8").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if colon:
            out[key.strip().lower()] = value.strip()
    return out


def parse_record(raw: bytes) -> tuple:
    """(id, url, type, digest, payload length, refers to, payload) of one WARC record; raises if
    the payload of a response has another digest than its header says."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record here")
    h = headers_of(head)
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda uri: int(x) if (x := uri[len("<urn:page:"):-1]) else None
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    revisit = h["warc-type"] == "revisit"
    if not revisit and digest_of(payload) != digest:
        raise ValueError(f"record {h['warc-record-id']}: the payload differs from its digest")
    return (page(h["warc-record-id"]), h["warc-target-uri"], h["warc-type"], digest,
            int(headers_of(http)["content-length"]), page(h["warc-refers-to"]) if revisit else None,
            None if revisit else payload)


def zip_package(members: list[tuple[str, bytes]], zip64: bool = False) -> bytes:
    """A ZIP archive of stored members; with ZIP64 records where sizes need or ``zip64`` asks for them."""
    out, central = bytearray(), bytearray()
    limit = 0 if zip64 else 0xFFFFFFFF
    for name, data in members:
        raw, crc, at = name.encode(), zlib.crc32(data), len(out)
        big, far = len(data) >= limit, at >= limit
        extra = struct.pack("<HHQQ", 1, 16, len(data), len(data)) if big else b""
        size = 0xFFFFFFFF if big else len(data)
        out += struct.pack("<4s5H3I2H", b"PK\3\4", 45 if big else 20, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra))
        out += raw + extra + data
        values = ([len(data), len(data)] if big else []) + ([at] if far else [])
        extra = struct.pack(f"<HH{len(values)}Q", 1, 8 * len(values), *values) if values else b""
        central += struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45 if values else 20, 0x800, 0, 0, 0x21, crc, size, size,
                               len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF if far else at) + raw + extra
    at, n = len(out), len(members)
    out += central
    big = zip64 or at >= limit or n >= 0xFFFF
    if big:
        out += struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, len(central), at)
        out += struct.pack("<4sIQI", b"PK\6\7", 0, at + len(central), 1)
    out += struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, min(n, 0xFFFF) if not zip64 else 0xFFFF,
                       min(n, 0xFFFF) if not zip64 else 0xFFFF,
                       0xFFFFFFFF if big else len(central), 0xFFFFFFFF if big else at, 0)
    return bytes(out)


def members_of(f, size: int) -> dict[str, tuple[int, int]]:
    """name -> (offset of the data, length) of the stored members of an open ZIP archive, by
    range reads of its directories only."""
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = f.read_at(size - tail_at, tail_at)
    k = tail.rfind(b"PK\5\6")
    if k < 0:
        raise ValueError("no ZIP end-of-directory record")
    _, _, _, _, n, length, at, _ = struct.unpack("<4s4H2IH", tail[k:k + 22])
    if k >= 20 and tail[k - 20:k - 16] == b"PK\6\7":
        end = struct.unpack("<4sIQI", tail[k - 20:k])[2]
        n, length, at = struct.unpack("<4sQ2H2I4Q", f.read_at(56, end))[7:]
    central, found, p = f.read_at(length, at), {}, 0
    for _ in range(n):
        x = struct.unpack("<4s6H3I5H2I", central[p:p + 46])
        if x[0] != b"PK\1\2":
            raise ValueError("a broken central directory")
        method, packed, plain, n_name, n_extra, n_note, local = x[4], x[8], x[9], x[10], x[11], x[12], x[16]
        name = central[p + 46:p + 46 + n_name].decode()
        extra, e = central[p + 46 + n_name:p + 46 + n_name + n_extra], 0
        while e + 4 <= len(extra):
            kind, n_field = struct.unpack("<HH", extra[e:e + 4])
            if kind == 1:  # ZIP64: only the fields that the fixed part leaves open
                values = list(struct.unpack(f"<{n_field // 8}Q", extra[e + 4:e + 4 + n_field // 8 * 8]))
                plain = values.pop(0) if plain == 0xFFFFFFFF else plain
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                local = values.pop(0) if local == 0xFFFFFFFF else local
            e += 4 + n_field
        if method:
            raise ValueError(f"member {name} is compressed: its records can't be range-read")
        head = struct.unpack("<4s5H3I2H", f.read_at(30, local))
        found[name] = (local + 30 + head[9] + head[10], packed)
        p += 46 + n_name + n_extra + n_note
    return found


def write_packages(folder: str, package_bytes: int, zip64: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (id, url, payload, refers_to) into packages below ``folder``; gives their manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        data, index, n = bytearray(), [], 0

        def put() -> pa.RecordBatch:
            name = f"part-{uuid.uuid4().hex}.zip"
            raw = zip_package([(DATA, bytes(data)), (INDEX, "".join(index).encode())], zip64)
            with fs.open_output_stream(f"{base}/{name}") as f:
                f.write(raw)
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "package_bytes": len(raw), "n_records": n}])

        made = False
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("id", "url", "payload", "refers_to")), strict=True):
                if not made:
                    fs.create_dir(base, recursive=True)
                    made = True
                member = gzip_member(warc_record(*(x.as_py() for x in row)))
                index.append(f"{len(data)} {len(member)}\n")
                data += member
                n += 1
                if len(data) >= package_bytes:
                    yield put()
                    data, index, n = bytearray(), [], 0
        if n:
            yield put()

    return run


def locate_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of consecutive records (path, start, lengths) of the packages of a manifest."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, inner = opened(path)
            with fs.open_input_file(inner) as f:
                members = members_of(f, f.size())
                at, length = members[INDEX]
                lines = [tuple(map(int, x.split())) for x in f.read_at(length, at).decode().splitlines()]
            base, rows, lengths, start, size = members[DATA][0], [], [], 0, 0
            for offset, n in lines:
                if not lengths:
                    start = base + offset
                lengths.append(n)
                size += n
                if size >= RUN_BYTES:
                    rows.append({"path": path, "start": start, "lengths": lengths})
                    lengths, size = [], 0
            if lengths:
                rows.append({"path": path, "start": start, "lengths": lengths})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))]))


def read_runs(payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "lengths")), strict=True):
                fs, inner = opened(path)
                with fs.open_input_file(inner) as f:
                    raw, at, rows = f.read_at(sum(lengths), start), 0, []
                for n in lengths:
                    rows.append(parse_record(zlib.decompress(raw[at:at + n], 31)))
                    at += n
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
                if not payloads:
                    columns[-1] = pa.nulls(len(rows), pa.binary())
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def write_archives(spark: SparkSession, pages: DataFrame, store: Callable[[DataFrame], DataFrame], folder: str | None = None,
                   id_col: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0,
                   package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Write a record for every row into packages below ``folder`` (a new scratch folder if
    none is given); the stored manifest (path, package_bytes, n_records) comes back."""
    need(pages, id_col, url, html)
    folder = folder or scratch_path(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    key = [F.sha1("payload").alias("sha"), F.octet_length("payload").alias("n")]
    # the largest id of each payload; the pages' own payloads are not aggregated
    last = rows.select("id", *key).groupBy("sha", "n").agg(F.max("id").alias("last"))
    last = last.select(F.col("sha").alias("l_sha"), F.col("n").alias("l_n"), "last")
    keyed = rows.select("*", *key)
    same = (keyed["sha"] == F.col("l_sha")) & (keyed["n"] == F.col("l_n"))
    first = F.when((F.col("n") >= min_bytes) & (F.col("id").isNull() | (F.col("id") != F.col("last"))), F.col("last"))
    marked = keyed.join(last, same).select("id", "url", "payload", first.alias("refers_to"))
    return store(marked.mapInArrow(write_packages(folder, package_bytes, zip64), MANIFEST))


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the packages that a manifest (a column ``path``) lists, ``READ_BYTES`` of
    packages a task or so (by ``package_bytes``, where the manifest has it)."""
    size = F.sum("package_bytes") if "package_bytes" in manifest.columns else F.count(F.lit(1)) * PACKAGE_BYTES
    total = manifest.agg(F.coalesce(size, F.lit(0))).first()[0]
    runs = manifest.select("path").mapInArrow(locate_records, "path string, start long, lengths array<long>")
    return runs.repartition(total // READ_BYTES + 1, "path", "start").mapInArrow(read_runs(payloads), RECORDS)
