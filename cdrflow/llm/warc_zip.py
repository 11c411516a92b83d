"""Web archives in ZIP packages (WACZ): writing, and reading records by range without unpacking.

A package stores, uncompressed as far as ZIP goes, ``archive/data.warc.gz``
(each WARC record its own gzip member) and ``indexes/index.cdxj`` (offset,
length and page of each record).  The reader parses the end-of-central-directory
record, its ZIP64 forms and the central directory itself, finds where the
stored members' bytes begin, reads the index, and then only the byte ranges of
the records it wants.

Files go to a folder that driver and executors share, through Arrow's file
systems (local paths, HDFS, S3 and others by their URI).  A task that is run
again writes files of its own; only those of finished tasks are in the manifest,
which is a written table.
"""

from __future__ import annotations

import gzip
import json
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, materialize, ship

ship(__name__)

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A package is closed, and another begun, beyond so many bytes of records.
MAX_PACKAGE = 1 << 30
#: Smaller payloads are never deduplicated.
MIN_REVISIT = 100
#: Adjacent records are fetched with one read up to so many bytes.
READ_BYTES = 4 << 20
#: Bytes of archives that a task reads at most, about.
TASK_BYTES = 128 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

# fixed values: ZIP record signatures and sizes
EOCD, EOCD64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF


def filesystem(uri: str):
    """The file system of a URI or an absolute path, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


# -- ZIP directories ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int  # offset of the local header


def _extra(extra: bytes, kind: int) -> bytes:
    at = 0
    while at + 4 <= len(extra):
        found, n = struct.unpack_from("<HH", extra, at)
        if found == kind:
            return extra[at + 4 : at + 4 + n]
        at += 4 + n
    return b""


def central_directory(read: Callable[[int, int], bytes], size: int) -> dict[str, Member]:
    """The members of a ZIP file by name; ``read(offset, length)`` gives its bytes."""
    tail_at = max(0, size - 22 - MAX16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(EOCD)
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(EOCD, 0, at)  # those bytes in a comment aren't the record
    if at < 0:
        raise ValueError("not a ZIP file: no end-of-central-directory record")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if entries == MAX16 or length == MAX32 or start == MAX32:
        place = tail_at + at - 20
        locator = read(place, 20) if place >= 0 else b""
        if locator[:4] != LOCATOR64:
            raise ValueError("ZIP64 locator missing")
        record = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != EOCD64:
            raise ValueError("ZIP64 end-of-central-directory record missing")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    data, at, out = read(start, length), 0, {}
    for _ in range(entries):
        if data[at : at + 4] != ENTRY:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, full = struct.unpack_from("<II", data, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", data, at + 28)
        (header,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        wide = _extra(data[at + 46 + n_name : at + 46 + n_name + n_extra], 1)
        for field in ("full", "packed", "header"):  # a ZIP64 field holds those that do not fit, in this order
            value = {"full": full, "packed": packed, "header": header}[field]
            if value == MAX32:
                (value,), wide = struct.unpack_from("<Q", wide), wide[8:]
                full, packed, header = (
                    value if field == "full" else full,
                    value if field == "packed" else packed,
                    value if field == "header" else header,
                )
        out[name] = Member(name, method, packed, full, header)
        at += 46 + n_name + n_extra + n_comment
    return out


def stored_at(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method:
        raise ValueError(f"{member.name} is compressed: its records can't be read by range")
    local = read(member.header, 30)
    if local[:4] != LOCAL:
        raise ValueError(f"{member.name}: no local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", local, 26))


# -- records -----------------------------------------------------------------------------------------------------------


def warc_record(fields: list[tuple[str, str]], body: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(body)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and body of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def _number(value: int | None) -> str:
    return "none" if value is None else str(value)


def _record(row: dict) -> bytes:
    """The gzip member of a page's record."""
    payload = (row["html"] or "").encode()
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:page:{row['row_id']}:{_number(row['page_id'])}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", quote(row["url"], safe="%/:?#[]@!$&'()*+,;=~")))
    body = HTTP % len(payload)
    if row["record_type"] == "revisit":
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", f"<urn:page:{row['first_row']}:{_number(row['first_page'])}>"))
    else:
        body += payload
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(warc_record(fields, body)) + packer.flush()


# -- writing -----------------------------------------------------------------------------------------------------------


def with_record_types(pages: DataFrame) -> DataFrame:
    """``pages`` (row_id, page_id, url, html; a written table) plus digest, record_type, first_row and first_page.

    Of equal payloads of ``MIN_REVISIT`` bytes or more, the smallest page_id is
    the response (then the smallest row; null ids come last).
    """
    data = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.withColumn("digest", F.sha2(data, 256)).withColumn("bytes", F.octet_length(data))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row_id")).alias("first")
    repeated = materialize(
        hashed.filter(F.col("bytes") >= MIN_REVISIT)
        .select("digest", "page_id", "row_id")
        .groupBy("digest")
        .agg(first, F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("of_digest"), F.col("first.row_id").alias("first_row"), F.col("first.page_id").alias("first_page")),
        "warc-repeated",
    )
    revisit = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row_id"))
    return (
        hashed.drop("bytes")
        .join(repeated, F.col("digest") == F.col("of_digest"), "left")
        .withColumn("record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
        .drop("of_digest")
    )


def write_packages(records: DataFrame, folder: str, max_package: int = MAX_PACKAGE) -> DataFrame:
    """The manifest (path, records, bytes) of the packages written to ``folder``, as a written table."""
    names = ["row_id", "page_id", "url", "html", "digest", "record_type", "first_row", "first_page"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        system, root = filesystem(folder)
        system.create_dir(root, recursive=True)

        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(0, batch.num_rows, 200):
                    yield from batch.slice(i, 200).to_pylist()

        waiting = rows()
        row = next(waiting, None)
        while row is not None:
            name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.wacz"
            index: list[str] = []
            with system.open_output_stream(f"{root}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True) as member:
                    at = 0
                    while row is not None and at < max_package:
                        record = _record(row)
                        member.write(record)
                        index.append(
                            json.dumps({"row": row["row_id"], "page": row["page_id"], "offset": at, "length": len(record)})
                        )
                        at += len(record)
                        row = next(waiting, None)
                package.writestr(zipfile.ZipInfo(INDEX), "".join(f"{line}\n" for line in index))
                resources = [{"path": ARCHIVE}, {"path": INDEX}]
                package.writestr(
                    zipfile.ZipInfo("datapackage.json"),
                    json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": resources}),
                )
            yield pa.RecordBatch.from_pylist([{"path": name, "records": len(index), "bytes": at}])

    return materialize(records.select(*names).mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


# -- reading -----------------------------------------------------------------------------------------------------------


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """(path, start, length) of each record, from the packages' directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_file(f"{root}/{path}") as f:
                    read = lambda at, n: f.read_at(n, at)
                    members = central_directory(read, f.size())
                    base = stored_at(read, members[ARCHIVE])
                    index = members[INDEX]
                    lines = read(stored_at(read, index), index.size).decode().splitlines()
                for i in range(0, len(lines), 10_000):
                    found = [json.loads(line) for line in lines[i : i + 10_000]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(found)),
                            pa.array([base + x["offset"] for x in found], pa.int64()),
                            pa.array([x["length"] for x in found], pa.int64()),
                        ],
                        names=["path", "start", "length"],
                    )

    return manifest.select("path").mapInArrow(run, "path string, start long, length long")


def _page(urn: str | None) -> int | None:
    page = (urn or "").strip("<>").rpartition(":")[2]
    return None if page in ("", "none") else int(page)


def read_tasks(spark, archive_bytes: int) -> int:
    """Tasks that read so many bytes of archives: TASK_BYTES each, less where that keeps every core busy."""
    cores = 2 * spark.sparkContext.defaultParallelism
    return max(1, -(-archive_bytes // TASK_BYTES), min(cores, -(-archive_bytes // READ_BYTES)))


def read_records(index: DataFrame, folder: str, archive_bytes: int | None = None) -> DataFrame:
    """Records by range: page_id, record_type, payload (null for a revisit), payload_digest, payload_bytes, refers_to.

    Ranges are dealt by package and stretch of it, so a large package is read by
    several tasks; neighbours are fetched together.  The number of tasks follows
    ``archive_bytes`` (the manifest's sum), as the index says little about it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        system, root = filesystem(folder)

        def parsed(path: str, ranges: list[tuple[int, int]]) -> list[tuple]:
            with system.open_input_file(f"{root}/{path}") as f:
                begin = ranges[0][0]
                data = f.read_at(ranges[-1][0] + ranges[-1][1] - begin, begin)
            out = []
            for start, n in ranges:
                fields, body = parse_record(gzip.decompress(data[start - begin : start - begin + n]))
                digest, length = fields["warc-payload-digest"].partition(":")[2], int(fields["warc-payload-length"])
                payload = None
                if fields["warc-type"] == "response":
                    payload = body.partition(b"\r\n\r\n")[2]
                    if hashlib.sha256(payload).hexdigest() != digest or len(payload) != length:
                        raise ValueError(f"{path} at {start}: the payload is not what its record says")
                out.append(
                    (_page(fields["warc-record-id"]), fields["warc-type"], payload, digest, length, _page(fields.get("warc-refers-to")))
                )
            return out

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
            names = ["page_id", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        path, ranges = None, []
        for batch in batches:
            for p, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                if ranges and (
                    p != path or start != sum(ranges[-1]) or start + n - ranges[0][0] > READ_BYTES
                ):
                    yield batch_of(parsed(path, ranges))
                    ranges = []
                path = p
                ranges.append((start, n))
        if ranges:
            yield batch_of(parsed(path, ranges))

    stretch = F.floor(F.col("start") / READ_BYTES)
    tasks = [] if archive_bytes is None else [read_tasks(index.sparkSession, archive_bytes)]
    return (
        index.repartition(*tasks, "path", stretch)
        .sortWithinPartitions("path", "start")
        .mapInArrow(
            run,
            "page_id long, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long",
        )
    )


def archive_pages(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Manifest and folder of the packages that hold a record of every page (page_id, url, html).

    A null html is an empty payload, a null page_id or url is left out of the
    record; repeated rows are records of their own.  Other columns are not
    read, and no page gives no package.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    numbered = materialize(
        pages.select(F.monotonically_increasing_id().alias("row_id"), F.col("page_id").cast("long").alias("page_id"), "url", "html"),
        "warc-pages",
    )
    return write_packages(with_record_types(numbered), folder), folder
