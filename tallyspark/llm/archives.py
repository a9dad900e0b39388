"""WARC records in ZIP packages: writing, and reading them by byte range without extraction.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, one gzip
member per WARC record, and ``indexes/index.cdxj``, one line of offset and length per record.
Because the members are stored, a record's bytes lie at a known offset of the package, and
reading one needs the package's directory, the index and one range read.

Reading a package: find the end-of-directory record in the file's tail, follow the ZIP64
locator when a field is saturated, parse the central directory, skip each member's local
header, and read the index lines. Packages without an index are scanned record by record in
bounded pieces. Compressed members are refused, as ranges of them cannot be read.

Writing: payloads of at least ``DEDUP_BYTES`` that are equal become one response record, of
the largest id, and revisit records that refer to it. A revisit keeps its HTTP header, whose
Content-Length is the payload's length. A task writes each package under a unique temporary
name and renames it; only packages named in the committed manifest are read, so a lost or
repeated task leaves at most an unread file.

Null payloads are empty. Null urls are left out of the record and read back as null. A null id
counts as smaller than any other. Rows that tie on payload and id are all responses. Empty
tables give no package and an empty result.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import small_batches, stage
from tallyspark.session import scratch_path

DEDUP_BYTES = 1000
PACKAGE_BYTES = 128 << 20
BLOCK_BYTES = 4 << 20
WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
_DATE = "2024-01-01T00:00:00Z"  # a fixed date: reruns write the same records

RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


# ------------------------------------------------------------------ records
def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _header_safe(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def build_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit when ``refers_to`` is not None."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    encoded = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{encoded}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_safe(url)}")
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse_record(data: bytes) -> dict:
    """Headers and payload of one uncompressed record; a response's digest is verified."""
    import hashlib

    end = data.index(b"\r\n\r\n")
    head = _fields(data[:end])
    block = data[end + 4 : end + 4 + int(head["content-length"])]
    split = block.find(b"\r\n\r\n")
    http, payload = _fields(block[:split]), block[split + 4 :]
    said = head.get("warc-payload-digest", "").removeprefix("sha1:")
    digest = said.lower() if len(said) == 40 else base64.b32decode(said).hex()
    if head["warc-type"] == "response":
        if hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
        size = len(payload)
    else:
        size = int(http["content-length"])
    number = lambda k: int(head[k]) if k in head else None
    return {
        "page_id": number("x-page-id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": head["warc-type"],
        "refers_to": number("x-refers-to-page-id"),
        "url": head.get("warc-target-uri"),
        "payload": payload,
    }


# ------------------------------------------------------------------ writing
def _open_fs(path: str):
    """The file system and path of a URI or plain path, through pyarrow (local, HDFS, S3, ...)."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class _Package:
    """A package being written; holds only its index in memory."""

    def __init__(self, folder: str):
        self.folder = folder
        self.files, base = _open_fs(folder)
        self.name = f"{uuid.uuid4().hex}.wacz"
        self.path = f"{base}/{self.name}"
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(self.path + ".tmp")
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, page_id, record: bytes) -> None:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = pack.compress(record) + pack.flush()
        self.member.write(data)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(data)}))
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX_MEMBER), "".join(f"{line}\n" for line in self.index))
        self.zip.close()
        self.out.close()
        self.files.move(self.path + ".tmp", self.path)
        return f"{self.folder}/{self.name}", len(self.index), self.size


def revisit_plan(pages: DataFrame, id_col: str, html_col: str, url_col: str | None) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: what to write for each page."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    url = F.col(url_col) if url_col else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")
    )
    # narrow rows only; the aggregate is partial, so a payload on a third of the pages is cheap
    winners = (
        rows.where(F.length("payload") >= DEDUP_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and newest is not null")
        .select("digest", "newest")
    )
    winners, _ = stage(winners, "revisits")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("newest")), F.col("newest"))
    return rows.join(winners, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_packages(
    pages: DataFrame, folder: str, id_col: str = "page_id", html_col: str = "html", url_col: str | None = "url",
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write every page as a record and return the manifest: ``path, records, bytes``."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        done: list[tuple[str, int, int]] = []
        for batch in small_batches(batches):
            for row in batch.to_pylist():
                package = package or _Package(folder)
                package.add(row["page_id"], build_record(**row))
                if package.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("path", "records", "bytes"), d, strict=True)) for d in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    plan = revisit_plan(pages, id_col, html_col, url_col)
    return stage(plan.mapInArrow(write, "path string, records long, bytes long"), "manifest")[0]


# ------------------------------------------------------------------ reading
_EOCD, _EOCD64, _LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"


def read_directory(source, size: int) -> dict[str, tuple[int, int]]:
    """``member -> (offset of its data, length)`` of a ZIP file, ZIP64 included.

    ``source`` has ``read_at(nbytes, offset)``.
    """
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = source.read_at(size - tail_at, tail_at)
    at = tail.rfind(_EOCD)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        where = tail_at + at - 20
        locator = source.read_at(20, where)
        if locator[:4] != _LOCATOR:
            raise ValueError("ZIP64 locator is missing")
        end64 = source.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end64[:4] != _EOCD64:
            raise ValueError("ZIP64 end record is missing")
        entries, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory = source.read_at(length, start)
    out, at = {}, 0
    for _ in range(entries):
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full = struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
        extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:  # ZIP64: the saturated fields, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                full = wide.pop(0) if full == 0xFFFFFFFF else full
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + n :]
        at += 46 + n_name + n_extra + n_comment
        if name.endswith("/"):
            continue
        if method != 0:
            raise ValueError(f"member {name} is compressed; only stored members can be read by range")
        header = source.read_at(30, local)
        n_name, n_extra = struct.unpack_from("<HH", header, 26)
        out[name] = (local + 30 + n_name + n_extra, packed)
    return out


def _scan_records(source, start: int, length: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip member, found by reading the archive once in pieces."""
    at, begun, unpack = start, start, zlib.decompressobj(31)
    data = b""
    while at < start + length or data:
        if not data:
            data = source.read_at(min(1 << 20, start + length - at), at)
            at += len(data)
        unpack.decompress(data)
        data = b""
        if unpack.eof:
            data = unpack.unused_data
            yield begun, at - len(data) - begun
            begun, unpack = at - len(data), zlib.decompressobj(31)


def package_blocks(path: str, block_bytes: int = BLOCK_BYTES) -> Iterator[dict]:
    """Ranges of a package that hold whole records, each of about ``block_bytes``."""
    files, name = _open_fs(path)
    with files.open_input_file(name) as source:
        members = read_directory(source, source.size())
        for member, (start, length) in members.items():
            if not member.startswith("archive/"):
                continue
            if INDEX_MEMBER in members:
                at, n = members[INDEX_MEMBER]
                lines = (json.loads(x) for x in source.read_at(n, at).splitlines())
                records = ((start + x["offset"], x["length"]) for x in lines)
            else:
                records = _scan_records(source, start, length)
            block: list[tuple[int, int]] = []
            for record in records:
                if block and record[0] + record[1] - block[0][0] > block_bytes:
                    yield {"path": path, "offset": block[0][0], "lengths": [r[1] for r in block]}
                    block = []
                block.append(record)
            if block:
                yield {"path": path, "offset": block[0][0], "lengths": [r[1] for r in block]}


def read_packages(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the packages named in ``path``, read by range and verified."""
    schema = RESULT + (", payload binary" if with_payload else "")
    names = [f.split()[0] for f in schema.split(", ")]
    block_type = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("lengths", pa.list_(pa.int64()))])

    def list_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist(list(package_blocks(path)), block_type)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        out_type = pa.schema([(f.split()[0], types[f.split()[1]]) for f in schema.split(", ")])
        for batch in batches:
            for block in batch.to_pylist():
                files, name = _open_fs(block["path"])
                with files.open_input_file(name) as source:
                    data = source.read_at(sum(block["lengths"]), block["offset"])
                at, rows = 0, []
                for n in block["lengths"]:
                    record = parse_record(zlib.decompress(data[at : at + n], 31))
                    rows.append({k: record[k] for k in names})
                    at += n
                yield pa.RecordBatch.from_pylist(rows, out_type)

    blocks = manifest.select("path").mapInArrow(list_blocks, "path string, offset long, lengths array<long>")
    return blocks.repartition(blocks_partitions(manifest.sparkSession)).mapInArrow(read, schema)


def blocks_partitions(spark: SparkSession) -> int:
    """Blocks are dealt evenly over as many tasks as a shuffle has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to packages in the shared folder, then read every record back."""
    spark = pages.sparkSession
    manifest = write_packages(pages, scratch_path(spark, "llm", f"packages-{uuid.uuid4().hex}"))
    return read_packages(manifest)
