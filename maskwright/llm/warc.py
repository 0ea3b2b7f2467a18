"""WARC archives as a Spark data source, and archiving of pages with revisit records.

Files are gzip members, one record each, with the standard's optional ``sl``
skip-length field, so a reader that does not want a payload parses the headers
from the first kilobytes of a member and seeks over the rest.  The writer's
manifest lists its files with member offsets every few megabytes; a large file
is read by several tasks.  Archives of others - without manifest or skip
lengths, plain or compressed - are read too, one task a file.

A record without complete headers, without a length or with damaged gzip data is
a row of type ``damaged`` and nothing else, so it can be counted; reading goes on
with the next member where a skip length tells where that is, and with the next
file where not.
"""

from __future__ import annotations

import base64
import json
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from .files import open_fs
from .scratch import materialise, scratch_path

FORMAT = "maskwright_warc"
RECORDS = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
TO_WRITE = "page_id long, url string, fetched string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload string"
MANIFEST = "_files-"
DAMAGED = "damaged"
SPLIT_BYTES = 64 << 20
HEAD_BYTES = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: repeated digests are broadcast up to this many (28 bytes and overhead each), else joined by shuffle
BROADCAST_DIGESTS = 500_000
_ID = "urn:maskwright:page:"


def _member(raw: bytes, level: int = 3) -> bytes:
    """One gzip member with its skip lengths in the extra field."""
    body = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = body.compress(raw) + body.flush()
    size = 10 + 2 + 12 + len(packed) + 8
    extra = struct.pack("<2sHII", b"sl", 8, size & 0xFFFFFFFF, len(raw) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", len(extra)) + extra
    return head + packed + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def record_bytes(page_id, url, fetched, record_type, refers_to, digest, length, payload) -> bytes:
    """A response, or a revisit that keeps the HTTP header but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if record_type == "response" else b"")
    name = f"{_ID}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {fetched}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._"))
    if record_type == "revisit":
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    name: str
    size: int
    splits: list[int]


class _WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"  # a retried task writes another file; only committed ones are listed
        at, splits = 0, [0]
        with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in iterator:
                columns = [batch.column(c) for c in ("page_id", "url", "fetched", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")]
                for row in zip(*columns):
                    *meta, payload = (x.as_py() for x in row)
                    member = _member(record_bytes(*meta, payload.encode("utf-8", "surrogatepass")))
                    out.write(member)
                    at += len(member)
                    if at - splits[-1] >= SPLIT_BYTES:
                        splits.append(at)
        return _Written(name, at, [s for s in splits if s < at])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Name the files of this write in a manifest of its own, which appears whole or not at all."""
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        listed = [{"name": m.name, "size": m.size, "splits": m.splits} for m in messages if m is not None]
        name = f"{MANIFEST}{uuid.uuid4().hex}.json"
        with fs.open_output_stream(f"{root}/.{name}", compression=None) as out:
            out.write(json.dumps(listed).encode())
        fs.move(f"{root}/.{name}", f"{root}/{name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = open_fs(self.path)
        for m in messages:
            if m is not None:
                fs.delete_file(f"{root}/{m.name}")


@dataclass
class _Split(InputPartition):
    name: str
    start: int
    end: int


def _headers(block: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields, lower-case names, and where the block begins; None while incomplete."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return None
    lines = block[:end].decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def _hex_digest(value: str) -> str | None:
    """A labelled base-32 SHA-1 in hex; any other digest as it is written."""
    try:
        return base64.b32decode(value[5:]).hex() if value.startswith("sha1:") else value or None
    except ValueError:
        return value


class _WarcReader(DataSourceReader):
    def __init__(self, path: str, with_payload: bool):
        self.path, self.with_payload = path, with_payload
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters):
        fields = {"record_type": "warc-type", "target_uri": "warc-target-uri", "record_id": "warc-record-id", "warc_date": "warc-date"}
        for f in filters:
            field = fields.get(f.attribute[0]) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if field and isinstance(f, EqualTo):
                self.tests.append((field, "in", (f.value,)))
            elif field and isinstance(f, In):
                self.tests.append((field, "in", tuple(f.value)))
            elif field and isinstance(f, StringStartsWith):
                self.tests.append((field, "starts", (f.value,)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = open_fs(self.path)
        files = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        manifests = sorted(i.path for i in files if i.base_name.startswith(MANIFEST))
        if manifests:
            listed = [m for path in manifests for m in json.loads(fs.open_input_file(path).read())]
            found = [_Split(m["name"], a, b) for m in listed for a, b in zip(m["splits"], [*m["splits"][1:], m["size"]]) if b > a]
        else:
            found = [_Split(i.base_name, 0, i.size) for i in files if i.base_name.endswith((".warc", ".warc.gz"))]
        return found or [_Split("", 0, 0)]

    def _wanted(self, fields: dict[str, str]) -> bool:
        for name, kind, values in self.tests:
            value = fields.get(name)
            value = value[1:-1] if value and name == "warc-record-id" else value
            if value is None or not (value in values if kind == "in" else value.startswith(values)):
                return False
        return True

    def _is_wanted_damage(self) -> bool:
        return self._wanted({"warc-type": DAMAGED})

    def _records(self, source: pa.NativeFile, end: int) -> Iterator[tuple[dict[str, str], bytes | None]]:
        """Header fields and block of wanted records; the block is None where payloads are not asked for."""
        while source.tell() < end:
            begin = source.tell()
            first = source.read(HEAD_BYTES)
            if first[:2] != b"\x1f\x8b":
                yield from self._plain(source, begin, end)
                return
            size = None
            if len(first) >= 24 and first[3] & 4 and first[12:14] == b"sl":
                size = struct.unpack_from("<I", first, 16)[0]
            try:
                fields, block, used = self._member(source, first, begin, size)
            except (zlib.error, ValueError):
                fields, block, used = {"warc-type": DAMAGED}, None, size
            if self._wanted(fields):
                yield fields, block
            if not used:
                return
            source.seek(begin + used)

    def _member(self, source: pa.NativeFile, first: bytes, begin: int, size: int | None) -> tuple[dict[str, str], bytes | None, int]:
        """Header fields, block and compressed size of one gzip member."""
        inflate = zlib.decompressobj(31)
        block = inflate.decompress(first)
        while (parsed := _headers(block)) is None and not inflate.eof and (more := source.read(HEAD_BYTES)):
            block += inflate.decompress(more)
        if parsed is None:
            raise ValueError("a record without complete headers")
        fields, at = parsed
        length = int(fields.get("content-length", ""))
        keep = self._wanted(fields) and (self.with_payload or fields.get("warc-type") == "revisit")
        if keep or size is None:
            parts = [block]
            while not inflate.eof and (more := source.read(1 << 16)):
                got = inflate.decompress(more)
                if keep:
                    parts.append(got)
            if not inflate.eof:
                raise ValueError("a member that ends early")
            size = source.tell() - len(inflate.unused_data) - begin
            block = b"".join(parts)
        return fields, block[at : at + length] if keep else None, size

    def _plain(self, source: pa.NativeFile, begin: int, end: int) -> Iterator[tuple[dict[str, str], bytes | None]]:
        source.seek(begin)
        while source.tell() < end:
            at, head = source.tell(), b""
            while (parsed := _headers(head.lstrip(b"\r\n"))) is None and (more := source.read(HEAD_BYTES)):
                head += more
            if parsed is None and not head.strip():
                return
            if parsed is None or not parsed[0].get("content-length", "").isdigit():
                if self._is_wanted_damage():
                    yield {"warc-type": DAMAGED}, None
                return
            fields, skip = parsed
            body = at + len(head) - len(head.lstrip(b"\r\n")) + skip
            length = int(fields["content-length"])
            source.seek(body)
            need = self._wanted(fields)
            block = source.read(length) if need and (self.with_payload or fields.get("warc-type") == "revisit") else None
            source.seek(body + length)
            if need:
                yield fields, block

    def read(self, partition: _Split) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, root = open_fs(self.path)
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

        with fs.open_input_file(f"{root}/{partition.name}") as source:
            source.seek(partition.start)
            for fields, block in self._records(source, partition.end):
                payload, length = None, None
                if block is not None:
                    is_http = fields.get("content-type", "").startswith("application/http")
                    http, cut = (is_http and _headers(block)) or ({}, 0)  # without an end of headers all is payload
                    if fields.get("warc-type") == "revisit":
                        told = http.get("content-length", "")
                        length = int(told) if told.isdigit() else None
                    else:
                        payload = block[cut:]
                        length = len(payload)
                digest = fields.get("warc-payload-digest", "")
                digest = _hex_digest(digest)
                strip = lambda v: v[1:-1] if v and v.startswith("<") else v
                rows.append(
                    (strip(fields.get("warc-record-id")), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"), strip(fields.get("warc-refers-to")), digest, length, payload)
                )
                held += len(payload or b"")
                if len(rows) >= 512 or held >= 8 << 20:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class WarcDataSource(DataSource):
    """``spark.read.format("maskwright_warc").load(folder)``; option payload=false reads headers only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> DataSourceReader:
        return _WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_warc(pages: DataFrame, path: str, min_bytes: int = 1000) -> None:
    """One record per row of ``page_id, url, html`` (and ``fetched``, if there) in archives below ``path``.

    The payload is the html in UTF-8, null as empty.  Of records with equal
    payloads of at least ``min_bytes`` the one with the largest page_id is a
    response, the others revisit it; repeats of that id are responses too, as
    are all smaller payloads and rows without an id.
    """
    register(pages.sparkSession)
    fetched = F.col("fetched") if "fetched" in pages.columns else F.lit("1970-01-01T00:00:00Z")
    html = F.coalesce("html", F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", fetched.cast("string").alias("fetched"),
        F.sha1(html.cast("binary")).alias("payload_digest"), F.octet_length(html).cast("long").alias("payload_bytes"), html.alias("payload"),
    )
    copies = base.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
    copies = materialise(copies.where("n > 1 and keep is not null").select("payload_digest", "keep"), "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_DIGESTS else copies
    revisit = F.col("keep").isNotNull() & (F.col("page_id") != F.col("keep"))
    rows = base.join(copies, "payload_digest", "left").select(
        "page_id", "url", "fetched", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keep")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(revisit, "").otherwise(F.col("payload")).alias("payload"),
    )
    rows.write.format(FORMAT).mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives in a folder; conditions on type, id, URI and date are tested on headers alone.

    Without ``payload`` no payload is inflated.  Damaged records are rows of
    type ``damaged``; an empty folder has no rows.
    """
    register(spark)
    return spark.read.format(FORMAT).option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as read back from the archives.

    Lengths and digests of responses are computed from the payloads read.
    Revisits are read apart, by their headers alone: the condition on the type
    is tested before anything of a response is inflated.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(pages, path)
    number = lambda c: F.nullif(F.regexp_extract(c, _ID + r"(-?\d+)$", 1), F.lit("")).cast("long")
    part = lambda records, digest: records.select(
        number("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to")
    )
    responses = read_warc(spark, path).where("record_type = 'response'")
    revisits = read_warc(spark, path, payload=False).where("record_type = 'revisit'")
    return part(responses, F.sha1("payload")).unionByName(part(revisits, F.col("payload_digest")))


#: DuckDB form of op3_warc
ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1
)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keep <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keep <> p.page_id THEN k.keep END AS refers_to
FROM p LEFT JOIN k USING (payload_digest)
"""
