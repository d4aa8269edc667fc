"""Web archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Files are WARC 1.1, one gzip member per record. The members this writer makes carry an extra field
``sl`` with their compressed and plain length, so a reader that has seen the header can step over
the rest without inflating it; members of other writers are read too, and inflated to their end.

Writing: each task writes files of its own below the folder, by any file system that pyarrow knows.
The commit lists the files of the tasks that succeeded in a manifest, with offsets at which a file
can be split. Files that no manifest lists, left by lost or repeated tasks, are not read.

Reading: partitions are ranges of files, cut at those offsets and packed to ``split_bytes``.
Filters on header columns (equal, in, starts with, not null) are pushed down: headers are parsed
first, and the payload of a rejected record is never inflated. Option ``payload``:

- ``text`` (default): the payload decoded as UTF-8,
- ``digest``: its length and SHA-256, computed piecewise, without keeping or decoding it,
- ``none``: neither; lengths and digests are those that the headers state.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from trendloom.llm.common import prepare

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "content_type string, payload_digest string, payload_bytes long, payload string"
)
# Column and the header that holds it.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
}
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SMALLEST_REVISIT = 100  # bytes; records below it are always stored whole
SPLIT_BYTES = 64 << 20
PIECE = 1 << 16
BATCH_BYTES = 4 << 20


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# --- one record ------------------------------------------------------------------------------


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def encode_record(values: dict, payload: bytes) -> bytes:
    """A record as one gzip member with its lengths in the extra field ``sl``."""
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        if values.get(column) is not None:
            lines.append(f"{header}: {_clean(str(values[column]))}")
    body = HTTP_HEAD + payload if values.get("record_type") == "response" else payload
    lines.append(f"Content-Length: {len(body)}")
    plain = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = packer.compress(plain) + packer.flush()
    total = 10 + 2 + 12 + len(packed) + 8
    known = total < 2**32 and len(plain) < 2**32
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, total if known else 0, len(plain) if known else 0)
    return head + packed + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


class Member:
    """One gzip member of a file, inflated only as far as it is read."""

    def __init__(self, file, start: int):
        file.seek(start)
        self.file, self.start = file, start
        head = file.read(12)
        if len(head) < 10 or head[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {start}")
        self.length = 0
        if head[3] & 4:
            (size,) = struct.unpack("<H", head[10:12])
            extra = file.read(size)
            at = 0
            while at + 4 <= len(extra):
                (n,) = struct.unpack("<H", extra[at + 2 : at + 4])
                if extra[at : at + 2] == b"sl" and n == 8:
                    (self.length,) = struct.unpack("<I", extra[at + 4 : at + 8])
                at += 4 + n
        file.seek(start)
        self.unpacker = zlib.decompressobj(31)
        self.waiting, self.read_bytes = b"", 0

    def inflate(self, most: int) -> bytes:
        """Up to ``most`` further bytes; empty at the end."""
        while not self.unpacker.eof:
            if not self.waiting:
                self.waiting = self.file.read(PIECE)
                self.read_bytes += len(self.waiting)
                if not self.waiting:
                    raise ValueError(f"the member at byte {self.start} is cut off")
            out = self.unpacker.decompress(self.waiting, most)
            self.waiting = self.unpacker.unconsumed_tail
            if out:
                return out
        return b""

    def end(self) -> int:
        """Where the next member starts; inflates to the end only if the length isn't stated."""
        if self.length:
            return self.start + self.length
        while self.inflate(PIECE):
            pass
        return self.start + self.read_bytes - len(self.unpacker.unused_data)


def parse_head(member: Member) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and what was inflated beyond them."""
    seen = b""
    while b"\r\n\r\n" not in seen:
        more = member.inflate(1024)
        if not more:
            raise ValueError(f"the record at byte {member.start} has no end of header")
        seen += more
    head, rest = seen.split(b"\r\n\r\n", 1)
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest


def _body(member: Member, rest: bytes, length: int) -> Iterator[bytes]:
    left = length
    while left > 0:
        piece = rest or member.inflate(PIECE)
        if not piece:
            raise ValueError(f"the record at byte {member.start} is shorter than it states")
        rest = b""
        yield piece[:left]
        left -= len(piece)


def _without_http_head(pieces: Iterator[bytes]) -> Iterator[bytes]:
    seen = b""
    for piece in pieces:
        seen += piece
        if b"\r\n\r\n" in seen:
            yield seen.split(b"\r\n\r\n", 1)[1]
            yield from pieces
            return
    yield seen


def read_payload(member: Member, fields: dict[str, str], rest: bytes) -> Iterator[bytes]:
    pieces = _body(member, rest, int(fields.get("content-length", 0)))
    return _without_http_head(pieces) if fields.get("warc-type") == "response" else pieces


# --- the data source -------------------------------------------------------------------------


class FileRanges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


class Written(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payload", "text"), int(self.options.get("split_bytes", SPLIT_BYTES)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], overwrite, int(self.options.get("split_bytes", SPLIT_BYTES)))


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of ``SCHEMA``; a null payload is empty."""

    def __init__(self, path: str, overwrite: bool, split_bytes: int):
        self.path, self.overwrite, self.split_bytes = path, overwrite, split_bytes

    def write(self, iterator) -> Written:
        fs, folder = open_folder(self.path)
        files: list[dict] = []
        stream = None
        try:
            for batch in iterator:
                names = batch.schema.names
                columns = [batch.column(i) for i in range(batch.num_columns)]
                for row in range(batch.num_rows):
                    values = {n: c[row].as_py() for n, c in zip(names, columns, strict=True)}
                    record = encode_record(values, (values.pop("payload", None) or "").encode("utf-8"))
                    if stream is None:
                        fs.create_dir(folder, recursive=True)
                        files.append({"file": f"part-{uuid.uuid4().hex}.warc.gz", "bytes": 0, "splits": [0], "records": 0})
                        stream = fs.open_output_stream(f"{folder}/{files[-1]['file']}", compression=None)
                    entry = files[-1]
                    if entry["bytes"] - entry["splits"][-1] >= self.split_bytes:
                        entry["splits"].append(entry["bytes"])
                    stream.write(record)
                    entry["bytes"] += len(record)
                    entry["records"] += 1
        finally:
            if stream is not None:
                stream.close()
        return Written(files)

    def commit(self, messages) -> None:
        """One manifest per write; an overwrite drops the older manifests, and so what they list."""
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        older = [f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".manifest")] if self.overwrite else []
        files = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{folder}/{uuid.uuid4().hex}.manifest", compression=None) as out:
            for entry in files:
                out.write(json.dumps(entry).encode() + b"\n")
        for path in older:
            fs.delete_file(path)

    def abort(self, messages) -> None:
        fs, folder = open_folder(self.path)
        for entry in (f for m in messages if m is not None for f in m.files):
            fs.delete_file(f"{folder}/{entry['file']}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str, split_bytes: int):
        if payload not in ("text", "digest", "none"):
            raise ValueError("option payload is text, digest or none")
        self.path, self.payload, self.split_bytes = path, payload, split_bytes
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column not in HEADERS or column in ("payload_bytes", "payload_digest"):
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "known", None))
            else:
                yield f

    def partitions(self):
        fs, folder = open_folder(self.path)
        infos = [f for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.is_file]
        manifests = [f for f in infos if f.base_name.endswith(".manifest")]
        ranges = []
        if manifests:
            for info in manifests:
                with fs.open_input_stream(info.path, compression=None) as lines:
                    for line in lines.read().splitlines():
                        entry = json.loads(line)
                        cuts = [*entry["splits"], entry["bytes"]]
                        ranges += [(entry["file"], a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        else:  # archives of another writer: a file is read from its start to its end
            ranges = [(f.base_name, 0, f.size) for f in infos if f.base_name.endswith(".warc.gz")]
        packed: list[list] = []
        room = 0
        for one in ranges:
            if not packed or room < one[2] - one[1]:
                packed.append([])
                room = self.split_bytes
            packed[-1].append(one)
            room -= one[2] - one[1]
        return [FileRanges(p) for p in packed] or [FileRanges([])]

    def wanted(self, values: dict) -> bool:
        for column, kind, value in self.tests:
            own = values[column]
            if own is None or kind == "in" and own not in value or kind == "starts" and not own.startswith(value):
                return False
        return True

    def read(self, partition):
        fs, folder = open_folder(self.path)
        schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in [*HEADERS, "payload"]])
        rows, size = [], 0
        for name, start, end in partition.ranges:
            with fs.open_input_file(f"{folder}/{name}") as file:
                at = start
                while at < end:
                    member = Member(file, at)
                    fields, rest = parse_head(member)
                    values = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
                    if self.wanted(values):
                        row = self.row(values, member, fields, rest)
                        rows.append(row)
                        size += 200 + len(row["payload"] or "")
                    at = member.end()
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def row(self, values: dict, member: Member, fields: dict, rest: bytes) -> dict:
        stated = values["payload_digest"]
        out = values | {"payload": None, "payload_digest": stated and stated.removeprefix("sha256:")}
        out["payload_bytes"] = int(values["payload_bytes"]) if values["payload_bytes"] else None
        if self.payload == "none" or values["record_type"] == "revisit":
            return out
        digest, length, kept = hashlib.sha256(), 0, []
        for piece in read_payload(member, fields, rest):
            digest.update(piece)
            length += len(piece)
            if self.payload == "text":
                kept.append(piece)
        out |= {"payload_digest": digest.hexdigest(), "payload_bytes": length}
        if self.payload == "text":
            out["payload"] = b"".join(kept).decode("utf-8", "replace")
        return out


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filter pushdown on."""
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages as records ------------------------------------------------------------------------


def page_records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One record per page, rows of ``SCHEMA``; equal payloads are stored once.

    Of the pages with an equal payload of at least ``SMALLEST_REVISIT`` bytes, the smallest id is a
    ``response`` and the others ``revisit`` it, without a payload. A null html is an empty payload. A
    null id has no record id and is never the smallest, unless all ids of the payload are null:
    then all are responses. Rows that repeat the smallest id are all responses.
    Copies are found on digests; only a payload's count and smallest id are joined back.
    """
    rows = pages.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("target_uri"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("payload")
    )
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    shared = rows.where(F.col("payload_bytes") >= SMALLEST_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    marked = rows.join(shared.where("n > 1").drop("n"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    urn = F.lit("<urn:page:")
    return marked.select(
        F.concat(urn, F.col("id").cast("string"), F.lit(">")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("2024-01-01T00:00:00Z").alias("date"),
        F.when(again, F.concat(urn, F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.concat(F.lit("sha256:"), F.col("digest")).alias("payload_digest"),
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_of(urn):
    """The page id in a record id that ``page_records`` made."""
    return F.regexp_extract(urn, r"^<urn:page:(.*)>$", 1).cast("long")
