"""Day files as they were captured, as a Spark data source for batch and stream: format ``captures``.

Rows are ``day``, ``path`` (below the folder), ``place`` in the file, and ``raw``: the bytes of one
element, exactly as they stand in the file. A file is read in pieces and never held; a batch of rows
holds about ``BATCH_BYTES``, or one longer element. Files are packed into tasks by size.

As a stream it lands a file again when its size or modification time has changed. What was listed is
kept in a log beside the stream's checkpoint: a load is a file of the log that names the files which
were new or changed, and the offset of the stream is the number of its last load. So an offset has
the same size for any number of files, a load that is repeated after a failure has the files it had,
and a file that changes again later comes with a later load.

Written, elements become one array file per day, ``{day}.json``, replacing a file of that name as a
whole; ``write_captures`` hands a day's rows to one task, in order, which passes them on as they come.

Options: ``path``, ``pattern`` of file names, ``start`` and ``end`` (inclusive days), ``log`` (streams).
Folders and files whose names begin with ``_`` or ``.`` are left out, and so is ``.gz`` inflated.
"""

from __future__ import annotations

import fnmatch
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from trendloom.session import ship_package
from trendloom.sources.json_cutter import Cutter
from trendloom.sources.tables import load_if_present

SCHEMA = "day string, path string, place long, raw string"
PIECE = 1 << 18
BATCH_BYTES = 1 << 20
TASK_BYTES = 64 << 20

_DAY = r"\d{4}-\d{2}-\d{2}"

File = tuple[str, int, int]  # path below the folder, size, modification time in nanoseconds


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """Any file system that Arrow knows; a path without a scheme is local."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path.removeprefix('file:')}"
    if "://" in path:
        return pafs.FileSystem.from_uri(path.rstrip("/"))
    return pafs.LocalFileSystem(), path.rstrip("/")


def day_of(path: str) -> str:
    """As ``raw_files.file_day``: the last date in the name, else that of its ``day=`` folder; else empty."""
    named = re.findall(_DAY, path.rsplit("/", 1)[-1])
    if named:
        return named[-1]
    folder = re.search(rf"(?:^|/)day=({_DAY})/[^/]*$", path)
    return folder[1] if folder else ""


def list_files(options: dict) -> list[File]:
    """The files of the folder that the options choose, in order of their paths."""
    fs, folder = open_folder(options["path"])
    start, end = options.get("start"), options.get("end") or options.get("start")
    out = []
    for info in fs.get_file_info(pafs.FileSelector(folder, recursive=True)):
        path = info.path[len(folder) :].lstrip("/")
        if not info.is_file or not fnmatch.fnmatchcase(info.base_name, options.get("pattern", "*.json")):
            continue
        if any(part[0] in "_." for part in path.split("/")) or start and not start <= day_of(path) <= end:
            continue
        out.append((path, info.size, info.mtime_ns or 0))
    return sorted(out)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def packed(files: list[File]) -> list[Files]:
    """Files put together until a task has enough to read; a longer file is a task."""
    out: list[list[str]] = []
    room = 0
    for path, size, _ in files:
        if not out or room < size:
            out.append([])
            room = TASK_BYTES
        out[-1].append(path)
        room -= size
    return [Files(paths) for paths in out]


def read_files(folder: str, paths: list[str]) -> Iterator[pa.RecordBatch]:
    """The elements of some files; a file that is cut off or not JSON is an error that names it."""
    fs, root = open_folder(folder)
    for path in paths:
        cutter, place, day = Cutter(), 0, day_of(path)
        with fs.open_input_stream(f"{root}/{path}") as file:
            held, size = [], 0
            while True:
                piece = file.read(PIECE)
                try:
                    held += (found := cutter.feed(piece) if piece else cutter.finish() or [])
                except ValueError as error:
                    raise ValueError(f"{path}: {error}") from None
                size += sum(map(len, found))
                if held and (size >= BATCH_BYTES or not piece):
                    yield _batch(day, path, place, held)
                    place, held, size = place + len(held), [], 0
                if not piece:
                    break


def _batch(day: str, path: str, place: int, elements: list[bytes]) -> pa.RecordBatch:
    n = len(elements)
    raw = pa.array(elements, pa.binary()).cast(pa.string())  # checked to be UTF-8
    return pa.RecordBatch.from_arrays([pa.array([day] * n), pa.array([path] * n), pa.array(range(place, place + n), pa.int64()), raw], names=["day", "path", "place", "raw"])


class CapturesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Files]:
        return packed(list_files(self.options)) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return read_files(self.options["path"], partition.paths)


class Log:
    """Loads of a stream: file ``n`` names the files that load ``n`` found new or changed."""

    def __init__(self, path: str):
        self.path = path
        self.known: dict[str, tuple[int, int]] = {}
        self.last = 0

    def files(self, load: int) -> list[File]:
        fs, folder = open_folder(self.path)
        with fs.open_input_stream(f"{folder}/{load}") as lines:
            return [tuple(json.loads(line)) for line in lines.read().splitlines()]

    def catch_up(self) -> None:
        """Learn the loads that were written so far, each of them once."""
        fs, folder = open_folder(self.path)
        names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))]
        for load in range(self.last + 1, max((int(n) for n in names if n.isdigit()), default=0) + 1):
            self.known |= {path: (size, changed) for path, size, changed in self.files(load)}
            self.last = load

    def add(self, files: list[File]) -> None:
        """Write the next load, under its name only when it is whole."""
        fs, folder = open_folder(self.path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/.{self.last + 1}") as out:
            out.write("\n".join(json.dumps(f) for f in files).encode())
        fs.move(f"{folder}/.{self.last + 1}", f"{folder}/{self.last + 1}")


class CapturesStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options
        self.log = Log(options["log"])

    def initialOffset(self) -> dict:
        return {"load": 0}

    def latestOffset(self) -> dict:
        self.log.catch_up()
        changed = [f for f in list_files(self.options) if self.log.known.get(f[0]) != f[1:]]
        if changed:
            self.log.add(changed)
            self.log.catch_up()
        return {"load": self.log.last}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        """A file of several loads is read once, as it is now."""
        files: dict[str, File] = {}
        for load in range(start["load"] + 1, end["load"] + 1):
            files |= {f[0]: f for f in self.log.files(load)}
        return packed(sorted(files.values()))

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return read_files(self.options["path"], partition.paths)


class DayWritten(WriterCommitMessage):
    pass


class CapturesWriter(DataSourceArrowWriter):
    """Rows of ``day`` and ``raw``, the rows of a day together; a file gets its name when it is whole."""

    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> DayWritten:
        fs, folder = open_folder(self.options["path"])
        fs.create_dir(folder, recursive=True)
        day, out, hidden = None, None, ""
        for batch in iterator:
            for own, raw in zip(batch.column("day").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                if own != day:
                    if out is not None:
                        self._close(fs, folder, out, hidden, day)
                    day, hidden = own, f"{folder}/.{own}-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(hidden)
                    out.write(b"[")
                else:
                    out.write(b",\n")
                out.write(raw.encode())
        if out is not None:
            self._close(fs, folder, out, hidden, day)
        return DayWritten()

    def _close(self, fs: pafs.FileSystem, folder: str, out: pa.NativeFile, hidden: str, day: str) -> None:
        out.write(b"]")
        out.close()
        fs.move(hidden, f"{folder}/{day}.json")


class CapturesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captures"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return CapturesReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return CapturesStream(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return CapturesWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(CapturesSource)


def scan_captured(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None, pattern: str = "*.json") -> DataFrame:
    """``scan_raw`` without changing a byte and without holding a file: ``day``, ``path``, ``place``, ``raw``.

    An element is not parsed here; brackets, strings and commas of the array are checked.
    """
    register(spark)
    reader = spark.read.format("captures").option("pattern", pattern)
    for name, day in (("start", start), ("end", end)):
        reader = reader.option(name, day) if day is not None else reader
    return reader.load(folder)


def write_captures(rows: DataFrame, folder: str, force: bool = False, order: str | None = None) -> None:
    """Write rows of ``day`` and ``raw`` as one array file per day, elements as they are, by ``order``.

    Days that have a file are skipped, or replaced as a whole when forced; other days stay. Rows of a
    null day are left out.
    """
    spark = rows.sparkSession
    register(spark)
    rows = rows.where("day IS NOT NULL AND raw IS NOT NULL")
    if not force:
        listed = load_if_present(spark.read.format("binaryFile").option("pathGlobFilter", "*.json"), folder)
        if listed is not None:
            # one row per calendar day
            present = listed.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("day"))
            rows = rows.join(F.broadcast(present), "day", "left_anti")
    rows = rows.repartition("day").sortWithinPartitions("day", *[order] if order else [])
    rows.select("day", rows["raw"].cast("string").alias("raw")).write.format("captures").mode("append").save(folder)
