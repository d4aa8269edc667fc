"""Incremental landing: new day files are appended once, versions are resolved on read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trendloom.sources.captures import register
from trendloom.sources.landing import with_created_month
from trendloom.sources.raw_files import explode_json_array


def stream_day_files(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    land: Callable[[DataFrame], DataFrame],
    files_per_batch: int = 1000,
    pattern: str = "*.json",
) -> StreamingQuery:
    """Land every day file that has arrived since the last run, then stop.

    The file sink commits each batch once, and no state is kept: the newest version wins, which
    a streaming ``dropDuplicates`` (first wins) cannot give, so ``current_state`` picks it on
    read. Files are read as ``scan_raw`` reads them, whatever their size. This stream reads each
    file name once; ``stream_captures`` lands a day again when its file was replaced.
    """
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return _append(land(explode_json_array(files, "value")), table, checkpoint)


def stream_captures(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    land: Callable[[DataFrame], DataFrame],
    pattern: str = "*.json",
) -> StreamingQuery:
    """Land every day file that is new, or was captured again under its name, since the last run, then stop.

    A file whose size or modification time has changed lands as a whole, as newer versions of its
    items; a file that did not change is not read. Items that a new capture lacks stay as they were.
    ``raw`` is kept as captured and no file is held in memory. Give a folder and a checkpoint only to
    one stream at a time.
    """
    register(spark)
    files = spark.readStream.format("captures").option("pattern", pattern).option("log", f"{checkpoint}/captures").load(folder)
    return _append(land(files.select("raw")), table, checkpoint)


def _append(landed: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    return (
        with_created_month(landed)
        .writeStream.format("parquet")
        .partitionBy("created_month")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table)
    )
