"""Versioned raw tables and day slices on a file system."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from trendloom.operators.versions import latest_by_key
from trendloom.sources.landing import with_created_month

NEWEST_FIRST = ("_loaded_at", "retrieved_on", "_digest")


def newest_first() -> list[Column]:
    """Total order of the versions of one id: load stamp, capture time, then the content digest.

    Rows that tie in all three hold the same object, so it does not matter which one stays.
    """
    return [F.col(c).desc() for c in NEWEST_FIRST]


def append_raw(landed: DataFrame, path: str, gather_months: bool = False) -> None:
    """Append a load to a month-partitioned raw table; repeating a load changes no result.

    Day files come in order of time, so a task writes to a month or two and nothing is
    shuffled. ``gather_months`` is for rows in no such order: it brings a month's rows into few
    files, and splits a month that holds most of them.
    """
    rows = with_created_month(landed)
    if gather_months:
        rows = rows.hint("rebalance", F.col("created_month"))
    rows.write.mode("append").partitionBy("created_month").parquet(path)


def read_versions(spark: SparkSession, *paths: str) -> DataFrame:
    """Every loaded version of every item, from one raw table or several.

    A table a stream writes is read by the stream's own log, so batch loads go to a table of
    their own; the newest version is the same wherever it was loaded.
    """
    return reduce(DataFrame.unionByName, [spark.read.parquet(path) for path in paths])


def current_state(versions: DataFrame) -> DataFrame:
    """Newest version per id, over all months: a version may sit in another partition."""
    return latest_by_key(versions, ["id"], newest_first())


def load_if_present(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The rows at a path, or None before its first write."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def days_present(spark: SparkSession, path: str) -> DataFrame | None:
    """Days that already have a slice, from the listing alone; None before the first write."""
    files = load_if_present(spark.read.format("binaryFile").option("recursiveFileLookup", True), path)
    if files is None:
        return None
    return files.select(F.regexp_extract("path", r"/day=([^/]+)/", 1).alias("day")).distinct()


def write_day_slices(rows: DataFrame, path: str, force: bool = False) -> None:
    """Write rows with a ``day`` and a ``raw`` column as JSON lines, one folder per day.

    Days that have a slice are skipped, or replaced as a whole when forced; other days stay.
    """
    present = None if force else days_present(rows.sparkSession, path)
    if present is not None:
        # one row per calendar day, however many rows a day has
        rows = rows.join(F.broadcast(present), "day", "left_anti")
    rows = rows.select("day", F.col("raw").alias("value")).hint("rebalance", F.col("day"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").text(path)


def write_json_arrays(arrays: DataFrame, path: str) -> None:
    """Write one file per row, each row the text of a JSON array, below ``day=…`` folders."""
    arrays.select("day", "value").write.option("maxRecordsPerFile", 1).partitionBy("day").text(path)


def overwrite_table(df: DataFrame, path: str, partition: str | None = None) -> DataFrame:
    """Store a model, replacing the last build, and read it back."""
    writer = df.hint("rebalance", F.col(partition)).write.partitionBy(partition) if partition else df.write
    writer.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
