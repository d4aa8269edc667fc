"""Scanning raw day files: one JSON array of objects per kind and UTC day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

def explode_json_array(df: DataFrame, array_text: str, name: str = "raw") -> DataFrame:
    """One row of JSON text per element of a top-level JSON array; a broken one is an error.

    An element keeps all its fields and their order; numbers come back in Spark's notation, so
    ``0.90`` becomes ``0.9``, and spacing is dropped.
    """
    elements = F.from_json(F.col(array_text), ArrayType(StringType()), {"mode": "FAILFAST"})
    kept = [c for c in df.columns if c != array_text]
    return df.select(*kept, F.explode(elements).alias(name))


def in_day_range(day: Column, start: str | None, end: str | None) -> Column:
    """Inclusive range of ISO days as text; without a start every day, without an end one day."""
    if start is None:
        return F.lit(True)
    return day.between(start, end or start)


def slice_days(df: DataFrame, moment: str, start: str, end: str | None = None) -> DataFrame:
    """Rows of the UTC days ``start`` to ``end``: half-open, so midnight belongs to one day.

    Plain comparisons on the column, so the range is pushed down to the scan.
    """
    first = F.lit(start).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(end or start).cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(moment) >= first) & (F.col(moment) < after))


def file_day(path: Column) -> Column:
    """The day a file is of: the last ISO date in its name, else that of its ``day=`` folder; else empty."""
    day = r"(\d{4}-\d{2}-\d{2})"
    named = F.regexp_extract(path, f".*{day}[^/]*$", 1)
    return F.when(named != "", named).otherwise(F.regexp_extract(path, f"/day={day}/[^/]*$", 1))


def scan_raw(
    spark: SparkSession, folder: str, start: str | None = None, end: str | None = None, pattern: str = "*.json"
) -> DataFrame:
    """Raw objects of ``{folder}/{YYYY-MM-DD}.json``: every file, one day, or a range of days.

    One reader for files of every size: a JSON array cannot be split, so a file is one text value
    and one task, which holds it with its elements; a file beyond what a value can hold is an
    error, never read in another way. Files outside the range are pruned before they are read. A
    day without a file is simply absent.
    """
    files = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(folder)
    day = file_day(F.col("_metadata.file_path"))
    chosen = files.where(in_day_range(day, start, end))
    return explode_json_array(chosen.select(day.alias("day"), "value"), "value")


def scan_lines(spark: SparkSession, folder: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Raw objects from the day slices this library writes: JSON lines below ``day=…``.

    Lines split across tasks, however large the day, and a range of days prunes partitions.
    """
    rows = spark.read.schema("value STRING, day STRING").text(folder)
    return rows.where(in_day_range(F.col("day"), start, end)).select("day", F.col("value").alias("raw"))
