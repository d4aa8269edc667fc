"""Which items of a listing are missing, or differ in size, on the other side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Key (path below the folder) and size of every file; the content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    key = F.substring("path", len(base.encode("utf-16-le")) // 2 + 2, 2**31 - 1)
    return files.load(folder).select(key.alias("key"), F.col("length").alias("size"))


def manifest_diff(source: DataFrame, target: DataFrame, key: str = "key", size: str = "size") -> DataFrame:
    """Each source item with what to do: ``copy`` if missing or of another size, else ``skip``."""
    there = target.select(F.col(key), F.col(size).alias("_size"))
    same: Column = F.coalesce(F.col(size) == F.col("_size"), F.lit(False))
    return source.join(there, key, "left").select(key, size, F.when(same, "skip").otherwise("copy").alias("action"))


def diff_counts(diff: DataFrame) -> DataFrame:
    """Items copied and skipped."""
    return diff.agg(
        F.count_if(F.col("action") == "copy").alias("copied"),
        F.count_if(F.col("action") == "skip").alias("skipped"),
    )
