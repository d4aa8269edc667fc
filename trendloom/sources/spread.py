"""Sharing out the rows of a scan over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan that has fewer partitions than there are cores.

    A file of one row group is one task, whatever follows the scan. Scans of more partitions stay
    as they are; the number is planned from the file listing that the scan has anyway.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
