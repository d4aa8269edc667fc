"""Newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order, which must be total to be repeatable.

    ``row_number() = 1`` is planned with a group limit before the shuffle as well as after
    it, so a key with very many versions leaves each task as a single row.
    """
    versions = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_version", F.row_number().over(versions)).where("_version = 1").drop("_version")


def dedup_last(df: DataFrame, key: str, sequence: str) -> DataFrame:
    """Within one batch keep the occurrence of each id that was seen last."""
    return latest_by_key(df, [key], [F.col(sequence).desc()])
