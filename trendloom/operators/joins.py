"""Joins with the reference semantics spelled out: defaults for misses, grids, membership."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions.text import Term
from trendloom.operators.quality import rows_per_value


def left_join_defaults(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: dict[str, Any]) -> DataFrame:
    """Left join; right-hand columns named in ``defaults`` get that value where nothing matched."""
    joined = left.join(right, list(on), "left")
    kept = [c for c in joined.columns if c not in defaults]
    return joined.select(*kept, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])


def dense_grid(totals: DataFrame, terms: Iterable[Term], counts: DataFrame, on: str, measures: Sequence[str]) -> DataFrame:
    """Every row of ``totals`` × every term, with the counts of that pair or 0.

    The dictionary is laid out by exploding a constant array, so no join multiplies rows.
    """
    dictionary = F.array(*[F.struct(F.lit(t.tool).alias("tool"), F.lit(t.category).alias("category")) for t in terms])
    grid = totals.select("*", F.explode(dictionary).alias("_term")).select(*totals.columns, "_term.*")
    return left_join_defaults(grid, counts, [on, "tool"], dict.fromkeys(measures, 0))


def with_membership(df: DataFrame, key: str, members: DataFrame, flag: str) -> DataFrame:
    """Add a boolean: does the key occur among the members? Each key of ``members`` counts once."""
    known = members.select(F.col(key).alias("_member")).distinct()
    joined = df.join(known, df[key] == known["_member"], "left")
    return joined.withColumn(flag, F.col("_member").isNotNull()).drop("_member")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, and how many rows carry each; a NULL key is no orphan.

    Counting first leaves one row per key, so a parent with very many children is not skewed; keys of
    both sides are counted as in ``unique``, which shares its shuffle.
    """
    per_key = rows_per_value(child, key).withColumnRenamed("rows", "failures")
    return per_key.join(rows_per_value(parent, parent_key).select("value"), "value", "left_anti")


def never_found(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """The expected values that do not occur at all."""
    wanted = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in expected])).alias(column))
    found = df.where(F.col(column).isin(*expected)).select(column).distinct()
    return wanted.join(found, column, "left_anti")


def in_list(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows of a small dimension picked by an IN list."""
    return df.where(F.col(column).isin(*values))
