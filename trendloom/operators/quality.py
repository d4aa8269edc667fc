"""Checks that return the violating rows: an empty result is a pass.

Checks over whole tables return one row per violating value with its number of rows, so the
result is aggregated before anything is shuffled and stays small when everything is wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import fixed_values as fv


class StaleSourceError(RuntimeError):
    """A source is older than its freshness budget allows."""


def not_null(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per (item, column) that is NULL, for all columns in one scan."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.select(F.col(key), F.explode(missing).alias("column"))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return grain_unique(df.where(F.col(column).isNotNull()), [column])


def grain_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def rows_per_value(df: DataFrame, column: str) -> DataFrame:
    """Each value that is not NULL as ``value``, with its ``rows``.

    The filter keeps the counts in the plan where only the values are used: then this is the shuffle of
    ``unique``, and Spark runs one for all tests on the column.
    """
    per_value = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    return per_value.where("rows > 0")


def unaccepted(column: str, values: Sequence[str]) -> Column:
    """Neither NULL nor in the list."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def null_unexplained(column: str, flag: str) -> Column:
    """NULL although the flag that would explain it is not set; a NULL flag explains nothing."""
    return F.col(column).isNull() & ~F.coalesce(F.col(flag), F.lit(False))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list and how often each occurs; NULL passes."""
    return (
        df.where(unaccepted(column, values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def window_size(windows: DataFrame, window_months: int = fv.WINDOW_MONTHS) -> DataFrame:
    """Windows that hold more months than allowed."""
    return windows.groupBy("period").agg(F.count("*").alias("months")).where(F.col("months") > window_months)


def exceeds(df: DataFrame, part: str, whole: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose part is larger than the whole."""
    return df.where(F.col(part) > F.col(whole)).select(*keys, whole, part)


def outside_percent(df: DataFrame, model: str, key: Column, columns: Sequence[str]) -> DataFrame:
    """Rows with a share outside 0 to 100; a NULL share passes."""
    within = F.lit(True)
    for column in columns:
        within = within & F.coalesce(F.col(column), F.lit(0)).between(0, 100)
    return df.where(~within).select(F.lit(model).alias("model"), key.alias("key"), *columns)


def null_without_flag(df: DataFrame, key: str, column: str, flag: str) -> DataFrame:
    """Rows whose column is NULL although the flag that would explain it is not set."""
    return df.where(null_unexplained(column, flag)).select(key)


def freshness(
    df: DataFrame,
    moment: str,
    source: str,
    now: str,
    warn_hours: int = fv.FRESHNESS_WARN_HOURS,
    error_hours: int = fv.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Age of the newest row in hours at ``now``, and what that means for the rebuild.

    Measured on the time of the events, since a source may go on loading without anything new. A
    source without any row counts as an error. Of a table stored by month only the newest month
    is read; the months themselves come from the folder names.
    """
    if "created_month" in df.columns and moment == "created_utc":
        df = df.where(F.col("created_month") == df.select(F.max("created_month")).scalar())
    newest = df.agg(F.max(F.col(moment)).cast("timestamp_ntz").alias("newest"))
    age = F.timestamp_diff("MICROSECOND", F.col("newest"), F.lit(now).cast("timestamp_ntz"))
    aged = newest.select(F.lit(source).alias("source"), "newest", (age / F.lit(3_600_000_000)).alias("age_hours"))
    status = (
        F.when(F.col("newest").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return aged.withColumn("status", status)


def require_fresh(report: DataFrame) -> list[str]:
    """Raise if any source is in error, else name the sources to warn about."""
    rows = report.select("source", "status", "age_hours").collect()  # one row per source
    stale = [f"{r.source} ({r.age_hours} h)" for r in rows if r.status == "error"]
    if stale:
        raise StaleSourceError("no new rows in: " + ", ".join(sorted(stale)))
    return sorted(r.source for r in rows if r.status == "warn")


def author_columns(df: DataFrame) -> list[str]:
    """Columns that would expose an author, direct or pseudonymised; marts must have none."""
    return [c for c in df.columns if c == "author" or c.startswith("author_")]
