"""The term dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.text import Term, check_terms

TERM_SCHEMA = "tool STRING, category STRING, pattern STRING, exclude_pattern STRING"


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary CSV with a header; a blank cell means no exclusion."""
    rows = spark.read.schema(TERM_SCHEMA).option("header", True).csv(path)
    return rows.withColumn("exclude_pattern", F.nullif("exclude_pattern", F.lit("")))


def term_list(terms: DataFrame) -> list[Term]:
    """The dictionary on the driver, in a fixed order; it becomes part of the query plan."""
    rows = terms.collect()
    return check_terms(sorted(Term(r.tool, r.category, r.pattern, r.exclude_pattern or None) for r in rows))


def term_frame(spark: SparkSession, terms: list[Term]) -> DataFrame:
    return spark.createDataFrame([tuple(t) for t in terms], TERM_SCHEMA)


def shipped_terms() -> list[Term]:
    """The shipped tool dictionary."""
    rows = [line.split(",") for line in fv.TOOL_DICTIONARY.strip().splitlines()]
    return check_terms(Term(*row[:3], row[3] or None) for row in rows)
