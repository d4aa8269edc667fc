"""The data tests of all models, and one report over them.

Tests on single rows are counted together, one pass per model, however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.operators import quality
from trendloom.operators.joins import never_found, orphans


class RowTest(NamedTuple):
    """Fails for each row of the model that meets the condition."""

    name: str
    model: str
    fails: Column


class SetTest(NamedTuple):
    """Fails for each row of the frame: duplicates, orphans and the like."""

    name: str
    severity: str
    violations: DataFrame


# What is declared per model and column.
NOT_NULL = {
    "stg_posts": ["post_id", "posted_at"],
    "stg_comments": ["comment_id", "post_id", "commented_at"],
    "fct_post_tool_mentions": ["post_id", "tool"],
    "mart_tool_mentions_by_month": ["month", "tool"],
    "fct_posts": ["post_id"],
    "mart_ai_share_by_flair_month": ["month", "flair"],
    "fct_comment_tool_mentions": ["comment_id", "tool"],
    "mart_comment_tool_mentions_by_month": ["month", "tool"],
    "dim_comparison_windows": ["month"],
    "mart_ai_share_change": ["measure"],
    "mart_tool_share_change": ["tool"],
    "mart_ai_share_by_flair_window": ["flair"],
}
UNIQUE = {
    "stg_posts": "post_id",
    "stg_comments": "comment_id",
    "fct_posts": "post_id",
    "dim_comparison_windows": "month",
    "mart_ai_share_change": "measure",
}
ACCEPTED_VALUES = [
    ("stg_posts", "removal_reason", fv.REMOVAL_REASONS),
    ("stg_posts", "later_removal_type", fv.POST_LATER_REMOVALS),
    ("stg_comments", "later_removal_type", fv.COMMENT_LATER_REMOVALS),
    ("dim_comparison_windows", "period", [fv.FIRST, fv.LAST]),
    ("mart_ai_share_by_month", "measure", [fv.POST_TITLES, fv.COMMENTS]),
    ("mart_ai_share_by_flair_window", "period", [fv.FIRST, fv.LAST]),
]
# comments may belong to posts from before the first day file, so orphans among them only warn
RELATIONSHIPS = [
    ("stg_comments", "post_id", "stg_posts", "post_id", "warn"),
    ("fct_post_tool_mentions", "post_id", "stg_posts", "post_id", "error"),
    ("fct_post_tool_mentions", "tool", "tools", "tool", "error"),
    ("fct_posts", "post_id", "stg_posts", "post_id", "error"),
    ("fct_comment_tool_mentions", "comment_id", "stg_comments", "comment_id", "error"),
    ("fct_comment_tool_mentions", "tool", "tools", "tool", "error"),
]
GRAINS = {
    "fct_comment_tool_mentions": ["comment_id", "tool"],
    "fct_post_tool_mentions": ["post_id", "tool"],
    "mart_ai_share_by_flair_month": ["month", "flair"],
    "mart_ai_share_by_flair_window": ["flair", "period"],
    "mart_ai_share_by_month": ["month", "measure"],
    "mart_comment_tool_mentions_by_month": ["month", "tool"],
    "mart_tool_mentions_by_month": ["month", "tool"],
    "mart_tool_share_change": ["tool", "measure"],
}
SHARES = ["first_share_pct", "last_share_pct"]


def share_violations(ai_change: DataFrame, tool_change: DataFrame) -> DataFrame:
    """Share columns outside 0 to 100 in both change marts, tagged with the model."""
    tool_key = F.concat("tool", F.lit(" / "), "measure")
    return quality.outside_percent(ai_change, "ai_share_change", F.col("measure"), SHARES).unionByName(
        quality.outside_percent(tool_change, "tool_share_change", tool_key, SHARES)
    )


def row_tests() -> list[RowTest]:
    tests = [
        RowTest(f"not_null {model}.{column}", model, F.col(column).isNull())
        for model, columns in NOT_NULL.items()
        for column in columns
    ]
    tests += [
        RowTest(f"accepted_values {model}.{column}", model, quality.unaccepted(column, values))
        for model, column, values in ACCEPTED_VALUES
    ]
    tests += [
        RowTest(
            "title within total",
            "mart_tool_mentions_by_month",
            F.col("posts_mentioning_in_title") > F.col("posts_mentioning"),
        ),
        RowTest("null body means removed", "stg_comments", quality.null_unexplained("body", "is_body_removed")),
    ]
    return tests


def narrow_staging(posts: DataFrame, comments: DataFrame) -> dict[str, DataFrame]:
    """What the tests read of staging, to be stored once per build: no text, no author.

    The body of a comment is empty text or NULL, which is all that is tested of it.
    """
    return {
        "stg_posts": posts.select("post_id", "posted_at", "removal_reason", "later_removal_type"),
        "stg_comments": comments.select(
            "comment_id", "post_id", "commented_at", "later_removal_type", "is_body_removed", F.left("body", F.lit(0)).alias("body")
        ),
    }


def set_tests(
    models: dict[str, DataFrame],
    window_months: int = fv.WINDOW_MONTHS,
    expected_terms: Sequence[str] = fv.MULTI_WORD_TOOLS,
) -> list[SetTest]:
    tests = [SetTest(f"unique {m}.{c}", "error", quality.unique(models[m], c)) for m, c in UNIQUE.items()]
    tests += [
        SetTest(f"relationships {m}.{c}", severity, orphans(models[m], c, models[parent], key))
        for m, c, parent, key, severity in RELATIONSHIPS
    ]
    tests += [SetTest(f"grain {m}", "error", quality.grain_unique(models[m], keys)) for m, keys in GRAINS.items()]
    tests += [
        SetTest("window size", "error", quality.window_size(models["dim_comparison_windows"], window_months)),
        SetTest(
            "shares are percentages",
            "error",
            share_violations(models["mart_ai_share_change"], models["mart_tool_share_change"]),
        ),
        SetTest(
            "multi-word tools found", "error", never_found(models["fct_post_tool_mentions"], "tool", expected_terms)
        ),
    ]
    return tests


def _result(name: str, severity: str, failures: Column) -> Column:
    return F.struct(F.lit(name).alias("test"), F.lit(severity).alias("severity"), failures.alias("failures"))


def _count_row_tests(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    counted = df.agg(*[F.count_if(test.fails).alias(f"n{i}") for i, test in enumerate(tests)])
    results = F.array(*[_result(test.name, "error", F.col(f"n{i}")) for i, test in enumerate(tests)])
    return counted.select(F.explode(results).alias("r")).select("r.*")


RowCounts = dict[str, dict[str, int]]


def watched(model: str, df: DataFrame) -> tuple[DataFrame, Observation | None]:
    """A model that counts the failures of its row tests while it is written."""
    tests = [test for test in row_tests() if test.model == model]
    if not tests:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.count_if(test.fails).alias(f"n{i}") for i, test in enumerate(tests)]), seen


def counts_of(model: str, seen: Observation) -> dict[str, int]:
    """Failures by test, once the model is written."""
    found = seen.get
    return {test.name: found[f"n{i}"] for i, test in enumerate(t for t in row_tests() if t.model == model)}


def report(
    models: dict[str, DataFrame],
    window_months: int = fv.WINDOW_MONTHS,
    expected_terms: Sequence[str] = fv.MULTI_WORD_TOOLS,
    row_counts: RowCounts | None = None,
) -> DataFrame:
    """One row per test of all 50: failing rows, and ``pass``, ``warn`` or ``error``.

    ``models`` holds staging, facts and marts by name, and the dictionary as ``tools``. Staging is
    read by several tests: pass the stored frames of ``narrow_staging``, not lazy views. Models whose
    row tests were counted while they were written, ``row_counts``, are not read for them again.
    """
    by_model: dict[str, list[RowTest]] = {}
    known = [(name, "error", n) for counts in (row_counts or {}).values() for name, n in counts.items()]
    for test in row_tests():
        if test.model not in (row_counts or {}):
            by_model.setdefault(test.model, []).append(test)
    parts = [_count_row_tests(models[model], tests) for model, tests in by_model.items()]
    if known:
        spark = models["tools"].sparkSession
        parts.append(spark.createDataFrame(known, "test string, severity string, failures long"))
    for test in set_tests(models, window_months, expected_terms):
        counted = test.violations.agg(F.count("*").alias("n"))
        parts.append(counted.select(_result(test.name, test.severity, F.col("n")).alias("r")).select("r.*"))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))
