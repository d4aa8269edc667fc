from __future__ import annotations

from trendloom.bindings import queries as q
from trendloom.bindings import tables as t
from trendloom.plans import checks, rebuild
from trendloom.sources import terms

FOLDER = "/root/testdata/sf0.001"


def test_rows_counted_while_written_give_the_same_report(spark, tmp_path):
    counts: checks.RowCounts = {}
    models = rebuild.store_models(q._matched_posts(spark, FOLDER), q._matched_comments(spark, FOLDER), t.PART_TERMS, str(tmp_path / "m"), row_counts=counts)
    assert set(counts) == {test.model for test in checks.row_tests()} - {"stg_posts", "stg_comments"}
    staging = {"stg_posts": q._posts(spark, FOLDER), "stg_comments": q._comments(spark, FOLDER), "tools": terms.term_frame(spark, t.PART_TERMS)}
    with_counts = rebuild.tested({**staging, **models}, str(tmp_path / "a"), counts)
    read_again = checks.report({**staging, **models})
    assert sorted(map(str, with_counts.collect())) == sorted(map(str, read_again.collect()))
    scans = [df._jdf.queryExecution().sparkPlan().toString().count("FileScan") for df in (with_counts, read_again)]
    assert scans[0] + len(counts) <= scans[1]


def test_failures_are_counted(spark, tmp_path):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS post_id, 'x' AS tool UNION ALL SELECT 'p', NULL UNION ALL SELECT NULL, NULL")
    counts: checks.RowCounts = {}
    rebuild.store_tables({"fct_post_tool_mentions": df, "other": df}, str(tmp_path), counts)
    assert counts == {"fct_post_tool_mentions": {"not_null fct_post_tool_mentions.post_id": 2, "not_null fct_post_tool_mentions.tool": 2}}
