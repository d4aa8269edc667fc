"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from trendloom.bindings.queries import QUERIES
from trendloom.functions.text import Term
from trendloom.operators import quality
from trendloom.operators.versions import latest_by_key
from trendloom.plans import facts
from trendloom.sources import raw_files, tables
from trendloom.sources.landing import land_posts, with_created_month

FOLDER = "/root/testdata/sf0.001"
# read day files as captured, and match thousands of terms, in Python workers
BY_WORKERS = ("scan_raw_verbatim", "text_mentions_large")
STORED_FIRST = ("mart_chain", "dq_report", "dq_no_author_columns", "stream_day_files", "stream_recaptured_day", "marts_incremental", "flair_mart_incremental")
LAZY = [name for name in QUERIES if name not in (*STORED_FIRST, *BY_WORKERS) and "_from_" not in name]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_crosses_rows_or_leaves_the_jvm(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Scan ExistingRDD"):
        assert node not in text


def test_versions_are_reduced_before_and_after_the_shuffle(spark):
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(latest_by_key(rows, ["l_orderkey"], [F.col("l_shipdate").desc()]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_the_text_is_matched_before_it_would_be_shuffled(spark):
    raw = spark.createDataFrame([("{}",)], "raw string")
    versions = with_created_month(land_posts(raw, "2024-01-01 00:00:00"))
    text = plan(facts.match_post_versions(versions, [Term("Spark", "x", "spark")]))
    below_shuffle = text.split("Exchange", 1)[1]
    above_shuffle = text.split("Exchange", 1)[0]
    assert "RLIKE" in below_shuffle and "RLIKE" not in above_shuffle
    assert "selftext" not in above_shuffle


def test_each_regex_runs_once_per_text(spark):
    text = plan(entry.queries()["text_mentions"](spark, FOLDER))
    assert not re.search(r"Filter [^\n]*RLIKE", text)


def test_stored_raw_text_is_not_read_again(spark, tmp_path):
    path = str(tmp_path / "posts")
    raw = spark.createDataFrame([('{"id": "a", "title": "spark", "created_utc": 1704067200}',)], "raw string")
    tables.append_raw(land_posts(raw, "2024-01-01 00:00:00"), path)
    text = plan(facts.match_post_versions(tables.read_versions(spark, path), [Term("Spark", "x", "spark")]))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "selftext" in schema and "raw:" not in schema and "author" not in schema


def test_months_days_and_times_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "months")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumnRenamed("o_orderdate", "created_utc")
    tables.append_raw(orders, path, gather_months=True)
    text = plan(tables.read_versions(spark, path).where("created_month = date'1996-03-01'"))
    assert re.search(r"PartitionFilters: \[[^\]]*created_month", text)

    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan(raw_files.slice_days(events, "ts", "2024-01-02")))

    days = str(tmp_path / "days")
    tables.write_day_slices(spark.createDataFrame([("2024-01-01", "a"), ("2024-01-02", "b")], "day string, raw string"), days)
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan(raw_files.scan_lines(spark, days, "2024-01-02")))


def test_the_report_finds_no_newest_version_again(spark):
    """Staging is stored for the tests, once for each kind."""
    text = plan(QUERIES["dq_report"](spark, FOLDER))
    assert "WindowGroupLimit" not in text
    assert "l_partkey" not in text and "o_orderkey" not in text
    assert "comment_id" in text


def test_freshness_reads_the_newest_month(spark, tmp_path):
    path = str(tmp_path / "posts")
    raw = [f'{{"id": "{i}", "created_utc": {1704067200 + i * 86400 * 20}}}' for i in range(6)]
    tables.append_raw(land_posts(spark.createDataFrame([(r,) for r in raw], "raw string"), "2024-05-01 00:00:00"), path, gather_months=True)
    report = quality.freshness(tables.read_versions(spark, path), "created_utc", "posts", "2024-04-10 00:00:00")
    assert str(report.first().newest) == "2024-04-10 00:00:00"
    scans = re.findall(r"FileScan parquet \[created_utc[^\n]*", plan(report))
    assert len(scans) == 1 and re.search(r"PartitionFilters: \[[^\]]*created_month[^\]]*(?i:subquery)", scans[0])


def test_a_load_of_day_files_is_not_shuffled(spark, day_files):
    raw = raw_files.scan_raw(spark, day_files("posts", {"2024-01-01": [{"id": "a"}]}))
    assert "Exchange" not in plan(with_created_month(land_posts(raw)))


def test_columns_are_pruned_to_what_a_mart_needs(spark):
    text = plan(entry.queries()["monthly_counts"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text
