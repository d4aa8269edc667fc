from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from trendloom.functions.scalars import pct, round_half_even
from trendloom.operators import joins, quality, windows
from trendloom.plans import serving


def months(spark, count):
    rows = [(date(2020 + i // 12, i % 12 + 1, 1),) for i in range(count)]
    return spark.createDataFrame(rows, "month date")


def expected_windows(count, n):
    complete = list(range(1, count - 1))
    result = {}
    for position, index in enumerate(complete, start=1):
        if position <= n:
            result[index] = "first"
        elif position > len(complete) - n:
            result[index] = "last"
    return {(date(2020 + i // 12, i % 12 + 1, 1), p) for i, p in result.items()}


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 8, 14, 15, 30])
@pytest.mark.parametrize("n", [1, 3, 6])
def test_windows_shrink_and_never_overlap(spark, count, n):
    found = {tuple(r) for r in windows.comparison_windows(months(spark, count), n).collect()}
    assert found == expected_windows(count, n)


def test_rounding_is_half_to_even_on_the_binary_value(spark):
    values = [0.125, 0.375, 2.5 / 100, 1.005, 1.015, 11.705, 33.333333, -0.125]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_half_even(F.col("v")).alias("r"))
    for row in rows.collect():
        scaled = row.v * 100
        assert row.r == float(round(scaled)) / 100


def test_percent_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(0, 0), (1, 3), (0, 4)], "a long, b long")
    assert [r[0] for r in rows.select(pct(F.col("a"), F.col("b"))).collect()] == [None, 33.33, 0.0]


CHANGE = "tool string, category string, is_ai boolean, measure string, first_share_pct double, last_share_pct double, change_pts double"


def change(spark, *rows):
    return spark.createDataFrame(
        [(tool, "ai" if ai else "x", ai, measure, 1.0, 1.0, pts) for tool, ai, measure, pts in rows], CHANGE
    )


def test_movers_break_ties_by_tool_and_ignore_comments(spark):
    table = change(
        spark,
        ("Gear", False, "Post titles", 0.5), ("Anvil", False, "Post titles", 0.5), ("Bolt", False, "Post titles", 0.5),
        ("Cog", False, "Post titles", 0.5), ("Disc", False, "Post titles", -2.0), ("Rod", True, "Post titles", 1.0),
        ("Gizmo", True, "Post titles", 3.0), ("Disc", False, "Comments", 99.0), ("Void", False, "Post titles", None),
    )
    lists = {}
    for row in serving.digest_movers(table).collect():
        lists.setdefault(row.section, []).append((row.place, row.tool))
    assert lists == {
        "AI tools rising fastest": [(1, "Gizmo"), (2, "Rod")],
        "Other tools rising most": [(1, "Anvil"), (2, "Bolt"), (3, "Cog")],
        "Other tools falling most": [(1, "Disc"), (2, "Anvil"), (3, "Bolt")],
    }
    assert tuple(serving.largest_other_move(table).first()) == ("Disc", -2.0)
    listed = serving.tool_changes(table, "Post titles").collect()
    assert [r.tool for r in listed][:3] == ["Gizmo", "Rod", "Anvil"] and listed[0].group == "AI tools"


def test_few_other_tools_may_both_rise_and_fall(spark):
    table = change(spark, ("A", False, "Post titles", 1.0), ("B", False, "Post titles", -1.0))
    lists = [(r.section, r.tool) for r in serving.digest_movers(table).collect()]
    assert sorted(lists) == [
        ("Other tools falling most", "A"), ("Other tools falling most", "B"),
        ("Other tools rising most", "A"), ("Other tools rising most", "B"),
    ]


def test_latest_two_months_fill_a_missing_share_and_mark_the_running_month(spark):
    monthly = spark.createDataFrame(
        [(date(2031, 1, 1), "Post titles", 41.25), (date(2031, 2, 1), "Comments", 3.0),
         (date(2031, 2, 1), "Post titles", 38.0), (date(2031, 3, 1), "Comments", 2.75)],
        "month date, measure string, share_pct double",
    )
    rows = [(r.measure, r.month.month, r.share_pct, r.label) for r in serving.latest_two_months(monthly, "2031-03-04").collect()]
    assert rows == [
        ("Comments", 2, 3.0, "Feb 2031"), ("Comments", 3, 2.75, "Mar 2031 (so far)"),
        ("Post titles", 2, 38.0, "Feb 2031"), ("Post titles", 3, 0.0, "Mar 2031 (so far)"),
    ]


def test_window_labels(spark):
    frame = spark.createDataFrame(
        [(date(2029, 5, 1), "first"), (date(2029, 7, 1), "first"), (date(2030, 11, 1), "last"), (date(2031, 1, 1), "last")],
        "month date, period string",
    )
    assert [r.label for r in serving.window_labels(frame).collect()] == ["May 2029 – Jul 2029", "Nov 2030 – Jan 2031"]


def test_json_rows_keep_nulls(spark):
    row = serving.json_rows(spark.createDataFrame([(1, None)], "a int, b string")).first().row
    assert json.loads(row) == {"a": 1, "b": None}


def test_checks_return_violations(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, "b"), (None, "b"), (None, "c")], "k int, v string")
    assert [tuple(r) for r in quality.unique(rows, "k").collect()] == [(2, 2)]
    assert [tuple(r) for r in quality.accepted_values(rows, "v", ["a", "c"]).collect()] == [("b", 2)]
    assert sorted(map(str, quality.not_null(rows, "v", ["k", "v"]).collect())) == sorted(
        map(str, [("b", "k"), ("c", "k"), (None, "v")])
    ) or quality.not_null(rows, "v", ["k", "v"]).count() == 3
    parents = spark.createDataFrame([(1,), (3,)], "id int")
    assert [tuple(r) for r in joins.orphans(rows, "k", parents, "id").collect()] == [(2, 2)]
    assert [r.v for r in joins.never_found(rows, "v", ["a", "z", "b"]).collect()] == ["z"]


def test_percent_range_lets_null_pass(spark):
    rows = spark.createDataFrame([("a", None, 5.0), ("b", -0.1, 5.0), ("c", 1.0, 100.1), ("d", 0.0, 100.0)], "k string, x double, y double")
    found = quality.outside_percent(rows, "m", F.col("k"), ["x", "y"])
    assert sorted(r.key for r in found.collect()) == ["b", "c"]


def test_null_explained_by_a_flag(spark):
    rows = spark.createDataFrame([(1, None, True), (2, None, False), (3, None, None), (4, "t", None)], "k int, body string, gone boolean")
    assert sorted(r.k for r in quality.null_without_flag(rows, "k", "body", "gone").collect()) == [2, 3]


def test_join_helpers(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, 5), (1, 6)], "k int, n int")
    joined = joins.left_join_defaults(left, right.dropDuplicates(["k"]).select("k", F.lit(5).alias("n")), ["k"], {"n": 0})
    assert sorted(tuple(r) for r in joined.collect()) == [(1, "a", 5), (2, "b", 0)]
    flagged = joins.with_membership(left, "k", right, "there")
    assert sorted((r.k, r.there) for r in flagged.collect()) == [(1, True), (2, False)]
