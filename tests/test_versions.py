from __future__ import annotations

from pyspark.sql import functions as F

from trendloom.operators.versions import dedup_last, latest_by_key
from trendloom.sources.landing import land_posts
from trendloom.sources.tables import append_raw, current_state, read_versions
from forum import post
import json


def raw(spark, *objects):
    return spark.createDataFrame([(json.dumps(o),) for o in objects], "raw string")


def test_newest_version_wins_and_ties_break_by_the_next_column(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "p"), ("b", 1, "q"), ("c", 5, "z")], "k string, v int, t string"
    )
    newest = latest_by_key(rows, ["k"], [F.col("v").desc(), F.col("t").desc()])
    assert sorted(map(tuple, newest.collect())) == [("a", 2, "y"), ("b", 1, "q"), ("c", 5, "z")]


def test_dedup_last_keeps_the_occurrence_seen_last(spark):
    rows = spark.createDataFrame([("a", 0, 1), ("b", 1, 2), ("a", 2, 3)], "id string, seq int, v int")
    assert sorted(tuple(r) for r in dedup_last(rows, "id", "seq").collect()) == [("a", 2, 3), ("b", 1, 2)]


def test_a_reload_changes_nothing_and_a_newer_version_may_sit_in_another_month(spark, tmp_path):
    path = str(tmp_path / "posts")
    first = [post("p1", "2024-01-31 23:00", "old"), post("p2", "2024-02-01 00:00", "two")]
    append_raw(land_posts(raw(spark, *first), "2024-03-01 00:00:00"), path)
    once = sorted(map(tuple, current_state(read_versions(spark, path)).drop("_loaded_at").collect()))
    append_raw(land_posts(raw(spark, *first), "2024-03-02 00:00:00"), path)
    twice = sorted(map(tuple, current_state(read_versions(spark, path)).drop("_loaded_at").collect()))
    assert once == twice and len(once) == 2

    moved = post("p1", "2024-02-01 01:00", "new")
    append_raw(land_posts(raw(spark, moved), "2024-03-03 00:00:00"), path)
    titles = {r.id: r.title for r in current_state(read_versions(spark, path)).collect()}
    assert titles == {"p1": "new", "p2": "two"}


def test_versions_of_several_tables_resolve_together(spark, tmp_path):
    batch, streamed = str(tmp_path / "batch"), str(tmp_path / "streamed")
    append_raw(land_posts(raw(spark, post("p1", "2024-01-01", "early")), "2024-01-02 00:00:00"), batch)
    append_raw(land_posts(raw(spark, post("p1", "2024-01-01", "late")), "2024-01-03 00:00:00"), streamed)
    assert [r.title for r in current_state(read_versions(spark, batch, streamed)).collect()] == ["late"]


def test_equal_stamps_resolve_the_same_way_in_any_order(spark):
    objects = [post("p1", "2024-01-01", f"title {i}") for i in range(6)]
    results = set()
    for order in (objects, objects[::-1], objects[3:] + objects[:3]):
        landed = land_posts(raw(spark, *order), "2024-01-02 00:00:00").repartition(3)
        results.add(current_state(landed).first().title)
    assert len(results) == 1
