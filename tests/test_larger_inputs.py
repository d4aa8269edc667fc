"""Work that must not be done twice, or by one task, as tables grow."""

from __future__ import annotations

from pathlib import Path

import pytest

from trendloom.bindings import queries as q
from trendloom.bindings import tables as t
from trendloom.operators import joins, quality

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["dq_report", "mart_chain"])
def test_the_newest_lines_are_found_once(spark, monkeypatch, name):
    calls, current_lines = [], t.current_lines
    monkeypatch.setattr(t, "current_lines", lambda *a: calls.append(a) or current_lines(*a))
    assert q.QUERIES[name](spark, FOLDER).count() > 0
    assert len(calls) == 1


def test_tests_on_one_column_share_its_shuffle(spark, tmp_path):
    for name, sql in (("posts", "SELECT id FROM VALUES ('a'), ('a'), ('b'), (NULL) v(id)"), ("facts", "SELECT id FROM VALUES ('a'), ('c'), ('c'), (NULL) v(id)")):
        spark.sql(sql).write.parquet(str(tmp_path / name))
    posts, facts = (spark.read.parquet(str(tmp_path / name)) for name in ("posts", "facts"))
    lost = joins.orphans(facts, "id", posts, "id")
    assert [tuple(r) for r in lost.collect()] == [("c", 2)]
    values = [quality.unique(posts, "id").select("id"), quality.unique(facts, "id").select("id"), lost.select("value")]
    report = values[0].unionAll(values[1]).unionAll(values[2])
    assert sorted(r[0] for r in report.collect()) == ["a", "c", "c"]
    final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 2 and final.count("ReusedExchange") == 2


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """All but two events are of one type and day."""
    events = "SELECT id AS event_id, IF(id = 1, 'view', 'click') AS event_type, TIMESTAMP_NTZ '2024-01-01 00:00:00' + MAKE_DT_INTERVAL(IF(id = 2, 1, 0)) AS ts FROM range(60000)"
    spark.sql(events).repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(q, "new_folder", lambda *a: str(tmp_path / "listing"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        rows = q.QUERIES["listing_diff"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sorted(map(tuple, rows)) == [
        ("event_type=click/day=2024-01-01", "copy", True),
        ("event_type=click/day=2024-01-02", "copy", True),
        ("event_type=view/day=2024-01-01", "skip", True),
    ]
    files = [f for f in Path(tmp_path / "listing").rglob("*.txt") if "event_type=click/day=2024-01-01" in str(f)]
    assert len(files) > 1
    assert sum(len(f.read_text().splitlines()) for f in files) == 59_998
