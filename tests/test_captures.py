from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from forum import POSTS, post
from trendloom.sources import captures, json_cutter, raw_files, tables
from trendloom.sources.landing import land_posts
from trendloom.streaming.day_files import stream_captures


def cut(text: bytes, piece: int) -> list[bytes]:
    cutter, out = json_cutter.Cutter(), []
    for at in range(0, len(text), piece):
        out += cutter.feed(text[at : at + piece])
    cutter.finish()
    return out


def some_value(r, depth=0):
    kind = r.randrange(8)
    if kind == 0:
        return r.choice([1, 0.9, -3, 1e5, True, None])
    if kind < 4 or depth > 2:
        return "".join(r.choices('ab"\\[]{},: \né😀', k=r.randrange(12)))
    if kind < 6:
        return [some_value(r, depth + 1) for _ in range(r.randrange(4))]
    return {f'{i}"\\': some_value(r, depth + 1) for i in range(r.randrange(4))}


def test_elements_are_the_bytes_of_the_text_whatever_the_pieces():
    r = random.Random(2)
    for _ in range(500):
        own = [json.dumps(some_value(r), ensure_ascii=r.random() < 0.5, separators=r.choice([(",", ":"), (" , ", " : ")])) for _ in range(r.randrange(6))]
        text = r.choice(["", "\ufeff", " \n"]) + "[" + r.choice([",", " ,\n "]).join(own) + r.choice(["]", " ]\n"])
        objects = [e for e in own if e.startswith("{")]
        for piece in (1, 2, 7, 1000):
            assert [e.decode() for e in cut(text.encode(), piece)] == own
            assert [e.decode() for e in cut("\n".join(objects).encode(), piece)] == objects


BROKEN = ["[1,2", "[1,,2]", "[1,]", "[,1]", "x", "[1]x", '{"a":1} x', '{"a":1', '["a]', "[1}", '{"a":1},{"b":2}', '{"a":1}]', "[1]]", '[{"a":1]']


@pytest.mark.parametrize("text", BROKEN)
def test_a_text_that_is_not_whole_is_an_error(text):
    for piece in (1, 100):
        with pytest.raises(json_cutter.BrokenJsonError):
            cut(text.encode(), piece)


def test_raw_equals_the_bytes_of_the_file(spark, tmp_path):
    own = ['{"id": "a",  "upvote_ratio": 0.90}', '{"id":"b","t":"\\u00e9 \\/ \\"]"}', "[ 1.0 , 2 ]", '"é"', "1E+2", "null"]
    (tmp_path / "2024-01-05.json").write_text("[ " + " ,\n".join(own) + " ]", encoding="utf-8")
    (tmp_path / "2024-01-06.json").write_text("")
    (tmp_path / "2024-01-07.json").write_text("[]")
    (tmp_path / "_other").mkdir()
    (tmp_path / "_other" / "2024-01-05.json").write_text("broken")
    rows = captures.scan_captured(spark, str(tmp_path)).orderBy("place").collect()
    assert [r.raw for r in rows] == own
    assert {(r.day, r.path) for r in rows} == {("2024-01-05", "2024-01-05.json")}


def test_days_and_a_broken_file(spark, day_files):
    folder = day_files("posts", POSTS)
    ids = captures.scan_captured(spark, folder, "2024-01-10", "2024-02-05").select(F.get_json_object("raw", "$.id"))
    assert sorted(r[0] for r in ids.collect()) == ["p1", "p2", "p3", "p4", "p5", "p6", "p7"]
    assert captures.scan_captured(spark, folder, "2019-01-01").count() == 0
    with open(f"{folder}/2024-09-09.json", "w") as file:
        file.write('[{"id": "b"}, {"id": ')
    with pytest.raises(Exception, match="2024-09-09.json: malformed"):
        captures.scan_captured(spark, folder).collect()


def test_days_are_written_under_their_names_and_skipped_unless_forced(spark, tmp_path):
    folder = str(tmp_path / "days")

    def write(*rows, force=False):
        captures.write_captures(spark.createDataFrame(list(rows), "day string, raw string, n int"), folder, force, "n")

    write(("2024-01-01", "{ }", 2), ("2024-01-01", '{"a":1.0}', 1), ("2024-01-02", "3", 1), (None, "4", 1))
    assert sorted(os.listdir(folder)) == ["2024-01-01.json", "2024-01-02.json"]
    assert (tmp_path / "days" / "2024-01-01.json").read_text() == '[{"a":1.0},\n{ }]'
    write(("2024-01-01", "9", 1), ("2024-01-03", "5", 1))
    assert (tmp_path / "days" / "2024-01-01.json").read_text() != "[9]"
    write(("2024-01-01", "9", 1), force=True)
    got = {(r.day, r.place): r.raw for r in captures.scan_captured(spark, folder).collect()}
    assert got == {("2024-01-01", 0): "9", ("2024-01-02", 0): "3", ("2024-01-03", 0): "5"}


def test_a_day_captured_again_under_its_name_lands_again(spark, day_files, tmp_path):
    folder = day_files("posts", POSTS)
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run(stamp):
        stream_captures(spark, folder, table, progress, lambda raw: land_posts(raw, stamp)).awaitTermination()
        return tables.read_versions(spark, table)

    assert run("2024-05-01 00:00:00").count() == 12
    assert run("2024-05-02 00:00:00").count() == 12
    day = [post("p2", "2024-01-10 09:00", "changed"), post("p1", "2024-01-10 08:00", "other")]
    day_files("posts", {"2024-01-10": day, "2024-12-01": [post("p99", "2024-12-01 09:00", "new")]})
    versions = run("2024-05-03 00:00:00")
    assert versions.count() == 15
    current = {r.id: r.title for r in tables.current_state(versions).collect()}
    assert (current["p1"], current["p2"], current["p99"]) == ("other", "changed", "new")
    assert len(current) == 13
    assert run("2024-05-04 00:00:00").count() == 15


def test_a_load_that_was_listed_but_not_landed_keeps_its_files(tmp_path):
    folder, log = tmp_path / "in", str(tmp_path / "log")
    folder.mkdir()
    (folder / "2024-01-01.json").write_text("[1]")
    options = {"path": str(folder), "log": log}
    assert captures.CapturesStream(options).latestOffset() == {"load": 1}
    (folder / "2024-01-02.json").write_text("[2]")
    (folder / "2024-01-01.json").write_text("[1, 3]")
    again = captures.CapturesStream(options)
    assert again.latestOffset() == {"load": 2}
    files = lambda a, b: [p for part in again.partitions({"load": a}, {"load": b}) for p in part.paths]
    assert files(0, 1) == ["2024-01-01.json"]
    assert files(0, 2) == files(1, 2) == ["2024-01-01.json", "2024-01-02.json"]
    assert files(2, 2) == [] and captures.CapturesStream(options).latestOffset() == {"load": 2}


def test_batches_are_bounded_while_a_file_is_read(tmp_path, monkeypatch):
    monkeypatch.setattr(captures, "PIECE", 1 << 10)
    monkeypatch.setattr(captures, "BATCH_BYTES", 1 << 12)
    own = [json.dumps({"id": i, "text": "x" * (i % 300)}) for i in range(5000)]
    (tmp_path / "2024-01-01.json").write_text("[" + ",".join(own) + "]")
    batches = list(captures.read_files(str(tmp_path), ["2024-01-01.json"]))
    assert [v for b in batches for v in b.column("raw").to_pylist()] == own
    assert [v for b in batches for v in b.column("place").to_pylist()] == list(range(5000))
    assert max(b.column("raw").nbytes for b in batches) < 4 * (1 << 12)


def test_small_files_share_a_task_and_large_ones_do_not(monkeypatch):
    monkeypatch.setattr(captures, "TASK_BYTES", 100)
    tasks = captures.packed([("a", 40, 0), ("b", 50, 0), ("c", 300, 0), ("d", 1, 0), ("e", 90, 0)])
    assert [t.paths for t in tasks] == [["a", "b"], ["c"], ["d", "e"]]


@pytest.mark.parametrize("path", ["x/2024-01-05.json", "posts-2024-01-05.json", "2023-01-01-2024-01-05.json", "day=2024-01-05/part.json"])
def test_the_day_of_a_file_is_the_one_that_scans_give(spark, path):
    assert captures.day_of(path) == "2024-01-05"
    assert spark.range(1).select(raw_files.file_day(F.lit(f"/{path}"))).first()[0] == "2024-01-05"
