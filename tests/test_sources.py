from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forum import COMMENTS, POSTS, post
from trendloom.functions.scalars import epoch_to_timestamp, nested_text, timestamp_to_epoch
from trendloom.operators.reconcile import diff_counts, list_files, manifest_diff
from trendloom.sources import raw_files, tables
from trendloom.sources.landing import land_comments, land_posts
from trendloom.sources.spread import spread
from trendloom.sources.terms import read_terms, shipped_terms, term_frame, term_list
from trendloom.streaming.day_files import stream_day_files


def ids(raw) -> list[str]:
    return sorted(r[0] for r in raw.select(F.get_json_object("raw", "$.id")).collect())


def test_every_object_of_every_day_file_is_one_row(spark, day_files):
    raw = raw_files.scan_raw(spark, day_files("posts", POSTS))
    assert ids(raw) == sorted(p["id"] for day in POSTS.values() for p in day)
    dashes = [json.loads(r.raw)["title"] for r in raw.collect() if "—" in r.raw]
    assert dashes == ["Moving from SQL Server to Power BI reports — advice?"]
    nested = raw.where(F.get_json_object("raw", "$.id") == "p10").first().raw
    assert json.loads(nested)["_meta"] == {"removal_type": "deleted"}


@pytest.mark.parametrize(
    ("start", "end", "wanted"),
    [
        ("2024-02-05", None, ["p4", "p5", "p6", "p7"]),
        ("2024-01-10", "2024-02-05", ["p1", "p2", "p3", "p4", "p5", "p6", "p7"]),
        ("2024-01-11", "2024-02-04", []),
    ],
)
def test_a_range_of_days_is_inclusive_and_may_have_gaps(spark, day_files, start, end, wanted):
    folder = day_files("posts", POSTS)
    assert ids(raw_files.scan_raw(spark, folder, start, end)) == wanted


def test_days_are_pruned_by_file_name(spark, day_files):
    raw = raw_files.scan_raw(spark, day_files("posts", POSTS), "2024-02-05")
    assert raw.count() == 4
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan.split("FileScan text")[1]


def test_the_day_is_the_last_date_in_a_name_or_that_of_its_folder(spark, tmp_path):
    for name in ("posts-2024-01-05.json", "2024-01-06.2.json", "old-2023-01-01-2024-01-07.json", "day=2024-01-08/part-0.json", "x.json"):
        file = tmp_path / "2022-02-02" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps([{"id": name}]))
    folder = str(tmp_path / "2022-02-02")
    found = {r.raw: r.day for r in spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder).select(
        F.get_json_object("value", "$[0].id").alias("raw"), raw_files.file_day(F.col("_metadata.file_path")).alias("day")).collect()}
    assert found == {
        "posts-2024-01-05.json": "2024-01-05", "2024-01-06.2.json": "2024-01-06", "old-2023-01-01-2024-01-07.json": "2024-01-07",
        "day=2024-01-08/part-0.json": "2024-01-08", "x.json": "",
    }


def test_batch_and_stream_land_the_same_rows(spark, tmp_path):
    """Mixed types, empty objects and missing keys: what one row holds changes no other row."""
    (tmp_path / "in").mkdir()
    objects = [{"id": "a", "score": 5, "_meta": {}}, {"id": "b", "score": "12", "upvote_ratio": 0.90}, {"id": "c"}, {}]
    (tmp_path / "in" / "2024-01-05.json").write_text(json.dumps(objects))
    batch = land_posts(raw_files.scan_raw(spark, str(tmp_path / "in")), "2024-05-01 00:00:00")
    stream_day_files(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "p"), lambda raw: land_posts(raw, "2024-05-01 00:00:00")).awaitTermination()
    streamed = tables.read_versions(spark, str(tmp_path / "t")).drop("created_month")
    rows = sorted(map(str, batch.collect()))
    assert rows == sorted(map(str, streamed.collect()))
    assert {r.id: r.score for r in batch.collect()} == {"a": 5, "b": 0, "c": 0, "": 0}
    assert [json.loads(r.raw) for r in batch.orderBy("id").collect()] == [{}, *objects[:3]]


def test_a_broken_day_file_is_an_error(spark, day_files):
    folder = day_files("posts", {"2024-01-01": [{"id": "a"}]})
    with open(f"{folder}/2024-01-02.json", "w") as file:
        file.write('[{"id": "b"}, {"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        raw_files.scan_raw(spark, folder).collect()


def test_missing_fields_land_as_defaults_and_null_stays_null(spark):
    raw = spark.createDataFrame([("{}",), ('{"id": "x", "title": null, "score": 3}',), ("not json",)], "raw string")
    rows = land_posts(raw, "2024-01-01 00:00:00").collect()
    empty = rows[0].asDict()
    assert empty["id"] == empty["title"] == empty["selftext"] == empty["url"] == ""
    assert empty["link_flair_text"] is None and empty["removed_by_category"] is None
    assert empty["is_self"] is False and empty["score"] == 0 and empty["upvote_ratio"] == 0.0
    assert empty["created_utc"] == datetime(1970, 1, 1) and empty["later_removal_type"] is None
    assert (rows[1].id, rows[1].title, rows[1].score) == ("x", "", 3)
    assert rows[2].id == "" and rows[2].raw == "not json"
    comment = land_comments(raw, "2024-01-01 00:00:00").first().asDict()
    assert comment["controversiality"] == 0 and comment["distinguished"] is None and comment["body"] == ""


def test_landed_types(spark):
    landed = land_posts(spark.createDataFrame([("{}",)], "raw string"))
    types = dict(landed.dtypes)
    assert types["score"] == "int" and types["upvote_ratio"] == "float" and types["is_self"] == "boolean"
    assert types["created_utc"] == types["_loaded_at"] == "timestamp_ntz"
    assert dict(land_comments(spark.createDataFrame([("{}",)], "raw string")).dtypes)["controversiality"] == "smallint"


def test_epochs_do_not_depend_on_the_session_time_zone(spark):
    seconds = spark.createDataFrame([(0,), (1711846800,), (-1,)], "s bigint")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moments = seconds.select(epoch_to_timestamp(F.col("s")).alias("m"))
        assert [r.m for r in moments.collect()] == [
            datetime(1970, 1, 1), datetime(2024, 3, 31, 1), datetime(1969, 12, 31, 23, 59, 59)
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    back = moments.select(timestamp_to_epoch(F.col("m")))
    assert [r[0] for r in back.collect()] == [0, 1711846800, -1]


def test_nested_text_treats_empty_as_missing(spark):
    raw = spark.createDataFrame([('{"_meta":{"removal_type":"x"}}',), ('{"_meta":{"removal_type":""}}',), ("{}",)], "raw string")
    values = raw.select(nested_text(F.col("raw"), "$._meta.removal_type")).collect()
    assert [v[0] for v in values] == ["x", None, None]


def test_half_open_days(spark):
    rows = spark.sql(
        "select * from values (1, timestamp_ntz'2024-01-02 00:00:00'), (2, timestamp_ntz'2024-01-02 23:59:59.999'), "
        "(3, timestamp_ntz'2024-01-03 00:00:00'), (4, timestamp_ntz'2024-01-01 23:59:59') as t(i, ts)"
    )
    assert sorted(r.i for r in raw_files.slice_days(rows, "ts", "2024-01-02").collect()) == [1, 2]
    assert sorted(r.i for r in raw_files.slice_days(rows, "ts", "2024-01-01", "2024-01-03").collect()) == [1, 2, 3, 4]


def test_day_slices_are_skipped_unless_forced(spark, tmp_path):
    path = str(tmp_path / "days")

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "day string, raw string")

    def stored():
        return sorted((r.day, r.raw) for r in raw_files.scan_lines(spark, path).collect())

    tables.write_day_slices(rows(("2024-01-01", "a"), ("2024-01-02", "b")), path)
    tables.write_day_slices(rows(("2024-01-02", "changed"), ("2024-01-03", "c")), path)
    assert stored() == [("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-03", "c")]
    tables.write_day_slices(rows(("2024-01-02", "changed")), path, force=True)
    assert stored() == [("2024-01-01", "a"), ("2024-01-02", "changed"), ("2024-01-03", "c")]
    assert [r.raw for r in raw_files.scan_lines(spark, path, "2024-01-03").collect()] == ["c"]


def test_reconcile_copies_what_is_missing_or_of_another_size(spark, tmp_path):
    for name, files in {"src": {"p/1.json": "[1]", "p/2.json": "[1,2]", "c/1.json": "[]"}, "dst": {"p/1.json": "[1]", "p/2.json": "[1]"}}.items():
        for key, content in files.items():
            file = tmp_path / name / key
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_text(content)
    source, target = (list_files(spark, str(tmp_path / n)) for n in ("src", "dst"))
    diff = manifest_diff(source, target)
    assert {r.key: r.action for r in diff.collect()} == {"p/1.json": "skip", "p/2.json": "copy", "c/1.json": "copy"}
    assert tuple(diff_counts(diff).first()) == (2, 1)
    assert {r.key: r.action for r in manifest_diff(target, source).collect()} == {"p/1.json": "skip", "p/2.json": "copy"}


def test_terms_round_trip_with_blank_exclusions(spark, tmp_path):
    path = str(tmp_path / "terms")
    term_frame(spark, shipped_terms()).coalesce(1).write.option("header", True).csv(path)
    terms = read_terms(spark, path)
    assert terms.where("exclude_pattern = ''").count() == 0
    assert term_list(terms) == sorted(shipped_terms(), key=lambda t: (t.tool, t.category))


def test_a_stream_lands_each_file_once_and_the_newest_version_wins(spark, day_files, tmp_path):
    folder = day_files("posts", POSTS)
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")

    def run(stamp):
        stream_day_files(spark, folder, table, progress, lambda raw: land_posts(raw, stamp)).awaitTermination()

    run("2024-05-01 00:00:00")
    run("2024-05-02 00:00:00")
    assert tables.read_versions(spark, table).count() == 12
    day_files("posts", {"2024-01-10.2": [post("p2", "2024-01-10 09:00", "changed")]})
    run("2024-05-03 00:00:00")
    versions = tables.read_versions(spark, table)
    assert versions.count() == 13
    assert {r.title for r in tables.current_state(versions).where("id = 'p2'").collect()} == {"changed"}


def test_comments_land_from_day_files(spark, day_files):
    landed = land_comments(raw_files.scan_raw(spark, day_files("comments", COMMENTS)))
    assert landed.count() == sum(map(len, COMMENTS.values()))


def test_scans_of_few_partitions_are_spread_and_others_left(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).coalesce(1).write.parquet(path)
    assert "RoundRobin" in spread(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in spread(spark.range(0, 1000, 1, 16))._jdf.queryExecution().executedPlan().toString()


def test_a_base_path_below_itself_keeps_its_keys_apart(spark, tmp_path):
    base = tmp_path / "raw"
    for key in ("1.json", f"a{base}/1.json"):
        file = base / key
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("[]")
    for folder in (str(base), f"{base}/", f"file:{base}", f"file://{base}"):
        assert {r.key for r in list_files(spark, folder).collect()} == {"1.json", f"a{base}/1.json"}
