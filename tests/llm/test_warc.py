from __future__ import annotations

import gzip
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from trendloom.llm import warc
from trendloom.llm.oracle import ORACLE
from trendloom.llm.queries import QUERIES
from trendloom.session import new_folder

LONG = "<p>" + "lorem ipsum é " * 20


@pytest.fixture
def archive(spark):
    warc.register(spark)

    def write(rows, **options) -> str:
        path = new_folder(spark, "archive")
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("own")).withColumn("first", F.lit(1))
        warc.page_records(pages).write.format("warc").options(**options).mode("append").save(path)
        return path

    return write


def read(spark, path, **options):
    return spark.read.format("warc").options(**options).load(path)


def test_round_trip_of_texts(spark, archive):
    rows = [(1, "http://a/", LONG), (2, "http://b/", LONG), (3, None, None), (4, "http://d/", ""), (5, "http://e/\r\nx", "short"), (6, "http://f/", "short"), (None, "http://g/", LONG)]
    got = {(r.record_id, r.target_uri): r for r in read(spark, archive(rows)).collect()}
    assert len(got) == 7
    first = got["<urn:page:1>", "http://a/"]
    assert (first.record_type, first.payload, first.refers_to) == ("response", LONG, None)
    again = got["<urn:page:2>", "http://b/"]
    assert (again.record_type, again.payload, again.refers_to) == ("revisit", None, "<urn:page:1>")
    assert again.payload_bytes == len(LONG.encode()) and again.payload_digest == hashlib.sha256(LONG.encode()).hexdigest()
    assert got[None, "http://g/"].refers_to == "<urn:page:1>"
    assert got["<urn:page:3>", None].payload == "" and got["<urn:page:4>", "http://d/"].record_type == "response"
    assert got["<urn:page:6>", "http://f/"].record_type == "response"


def test_rows_that_repeat_the_smallest_id_are_responses(spark, archive):
    rows = [(1, "u", LONG), (1, "u", LONG), (2, "u", LONG)]
    kinds = sorted((r.record_id, r.record_type) for r in read(spark, archive(rows), payload="none").collect())
    assert kinds == [("<urn:page:1>", "response"), ("<urn:page:1>", "response"), ("<urn:page:2>", "revisit")]


def test_filters_are_pushed_down_and_payloads_skipped(spark, archive):
    path = archive([(i, f"http://{'ab'[i % 2]}/{i}", f"{i} {LONG}") for i in range(30)])
    chosen = read(spark, path).where("record_type = 'response' AND target_uri LIKE 'http://a/%' AND record_id IN ('<urn:page:4>', '<urn:page:3>')")
    assert [r.record_id for r in chosen.collect()] == ["<urn:page:4>"]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan or "record_type" not in plan.split("Filter", 1)[1].split("\n")[0]
    assert read(spark, path, payload="none").where("payload IS NOT NULL").count() == 0


def test_splits_give_the_same_records(spark, archive):
    rows = [(i, "u", f"{i} " + LONG) for i in range(200)]
    path = archive(rows, split_bytes="2000")
    one, many = read(spark, path), read(spark, path, split_bytes="2000")
    assert many.rdd.getNumPartitions() > one.rdd.getNumPartitions()
    assert sorted(one.collect()) == sorted(many.collect()) and one.count() == 200


def test_files_of_lost_tasks_are_not_read_and_overwrite_replaces(spark, archive, tmp_path):
    path = archive([(1, "u", "one")])
    with open(f"{path}/part-{uuid.uuid4().hex}.warc.gz", "wb") as lost:
        lost.write(warc.encode_record({"record_type": "response", "record_id": "<urn:page:9>"}, b"lost"))
    assert [r.record_id for r in read(spark, path).collect()] == ["<urn:page:1>"]
    pages = spark.createDataFrame([(2, "u", "two")], "page_id long, url string, html string")
    warc.page_records(pages).write.format("warc").mode("overwrite").save(path)
    assert [r.payload for r in read(spark, path).collect()] == ["two"]


def test_archives_of_other_writers(spark, tmp_path):
    warc.register(spark)
    body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hi</p>"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(record) + gzip.compress(record))
    got = read(spark, str(tmp_path)).where("record_type = 'response'").collect()
    assert [(r.target_uri, r.payload) for r in got] == [("http://x/", "<p>hi</p>")] * 2


def test_no_pages(spark, archive):
    assert read(spark, archive([])).count() == 0


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES["op9_warc_round_trip"](spark, folder), connect(folder), ORACLE["op9_warc_round_trip"]) == ""
