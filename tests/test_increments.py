from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from forum import COMMENTS, POSTS, post
from trendloom.functions.text import Term
from trendloom.plans import facts, increments, marts
from trendloom.plans.increments import CountStore, MatchedStore
from trendloom.sources import tables
from trendloom.sources.landing import land_comments, land_posts
from trendloom.sources.terms import shipped_terms

TERMS = [Term("Spark", "engine", "spark"), Term("MCP", "ai", "mcp"), Term("Power BI", "bi", "power bi")]


def load(spark, path, objects, stamp, land=land_posts):
    raw = spark.createDataFrame([(json.dumps(o),) for o in objects], "raw string")
    tables.append_raw(land(raw, stamp), path)
    return tables.read_versions(spark, path)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def all_posts():
    return [p for day in POSTS.values() for p in day]


def all_comments():
    return [c for day in COMMENTS.values() for c in day]


def check(spark, counts, posts, comments, terms):
    """The kept marts are those of a full rebuild."""
    items = facts.newest_posts(facts.match_each_post(posts, terms))
    said = facts.newest_comments(facts.match_each_comment(comments, terms))
    fact = facts.posts_fact(items)
    assert rows(counts.tool_mentions_by_month()) == rows(marts.tool_mentions_by_month(items, terms))
    assert rows(counts.comment_tool_mentions_by_month()) == rows(marts.comment_tool_mentions_by_month(said, terms))
    assert rows(counts.ai_share_by_flair_month()) == rows(marts.ai_share_by_flair_month(fact))
    assert rows(counts.ai_share_by_month()) == rows(marts.ai_share_by_month(fact, said))


def test_counts_follow_late_edits(spark, tmp_path):
    """An item in another month, one without its mention, a flair, a bot, and a month left empty."""
    terms = shipped_terms()
    posts = {k: str(tmp_path / f"posts_{k}") for k in ("table", "matched")}
    comments = {k: str(tmp_path / f"comments_{k}") for k in ("table", "matched")}
    of_posts, of_comments = (MatchedStore(spark, k["matched"], terms) for k in (posts, comments))
    counts = CountStore(spark, str(tmp_path / "counts"), terms)
    first, said = all_posts(), all_comments()
    alone = post("p80", "2023-07-01 10:00", "Spark and MCP in one title")
    edits = [
        [post("p80", "2024-02-07 10:00", "Spark and MCP in one title"), {**first[0], "title": "nothing", "selftext": ""}],
        [{**first[3], "link_flair_text": "Other"}, {**first[4], "created_utc": first[4]["created_utc"] + 40 * 86400}],
        [post("p80", "2024-02-07 10:00", "Spark only")],
    ]
    newer = [[{**said[0], "body": "dbt and MCP"}], [{**said[1], "author": "AutoModerator"}], [{**said[2], "body": "[removed]"}]]
    post_versions = load(spark, posts["table"], [*first, alone], "2024-05-01 00:00:00")
    comment_versions = load(spark, comments["table"], said, "2024-05-01 00:00:00", land_comments)
    for day in range(4):
        if day:
            post_versions = load(spark, posts["table"], edits[day - 1], f"2024-05-0{day + 1} 00:00:00")
            comment_versions = load(spark, comments["table"], newer[day - 1], f"2024-05-0{day + 1} 00:00:00", land_comments)
        of_posts.update(post_versions, facts.match_each_post)
        of_comments.update(comment_versions, facts.match_each_comment)
        if day != 1:  # two loads are counted together
            counts.update(increments.POSTS, of_posts)
            counts.update(increments.COMMENTS, of_comments)
            check(spark, counts, post_versions, comment_versions, terms)
    months = {str(r.month) for r in counts.ai_share_by_flair_month().collect()}
    assert "2023-07-01" not in months
    counts.update(increments.POSTS, of_posts)
    assert counts.upto(increments.POSTS) == of_posts.last == 4


def test_only_new_files_are_opened(spark, tmp_path):
    path, matched = str(tmp_path / "posts"), MatchedStore(spark, str(tmp_path / "matched"), TERMS)
    versions = load(spark, path, all_posts(), "2024-05-01 00:00:00")
    assert matched.last == 0
    assert matched.update(versions, facts.match_each_post) == 1
    assert matched.unmatched(versions) is None and matched.update(versions, facts.match_each_post) == 1
    versions = load(spark, path, [post("p1", "2024-01-10", "Spark"), post(None, "2024-01-10", "MCP")], "2024-05-01 00:00:00")
    new = matched.unmatched(versions)
    assert new.count() == 2 and len(new.inputFiles()) < len(versions.inputFiles())
    plan = facts.match_each_post(new, TERMS)._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan and "Exchange" not in plan and "Join" not in plan
    assert matched.update(versions, facts.match_each_post) == 2
    assert rows(matched.versions()) == rows(facts.match_each_post(versions, TERMS))
    assert matched.versions(after=1).count() == 2
    other = MatchedStore(spark, str(tmp_path / "matched"), TERMS[:1])
    assert other.last == 0


def test_a_load_of_another_table_is_matched_whatever_its_stamp(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    matched = MatchedStore(spark, str(tmp_path / "matched"), TERMS)
    matched.update(load(spark, one, all_posts(), "2024-05-02 00:00:00"), facts.match_each_post)
    load(spark, two, all_posts()[:5], "2024-05-01 00:00:00")
    both = tables.read_versions(spark, one, two)
    matched.update(both, facts.match_each_post)
    assert rows(matched.versions()) == rows(facts.match_each_post(both, TERMS))


def test_what_a_failed_load_left_is_overwritten(spark, tmp_path, monkeypatch):
    path, matched = str(tmp_path / "posts"), MatchedStore(spark, str(tmp_path / "matched"), TERMS)
    counts = CountStore(spark, str(tmp_path / "counts"), TERMS)
    versions = load(spark, path, all_posts()[:6], "2024-05-01 00:00:00")
    matched.update(versions, facts.match_each_post)
    counts.update(increments.POSTS, matched)
    versions = load(spark, path, all_posts()[4:], "2024-05-02 00:00:00")
    # both steps wrote their rows, and ended before they said so
    facts.match_each_post(versions, TERMS).write.parquet(f"{matched.path}/versions/load=2")
    assert rows(matched.versions()) == rows(facts.match_each_post(versions.where("_loaded_at = timestamp_ntz'2024-05-01 00:00:00'"), TERMS))
    matched.update(versions, facts.match_each_post)
    counts.changes(increments.POSTS, matched, 1, 2).union(counts.changes(increments.POSTS, matched, 1, 2)).write.parquet(f"{counts.folder}/changes/posts/upto=2")
    counts.update(increments.POSTS, matched)
    items = facts.newest_posts(facts.match_each_post(versions, TERMS))
    assert rows(counts.tool_mentions_by_month()) == rows(marts.tool_mentions_by_month(items, TERMS))


def test_months_that_nothing_touches_are_not_written(spark, tmp_path):
    import os

    path, matched = str(tmp_path / "posts"), MatchedStore(spark, str(tmp_path / "matched"), TERMS)
    counts = CountStore(spark, str(tmp_path / "counts"), TERMS)
    matched.update(load(spark, path, all_posts(), "2024-05-01 00:00:00"), facts.match_each_post)
    counts.update(increments.POSTS, matched)

    def files():
        return {f for folder, _, names in os.walk(f"{counts.folder}/counts") for f in (os.path.join(folder, n) for n in names if n.endswith(".parquet"))}

    before = files()
    matched.update(load(spark, path, [post("p99", "2024-02-09", "Spark")], "2024-05-02 00:00:00"), facts.match_each_post)
    counts.update(increments.POSTS, matched)
    changed = before ^ files()
    assert changed and all("month=2024-02-01" in f for f in changed)


def test_rows_of_one_item_are_counted_once(spark):
    items = spark.sql("SELECT 'p' AS post_id, timestamp_ntz'2024-01-05 00:00:00' AS posted_at, CAST(NULL AS STRING) AS flair, "
                      "array(struct('MCP' AS tool, 'ai' AS category, true AS is_in_title)) AS mentions")
    got = {(r.what, r.key, r.a, r.b) for r in increments.contributions(items, increments.POSTS, -1).collect()}
    assert got == {("total", None, -1, 0), ("flair", "No flair", -1, -1), ("measure", "Post titles", -1, -1), ("tool", "MCP", -1, -1)}
    assert increments.contributions(items, increments.POSTS, 1).select(F.sum("a")).first()[0] == 4


@pytest.mark.parametrize("kind", [increments.POSTS, increments.COMMENTS])
def test_no_loads_no_counts(spark, tmp_path, kind):
    counts = CountStore(spark, str(tmp_path / "counts"), TERMS)
    counts.update(kind, MatchedStore(spark, str(tmp_path / "matched"), TERMS))
    assert counts.upto(kind) == 0
