"""The invented forum through landing, rebuild and serving."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from forum import COMMENTS, POSTS
from trendloom.operators import quality
from trendloom.operators.quality import StaleSourceError, author_columns
from trendloom.plans import checks, facts, marts, serving, staging
from trendloom.plans import rebuild as builds
from trendloom.sources import tables
from trendloom.sources.landing import land_comments, land_posts
from trendloom.sources.raw_files import scan_raw
from trendloom.sources.tables import current_state
from trendloom.sources.terms import shipped_terms

NOW = "2024-05-01 20:00:00"
FEB, MAR = date(2024, 2, 1), date(2024, 3, 1)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    import json

    folder = tmp_path_factory.mktemp("raw")
    versions = []
    for kind, days, land in (("posts", POSTS, land_posts), ("comments", COMMENTS, land_comments)):
        (folder / kind).mkdir()
        for day, objects in days.items():
            (folder / kind / f"{day}.json").write_text(json.dumps(objects, ensure_ascii=False), encoding="utf-8")
        landed = scan_raw(spark, str(folder / kind))
        versions.append(land(landed, "2024-05-01 00:00:00").unionByName(land(landed, "2024-05-02 00:00:00")))
    return versions


@pytest.fixture(scope="module")
def models(spark, raw, tmp_path_factory):
    posts, comments = raw
    folder = str(tmp_path_factory.mktemp("models"))
    return builds.rebuild(
        spark, posts.where("id <> 'p12'").unionByName(posts.where("id = 'p12'").withColumn(
            "created_utc", F.lit("2024-04-30 12:00:00").cast("timestamp_ntz"))),
        comments, shipped_terms(), folder, "salt", NOW, window_months=1,
    )


def pairs(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_every_row_reaches_staging_once(models):
    assert models["stg_posts"].count() == 12
    assert models["stg_comments"].count() == 11


def test_staged_posts(models):
    rows = {r.post_id: r for r in models["stg_posts"].collect()}
    assert rows["p3"].body is None and rows["p5"].body is None and rows["p10"].body is None
    assert rows["p5"].is_removed_at_capture and not rows["p5"].is_removed_later
    assert rows["p10"].is_removed_later and not rows["p10"].is_removed_at_capture
    assert rows["p10"].author_id is None and len(rows["p1"].author_id) == 64
    assert rows["p9"].flair is None


def test_staged_comments(models):
    rows = {r.comment_id: r for r in models["stg_comments"].collect()}
    assert rows["c1"].is_top_level and rows["c1"].parent_comment_id is None
    assert not rows["c2"].is_top_level and rows["c2"].parent_comment_id == "c1"
    assert rows["c3"].is_automoderator and rows["c4"].is_body_removed and rows["c4"].body is None
    assert rows["c5"].author_id is None and rows["c8"].later_removal_type == "removed"


def test_post_mentions(models):
    found = pairs(models["fct_post_tool_mentions"], "post_id", "tool", "is_in_title")
    assert found == {
        ("p1", "SQL Server", True), ("p1", "Power BI", True),
        ("p2", "Delta Lake", True), ("p2", "Iceberg", False), ("p2", "Spark", False),
        ("p4", "LLM", True),
        ("p6", "Airflow", True), ("p6", "Dagster", True), ("p6", "dbt", False),
        ("p7", "Power BI", False),
        ("p8", "LLM", True),
        ("p9", "AI Agent", True), ("p9", "RAG", True), ("p9", "MCP", False),
        ("p11", "SQL Server", True),
        ("p12", "Snowflake", True),
    }


def test_comment_mentions_leave_out_bots_and_removed_texts(models):
    assert pairs(models["fct_comment_tool_mentions"], "comment_id", "tool") == {
        ("c1", "SQL Server"), ("c2", "Postgres"), ("c5", "AI Agent"), ("c5", "LLM"), ("c6", "dbt"),
        ("c7", "LLM"), ("c11", "Kafka"),
    }


def test_posts_fact(models):
    rows = {r.post_id: r for r in models["fct_posts"].collect()}
    assert len(rows) == 12
    assert (rows["p9"].tools_mentioned, rows["p9"].mentions_ai, rows["p9"].mentions_ai_in_title) == (3, True, True)
    assert (rows["p3"].tools_mentioned, rows["p3"].mentions_ai, rows["p3"].mentions_ai_in_title) == (0, False, False)


def test_windows_skip_the_partial_edge_months(models):
    assert pairs(models["dim_comparison_windows"], "month", "period") == {(FEB, "first"), (MAR, "last")}


def test_dense_grid_has_every_month_and_tool_with_zero_shares(models):
    mart = models["mart_tool_mentions_by_month"]
    assert mart.count() == 4 * 35
    rows = {(r.month, r.tool): r for r in mart.collect()}
    power = rows[FEB, "Power BI"]
    assert (power.posts_mentioning, power.posts_mentioning_in_title, power.posts_in_month) == (1, 0, 4)
    assert (power.share_pct, power.title_share_pct) == (25.0, 0.0)
    silent = rows[FEB, "Hudi"]
    assert (silent.posts_mentioning, silent.share_pct, silent.title_share_pct) == (0, 0.0, 0.0)
    comments = {(r.month, r.tool): r for r in models["mart_comment_tool_mentions_by_month"].collect()}
    assert len(comments) == 4 * 35
    assert (comments[MAR, "LLM"].comments_mentioning, comments[MAR, "LLM"].comments_in_month) == (1, 4)


def test_focus_share_change(models):
    rows = {r.measure: r for r in models["mart_ai_share_change"].collect()}
    titles, comments = rows["Post titles"], rows["Comments"]
    assert (titles.first_share_pct, titles.last_share_pct, titles.change_pts, titles.growth_ratio) == (25, 50, 25, 2)
    assert (comments.first_share_pct, comments.last_share_pct, comments.change_pts) == (50, 25, -25)
    months = pairs(models["mart_ai_share_by_month"], "month", "measure", "mentions_ai", "total")
    assert (date(2024, 5, 1), "Comments", 0, 1) in months and (MAR, "Post titles", 2, 4) in months


def test_a_zero_first_share_has_no_growth(spark):
    monthly = spark.createDataFrame(
        [(FEB, "Comments", 0, 5), (MAR, "Comments", 1, 3)], "month date, measure string, mentions_ai long, total long"
    )
    windows = spark.createDataFrame([(FEB, "first"), (MAR, "last")], "month date, period string")
    row = marts.ai_share_change(monthly, windows).first()
    assert (row.first_share_pct, row.last_share_pct, row.change_pts, row.growth_ratio) == (0.0, 33.33, 33.33, None)


def test_a_missing_last_window_gives_null_shares(spark):
    monthly = spark.createDataFrame([(FEB, "Comments", 1, 4)], "month date, measure string, mentions_ai long, total long")
    windows = spark.createDataFrame([(FEB, "first")], "month date, period string")
    row = marts.ai_share_change(monthly, windows).first()
    assert (row.first_share_pct, row.last_share_pct, row.change_pts, row.growth_ratio) == (25.0, None, None, None)


def test_window_shares_are_ratios_of_sums_and_change_is_rounded_once(spark):
    months = [date(2024, m, 1) for m in (2, 3, 4, 5)]
    monthly = spark.createDataFrame(
        [(months[0], "x", 1, 10), (months[1], "x", 9, 999), (months[2], "x", 5, 300), (months[3], "x", 7, 11)],
        "month date, measure string, mentions_ai long, total long",
    )
    periods = ["first", "first", "last", "last"]
    windows = spark.createDataFrame(list(zip(months, periods, strict=True)), "month date, period string")
    row = marts.ai_share_change(monthly, windows).first()
    first, last = 10 / 1009 * 100, 12 / 311 * 100
    assert row.first_share_pct == round(first, 2) and row.last_share_pct == round(last, 2)
    assert row.change_pts == round(last - first, 2) and row.growth_ratio == round(last / first, 2)


def test_flairs(models):
    by_month = pairs(models["mart_ai_share_by_flair_month"], "month", "flair", "posts", "ai_posts_in_title")
    assert (MAR, "No flair", 1, 1) in by_month and (FEB, "Discussion", 1, 1) in by_month
    windows = pairs(models["mart_ai_share_by_flair_window"], "flair", "period", "ai_title_share_pct")
    assert ("Help", "first", 0.0) in windows and ("Discussion", "last", 100.0) in windows
    ranked = serving.flair_windows(
        models["mart_ai_share_by_flair_window"], models["dim_comparison_windows"], ["Help", "Discussion"]
    ).collect()
    assert [(r.flair, r.period, r.flair_rank) for r in ranked] == [
        ("Discussion", "first", 1), ("Discussion", "last", 1), ("Help", "first", 2), ("Help", "last", 2)
    ]
    assert ranked[0].period_label == "Feb 2024 – Feb 2024"


def test_all_50_data_tests_are_reported(models):
    rows = {r.test: r for r in checks.report(models, 1).collect()}
    assert len(rows) == 50
    bad = {name: (r.failures, r.status) for name, r in rows.items() if r.status != "pass"}
    assert bad == {"relationships stg_comments.post_id": (1, "warn")}


def test_no_model_carries_an_author(models):
    for name, df in models.items():
        if not name.startswith("stg_"):
            assert author_columns(df) == [], name
    assert author_columns(models["stg_posts"]) == ["author_id"]


def test_relational_forms_agree(models, spark, raw):
    posts, comments = raw
    staged, talk = models["stg_posts"], models["stg_comments"]
    mentions = models["fct_post_tool_mentions"]
    again = facts.posts_fact_from_mentions(staged, mentions)
    assert pairs(again, *again.columns) == pairs(models["fct_posts"], *again.columns)
    grid = marts.tool_mentions_by_month_from_facts(staged, mentions, shipped_terms())
    assert pairs(grid, *grid.columns) == pairs(models["mart_tool_mentions_by_month"], *grid.columns)
    humans = staging.human_comments(talk)
    shares = marts.ai_share_by_month_from_facts(models["fct_posts"], humans, models["fct_comment_tool_mentions"])
    assert pairs(shares, *shares.columns) == pairs(models["mart_ai_share_by_month"], *shares.columns)
    grid = marts.comment_tool_mentions_by_month_from_facts(
        humans, models["fct_comment_tool_mentions"], shipped_terms()
    )
    assert pairs(grid, *grid.columns) == pairs(models["mart_comment_tool_mentions_by_month"], *grid.columns)


def test_matching_before_the_dedup_gives_the_same_items(raw):
    posts, comments = raw
    early = facts.match_post_versions(posts, shipped_terms())
    late = facts.match_posts(staging.clean_posts(current_state(posts), "salt"), shipped_terms())
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))
    early = facts.match_comment_versions(comments, shipped_terms())
    late = facts.match_comments(staging.clean_comments(current_state(comments), "salt"), shipped_terms())
    assert sorted(map(str, early.collect())) == sorted(map(str, late.collect()))


def test_only_new_loads_are_matched(spark, raw, tmp_path):
    posts, terms, folder = raw[0], shipped_terms(), str(tmp_path / "matched")
    first = posts.where("_loaded_at = timestamp_ntz'2024-05-01 00:00:00'")
    changed = posts.where("_loaded_at = timestamp_ntz'2024-05-02 00:00:00'").withColumn(
        "title", F.when(F.col("id") == "p12", "Trino cost").otherwise(F.col("title"))
    )
    assert builds.update_matched(first, facts.match_each_post, terms, folder).count() == 12
    both = first.unionByName(changed)
    matched = builds.update_matched(both, facts.match_each_post, terms, folder)
    assert matched.count() == 24
    assert builds.update_matched(both, facts.match_each_post, terms, folder).count() == 24
    direct = facts.match_post_versions(both, terms)
    assert sorted(map(str, facts.newest_posts(matched).collect())) == sorted(map(str, direct.collect()))
    fewer = builds.update_matched(both, facts.match_each_post, terms[:3], folder)
    assert fewer.count() == 24 and matched.count() == 24


def test_a_load_is_matched_whatever_its_stamp(spark, raw, tmp_path):
    """Loads that overlap a rebuild: of an equal and of an earlier stamp, and from another table."""
    posts, terms, folder = raw[0], shipped_terms(), str(tmp_path / "matched")
    late = posts.where("_loaded_at = timestamp_ntz'2024-05-02 00:00:00'")
    early = posts.where("_loaded_at = timestamp_ntz'2024-05-01 00:00:00'")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    seen = 0
    for load, path in ((late.where("id < 'p5'"), one), (late.where("id >= 'p5'"), one), (early.where("id < 'p5'"), one), (early.where("id >= 'p5'"), two)):
        tables.append_raw(load, path)
        seen += load.count()
        versions = tables.read_versions(spark, *[p for p in (one, two) if (tmp_path / p).exists()])
        assert builds.update_matched(versions, facts.match_each_post, terms, folder).count() == seen
    matched = builds.update_matched(versions, facts.match_each_post, terms, folder)
    whole = facts.match_each_post(versions, terms)
    assert sorted(map(str, matched.collect())) == sorted(map(str, whole.collect()))


def test_readers_see_the_last_complete_build(spark, raw, tmp_path, monkeypatch):
    posts, comments = raw
    posts = posts.withColumn("created_utc", F.when(F.col("id") == "p12", F.lit("2024-04-30 12:00:00").cast("timestamp_ntz")).otherwise(F.col("created_utc")))
    folder = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        builds.open_models(spark, folder)

    def build(rows):
        name = builds.new_build()
        models = builds.rebuild(spark, rows, comments, shipped_terms(), builds.build_folder(folder, name), "salt", NOW, window_months=1)
        builds.publish(spark, folder, name)
        return models

    fewer = posts.where("id not in ('p1', 'p2')")
    build(fewer)
    before = {n: sorted(map(str, df.collect())) for n, df in builds.open_models(spark, folder).items()}

    def broken(*_):
        raise RuntimeError("no change mart today")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="no change mart"):
        patch.setattr(marts, "tool_share_change", broken)
        build(posts)
    assert {n: sorted(map(str, df.collect())) for n, df in builds.open_models(spark, folder).items()} == before
    build(posts)
    assert builds.open_models(spark, folder)["fct_posts"].count() == 12


def test_a_stale_source_stops_the_rebuild(spark, raw, tmp_path):
    posts, comments = raw
    with pytest.raises(StaleSourceError, match="posts"):
        builds.rebuild(spark, posts, comments, shipped_terms(), str(tmp_path / "m"), "salt", "2024-06-01 00:00:00")
    assert list(tmp_path.iterdir()) == []


@pytest.mark.parametrize(
    ("now", "status"),
    [("2024-05-02 20:00:00", "pass"), ("2024-05-02 20:00:01", "warn"), ("2024-05-04 08:00:00", "warn"), ("2024-05-04 08:00:01", "error")],
)
def test_freshness_thresholds(raw, now, status):
    """The newest comment is of 1 May, 08:00."""
    report = quality.freshness(raw[1], "created_utc", "comments", now)
    assert report.first().status == status
    if status == "warn":
        assert quality.require_fresh(report) == ["comments"]


def test_an_empty_source_is_an_error(raw):
    report = quality.freshness(raw[1].where("false"), "created_utc", "comments", NOW)
    assert report.first().status == "error"


def test_serving_trend_and_headline(models):
    assert [r.measure for r in serving.headline(models["mart_ai_share_change"]).collect()] == ["Post titles", "Comments"]
    trend = serving.ai_trend(models["mart_ai_share_by_month"]).collect()
    assert [r.month for r in trend] == sorted(r.month for r in trend)
    last = pairs(serving.latest_point_per_measure(models["mart_ai_share_by_month"]), "measure", "month")
    assert last == {("Post titles", date(2024, 4, 1)), ("Comments", date(2024, 5, 1))}
    assert pairs(serving.population_totals(models["mart_ai_share_by_month"]), "measure", "total") == {
        ("Post titles", 12), ("Comments", 9)
    }
    assert [r.tool for r in serving.tool_list(models["mart_tool_mentions_by_month"]).collect()] == sorted(
        t.tool for t in shipped_terms()
    )
    chosen = serving.compare_tools(models["mart_tool_mentions_by_month"], ["LLM", "dbt"], "posts_mentioning", "share_pct")
    assert chosen.count() == 8
    with pytest.raises(ValueError):
        serving.compare_tools(models["mart_tool_mentions_by_month"], list("abcde"), "posts_mentioning", "share_pct")
