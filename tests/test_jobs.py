"""The submitted jobs end to end on the invented forum."""

from __future__ import annotations

import json

import pytest

from forum import COMMENTS, POSTS, post
from trendloom import jobs
from trendloom.plans import rebuild


def test_land_rebuild_and_digest(spark, day_files, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("TRENDLOOM_SALT", "salt")
    posts, streamed, comments, models = (str(tmp_path / n) for n in ("t_posts", "t_streamed", "t_comments", "models"))
    post_files = day_files("posts", POSTS)
    comment_files = day_files("comments", COMMENTS)
    jobs.main(["land", "--kind", "posts", "--files", post_files, "--table", posts])
    jobs.main(["land", "--kind", "posts", "--files", post_files, "--table", posts, "--start", "2024-02-01", "--end", "2024-02-28"])
    jobs.main(["land", "--kind", "comments", "--files", comment_files, "--table", comments])
    later = day_files("later", {"2024-04-30": [post("p13", "2024-04-30 08:00", "Power BI and MCP")]})
    jobs.main(["stream", "--kind", "posts", "--files", later, "--table", streamed, "--progress", str(tmp_path / "progress")])
    rebuild_again = ["rebuild", "--posts", posts, streamed, "--comments", comments, "--models", models]
    rebuild_again += ["--matched", str(tmp_path / "matched"), "--window-months", "1", "--now", "2024-05-01 20:00:00"]
    for _ in range(2):
        jobs.main(rebuild_again)
        report = capsys.readouterr().out
        assert report.count("|pass") == 49 and "|warn" in report

    stored = rebuild.open_models(spark, models)
    rebuild.publish_views(stored)
    found = spark.sql("select post_id from fct_post_tool_mentions where tool = 'Power BI' order by post_id").collect()
    assert [r.post_id for r in found] == ["p1", "p13", "p7"]

    jobs.main(["digest", "--models", models, "--now", "2024-05-01 20:00:00"])
    lines = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert {"period": "first", "first_month": "2024-02-01", "last_month": "2024-02-01", "label": "Feb 2024 – Feb 2024"} in lines
    assert any(line.get("label") == "May 2024 (so far)" for line in lines)


def test_failed_tests_are_named(spark, day_files, tmp_path, monkeypatch):
    """Without any multi-word tool in the data the expectation on them fails."""
    monkeypatch.setenv("TRENDLOOM_SALT", "salt")
    posts, comments = str(tmp_path / "p"), str(tmp_path / "c")
    jobs.main(["land", "--files", day_files("posts", {"2024-02-05": POSTS["2024-02-05"][:1]}), "--table", posts])
    jobs.main(["land", "--kind", "comments", "--files", day_files("comments", {"2024-02-06": COMMENTS["2024-02-06"]}), "--table", comments])
    args = ["rebuild", "--posts", posts, "--comments", comments, "--models", str(tmp_path / "m"), "--now", "2024-02-06 12:00:00"]
    with pytest.raises(jobs.FailedTestsError, match="multi-word"):
        jobs.main(args)
