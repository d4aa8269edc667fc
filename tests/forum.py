"""A small invented forum: posts and comments over four months, January to April 2024.

With one month per window, February is the first window and March the last.
"""

from __future__ import annotations

from datetime import UTC, datetime


def epoch(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp())


def post(key: str, when: str, title: str, text: str = "Some text.", **fields) -> dict:
    created = epoch(when)
    return {
        "id": key,
        "subreddit": "looms",
        "author": f"weaver_{key}",
        "title": title,
        "selftext": text,
        "url": f"https://forum.example/{key}",
        "permalink": f"/{key}/",
        "link_flair_text": "Help",
        "is_self": True,
        "over_18": False,
        "score": 7,
        "num_comments": 1,
        "upvote_ratio": 0.75,
        "removed_by_category": None,
        "created_utc": created,
        "retrieved_on": created + 20,
        "_meta": {"retrieved_2nd_on": created + 90000},
        **fields,
    }


def comment(key: str, when: str, post_key: str, text: str, parent: str | None = None, **fields) -> dict:
    created = epoch(when)
    return {
        "id": key,
        "link_id": f"t3_{post_key}",
        "parent_id": parent or f"t3_{post_key}",
        "subreddit": "looms",
        "author": f"weaver_{key}",
        "body": text,
        "score": 2,
        "controversiality": 0,
        "is_submitter": False,
        "distinguished": None,
        "created_utc": created,
        "retrieved_on": created + 20,
        "_meta": {},
        **fields,
    }


POSTS = {
    "2024-01-10": [
        post("p1", "2024-01-10 08:00", "Moving from SQL Server to Power BI reports — advice?"),
        post("p2", "2024-01-10 09:00", "Delta Lake basics", "Compared with Iceberg and Spark."),
        post("p3", "2024-01-10 23:59:59", "Weekly thread", ""),
    ],
    "2024-02-05": [
        post("p4", "2024-02-05 08:00", "Anyone using an LLM for docs?", link_flair_text="Discussion"),
        post("p5", "2024-02-05 09:00", "Buy my course", "[removed]", removed_by_category="moderator"),
        post("p6", "2024-02-05 10:00", "Airflow or Dagster", "We run dbt too."),
        post("p7", "2024-02-05 11:00", "Power", "BI dashboards are slow"),
    ],
    "2024-03-07": [
        post("p8", "2024-03-07 08:00", "ChatGPT wrote my pipeline", link_flair_text="Discussion"),
        post("p9", "2024-03-07 09:00", "Agents everywhere: agentic RAG in prod", "MCP too", link_flair_text=None),
        post(
            "p10", "2024-03-07 10:00", "Career switch", "[deleted]", author="[deleted]",
            _meta={"removal_type": "deleted"},
        ),
        post("p11", "2024-03-07 11:00", "The SQL Server Agent job keeps failing", "user-agent strings too"),
    ],
    "2024-04-02": [
        post("p12", "2024-04-02 08:00", "Snowflake cost", link_flair_text="Help"),
    ],
}
COMMENTS = {
    "2024-01-11": [
        comment("c1", "2024-01-11 08:00", "p1", "Schedule it with SQL Server Agent."),
        comment("c2", "2024-01-11 09:00", "p1", "Agreed, Postgres is nicer", parent="t1_c1"),
    ],
    "2024-02-06": [
        comment("c3", "2024-02-06 08:00", "p5", "This post mentions Airflow rules", author="AutoModerator"),
        comment("c4", "2024-02-06 09:00", "p6", "[removed]"),
        comment("c5", "2024-02-06 10:00", "p6", "An agent and an LLM walk into a bar", author="[deleted]"),
        comment("c6", "2024-02-06 11:00", "p6", "dbt, DBT and dbt again"),
    ],
    "2024-03-08": [
        comment("c7", "2024-03-08 08:00", "p8", "gpt and Claude both fine"),
        comment("c8", "2024-03-08 09:00", "p8", "nothing here", _meta={"removal_type": "removed"}),
        comment("c9", "2024-03-08 10:00", "p8", "sparkling water is not spark_sql"),
        comment("c10", "2024-03-08 11:00", "p0", "orphan on a post before the data"),
    ],
    "2024-05-01": [
        comment("c11", "2024-05-01 08:00", "p12", "late comment in a month without posts: kafka"),
    ],
}
