"""SQL that gives the same rows as each query, for an independent engine.

Common table expressions are named once and pulled in by need. Booleans, dates and counts are
cast to the types the queries return; word boundaries are ``\\b``, which is ASCII there.
"""

from __future__ import annotations

import re

from trendloom.bindings import queries as q
from trendloom.bindings import tables as t
from trendloom.functions.text import Term
from trendloom.plans import checks
from trendloom.sources.terms import shipped_terms


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _ascii_lower(column: str) -> str:
    """Texts are compared in ASCII lower case: an accented capital stays as it is."""
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _hit(column: str, term: Term) -> str:
    searched = column
    if term.exclude_pattern:
        searched = rf"regexp_replace({column}, '\b({term.exclude_pattern})\b', ' ', 'g')"
    return rf"regexp_matches({searched}, '\b({term.pattern})\b', 's')"


def _mentions(source: str, keys: str, text: str, terms: list[Term], title: str | None = None) -> str:
    flag = (lambda term: f", {_hit(title, term)} AS is_in_title") if title else (lambda term: "")
    return " UNION ALL ".join(
        f"SELECT {keys}, {_text(x.tool)} AS tool, {_text(x.category)} AS category{flag(x)} "
        f"FROM {source} WHERE {_hit(text, x)}"
        for x in terms
    )


def _pct(part: str, whole: str) -> str:
    return f"round_even({part} / nullif({whole}, 0) * 100, 2)"


_ORDER = ", ".join(f"{c} DESC" for c in t.LINE_ORDER)
_TERMS = ", ".join(f"({_text(x.tool)}, {_text(x.category)})" for x in t.PART_TERMS)

CTES = {
    "terms": f"SELECT * FROM (VALUES {_TERMS}) AS v(tool, category)",
    "lines": (
        "SELECT * FROM lineitem QUALIFY row_number() OVER "
        f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) = 1"
    ),
    "ends": """
        SELECT l_orderkey, arg_min(p_name, l_linenumber) AS first_name, arg_max(p_name, l_linenumber) AS last_name,
               CAST(count(*) AS INTEGER) AS n
        FROM lines JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""",
    "s_posts": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS post_id,
               CASE WHEN o_custkey % 10 <> 0 THEN sha256('{t.SALT}' || o_custkey) END AS author_id,
               coalesce(first_name, '') AS title,
               CASE WHEN o_orderstatus <> 'F' THEN last_name END AS body,
               nullif(o_orderpriority, '4-NOT SPECIFIED') AS flair,
               l_orderkey IS NOT NULL AS is_text_post,
               o_orderpriority = '1-URGENT' AS is_nsfw,
               CAST(floor(o_totalprice) AS INTEGER) AS score,
               coalesce(n, 0) AS num_comments,
               CAST((o_custkey % 4) / 4 AS FLOAT) AS upvote_ratio,
               CASE WHEN o_orderstatus = 'F' THEN 'moderator' END AS removal_reason,
               o_orderstatus = 'F' AS is_removed_at_capture,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'deleted' END AS later_removal_type,
               o_orderstatus = 'P' AND o_orderkey % 3 = 0 AS is_removed_later,
               o_orderdate AS posted_at,
               o_orderdate + INTERVAL 30 SECOND AS retrieved_at,
               'https://forum.example/p/' || o_orderkey AS url,
               '/p/' || o_orderkey AS permalink
        FROM orders LEFT JOIN ends ON l_orderkey = o_orderkey""",
    "s_comments": f"""
        SELECT l_orderkey || '-' || l_linenumber AS comment_id,
               CAST(l_orderkey AS VARCHAR) AS post_id,
               CASE WHEN l_linenumber <> 1 THEN l_orderkey || '-1' END AS parent_comment_id,
               l_linenumber = 1 AS is_top_level,
               CASE WHEN l_suppkey = 1 THEN sha256('{t.SALT}AutoModerator')
                    WHEN l_suppkey % 10 <> 0 THEN sha256('{t.SALT}' || l_suppkey) END AS author_id,
               l_suppkey = 1 AS is_automoderator,
               l_linenumber = 2 AS is_by_post_author,
               CASE WHEN l_suppkey = 1 THEN 'moderator' END AS distinguished,
               l_returnflag = 'R' AS is_body_removed,
               CASE WHEN l_returnflag <> 'R' THEN p_name END AS body,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'deleted' END AS later_removal_type,
               CAST(l_quantity AS INTEGER) AS score,
               CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS SMALLINT) AS controversiality,
               l_shipdate AS commented_at,
               l_shipdate + INTERVAL 30 SECOND AS retrieved_at
        FROM lines JOIN part ON p_partkey = l_partkey""",
    "humans": "SELECT * FROM s_comments WHERE NOT is_automoderator AND body IS NOT NULL",
    "post_texts": "SELECT *, lower(title) AS title_text, lower(title || ' ' || coalesce(body, '')) AS post_text FROM s_posts",
    "comment_texts": "SELECT *, lower(body) AS comment_text FROM humans",
    "post_mentions": _mentions(
        "post_texts",
        "post_id, posted_at, flair, is_removed_at_capture, is_removed_later, score, num_comments",
        "post_text",
        t.PART_TERMS,
        "title_text",
    ),
    "comment_mentions": _mentions(
        "comment_texts", "comment_id, post_id, commented_at, is_top_level, score", "comment_text", t.PART_TERMS
    ),
    "f_posts": """
        SELECT post_id, posted_at, flair, is_text_post, is_removed_at_capture, removal_reason, is_removed_later,
               later_removal_type, score, num_comments, upvote_ratio,
               coalesce(tools, 0) AS tools_mentioned, coalesce(ai, false) AS mentions_ai,
               coalesce(ai_title, false) AS mentions_ai_in_title
        FROM s_posts LEFT JOIN (
            SELECT post_id, count(*) AS tools, bool_or(category = 'ai') AS ai,
                   bool_or(category = 'ai' AND is_in_title) AS ai_title
            FROM post_mentions GROUP BY post_id) USING (post_id)""",
    "by_tool": f"""
        SELECT month, tool, category, coalesce(a, 0) AS posts_mentioning, coalesce(b, 0) AS posts_mentioning_in_title,
               n AS posts_in_month, {_pct("coalesce(a, 0)", "n")} AS share_pct,
               {_pct("coalesce(b, 0)", "n")} AS title_share_pct
        FROM (SELECT CAST(date_trunc('month', posted_at) AS DATE) AS month, count(*) AS n FROM s_posts GROUP BY 1)
        CROSS JOIN terms
        LEFT JOIN (SELECT CAST(date_trunc('month', posted_at) AS DATE) AS month, tool, count(*) AS a,
                          count(*) FILTER (is_in_title) AS b
                   FROM post_mentions GROUP BY 1, 2) USING (month, tool)""",
    "by_comment_tool": f"""
        SELECT month, tool, category, coalesce(a, 0) AS comments_mentioning, n AS comments_in_month,
               {_pct("coalesce(a, 0)", "n")} AS share_pct
        FROM (SELECT CAST(date_trunc('month', commented_at) AS DATE) AS month, count(*) AS n FROM humans GROUP BY 1)
        CROSS JOIN terms
        LEFT JOIN (SELECT CAST(date_trunc('month', commented_at) AS DATE) AS month, tool, count(*) AS a
                   FROM comment_mentions GROUP BY 1, 2) USING (month, tool)""",
    "by_flair": f"""
        SELECT month, label AS flair, count(*) AS posts, count(*) FILTER (mentions_ai_in_title) AS ai_posts_in_title,
               {_pct("count(*) FILTER (mentions_ai_in_title)", "count(*)")} AS ai_title_share_pct
        FROM (SELECT CAST(date_trunc('month', posted_at) AS DATE) AS month, coalesce(flair, 'No flair') AS label,
                     mentions_ai_in_title FROM f_posts)
        GROUP BY 1, 2""",
    "by_month": f"""
        SELECT month, measure, count(*) FILTER (hit) AS mentions_ai, count(*) AS total,
               {_pct("count(*) FILTER (hit)", "count(*)")} AS share_pct
        FROM (SELECT CAST(date_trunc('month', posted_at) AS DATE) AS month, 'Post titles' AS measure,
                     mentions_ai_in_title AS hit FROM f_posts
              UNION ALL
              SELECT CAST(date_trunc('month', commented_at) AS DATE), 'Comments',
                     comment_id IN (SELECT comment_id FROM comment_mentions WHERE category = 'ai')
              FROM humans)
        GROUP BY 1, 2""",
    "months": "SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders",
    "positions": """
        SELECT month, row_number() OVER (ORDER BY month) AS month_number, count(*) OVER () AS month_count
        FROM months""",
    "priority_posts": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, title,
               title || ' ' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE lower(o_orderstatus) END AS whole
        FROM (SELECT *, lower(CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '' WHEN '2-HIGH' THEN '1-URGENT'
                              ELSE o_orderpriority END) AS title FROM orders)""",
    "edited_posts": f"""
        SELECT CAST(date_trunc('month', CASE WHEN edited THEN o_orderdate + INTERVAL {t.MOVED_DAYS} DAY ELSE o_orderdate END) AS DATE) AS month,
               title, title || ' ' || CASE WHEN o_orderstatus = 'F' THEN '' ELSE lower(o_orderstatus) END AS whole,
               nullif(o_orderpriority, '5-LOW') AS flair
        FROM (SELECT *, o_orderkey % {t.EDITED} = 0 AS edited,
                     lower(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
                                WHEN o_orderkey % {t.EDITED} = 0 AND o_orderpriority = '1-URGENT' THEN '5-LOW'
                                ELSE o_orderpriority END) AS title FROM orders)""",
    "windows": """
        SELECT month, CASE WHEN month_number - 1 <= 6 THEN 'first' ELSE 'last' END AS period FROM positions
        WHERE month_number > 1 AND month_number < month_count
          AND (month_number - 1 <= 6 OR month_number - 1 > month_count - 8)""",
    "change": """
        SELECT measure, round_even(f, 2) AS first_share_pct, round_even(l, 2) AS last_share_pct,
               round_even(l - f, 2) AS change_pts, round_even(l / nullif(f, 0), 2) AS growth_ratio
        FROM (SELECT measure,
                     sum(mentions_ai) FILTER (period = 'first') / nullif(sum(total) FILTER (period = 'first'), 0) * 100 AS f,
                     sum(mentions_ai) FILTER (period = 'last') / nullif(sum(total) FILTER (period = 'last'), 0) * 100 AS l
              FROM by_month JOIN windows USING (month) GROUP BY measure)""",
    "tool_change": """
        SELECT tool, category, category = 'ai' AS is_ai, measure, round_even(f, 2) AS first_share_pct,
               round_even(l, 2) AS last_share_pct, round_even(l - f, 2) AS change_pts
        FROM (SELECT tool, category, measure,
                     sum(hits) FILTER (period = 'first') / nullif(sum(total) FILTER (period = 'first'), 0) * 100 AS f,
                     sum(hits) FILTER (period = 'last') / nullif(sum(total) FILTER (period = 'last'), 0) * 100 AS l
              FROM (SELECT month, tool, category, 'Post titles' AS measure, posts_mentioning_in_title AS hits,
                           posts_in_month AS total FROM by_tool
                    UNION ALL
                    SELECT month, tool, category, 'Comments', comments_mentioning, comments_in_month
                    FROM by_comment_tool)
              JOIN windows USING (month) GROUP BY ALL)""",
    "flair_window": f"""
        SELECT flair, period, CAST(sum(posts) AS BIGINT) AS posts,
               CAST(sum(ai_posts_in_title) AS BIGINT) AS ai_posts_in_title,
               {_pct("sum(ai_posts_in_title)", "sum(posts)")} AS ai_title_share_pct
        FROM by_flair JOIN windows USING (month) GROUP BY flair, period""",
    "labels_of_windows": """
        SELECT period, min(month) AS first_month, max(month) AS last_month,
               strftime(min(month), '%b %Y') || ' – ' || strftime(max(month), '%b %Y') AS label
        FROM windows GROUP BY period""",
    "event_posts": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(event_id AS VARCHAR) AS id, event_type AS title,
               CAST(user_id AS VARCHAR) AS author, CAST(floor(value) AS INTEGER) AS score,
               date_trunc('second', ts) AS created_utc, props
        FROM events""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            found[name] = None
            _needed(body, found)


def _sql(body: str) -> str:
    """The query with the common table expressions it uses, in order."""
    needed: dict[str, None] = {}
    _needed(body, needed)
    if not needed:
        return body.strip()
    ctes = ", ".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in CTES if name in needed)
    return f"WITH {ctes} {body.strip()}"


_POST_JSON = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'town' AS subreddit, CAST(o_custkey AS VARCHAR) AS author,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS title,
           CASE WHEN o_orderstatus = 'F' THEN '[removed]' ELSE o_orderstatus END AS selftext,
           '' AS url, '' AS permalink, nullif(o_orderpriority, '5-LOW') AS link_flair_text,
           o_custkey % 2 = 0 AS is_self, false AS over_18,
           CAST(CASE WHEN o_custkey % 3 <> 0 THEN floor(o_totalprice) ELSE 0 END AS INTEGER) AS score,
           CAST(0 AS INTEGER) AS num_comments,
           CAST(CASE WHEN o_custkey % 4 <> 3 THEN (o_custkey % 4) / 4 ELSE 0 END AS FLOAT) AS upvote_ratio,
           CASE WHEN o_orderstatus = 'F' THEN 'moderator' END AS removed_by_category,
           o_orderdate AS created_utc,
           CASE WHEN o_custkey % 7 <> 0 THEN o_orderdate + INTERVAL 30 SECOND
                ELSE TIMESTAMP '1970-01-01 00:00:00' END AS retrieved_on,
           CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN 'deleted' END AS later_removal_type,
           CAST(o_orderkey AS VARCHAR) AS id_in_raw"""

def _priority_mart(posts: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT month, {_text(x.tool)} AS tool, {_text(x.category)} AS category, a AS posts_mentioning,
               b AS posts_mentioning_in_title, n AS posts_in_month, {_pct("a", "n")} AS share_pct,
               {_pct("b", "n")} AS title_share_pct
        FROM (SELECT month, count(*) AS n, count(*) FILTER ({_hit("whole", x)}) AS a,
                     count(*) FILTER ({_hit("whole", x)} AND {_hit("title", x)}) AS b
              FROM {posts} GROUP BY month)"""
        for x in t.PRIORITY_TERMS
    )


_DAYS = f"BETWEEN '{q.FIRST_DAY}' AND '{q.LAST_DAY}'"

_ALL_MENTIONED = "SELECT DISTINCT tool FROM comment_mentions"

_MODELS = {
    "fct_post_tool_mentions": "post_mentions",
    "fct_comment_tool_mentions": "comment_mentions",
    "fct_posts": "f_posts",
    "dim_comparison_windows": "windows",
    "mart_tool_mentions_by_month": "by_tool",
    "mart_comment_tool_mentions_by_month": "by_comment_tool",
    "mart_ai_share_by_flair_month": "by_flair",
    "mart_ai_share_by_month": "by_month",
    "mart_ai_share_change": "change",
    "mart_tool_share_change": "tool_change",
    "mart_ai_share_by_flair_window": "flair_window",
}


# What is summed up of each model: texts, days, flags and numbers.
_CONTENT = {
    "fct_post_tool_mentions": ("post_id tool category flair", "posted_at", "is_in_title is_removed_at_capture is_removed_later", "score num_comments"),
    "fct_comment_tool_mentions": ("comment_id post_id tool category", "commented_at", "is_top_level", "score"),
    "fct_posts": (
        "post_id flair removal_reason later_removal_type",
        "posted_at",
        "is_text_post is_removed_at_capture is_removed_later mentions_ai mentions_ai_in_title",
        "score num_comments upvote_ratio tools_mentioned",
    ),
    "dim_comparison_windows": ("period", "month", "", ""),
    "mart_tool_mentions_by_month": ("tool category", "month", "", "posts_mentioning posts_mentioning_in_title posts_in_month share_pct title_share_pct"),
    "mart_comment_tool_mentions_by_month": ("tool category", "month", "", "comments_mentioning comments_in_month share_pct"),
    "mart_ai_share_by_flair_month": ("flair", "month", "", "posts ai_posts_in_title ai_title_share_pct"),
    "mart_ai_share_by_month": ("measure", "month", "", "mentions_ai total share_pct"),
    "mart_ai_share_change": ("measure", "", "", "first_share_pct last_share_pct change_pts growth_ratio"),
    "mart_tool_share_change": ("tool category measure", "", "is_ai", "first_share_pct last_share_pct change_pts"),
    "mart_ai_share_by_flair_window": ("flair period", "", "", "posts ai_posts_in_title ai_title_share_pct"),
}


def _contents(model: str) -> str:
    forms = ["length({0})", "date_diff('day', DATE '1970-01-01', CAST({0} AS DATE))", "CAST({0} AS INTEGER)", "CAST({0} AS DOUBLE)"]
    sums = [" + ".join(["0", *(f"coalesce(sum({form.format(c)}), 0)" for c in columns.split())]) for form, columns in zip(forms, _CONTENT[model], strict=True)]
    whole = [f"CAST({value} AS BIGINT) AS {name}" for name, value in zip(("chars", "days", "flags"), sums, strict=False)]
    return f"SELECT '{model}' AS model, count(*) AS rows, {', '.join(whole)}, round(CAST({sums[3]} AS DOUBLE), 4) AS numbers FROM {_MODELS[model]}"


# Objects of four shapes, as they land.
_MIXED = """
    SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 4 = 2 THEN '' ELSE event_type END AS title, '' AS author,
           CAST(CASE WHEN event_id % 4 = 0 THEN floor(value) ELSE 0 END AS INTEGER) AS score,
           CASE WHEN event_id % 4 = 1 THEN 'deleted' END AS later_removal_type,
           CASE event_id % 4 WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN 1 THEN '12' END AS raw_score,
           CASE event_id % 4 WHEN 0 THEN '{}' WHEN 1 THEN '{"removal_type":"deleted","k":1}' END AS raw__meta,
           CASE WHEN event_id % 4 = 3 THEN '[1,{"a":{}}]' END AS raw_extra
    FROM events"""


def _listed(values: list[str]) -> str:
    return ", ".join(_text(v) for v in values)


def _report() -> str:
    """The data tests counted one by one over the same models."""
    names = {**_MODELS, "stg_posts": "s_posts", "stg_comments": "s_comments", "tools": "terms"}
    rows: list[tuple[str, str, str]] = []
    for model, columns in checks.NOT_NULL.items():
        rows += [(f"not_null {model}.{c}", "error", f"SELECT 1 FROM {names[model]} WHERE {c} IS NULL") for c in columns]
    for model, c in checks.UNIQUE.items():
        sql = f"SELECT 1 FROM {names[model]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
        rows.append((f"unique {model}.{c}", "error", sql))
    for model, c, values in checks.ACCEPTED_VALUES:
        sql = f"SELECT 1 FROM {names[model]} WHERE {c} NOT IN ({_listed(values)})"
        rows.append((f"accepted_values {model}.{c}", "error", sql))
    for model, c, parent, key, severity in checks.RELATIONSHIPS:
        sql = f"SELECT DISTINCT {c} FROM {names[model]} WHERE {c} NOT IN (SELECT {key} FROM {names[parent]})"
        rows.append((f"relationships {model}.{c}", severity, sql))
    for model, keys in checks.GRAINS.items():
        grain = ", ".join(keys)
        rows.append((f"grain {model}", "error", f"SELECT 1 FROM {names[model]} GROUP BY {grain} HAVING count(*) > 1"))
    outside = "NOT (coalesce(first_share_pct, 0) BETWEEN 0 AND 100 AND coalesce(last_share_pct, 0) BETWEEN 0 AND 100)"
    rows += [
        ("window size", "error", "SELECT 1 FROM windows GROUP BY period HAVING count(*) > 6"),
        ("title within total", "error", "SELECT 1 FROM by_tool WHERE posts_mentioning_in_title > posts_mentioning"),
        (
            "shares are percentages",
            "error",
            f"SELECT 1 FROM change WHERE {outside} UNION ALL SELECT 1 FROM tool_change WHERE {outside}",
        ),
        ("null body means removed", "error", "SELECT 1 FROM s_comments WHERE body IS NULL AND NOT is_body_removed"),
        (
            "multi-word tools found",
            "error",
            "SELECT * FROM (VALUES ('Hot Ring'), ('Sprocket')) AS e(tool) "
            "WHERE tool NOT IN (SELECT tool FROM post_mentions)",
        ),
    ]
    counted = " UNION ALL ".join(
        f"SELECT {_text(name)} AS test, {_text(severity)} AS severity, (SELECT count(*) FROM ({sql})) AS failures"
        for name, severity, sql in rows
    )
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ({counted})"


_BODIES = {
    "latest_by_key": "SELECT * FROM lines",
    "dedup_last_in_batch": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "idempotent_reload": f"""
        SELECT id, title, score, created_utc, CAST(date_trunc('month', created_utc) AS DATE) AS created_month,
               TIMESTAMP '{q.LOAD_2}' AS loaded_at
        FROM ({_POST_JSON} FROM orders)""",
    "month_partition_roundtrip": """
        SELECT o_orderkey, o_orderdate AS created_utc, CAST(date_trunc('month', o_orderdate) AS DATE) AS created_month
        FROM orders""",
    "day_range_slice": f"SELECT event_id, ts, event_type FROM events WHERE strftime(ts, '%Y-%m-%d') {_DAYS}",
    "day_slice_write": "SELECT day, id, title FROM event_posts",
    "day_slice_force": f"""
        SELECT day, id, CASE WHEN day {_DAYS} THEN 'again ' || title ELSE title END AS title FROM event_posts""",
    "day_slice_scan": f"SELECT day, id, title FROM event_posts WHERE day {_DAYS}",
    "stream_day_files": "SELECT id, 'again ' || title AS title, author, score, created_utc FROM event_posts",
    "stream_recaptured_day": f"""
        SELECT id, CASE WHEN day {_DAYS} THEN 'again ' || title ELSE title END AS title, author, score, created_utc,
               CAST(CASE WHEN day {_DAYS} THEN 2 ELSE 1 END AS BIGINT) AS versions
        FROM event_posts""",
    "scan_raw_verbatim": rf"""
        SELECT strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY event_id) - 1 AS place,
               CASE event_id % 3
                   WHEN 0 THEN '{{ "id" : "' || event_id || '","ratio":0.90, "big": 1E+2,' || chr(10) || ' "title":"a \"quoted\" \u00e9 [é] {{"}}'
                   WHEN 1 THEN '{{"id":"' || event_id || '", "tags":[ ], "path":"c:\\", "user":' || user_id || '}}'
                   ELSE '{{"id":"' || event_id || '","inner":{{"k":[1.50,{{"]":"}}"}}]}}}}' END AS raw
        FROM events WHERE strftime(ts, '%Y-%m-%d') {_DAYS}""",
    "seed_terms": """
        SELECT 'Part ' || p_partkey AS tool, p_type AS category, p_name || '|' || lower(p_brand) AS pattern,
               CASE WHEN p_size % 2 = 0 THEN 'hot ' || p_name END AS exclude_pattern
        FROM part""",
    "json_array_explode": "SELECT day, id, title, json_extract_string(props, '$.k') AS k FROM event_posts",
    "json_array_files": "SELECT day, id, title FROM event_posts",
    "scan_raw_all": _MIXED,
    "scan_raw_days": f"{_MIXED} WHERE CAST(ts AS DATE) BETWEEN DATE '{q.FIRST_DAY}' AND DATE '{q.LAST_DAY}'",
    "variant_field": """
        SELECT CAST(event_id AS VARCHAR) AS id,
               CASE event_id % 4 WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN 1 THEN '12' END AS score,
               CAST(CASE WHEN event_id % 4 = 1 THEN 1 END AS INTEGER) AS k,
               CAST(CASE WHEN event_id % 4 = 3 THEN 1 END AS BIGINT) AS first_extra,
               CAST(NULL AS INTEGER) AS title_as_number
        FROM events""",
    "listing_diff": """
        SELECT DISTINCT 'event_type=' || event_type || '/day=' || strftime(ts, '%Y-%m-%d') AS key,
               CASE WHEN event_type = 'click' THEN 'copy' ELSE 'skip' END AS action, TRUE AS below_itself
        FROM events""",
    "land_json_defaults": f"SELECT *, TIMESTAMP '{q.LOAD_1}' AS loaded_at FROM ({_POST_JSON} FROM orders)",
    "land_comments_defaults": """
        SELECT l_orderkey || '-' || l_linenumber AS id, 't3_' || l_orderkey AS link_id,
               CASE WHEN l_linenumber = 1 THEN 't3_' || l_orderkey ELSE '' END AS parent_id, '' AS subreddit,
               CAST(l_suppkey AS VARCHAR) AS author,
               CASE WHEN l_returnflag = 'R' THEN '' ELSE l_returnflag END AS body,
               CAST(CASE WHEN l_linenumber <> 4 THEN l_quantity ELSE 0 END AS INTEGER) AS score,
               CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS SMALLINT) AS controversiality,
               l_linenumber = 2 AS is_submitter,
               CASE WHEN l_suppkey = 1 THEN 'moderator' END AS distinguished,
               l_shipdate AS created_utc,
               CASE WHEN l_linenumber <> 5 THEN l_shipdate + INTERVAL 30 SECOND
                    ELSE TIMESTAMP '1970-01-01 00:00:00' END AS retrieved_on,
               CAST(NULL AS VARCHAR) AS later_removal_type,
               l_orderkey || '-' || l_linenumber AS id_in_raw
        FROM lineitem""",
    "json_nested_field": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN 'deleted' END AS later_removal_type
        FROM orders""",
    "epoch_to_ts": """
        SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds,
               date_trunc('second', ts) AS moment FROM events""",
    "prefixed_ids": """
        SELECT CAST(l_orderkey AS VARCHAR) AS post_id,
               CASE WHEN l_linenumber <> 1 THEN 'c' || l_orderkey END AS parent_comment_id,
               l_linenumber = 1 AS is_top_level
        FROM lineitem""",
    "pseudonymise": f"""
        SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN sha256('{t.SALT}' || user_id) END AS author_id FROM events""",
    "json_rows": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, props
        FROM events""",
    "manifest_diff": """
        SELECT 'doc/' || doc_id AS key, n_chars AS size, CASE WHEN toxic = 0 THEN 'skip' ELSE 'copy' END AS action
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "manifest_diff_back": """
        SELECT count(*) FILTER (toxic <> 0) AS copied, count(*) FILTER (toxic = 0) AS skipped
        FROM documents JOIN labels USING (doc_id)""",
    "stg_posts": "SELECT * FROM s_posts",
    "stg_comments": "SELECT * FROM s_comments",
    "removal_flags": """
        SELECT post_id, removal_reason, is_removed_at_capture, later_removal_type, is_removed_later FROM s_posts""",
    "human_comments": "SELECT comment_id, post_id, body, commented_at FROM humans",
    "post_text": "SELECT post_id, title_text, post_text FROM post_texts",
    "text_mentions": _mentions(
        "(SELECT doc_id, lang, lower(text) AS x FROM documents)", "doc_id, lang", "x", t.WORD_TERMS
    ),
    "text_mentions_regex": _mentions(
        f"(SELECT doc_id, lang, {_ascii_lower('text')} AS x FROM documents)", "doc_id, lang", "x", t.REGEX_TERMS
    ),
    "text_mentions_mixed": _mentions(
        f"(SELECT doc_id, lang, {_ascii_lower('text')} AS x FROM documents)", "doc_id, lang", "x", t.MIXED_TERMS
    ),
    "text_mentions_large": f"""
        WITH words AS (
            SELECT DISTINCT doc_id, lang, unnest(regexp_extract_all({_ascii_lower('text')}, '[0-9a-z_]+')) AS word FROM documents
        ), syllables AS (
            SELECT unnest([{_listed(t.SYLLABLES)}]) AS s
        ), many AS (
            SELECT a.s || b.s AS tool, a.s AS category FROM syllables a, (SELECT '' AS s UNION ALL SELECT s FROM syllables) b
        )
        SELECT doc_id, lang, tool, category FROM words JOIN many ON tool = word""",
    "text_mentions_tools": _mentions(
        "(SELECT 'document ' || doc_id AS item_id, lower(text) AS x FROM documents UNION ALL "
        "SELECT 'turn ' || conv_id || '-' || turn, lower(text) FROM conversations)",
        "item_id",
        "x",
        shipped_terms(),
    ),
    "post_tool_mentions": "SELECT * FROM post_mentions",
    "comment_tool_mentions": "SELECT * FROM comment_mentions",
    "mentions_from_versions": _priority_mart("priority_posts"),
    "marts_incremental": _priority_mart("edited_posts"),
    "flair_mart_incremental": f"""
        SELECT month, flair, count(*) AS posts, count(*) FILTER (hit) AS ai_posts_in_title,
               {_pct("count(*) FILTER (hit)", "count(*)")} AS ai_title_share_pct
        FROM (SELECT month, coalesce(flair, 'No flair') AS flair, {_hit("title", t.PRIORITY_TERMS[0])} AS hit FROM edited_posts)
        GROUP BY 1, 2""",
    "posts_fact": "SELECT * FROM f_posts",
    "posts_fact_from_mentions": "SELECT * FROM f_posts",
    "monthly_counts": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS total FROM orders GROUP BY 1""",
    "distinct_months": "SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem",
    "month_positions": "SELECT * FROM positions",
    "comparison_windows": "SELECT * FROM windows",
    "tool_mentions_by_month": "SELECT * FROM by_tool",
    "tool_mentions_by_month_from_facts": "SELECT * FROM by_tool",
    "comment_tool_mentions_by_month": "SELECT * FROM by_comment_tool",
    "comment_tool_mentions_by_month_from_facts": "SELECT * FROM by_comment_tool",
    "ai_share_by_flair_month": "SELECT * FROM by_flair",
    "ai_share_by_month": "SELECT * FROM by_month",
    "ai_share_by_month_from_facts": "SELECT * FROM by_month",
    "ai_share_change": "SELECT * FROM change",
    "tool_share_change": "SELECT * FROM tool_change",
    "ai_share_by_flair_window": "SELECT * FROM flair_window",
    "window_labels": "SELECT * FROM labels_of_windows",
    "serve_headline": "SELECT * FROM change",
    "largest_other_move": """
        SELECT tool, change_pts FROM tool_change WHERE measure = 'Post titles' AND NOT is_ai
        ORDER BY abs(change_pts) DESC, tool LIMIT 1""",
    "serve_ai_trend": "SELECT * FROM by_month",
    "serve_tool_changes": """
        SELECT tool, category, CASE WHEN is_ai THEN 'AI tools' ELSE 'Other tools' END AS "group", first_share_pct,
               last_share_pct, change_pts
        FROM tool_change WHERE measure = 'Post titles'""",
    "serve_tool_list": "SELECT DISTINCT tool FROM by_tool",
    "serve_flair_windows": f"""
        SELECT flair, period, label AS period_label, ai_title_share_pct AS ai_share_pct,
               CAST(dense_rank() OVER (ORDER BY last_share DESC, flair) AS INTEGER) AS flair_rank
        FROM (SELECT *, max(ai_title_share_pct) FILTER (period = 'last') OVER (PARTITION BY flair) AS last_share
              FROM flair_window WHERE flair IN ({_listed(q.PICKED_FLAIRS)}))
        JOIN labels_of_windows USING (period)""",
    "serve_compare_tools": f"""
        SELECT month, tool, posts_mentioning_in_title, title_share_pct FROM by_tool
        WHERE tool IN ({_listed(q.PICKED_TOOLS)})""",
    "serve_compare_tools_comments": f"""
        SELECT month, tool, comments_mentioning, share_pct FROM by_comment_tool
        WHERE tool IN ({_listed(q.PICKED_TOOLS)})""",
    "population_totals": "SELECT measure, CAST(sum(total) AS BIGINT) AS total FROM by_month GROUP BY measure",
    "latest_point_per_measure": "SELECT * FROM by_month QUALIFY rank() OVER (PARTITION BY measure ORDER BY month DESC) = 1",
    "latest_two_months": f"""
        SELECT m.month, x.measure, coalesce(b.share_pct, 0) AS share_pct,
               strftime(m.month, '%b %Y') ||
                   CASE WHEN m.month = date_trunc('month', DATE '{t.RUN_DATE}') THEN ' (so far)' ELSE '' END AS label
        FROM (SELECT DISTINCT month FROM by_month ORDER BY month DESC LIMIT 2) m
        CROSS JOIN (VALUES ('Post titles'), ('Comments')) x(measure)
        LEFT JOIN by_month b ON b.month = m.month AND b.measure = x.measure""",
    "digest_movers": """
        SELECT 'AI tools rising fastest' AS section, CAST(up AS INTEGER) AS place, tool, change_pts
        FROM ranked WHERE is_ai AND up <= 3
        UNION ALL SELECT 'Other tools rising most', CAST(up AS INTEGER), tool, change_pts
        FROM ranked WHERE NOT is_ai AND up <= 3
        UNION ALL SELECT 'Other tools falling most', CAST(down AS INTEGER), tool, change_pts
        FROM ranked WHERE NOT is_ai AND down <= 3""",
    "dq_not_null": """
        SELECT post_id, 'body' AS "column" FROM s_posts WHERE body IS NULL
        UNION ALL SELECT post_id, 'flair' FROM s_posts WHERE flair IS NULL
        UNION ALL SELECT post_id, 'later_removal_type' FROM s_posts WHERE later_removal_type IS NULL
        UNION ALL SELECT post_id, 'posted_at' FROM s_posts WHERE posted_at IS NULL""",
    "dq_unique": "SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "dq_accepted_values": """
        SELECT o_orderstatus AS value, count(*) AS rows FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1""",
    "dq_relationships": """
        SELECT doc_id AS value, count(*) AS failures FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""",
    "dq_grain_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_window_size": "SELECT period, count(*) AS months FROM windows GROUP BY period HAVING count(*) > 5",
    "dq_title_within_total": """
        SELECT month, tool, posts_mentioning_in_title, posts_mentioning FROM by_tool
        WHERE posts_mentioning > posts_mentioning_in_title""",
    "dq_pct_range": """
        SELECT 'ai_share_change' AS model, measure AS key, first_share_pct - 10 AS first_share_pct,
               last_share_pct - 10 AS last_share_pct
        FROM change WHERE first_share_pct < 10 OR last_share_pct < 10
        UNION ALL
        SELECT 'tool_share_change', tool || ' / ' || measure, first_share_pct - 10, last_share_pct - 10
        FROM tool_change WHERE first_share_pct < 10 OR last_share_pct < 10""",
    "dq_null_implies_flag": "SELECT post_id FROM s_posts WHERE body IS NULL AND NOT is_removed_at_capture",
    "dq_expected_terms_found": f"""
        SELECT tool FROM (VALUES ('Hot Ring'), ('Sprocket'), ('Gizmo'), ('Flywheel')) AS e(tool)
        WHERE tool NOT IN ({_ALL_MENTIONED})""",
    "dq_no_author_columns": "SELECT * FROM (VALUES ('stg_posts', 'author_id'), ('stg_comments', 'author_id')) AS v(model, \"column\")",
    "freshness_gate": " UNION ALL ".join(
        f"""SELECT '{name}' AS source, newest, hours AS age_hours,
               CASE WHEN hours > 72 THEN 'error' WHEN hours > 36 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max({column}) AS newest,
                     (epoch_us(TIMESTAMP '{q.NOW}') - epoch_us(max({column}))) / 3600000000 AS hours FROM {name})"""
        for name, column in [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    ),
    "mart_chain": " UNION ALL ".join(map(_contents, _MODELS)),
    "dq_report": _report(),
}

_BODIES["mentions_incremental"] = _BODIES["mentions_from_versions"]

CTES["ranked"] = """
    SELECT tool, is_ai, change_pts, row_number() OVER (PARTITION BY is_ai ORDER BY change_pts DESC, tool) AS up,
           row_number() OVER (PARTITION BY is_ai ORDER BY change_pts, tool) AS down
    FROM tool_change WHERE measure = 'Post titles' AND change_pts IS NOT NULL"""

ORACLE = {name: _sql(body) for name, body in _BODIES.items()}
