"""Facts: which item mentions which tool."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import post_text
from trendloom.functions.text import Term
from trendloom.operators.joins import left_join_defaults
from trendloom.operators.mentions import explode_mentions, mentions_category, with_mentions
from trendloom.operators.versions import latest_by_key
from trendloom.plans.staging import clean_comments, clean_posts, human_comments
from trendloom.sources.tables import NEWEST_FIRST, newest_first

# what facts and marts need of an item, next to its mentions: no text, no author
POST_COLUMNS = [
    "post_id",
    "posted_at",
    "flair",
    "is_text_post",
    "is_removed_at_capture",
    "removal_reason",
    "is_removed_later",
    "later_removal_type",
    "score",
    "num_comments",
    "upvote_ratio",
]
COMMENT_COLUMNS = ["comment_id", "post_id", "commented_at", "is_top_level", "score"]


def match_posts(posts: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Each staged post with the terms its title or body mentions."""
    found = with_mentions(posts, post_text(F.col("title"), F.col("body")), terms, title="title")
    return found.select(*POST_COLUMNS, "mentions")


def match_comments(comments: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Each human comment with text, with the terms it mentions."""
    found = with_mentions(human_comments(comments), F.col("body"), terms)
    return found.select(*COMMENT_COLUMNS, "mentions")


def match_staged_comments(comments: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Every staged comment with its mentions, and what the data tests read of it: no text, no author."""
    found = with_mentions(comments, F.col("body"), terms)
    tested = ["is_automoderator", "is_body_removed", "later_removal_type", F.left("body", F.lit(0)).alias("body")]
    return found.select(*COMMENT_COLUMNS, *tested, "mentions")


def matched_of(staged: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Matched posts and human comments from staging that was stored with its mentions."""
    posts, comments = staged["stg_posts"], human_comments(staged["stg_comments"])
    return posts.select(*POST_COLUMNS, "mentions"), comments.select(*COMMENT_COLUMNS, "mentions")


def match_each_post(versions: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Every raw version matched where it is read: narrow rows, without text, nothing shuffled."""
    staged = clean_posts(versions, "", *NEWEST_FIRST)
    found = with_mentions(staged, post_text(F.col("title"), F.col("body")), terms, title="title")
    return found.select(*POST_COLUMNS, "mentions", *NEWEST_FIRST)


def match_each_comment(versions: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """As ``match_each_post``, with what decides whether the newest version counts."""
    staged = clean_comments(versions, "", *NEWEST_FIRST).withColumn("has_text", F.col("body").isNotNull())
    found = with_mentions(staged, F.col("body"), terms)
    return found.select(*COMMENT_COLUMNS, "is_automoderator", "has_text", "mentions", *NEWEST_FIRST)


def newest_posts(matched_versions: DataFrame) -> DataFrame:
    """Matched posts from matched versions."""
    return latest_by_key(matched_versions, ["post_id"], newest_first()).select(*POST_COLUMNS, "mentions")


def newest_comments(matched_versions: DataFrame) -> DataFrame:
    """Matched comments; bots and removed texts drop out after the newest version is known."""
    newest = latest_by_key(matched_versions, ["comment_id"], newest_first())
    return newest.where(~F.col("is_automoderator") & F.col("has_text")).select(*COMMENT_COLUMNS, "mentions")


def match_post_versions(versions: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Matched posts straight from the raw versions.

    Only the narrow result of matching is shuffled to find the newest version: the text, nearly
    all of the bytes, never leaves its task.
    """
    return newest_posts(match_each_post(versions, terms))


def match_comment_versions(versions: DataFrame, terms: Iterable[Term]) -> DataFrame:
    return newest_comments(match_each_comment(versions, terms))


def post_tool_mentions(matched_posts: DataFrame) -> DataFrame:
    """One row per (post, tool) whose title or body mentions the tool."""
    return explode_mentions(matched_posts).select(
        "post_id",
        "tool",
        "category",
        "is_in_title",
        "posted_at",
        "flair",
        "is_removed_at_capture",
        "is_removed_later",
        "score",
        "num_comments",
    )


def comment_tool_mentions(matched_comments: DataFrame) -> DataFrame:
    """One row per (comment, tool) a human comment mentions."""
    return explode_mentions(matched_comments).select(
        "comment_id", "post_id", "tool", "category", "commented_at", "is_top_level", "score"
    )


def posts_fact(matched_posts: DataFrame, focus: str = fv.FOCUS_CATEGORY) -> DataFrame:
    """One row per post with its mention flags, read off the post's own array: no join."""
    return matched_posts.select(
        *POST_COLUMNS,
        F.size("mentions").cast("long").alias("tools_mentioned"),
        mentions_category(focus).alias("mentions_ai"),
        mentions_category(focus, only_in_title=True).alias("mentions_ai_in_title"),
    )


def posts_fact_from_mentions(posts: DataFrame, mentions: DataFrame, focus: str = fv.FOCUS_CATEGORY) -> DataFrame:
    """The posts fact from a stored mention fact: counted per post, then joined to the posts."""
    in_focus = F.col("category") == focus
    per_post = mentions.groupBy("post_id").agg(
        F.count("*").alias("tools_mentioned"),
        F.bool_or(in_focus).alias("mentions_ai"),
        F.bool_or(in_focus & F.col("is_in_title")).alias("mentions_ai_in_title"),
    )
    defaults = {"tools_mentioned": 0, "mentions_ai": False, "mentions_ai_in_title": False}
    return left_join_defaults(posts.select(*POST_COLUMNS), per_post, ["post_id"], defaults)
