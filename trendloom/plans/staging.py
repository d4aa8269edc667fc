"""Staging: raw columns cleaned one to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import has_prefix, id_if_prefixed, nested_text, null_if_in, pseudonym, strip_prefix


def _later_removal(landed: DataFrame) -> Column:
    """The nested removal type: landed as a column, else taken from the raw text."""
    if "later_removal_type" in landed.columns:
        return F.col("later_removal_type")
    return nested_text(F.col("raw"), "$._meta.removal_type")


def clean_posts(landed: DataFrame, salt: str, *carry: str) -> DataFrame:
    """Posts as analysed; ``carry`` names further landed columns to keep."""
    later = _later_removal(landed)
    captured = F.col("removed_by_category").isNotNull()
    return landed.select(
        F.col("id").alias("post_id"),
        pseudonym(F.col("author"), salt).alias("author_id"),
        "title",
        null_if_in(F.col("selftext"), [fv.EMPTY_TEXT, *fv.REMOVED_TEXTS]).alias("body"),
        F.col("link_flair_text").alias("flair"),
        F.col("is_self").alias("is_text_post"),
        F.col("over_18").alias("is_nsfw"),
        "score",
        "num_comments",
        "upvote_ratio",
        F.col("removed_by_category").alias("removal_reason"),
        captured.alias("is_removed_at_capture"),
        later.alias("later_removal_type"),
        (~captured & later.isNotNull()).alias("is_removed_later"),
        F.col("created_utc").alias("posted_at"),
        F.col("retrieved_on").alias("retrieved_at"),
        "url",
        "permalink",
        *carry,
    )


def clean_comments(landed: DataFrame, salt: str, *carry: str) -> DataFrame:
    """Comments as analysed; ``carry`` names further landed columns to keep."""
    return landed.select(
        F.col("id").alias("comment_id"),
        strip_prefix(F.col("link_id"), fv.POST_PREFIX).alias("post_id"),
        id_if_prefixed(F.col("parent_id"), fv.COMMENT_PREFIX).alias("parent_comment_id"),
        has_prefix(F.col("parent_id"), fv.POST_PREFIX).alias("is_top_level"),
        pseudonym(F.col("author"), salt).alias("author_id"),
        (F.col("author") == fv.BOT_ACCOUNT).alias("is_automoderator"),
        F.col("is_submitter").alias("is_by_post_author"),
        "distinguished",
        F.col("body").isin(*fv.REMOVED_TEXTS).alias("is_body_removed"),
        null_if_in(F.col("body"), fv.REMOVED_TEXTS).alias("body"),
        _later_removal(landed).alias("later_removal_type"),
        "score",
        "controversiality",
        F.col("created_utc").alias("commented_at"),
        F.col("retrieved_on").alias("retrieved_at"),
        *carry,
    )


def human_comments(comments: DataFrame) -> DataFrame:
    """The population comment shares are measured on: no bot, and text still there."""
    return comments.where(~F.col("is_automoderator") & F.col("body").isNotNull())
