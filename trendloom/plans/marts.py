"""Marts: monthly counts and shares, and the change between comparison windows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import month_of, pct
from trendloom.functions.text import Term
from trendloom.operators.joins import dense_grid, with_membership
from trendloom.operators.mentions import counts_by_term, mentions_category
from trendloom.operators.windows import in_windows, rounded_change, share_per_window


def monthly_counts(df: DataFrame, moment: str, total: str = "total") -> DataFrame:
    return df.groupBy(month_of(F.col(moment)).alias("month")).agg(F.count("*").alias(total))


def with_post_shares(counts: DataFrame) -> DataFrame:
    posts = F.col("posts_in_month")
    return counts.select(
        "month",
        "tool",
        "category",
        "posts_mentioning",
        "posts_mentioning_in_title",
        "posts_in_month",
        pct(F.col("posts_mentioning"), posts).alias("share_pct"),
        pct(F.col("posts_mentioning_in_title"), posts).alias("title_share_pct"),
    )


def with_comment_share(counts: DataFrame) -> DataFrame:
    return counts.select(
        "month",
        "tool",
        "category",
        "comments_mentioning",
        "comments_in_month",
        pct(F.col("comments_mentioning"), F.col("comments_in_month")).alias("share_pct"),
    )


def tool_mentions_by_month(matched_posts: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Every month × every tool: posts that mention it and their share of the month's posts."""
    counts = counts_by_term(
        matched_posts,
        month_of(F.col("posted_at")),
        terms,
        "posts_in_month",
        {"posts_mentioning": F.lit(True), "posts_mentioning_in_title": F.col("m.is_in_title")},
    )
    return with_post_shares(counts.withColumnRenamed("bucket", "month"))


def comment_tool_mentions_by_month(matched_comments: DataFrame, terms: Iterable[Term]) -> DataFrame:
    """Every month × every tool: human comments that mention it and their share."""
    counts = counts_by_term(
        matched_comments,
        month_of(F.col("commented_at")),
        terms,
        "comments_in_month",
        {"comments_mentioning": F.lit(True)},
    )
    return with_comment_share(counts.withColumnRenamed("bucket", "month"))


def tool_mentions_by_month_from_facts(posts: DataFrame, mentions: DataFrame, terms: list[Term]) -> DataFrame:
    """The same mart from stored posts and mentions: two counts laid over a dense grid."""
    counts = mentions.groupBy(month_of(F.col("posted_at")).alias("month"), "tool").agg(
        F.count("*").alias("posts_mentioning"), F.count_if("is_in_title").alias("posts_mentioning_in_title")
    )
    totals = monthly_counts(posts, "posted_at", "posts_in_month")
    measures = ["posts_mentioning", "posts_mentioning_in_title"]
    return with_post_shares(dense_grid(totals, terms, counts, "month", measures))


def comment_tool_mentions_by_month_from_facts(humans: DataFrame, mentions: DataFrame, terms: list[Term]) -> DataFrame:
    """The comment mart from stored human comments and mentions."""
    counts = mentions.groupBy(month_of(F.col("commented_at")).alias("month"), "tool").agg(
        F.count("*").alias("comments_mentioning")
    )
    totals = monthly_counts(humans, "commented_at", "comments_in_month")
    return with_comment_share(dense_grid(totals, terms, counts, "month", ["comments_mentioning"]))


def ai_share_by_flair_month(posts: DataFrame) -> DataFrame:
    """Per month and flair: posts, and those with the focus category in the title."""
    labelled = posts.select(
        month_of(F.col("posted_at")).alias("month"),
        F.coalesce("flair", F.lit(fv.NO_FLAIR)).alias("flair"),
        "mentions_ai_in_title",
    )
    counts = labelled.groupBy("month", "flair").agg(
        F.count("*").alias("posts"), F.count_if("mentions_ai_in_title").alias("ai_posts_in_title")
    )
    return counts.withColumn("ai_title_share_pct", pct(F.col("ai_posts_in_title"), F.col("posts")))


def _measure(df: DataFrame, moment: str, measure: str, in_focus: Column) -> DataFrame:
    counted = df.groupBy(month_of(F.col(moment)).alias("month")).agg(
        F.count_if(in_focus).alias("mentions_ai"), F.count("*").alias("total")
    )
    return counted.select("month", F.lit(measure).alias("measure"), "mentions_ai", "total")


def with_share(both: DataFrame) -> DataFrame:
    return both.withColumn("share_pct", pct(F.col("mentions_ai"), F.col("total")))


def ai_share_by_month(posts: DataFrame, matched_comments: DataFrame, focus: str = fv.FOCUS_CATEGORY) -> DataFrame:
    """Per month: share of post titles, and of human comments, that mention the focus category."""
    titles = _measure(posts, "posted_at", fv.POST_TITLES, F.col("mentions_ai_in_title"))
    comments = _measure(matched_comments, "commented_at", fv.COMMENTS, mentions_category(focus))
    return with_share(titles.unionByName(comments))


def ai_share_by_month_from_facts(
    posts: DataFrame, humans: DataFrame, mentions: DataFrame, focus: str = fv.FOCUS_CATEGORY
) -> DataFrame:
    """The same mart from stored facts: a comment counts if its id is among the focus mentions."""
    flagged = with_membership(humans, "comment_id", mentions.where(F.col("category") == focus), "is_focus")
    titles = _measure(posts, "posted_at", fv.POST_TITLES, F.col("mentions_ai_in_title"))
    return with_share(titles.unionByName(_measure(flagged, "commented_at", fv.COMMENTS, F.col("is_focus"))))


def ai_share_change(by_month: DataFrame, windows: DataFrame) -> DataFrame:
    """Per measure: focus share in the first and the last window, and the change."""
    shares = share_per_window(by_month, windows, ["measure"], "mentions_ai", "total")
    return shares.select("measure", *rounded_change(with_growth=True))


def tool_share_change(
    by_month: DataFrame, comments_by_month: DataFrame, windows: DataFrame, focus: str = fv.FOCUS_CATEGORY
) -> DataFrame:
    """Per tool and measure: share in the first and the last window, and the change."""

    def measured(mart: DataFrame, measure: str, mentions: str, total: str) -> DataFrame:
        return mart.select(
            "month",
            "tool",
            "category",
            F.lit(measure).alias("measure"),
            F.col(mentions).alias("mentions"),
            F.col(total).alias("total"),
        )

    titles = measured(by_month, fv.POST_TITLES, "posts_mentioning_in_title", "posts_in_month")
    comments = measured(comments_by_month, fv.COMMENTS, "comments_mentioning", "comments_in_month")
    shares = share_per_window(
        titles.unionByName(comments), windows, ["tool", "category", "measure"], "mentions", "total"
    )
    return shares.select(
        "tool", "category", (F.col("category") == focus).alias("is_ai"), "measure", *rounded_change()
    )


def ai_share_by_flair_window(by_flair_month: DataFrame, windows: DataFrame) -> DataFrame:
    """Per flair and window: the monthly counts summed, then the share."""
    summed = (
        in_windows(by_flair_month, windows)
        .groupBy("flair", "period")
        .agg(F.sum("posts").alias("posts"), F.sum("ai_posts_in_title").alias("ai_posts_in_title"))
    )
    return summed.withColumn("ai_title_share_pct", pct(F.col("ai_posts_in_title"), F.col("posts")))
