"""What a dashboard and a digest read: small, ordered, labelled frames over the marts.

Marts hold a row per month or tool, so a global sort or an unpartitioned window here is over
hundreds of rows. Ties are broken by tool or flair, ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import group_label, month_label
from trendloom.operators.joins import in_list


def json_rows(df: DataFrame, name: str = "row") -> DataFrame:
    """Each row as one JSON text; NULL fields are kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def window_labels(windows: DataFrame) -> DataFrame:
    """Per window its first and last month and a label such as ``Feb 1995 – Jul 1995``."""
    bounds = windows.groupBy("period").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))
    label = F.concat(F.date_format("first_month", "MMM yyyy"), F.lit(" – "), F.date_format("last_month", "MMM yyyy"))
    return bounds.withColumn("label", label).orderBy("first_month")


def headline(change: DataFrame) -> DataFrame:
    """Focus share of both measures in the two windows, titles first."""
    return change.orderBy(F.col("measure").desc())


def largest_other_move(tool_change: DataFrame) -> DataFrame:
    """The tool outside the focus category whose share of titles moved most, either way."""
    others = tool_change.where((F.col("measure") == fv.POST_TITLES) & ~F.col("is_ai") & F.col("change_pts").isNotNull())
    return others.select("tool", "change_pts").orderBy(F.abs("change_pts").desc(), "tool").limit(1)


def ai_trend(by_month: DataFrame) -> DataFrame:
    return by_month.select("month", "measure", "mentions_ai", "total", "share_pct").orderBy("month", "measure")


def latest_point_per_measure(by_month: DataFrame) -> DataFrame:
    """The newest month of each measure, where its line is labelled."""
    newest = Window.partitionBy("measure").orderBy(F.col("month").desc())
    return by_month.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").drop("_rank")


def population_totals(by_month: DataFrame) -> DataFrame:
    return by_month.groupBy("measure").agg(F.sum("total").alias("total"))


def tool_changes(tool_change: DataFrame, measure: str) -> DataFrame:
    """All tools by change of share in one measure, with the group they are coloured by."""
    return (
        tool_change.where(F.col("measure") == measure)
        .select(
            "tool",
            "category",
            group_label(F.col("is_ai")).alias("group"),
            "first_share_pct",
            "last_share_pct",
            "change_pts",
        )
        .orderBy(F.col("change_pts").desc(), "tool")
    )


def tool_list(mart: DataFrame) -> DataFrame:
    return mart.select("tool").distinct().orderBy("tool")


def compare_tools(mart: DataFrame, tools: Sequence[str], mentions: str, share: str) -> DataFrame:
    """The monthly lines of up to four chosen tools."""
    if not 1 <= len(tools) <= fv.MAX_PICKED_TOOLS:
        raise ValueError(f"choose one to {fv.MAX_PICKED_TOOLS} tools")
    return in_list(mart, "tool", tools).select("month", "tool", mentions, share).orderBy("month", "tool")


def flair_windows(by_flair_window: DataFrame, windows: DataFrame, flairs: Sequence[str]) -> DataFrame:
    """Chosen flairs in both windows, ranked by their share in the last one."""
    labels = window_labels(windows).select("period", F.col("label").alias("period_label"))
    chosen = in_list(by_flair_window, "flair", flairs).join(F.broadcast(labels), "period")
    last_share = F.max(F.when(F.col("period") == fv.LAST, F.col("ai_title_share_pct"))).over(
        Window.partitionBy("flair")
    )
    ranked = Window.orderBy(F.col("_last_share").desc(), "flair")
    return (
        chosen.withColumn("_last_share", last_share)
        .select(
            "flair",
            "period",
            "period_label",
            F.col("ai_title_share_pct").alias("ai_share_pct"),
            F.dense_rank().over(ranked).alias("flair_rank"),
        )
        .orderBy("flair_rank", "period")
    )


def latest_two_months(by_month: DataFrame, run_date: str) -> DataFrame:
    """Both measures in the two newest months of either; a month without a share shows 0.

    The two measures are laid side by side per month first, so the mart is read once.
    """

    def share_of(measure: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("measure") == measure, F.col("share_pct"))), F.lit(0.0)).alias(measure)

    per_month = by_month.groupBy("month").agg(share_of(fv.POST_TITLES), share_of(fv.COMMENTS))
    newest = per_month.orderBy(F.col("month").desc()).limit(2)
    rows = newest.unpivot("month", [fv.POST_TITLES, fv.COMMENTS], "measure", "share_pct")
    return rows.withColumn("label", month_label(F.col("month"), run_date)).orderBy("measure", "month")


def digest_movers(tool_change: DataFrame, top: int = fv.TOP_MOVERS) -> DataFrame:
    """Three lists by share of titles: focus tools rising, other tools rising, other tools falling.

    With few other tools a tool may be in both of the latter.
    """
    titles = tool_change.where((F.col("measure") == fv.POST_TITLES) & F.col("change_pts").isNotNull())
    rising = Window.partitionBy("is_ai").orderBy(F.col("change_pts").desc(), "tool")
    falling = Window.partitionBy("is_ai").orderBy(F.col("change_pts").asc(), "tool")
    placed = titles.select(
        "tool",
        "is_ai",
        "change_pts",
        F.row_number().over(rising).alias("up"),
        F.row_number().over(falling).alias("down"),
    )

    def entry(wanted: Column, section: str, place: str) -> Column:
        return F.when(
            wanted & (F.col(place) <= top), F.struct(F.lit(section).alias("section"), F.col(place).alias("place"))
        )

    sections = F.array(
        entry(F.col("is_ai"), fv.FOCUS_RISING, "up"),
        entry(~F.col("is_ai"), fv.OTHERS_RISING, "up"),
        entry(~F.col("is_ai"), fv.OTHERS_FALLING, "down"),
    )
    return (
        placed.select(F.explode(F.array_compact(sections)).alias("s"), "tool", "change_pts")
        .select("s.section", "s.place", "tool", "change_pts")
        .orderBy("section", "place")
    )
