"""Month positions, moving comparison windows, and the change between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import month_of, ratio, round_half_even, share


def distinct_months(df: DataFrame, moment: str) -> DataFrame:
    return df.select(month_of(F.col(moment)).alias("month")).distinct()


def month_positions(months: DataFrame) -> DataFrame:
    """Number the months in order, beside their count.

    The windows have no partition: the input is distinct months, twelve a year.
    """
    in_order = Window.orderBy("month")
    everything = Window.partitionBy()
    return months.select(
        "month",
        F.row_number().over(in_order).cast("long").alias("month_number"),
        F.count("*").over(everything).alias("month_count"),
    )


def comparison_windows(months: DataFrame, window_months: int = fv.WINDOW_MONTHS) -> DataFrame:
    """The first and the last ``window_months`` complete months.

    The edge months are partial and left out. With too few months the windows shrink and never
    overlap: the first window wins.
    """
    position = F.col("month_number") - 1
    complete = F.col("month_count") - 2
    return (
        month_positions(months)
        .where((F.col("month_number") > 1) & (F.col("month_number") < F.col("month_count")))
        .where((position <= window_months) | (position > complete - window_months))
        .select("month", F.when(position <= window_months, fv.FIRST).otherwise(fv.LAST).alias("period"))
    )


def in_windows(monthly: DataFrame, windows: DataFrame) -> DataFrame:
    """Months that lie in a window, with its period.

    The hint is safe: windows hold at most twice ``window_months`` rows by construction.
    """
    return monthly.join(F.broadcast(windows), "month")


def sum_if(value: str, period: str) -> Column:
    return F.sum(F.when(F.col("period") == period, F.col(value)))


def share_per_window(monthly: DataFrame, windows: DataFrame, keys: Sequence[str], part: str, whole: str) -> DataFrame:
    """Unrounded first and last share per key, as ratios of sums over each window."""
    return (
        in_windows(monthly, windows)
        .groupBy(*keys)
        .agg(
            share(sum_if(part, fv.FIRST), sum_if(whole, fv.FIRST)).alias("first_share"),
            share(sum_if(part, fv.LAST), sum_if(whole, fv.LAST)).alias("last_share"),
        )
    )


def rounded_change(with_growth: bool = False) -> list[Column]:
    """Shares and their change; the change comes from the unrounded shares and is rounded once."""
    first, last = F.col("first_share"), F.col("last_share")
    columns = [
        round_half_even(first).alias("first_share_pct"),
        round_half_even(last).alias("last_share_pct"),
        round_half_even(last - first).alias("change_pts"),
    ]
    if with_growth:
        columns.append(round_half_even(ratio(last, first)).alias("growth_ratio"))
    return columns
