"""Items × dictionary, without a join.

Each item gets an array of the terms it mentions, in one narrow step. Facts are that array
exploded; per-item flags and monthly counts come from the array itself, so they need neither
a join back to the items nor a second scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.text import Searched, Term, check_terms, mention_array


def with_mentions(df: DataFrame, text: Column, terms: Iterable[Term], title: str | None = None) -> DataFrame:
    """Add ``mentions``: the terms the text mentions, with ``is_in_title`` if a title is given."""
    terms = check_terms(terms)
    columns = df.columns
    df = df.withColumn("_text", text).withColumn("_lowered", F.lower("_text"))
    in_title = None
    if title is not None:
        df = df.withColumn("_lowered_title", F.lower(title))
        in_title = Searched(F.col(title), F.col("_lowered_title"))
    found = mention_array(Searched(F.col("_text"), F.col("_lowered")), terms, in_title)
    return df.select(*columns, found.alias("mentions"))


def explode_mentions(df: DataFrame) -> DataFrame:
    """One row per (item, term) with the fields of the mention.

    The outer form plus a filter behind it: a plain explode lets the optimizer push
    ``size(mentions) > 0`` below the match and so evaluate every regex twice.
    """
    columns = [c for c in df.columns if c != "mentions"]
    rows = df.select(*columns, F.explode_outer("mentions").alias("_mention"))
    return rows.where(F.col("_mention").isNotNull()).select(*columns, "_mention.*")


def mentions_category(category: str, only_in_title: bool = False) -> Column:
    """Whether an item mentions any term of the category."""
    if only_in_title:
        return F.exists("mentions", lambda m: (m["category"] == category) & m["is_in_title"])
    return F.exists("mentions", lambda m: m["category"] == category)


def counts_by_term(
    df: DataFrame,
    bucket: Column,
    terms: Iterable[Term],
    total: str,
    counts: dict[str, Column],
) -> DataFrame:
    """Dense (bucket, tool) counts plus the items per bucket, from one pass over the items.

    ``counts`` maps an output name to a condition on the mention, seen as column ``m``. Items
    without a mention stay in as one row, and the first row of each item counts it once. The
    partial aggregate brings a bucket down to one row per term in each task; the dense grid is
    then laid out from the dictionary itself, so a term nobody mentions shows up as 0.
    """
    terms = check_terms(terms)
    rows = df.select(bucket.alias("bucket"), F.posexplode_outer("mentions").alias("pos", "m"))
    per_term = rows.groupBy("bucket", F.col("m.tool").alias("tool")).agg(
        F.count_if(F.coalesce(F.col("pos") == 0, F.lit(True))).alias("items"),
        *[F.count_if(F.col("m").isNotNull() & condition).alias(name) for name, condition in counts.items()],
    )
    # at most one entry per dictionary row and bucket
    per_bucket = per_term.groupBy("bucket").agg(
        F.sum("items").alias(total),
        F.map_from_entries(
            F.collect_list(F.when(F.col("tool").isNotNull(), F.struct("tool", F.struct(*counts))))
        ).alias("found"),
    )
    dictionary = F.array(*[F.struct(F.lit(t.tool).alias("tool"), F.lit(t.category).alias("category")) for t in terms])
    dense = per_bucket.select("bucket", total, "found", F.explode(dictionary).alias("term")).withColumn(
        "hit", F.try_element_at("found", F.col("term.tool"))
    )
    return dense.select(
        "bucket",
        "term.tool",
        "term.category",
        *[F.coalesce(F.col("hit")[name], F.lit(0)).alias(name) for name in counts],
        total,
    )
