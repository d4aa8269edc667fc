"""Typed landing of raw JSON objects, with the raw text kept beside the columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.scalars import epoch_to_timestamp, month_of

# Landed fields. JSON name and type, and what a missing or null value becomes;
# None keeps it NULL. Epoch fields land as timestamps.
POST_FIELDS = [
    ("id", "string", ""),
    ("subreddit", "string", ""),
    ("author", "string", ""),
    ("title", "string", ""),
    ("selftext", "string", ""),
    ("url", "string", ""),
    ("permalink", "string", ""),
    ("link_flair_text", "string", None),
    ("is_self", "boolean", False),
    ("over_18", "boolean", False),
    ("score", "int", 0),
    ("num_comments", "int", 0),
    ("upvote_ratio", "float", 0.0),
    ("removed_by_category", "string", None),
    ("created_utc", "epoch", 0),
    ("retrieved_on", "epoch", 0),
]
COMMENT_FIELDS = [
    ("id", "string", ""),
    ("link_id", "string", ""),
    ("parent_id", "string", ""),
    ("subreddit", "string", ""),
    ("author", "string", ""),
    ("body", "string", ""),
    ("score", "int", 0),
    ("controversiality", "smallint", 0),
    ("is_submitter", "boolean", False),
    ("distinguished", "string", None),
    ("created_utc", "epoch", 0),
    ("retrieved_on", "epoch", 0),
]


def _schema(fields: list[tuple]) -> str:
    columns = [f"{name} {'bigint' if kind == 'epoch' else kind}" for name, kind, _ in fields]
    return ", ".join([*columns, "_meta struct<removal_type: string>"])


def _landed(name: str, kind: str, default: object) -> Column:
    value = F.col(f"_object.{name}")
    if default is not None:
        value = F.coalesce(value, F.lit(default).cast("bigint" if kind == "epoch" else kind))
    return (epoch_to_timestamp(value) if kind == "epoch" else value).alias(name)


def _land(raw: DataFrame, fields: list[tuple], loaded_at: str | None) -> DataFrame:
    # digest and nested key are taken here, so that later steps never read the raw text again
    stamp = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else F.lit(loaded_at).cast("timestamp_ntz")
    return raw.select("raw", F.from_json("raw", _schema(fields)).alias("_object")).select(
        *[_landed(*field) for field in fields],
        F.nullif(F.col("_object._meta.removal_type"), F.lit("")).alias("later_removal_type"),
        "raw",
        F.xxhash64("raw").alias("_digest"),
        F.date_trunc("SECOND", stamp).cast("timestamp_ntz").alias("_loaded_at"),
    )


def land_posts(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Raw posts typed; ``loaded_at`` is the row version, the time of the load if not given."""
    return _land(raw, POST_FIELDS, loaded_at)


def land_comments(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    return _land(raw, COMMENT_FIELDS, loaded_at)


def with_created_month(landed: DataFrame) -> DataFrame:
    """Add the storage partition: the month of creation."""
    return landed.withColumn("created_month", month_of(F.col("created_utc")))


def with_fields(landed: DataFrame) -> DataFrame:
    """Add ``fields``, the raw object as a VARIANT: parsed once, read by path without parsing again.

    It holds the fields that landing doesn't know, too. Null where ``raw`` is no JSON.
    """
    return landed.withColumn("fields", F.try_parse_json("raw"))
