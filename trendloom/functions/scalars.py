"""Scalar expressions used by staging, marts and serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom import fixed_values as fv


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round a double to ``digits`` decimals, ties to the even neighbour.

    ``rint`` of the scaled value, because ``round`` goes half-up and ``bround`` works on the
    decimal text of the double, not on its binary value.
    """
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL when there is nothing to divide by."""
    return part / F.nullif(whole, F.lit(0))


def share(part: Column, whole: Column) -> Column:
    """Unrounded percentage."""
    return ratio(part, whole) * F.lit(100)


def pct(part: Column, whole: Column) -> Column:
    """Percentage with two decimals."""
    return round_half_even(share(part, whole))


def month_of(moment: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(moment, "MM")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a UTC wall-clock timestamp, whatever the session time zone is."""
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01").cast("timestamp_ntz"))


def timestamp_to_epoch(moment: Column) -> Column:
    """Whole epoch seconds of a UTC wall-clock timestamp."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), moment)


def null_if_in(value: Column, sentinels: Sequence[str]) -> Column:
    """The value, or NULL when it is one of the sentinel texts."""
    return F.when(~value.isin(*sentinels), value)


def strip_prefix(typed_id: Column, prefix: str) -> Column:
    """The id behind a typed prefix of known length."""
    return F.substr(typed_id, F.lit(len(prefix) + 1))


def id_if_prefixed(typed_id: Column, prefix: str) -> Column:
    """The id behind the prefix, or NULL when the id is of another type."""
    return F.when(F.startswith(typed_id, F.lit(prefix)), strip_prefix(typed_id, prefix))


def has_prefix(typed_id: Column, prefix: str) -> Column:
    return F.startswith(typed_id, F.lit(prefix))


def pseudonym(account: Column, salt: str) -> Column:
    """Salted SHA-256 in lower-case hex; a deleted account has none."""
    return F.when(account != fv.DELETED_ACCOUNT, F.sha2(F.concat(F.lit(salt), account), 256))


def nested_text(raw: Column, path: str) -> Column:
    """Text at a JSON path; a missing or empty value is NULL."""
    return F.nullif(F.get_json_object(raw, path), F.lit(""))


def post_text(title: Column, body: Column) -> Column:
    """Title and body as one text, so a phrase may run across the two."""
    return F.concat(title, F.lit(" "), F.coalesce(body, F.lit("")))


def month_label(month: Column, run_date: str) -> Column:
    """``Sep 2026``, marked while the month of the run is still going on."""
    text = F.date_format(month, "MMM yyyy")
    running = F.trunc(F.lit(run_date).cast("date"), "MM")
    return F.when(month == running, F.concat(text, F.lit(fv.CURRENT_MONTH_MARK))).otherwise(text)


def group_label(is_focus: Column) -> Column:
    return F.when(is_focus, F.lit(fv.FOCUS_GROUP)).otherwise(F.lit(fv.OTHER_GROUP))


def variant_field(fields: Column, path: str, kind: str = "string") -> Column:
    """A field of a VARIANT by its path, as a type; NULL if it is absent, JSON null, or of another type."""
    return F.try_variant_get(fields, path, kind)
