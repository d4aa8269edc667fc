"""One query per operator, over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.bindings import tables as t
from trendloom.functions import automaton, scalars
from trendloom.operators import joins, mentions, quality, reconcile, versions, windows
from trendloom.plans import checks, facts, increments, marts, serving, staging
from trendloom.plans import rebuild as builds
from trendloom.session import new_folder
from trendloom.sources import captures, landing, raw_files, tables, terms
from trendloom.streaming.day_files import stream_captures, stream_day_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# days of the events, and two load times; plain parameters of the queries below
FIRST_DAY, LAST_DAY = "2024-01-03", "2024-01-12"
LOAD_1, LOAD_2, LOAD_3 = "2024-03-01 02:00:00", "2024-03-02 02:00:00", "2024-03-03 02:00:00"
NOW = "2001-11-06 00:00:00"
PICKED_FLAIRS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
PICKED_TOOLS = ["Gizmo", "Gear", "Anvil", "Sprocket"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- versions, slices, storage ------------------------------------------------------


@query
def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return t.current_lines(spark, folder)


@query
def dedup_last_in_batch(spark: SparkSession, folder: str) -> DataFrame:
    events = t.table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    return versions.dedup_last(events, "user_id", "event_id")


@query
def idempotent_reload(spark: SparkSession, folder: str) -> DataFrame:
    """The same load appended twice under two stamps reads back as one."""
    path = new_folder(spark, "posts")
    raw = t.post_json(spark, folder)
    for stamp in (LOAD_1, LOAD_2):
        tables.append_raw(landing.land_posts(raw, stamp), path, gather_months=True)
    current = tables.current_state(tables.read_versions(spark, path))
    return current.select("id", "title", "score", "created_utc", "created_month", F.col("_loaded_at").alias("loaded_at"))


@query
def month_partition_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "months")
    orders = t.table(spark, folder, "orders").withColumnRenamed("o_orderdate", "created_utc")
    tables.append_raw(orders, path, gather_months=True)
    return tables.read_versions(spark, path).select("o_orderkey", "created_utc", "created_month")


@query
def day_range_slice(spark: SparkSession, folder: str) -> DataFrame:
    events = t.table(spark, folder, "events").select("event_id", "ts", "event_type")
    return raw_files.slice_days(events, "ts", FIRST_DAY, LAST_DAY)


def _day_rows(spark: SparkSession, folder: str) -> DataFrame:
    objects = t.event_objects(spark, folder)
    return objects.select("day", F.to_json("object").alias("raw"))


def _read_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    rows = raw_files.scan_lines(spark, path, start, end)
    parsed = F.from_json("raw", "id STRING, title STRING")
    return rows.select("day", parsed.alias("o")).select("day", F.col("o.id").alias("id"), F.col("o.title").alias("title"))


@query
def day_slice_write(spark: SparkSession, folder: str) -> DataFrame:
    """A second, changed write is skipped: every day has its slice."""
    path = new_folder(spark, "days")
    rows = _day_rows(spark, folder)
    tables.write_day_slices(rows, path)
    tables.write_day_slices(rows.withColumn("raw", F.upper("raw")), path)
    return _read_days(spark, path)


@query
def day_slice_force(spark: SparkSession, folder: str) -> DataFrame:
    """A forced write replaces the days it holds and leaves the others."""
    path = new_folder(spark, "days")
    rows = _day_rows(spark, folder)
    tables.write_day_slices(rows, path)
    again = rows.where(raw_files.in_day_range(F.col("day"), FIRST_DAY, LAST_DAY))
    tables.write_day_slices(again.withColumn("raw", F.regexp_replace("raw", '"title":"', '"title":"again ')), path, True)
    return _read_days(spark, path)


@query
def day_slice_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A range of days read back from its slices."""
    path = new_folder(spark, "days")
    tables.write_day_slices(_day_rows(spark, folder), path)
    return _read_days(spark, path, FIRST_DAY, LAST_DAY)


def _streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Day files landed by a stream in two runs, the second with a changed capture of all days."""
    source, table, checkpoint = (new_folder(spark, n) for n in ("incoming", "streamed", "progress"))
    arrays = t.event_arrays(spark, folder)
    tables.write_json_arrays(arrays, f"{source}/first")
    changed = arrays.withColumn("value", F.regexp_replace("value", '"title":"', '"title":"again '))
    for name, batch, stamp in (("first", None, LOAD_1), ("second", changed, LOAD_2)):
        if batch is not None:
            tables.write_json_arrays(batch, f"{source}/{name}")
        run = stream_day_files(
            spark, source, table, checkpoint, lambda raw, s=stamp: landing.land_posts(raw, s), pattern="*.txt"
        )
        run.awaitTermination()
    current = tables.current_state(tables.read_versions(spark, table))
    return current.select("id", "title", "author", "score", "created_utc")


QUERIES["stream_day_files"] = _streamed


@query
def stream_recaptured_day(spark: SparkSession, folder: str) -> DataFrame:
    """Day files landed by a stream in three runs: as captured, after some days were captured again
    under their names, and with nothing changed, which lands nothing.

    Rows are counted with all their versions, and titles are those of the newest.
    """
    source, table, checkpoint = (new_folder(spark, n) for n in ("incoming", "streamed", "progress"))
    rows = t.event_objects(spark, folder).select("day", "event_id", F.to_json("object").alias("raw"))
    again = rows.where(raw_files.in_day_range(F.col("day"), FIRST_DAY, LAST_DAY))
    again = again.withColumn("raw", F.regexp_replace("raw", '"title":"', '"title":"again '))
    for stamp, captured in ((LOAD_1, rows), (LOAD_2, again), (LOAD_3, None)):
        if captured is not None:
            captures.write_captures(captured, source, True, "event_id")
        stream_captures(spark, source, table, checkpoint, lambda raw, s=stamp: landing.land_posts(raw, s)).awaitTermination()
    versions = tables.read_versions(spark, table)
    counted = versions.groupBy("id").agg(F.count("*").alias("versions"))
    return tables.current_state(versions).join(counted, "id").select("id", "title", "author", "score", "created_utc", "versions")


# --- JSON and scalars ---------------------------------------------------------------


@query
def seed_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Part names as a dictionary CSV, written and read back; blank exclusions become NULL."""
    path = new_folder(spark, "terms")
    parts = t.table(spark, folder, "part")
    blank = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("hot "), F.col("p_name"))).otherwise(F.lit(""))
    parts.select(
        F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("tool"),
        F.col("p_type").alias("category"),
        F.concat_ws("|", "p_name", F.lower("p_brand")).alias("pattern"),
        blank.alias("exclude_pattern"),
    ).write.option("header", True).csv(path)
    return terms.read_terms(spark, path)


@query
def json_array_explode(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_files.explode_json_array(t.event_arrays(spark, folder), "value")
    return raw.select(
        "day",
        F.get_json_object("raw", "$.id").alias("id"),
        F.get_json_object("raw", "$.title").alias("title"),
        F.get_json_object("raw", "$._meta.k").alias("k"),
    )


@query
def json_array_files(spark: SparkSession, folder: str) -> DataFrame:
    """JSON arrays written as files and scanned back, one object per row."""
    path = new_folder(spark, "arrays")
    tables.write_json_arrays(t.event_arrays(spark, folder), path)
    files = spark.read.option("wholetext", True).text(path).select(F.col("day").cast("string").alias("day"), "value")
    raw = raw_files.explode_json_array(files, "value")
    return raw.select("day", F.get_json_object("raw", "$.id").alias("id"), F.get_json_object("raw", "$.title").alias("title"))


def _scanned(spark: SparkSession, folder: str, *days: str) -> DataFrame:
    """Day files of objects with mixed types, empty objects and missing keys, scanned and landed."""
    path = new_folder(spark, "day-files")
    tables.write_json_arrays(t.mixed_arrays(spark, folder), path)
    raw = raw_files.scan_raw(spark, path, *days, pattern="*.txt")
    fields = [F.get_json_object("raw", f"$.{name}").alias(f"raw_{name}") for name in ("score", "_meta", "extra")]
    landed = landing.land_posts(raw, LOAD_1).select("id", "title", "author", "score", "later_removal_type", *fields)
    return landed


@query
def scan_raw_all(spark: SparkSession, folder: str) -> DataFrame:
    return _scanned(spark, folder)


@query
def scan_raw_days(spark: SparkSession, folder: str) -> DataFrame:
    return _scanned(spark, folder, FIRST_DAY, LAST_DAY)


@query
def scan_raw_verbatim(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of day files, byte for byte as they were captured, in their places."""
    path = new_folder(spark, "day-files")
    captures.write_captures(t.verbatim_objects(spark, folder), path, order="event_id")
    return captures.scan_captured(spark, path, FIRST_DAY, LAST_DAY).select("day", "place", "raw")


@query
def listing_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Events in folders by day, against a copy that lacks a type; the base path stands below itself again."""
    base = new_folder(spark, "listing")
    again = f"{base}/source{base.split(':', 1)[-1]}/source"
    events = t.table(spark, folder, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").cast("string"))
    for name, rows in ((again, events), (f"{base}/target", events.where("event_type <> 'click'"))):
        rows.hint("rebalance", "event_type", "day").write.partitionBy("event_type", "day").text(name)

    inner = F.startswith("key", F.lit(again.removeprefix(f"{base}/source/") + "/event_type="))

    def folders(files: DataFrame) -> DataFrame:
        """Part files have a new name in each write, and a large folder has several: a folder stands for its files."""
        by_folder = files.groupBy(F.regexp_extract("key", "(event_type=.*)/", 1).alias("key"))
        return by_folder.agg(F.sum("size").alias("size"), F.bool_and(inner).alias("below_itself"))

    source = folders(reconcile.list_files(spark, f"{base}/source", "*.txt"))
    target = folders(reconcile.list_files(spark, f"{base}/target", "*.txt"))
    return reconcile.manifest_diff(source, target).join(source.select("key", "below_itself"), "key").select("key", "action", "below_itself")


@query
def land_json_defaults(spark: SparkSession, folder: str) -> DataFrame:
    landed = landing.land_posts(t.post_json(spark, folder), LOAD_1)
    kept = F.get_json_object("raw", "$.id").alias("id_in_raw")
    return landed.select(
        *[c for c in landed.columns if c not in ("raw", "_digest", "_loaded_at")],
        kept,
        F.col("_loaded_at").alias("loaded_at"),
    )


@query
def land_comments_defaults(spark: SparkSession, folder: str) -> DataFrame:
    landed = landing.land_comments(t.comment_json(spark, folder), LOAD_1)
    return landed.select(
        *[c for c in landed.columns if c not in ("raw", "_digest", "_loaded_at")],
        F.get_json_object("raw", "$.id").alias("id_in_raw"),
    )


@query
def json_nested_field(spark: SparkSession, folder: str) -> DataFrame:
    raw = t.post_json(spark, folder)
    return raw.select(
        F.get_json_object("raw", "$.id").alias("id"),
        scalars.nested_text(F.col("raw"), "$._meta.removal_type").alias("later_removal_type"),
    )


@query
def variant_field(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that landing didn't know, read from a stored table without its raw text."""
    path = new_folder(spark, "variants")
    raw = t.mixed_objects(spark, folder).select("raw")
    tables.append_raw(landing.with_fields(landing.land_posts(raw, LOAD_1)), path)
    fields = F.col("fields")
    return tables.read_versions(spark, path).select(
        "id",
        scalars.variant_field(fields, "$.score").alias("score"),
        scalars.variant_field(fields, "$._meta.k", "int").alias("k"),
        scalars.variant_field(fields, "$.extra[0]", "bigint").alias("first_extra"),
        scalars.variant_field(fields, "$.title", "int").alias("title_as_number"),
    )


@query
def epoch_to_ts(spark: SparkSession, folder: str) -> DataFrame:
    events = t.table(spark, folder, "events")
    seconds = scalars.timestamp_to_epoch(F.col("ts"))
    return events.select("event_id", seconds.alias("seconds")).withColumn(
        "moment", scalars.epoch_to_timestamp(F.col("seconds"))
    )


@query
def prefixed_ids(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.table(spark, folder, "lineitem")
    order = F.col("l_orderkey").cast("string")
    parent = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("t3_"), order)).otherwise(F.concat(F.lit("t1_c"), order))
    ids = lines.select(F.concat(F.lit("t3_"), order).alias("link_id"), parent.alias("parent_id"))
    return ids.select(
        scalars.strip_prefix(F.col("link_id"), fv.POST_PREFIX).alias("post_id"),
        scalars.id_if_prefixed(F.col("parent_id"), fv.COMMENT_PREFIX).alias("parent_comment_id"),
        scalars.has_prefix(F.col("parent_id"), fv.POST_PREFIX).alias("is_top_level"),
    )


@query
def pseudonymise(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id")
    account = F.when(user % 10 == 0, fv.DELETED_ACCOUNT).otherwise(user.cast("string"))
    events = t.table(spark, folder, "events")
    return events.select("event_id", scalars.pseudonym(account, t.SALT).alias("author_id"))


@query
def json_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = t.table(spark, folder, "events").select("event_id", "event_type", "user_id", "props")
    rows = serving.json_rows(events)
    return rows.select(
        *[F.get_json_object("row", f"$.{c}").alias(c) for c in ("event_id", "event_type", "user_id", "props")]
    )


def _manifests(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    documents = t.table(spark, folder, "documents").select("doc_id", F.col("n_chars").alias("size"))
    key = F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("key")
    labels = t.table(spark, folder, "labels").select("doc_id", "toxic")
    copied = documents.join(labels, "doc_id").select(key, (F.col("size") + F.col("toxic")).alias("size"))
    return documents.select(key, "size"), copied


@query
def manifest_diff(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.manifest_diff(*_manifests(spark, folder))


@query
def manifest_diff_back(spark: SparkSession, folder: str) -> DataFrame:
    """The other direction, summed up."""
    source, target = _manifests(spark, folder)
    return reconcile.diff_counts(reconcile.manifest_diff(target, source))


# --- staging ------------------------------------------------------------------------


def _posts(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    return staging.clean_posts(t.landed_posts(spark, folder, lines), t.SALT)


def _comments(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    return staging.clean_comments(t.landed_comments(spark, folder, lines), t.SALT)


def _stored_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The newest lines, found once for posts and comments that are written by jobs of their own."""
    return tables.overwrite_table(t.current_lines(spark, folder), new_folder(spark, "lines"))


@query
def stg_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _posts(spark, folder)


@query
def stg_comments(spark: SparkSession, folder: str) -> DataFrame:
    return _comments(spark, folder)


@query
def removal_flags(spark: SparkSession, folder: str) -> DataFrame:
    flags = ["post_id", "removal_reason", "is_removed_at_capture", "later_removal_type", "is_removed_later"]
    return _posts(spark, folder).select(*flags)


@query
def human_comments(spark: SparkSession, folder: str) -> DataFrame:
    return staging.human_comments(_comments(spark, folder)).select("comment_id", "post_id", "body", "commented_at")


@query
def post_text(spark: SparkSession, folder: str) -> DataFrame:
    text = scalars.post_text(F.col("title"), F.col("body"))
    return _posts(spark, folder).select(
        "post_id", F.lower("title").alias("title_text"), F.lower(text).alias("post_text")
    )


# --- dictionary matching and facts --------------------------------------------------


def _document_mentions(spark: SparkSession, folder: str, dictionary: list) -> DataFrame:
    documents = t.spread_table(spark, folder, "documents").select("doc_id", "lang", "text")
    found = mentions.with_mentions(documents, F.col("text"), dictionary).select("doc_id", "lang", "mentions")
    return mentions.explode_mentions(found)


@query
def text_mentions(spark: SparkSession, folder: str) -> DataFrame:
    return _document_mentions(spark, folder, t.WORD_TERMS)


@query
def text_mentions_regex(spark: SparkSession, folder: str) -> DataFrame:
    return _document_mentions(spark, folder, t.REGEX_TERMS)


@query
def text_mentions_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases and regexes in one dictionary, some across line breaks."""
    return _document_mentions(spark, folder, t.MIXED_TERMS)


@query
def text_mentions_large(spark: SparkSession, folder: str) -> DataFrame:
    """A dictionary of thousands of words."""
    documents = t.spread_table(spark, folder, "documents").select("doc_id", "lang", "text")
    found = automaton.with_mentions_of_many(documents, F.col("text"), t.MANY_TERMS)
    return mentions.explode_mentions(found.select("doc_id", "lang", "mentions"))


@query
def text_mentions_tools(spark: SparkSession, folder: str) -> DataFrame:
    """The shipped dictionary over documents and conversations."""
    documents = t.spread_table(spark, folder, "documents")
    documents = documents.select(F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("item_id"), "text")
    place = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    turns = t.spread_table(spark, folder, "conversations").select(F.concat(F.lit("turn "), place).alias("item_id"), "text")
    found = mentions.with_mentions(documents.unionByName(turns), F.col("text"), terms.shipped_terms())
    return mentions.explode_mentions(found.select("item_id", "mentions"))


def _matched_posts(spark: SparkSession, folder: str, dictionary: list = t.PART_TERMS) -> DataFrame:
    return facts.match_posts(_posts(spark, folder), dictionary)


def _matched_comments(spark: SparkSession, folder: str, dictionary: list = t.PART_TERMS) -> DataFrame:
    return facts.match_comments(_comments(spark, folder), dictionary)


@query
def post_tool_mentions(spark: SparkSession, folder: str) -> DataFrame:
    return facts.post_tool_mentions(_matched_posts(spark, folder))


@query
def comment_tool_mentions(spark: SparkSession, folder: str) -> DataFrame:
    return facts.comment_tool_mentions(_matched_comments(spark, folder))


@query
def posts_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.posts_fact(_matched_posts(spark, folder))


@query
def posts_fact_from_mentions(spark: SparkSession, folder: str) -> DataFrame:
    stored = tables.overwrite_table(_matched_posts(spark, folder), new_folder(spark, "matched"))
    return facts.posts_fact_from_mentions(stored, facts.post_tool_mentions(stored))


@query
def mentions_from_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Raw posts loaded twice, then with changed titles: matched first, resolved afterwards."""
    path = new_folder(spark, "posts")
    raw = t.post_json(spark, folder)
    changed = raw.withColumn("raw", F.regexp_replace("raw", "2-HIGH", "1-URGENT"))
    for stamp, load in ((LOAD_1, raw), (LOAD_2, changed)):
        tables.append_raw(landing.land_posts(load, stamp), path, gather_months=True)
    matched = facts.match_post_versions(tables.read_versions(spark, path), t.PRIORITY_TERMS)
    return marts.tool_mentions_by_month(matched, t.PRIORITY_TERMS)


@query
def mentions_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The same versions in four loads, each matched as it comes in: two of an equal stamp, then two
    of an earlier one, the last in a table of its own."""
    path, second, matched_folder = (new_folder(spark, n) for n in ("posts", "late", "matched"))
    raw = t.post_json(spark, folder)
    changed = raw.withColumn("raw", F.regexp_replace("raw", "2-HIGH", "1-URGENT"))
    even = F.get_json_object("raw", "$.id").cast("long") % 2 == 0
    loads = [(LOAD_2, changed.where(even), path), (LOAD_2, changed.where(~even), path), (LOAD_1, raw.where(even), path), (LOAD_1, raw.where(~even), second)]
    matched = increments.MatchedStore(spark, matched_folder, t.PRIORITY_TERMS)
    written: list[str] = []
    for stamp, load, to in loads:
        tables.append_raw(landing.land_posts(load, stamp), to, gather_months=True)
        written = list(dict.fromkeys([*written, to]))
        matched.update(tables.read_versions(spark, *written), facts.match_each_post)
    return marts.tool_mentions_by_month(facts.newest_posts(matched.versions()), t.PRIORITY_TERMS)


def _edited_counts(spark: SparkSession, folder: str) -> increments.CountStore:
    """Posts in three loads, counted after each: half of them, all, and late edits of a fifth, which
    move a post by forty days and take the urgent ones their mention."""
    path, matched_folder, counts_folder = (new_folder(spark, n) for n in ("posts", "matched", "counts"))
    raw = t.post_json(spark, folder)
    number = F.get_json_object("raw", "$.id").cast("long")
    created = F.get_json_object("raw", "$.created_utc").cast("long")
    moved = F.regexp_replace("raw", F.concat(F.lit('"created_utc":'), created), F.concat(F.lit('"created_utc":'), created + t.MOVED_DAYS * 86400))
    edited = raw.where(number % t.EDITED == 0).withColumn("raw", F.replace(moved, F.lit('"title":"1-URGENT"'), F.lit('"title":"5-LOW"')))
    matched = increments.MatchedStore(spark, matched_folder, t.PRIORITY_TERMS)
    counts = increments.CountStore(spark, counts_folder, t.PRIORITY_TERMS)
    for stamp, load in ((LOAD_1, raw.where(number % 2 == 0)), (LOAD_1, raw.where(number % 2 == 1)), (LOAD_2, edited)):
        tables.append_raw(landing.land_posts(load, stamp), path, gather_months=True)
        matched.update(tables.read_versions(spark, path), facts.match_each_post)
        counts.update(increments.POSTS, matched)
    return counts


@query
def marts_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _edited_counts(spark, folder).tool_mentions_by_month()


@query
def flair_mart_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _edited_counts(spark, folder).ai_share_by_flair_month()


# --- marts --------------------------------------------------------------------------


@query
def monthly_counts(spark: SparkSession, folder: str) -> DataFrame:
    return marts.monthly_counts(t.table(spark, folder, "orders"), "o_orderdate")


@query
def distinct_months(spark: SparkSession, folder: str) -> DataFrame:
    return windows.distinct_months(t.table(spark, folder, "lineitem"), "l_shipdate")


def _months(spark: SparkSession, folder: str) -> DataFrame:
    """Months of the posts; the order date is the time of the post."""
    return windows.distinct_months(t.table(spark, folder, "orders"), "o_orderdate")


@query
def month_positions(spark: SparkSession, folder: str) -> DataFrame:
    return windows.month_positions(_months(spark, folder))


@query
def comparison_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows.comparison_windows(_months(spark, folder))


@query
def tool_mentions_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.tool_mentions_by_month(_matched_posts(spark, folder), t.PART_TERMS)


@query
def comment_tool_mentions_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.comment_tool_mentions_by_month(_matched_comments(spark, folder), t.PART_TERMS)


@query
def tool_mentions_by_month_from_facts(spark: SparkSession, folder: str) -> DataFrame:
    """From stored facts: dense grid and left join."""
    stored = tables.overwrite_table(_matched_posts(spark, folder), new_folder(spark, "matched"))
    return marts.tool_mentions_by_month_from_facts(stored, facts.post_tool_mentions(stored), t.PART_TERMS)


@query
def comment_tool_mentions_by_month_from_facts(spark: SparkSession, folder: str) -> DataFrame:
    stored = tables.overwrite_table(_matched_comments(spark, folder), new_folder(spark, "matched"))
    return marts.comment_tool_mentions_by_month_from_facts(stored, facts.comment_tool_mentions(stored), t.PART_TERMS)


def _focus_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts fact for the marts that ask about the focus category only."""
    return facts.posts_fact(_matched_posts(spark, folder, t.FOCUS_TERMS))


@query
def ai_share_by_flair_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.ai_share_by_flair_month(_focus_posts(spark, folder))


@query
def ai_share_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.ai_share_by_month(_focus_posts(spark, folder), _matched_comments(spark, folder, t.FOCUS_TERMS))


@query
def ai_share_by_month_from_facts(spark: SparkSession, folder: str) -> DataFrame:
    """From stored facts: a comment counts if its id is among the focus mentions."""
    stored = tables.overwrite_table(_matched_comments(spark, folder), new_folder(spark, "matched"))
    return marts.ai_share_by_month_from_facts(
        _focus_posts(spark, folder), stored.drop("mentions"), facts.comment_tool_mentions(stored)
    )


@query
def ai_share_change(spark: SparkSession, folder: str) -> DataFrame:
    return marts.ai_share_change(ai_share_by_month(spark, folder), comparison_windows(spark, folder))


@query
def tool_share_change(spark: SparkSession, folder: str) -> DataFrame:
    return marts.tool_share_change(
        tool_mentions_by_month(spark, folder),
        comment_tool_mentions_by_month(spark, folder),
        comparison_windows(spark, folder),
    )


@query
def ai_share_by_flair_window(spark: SparkSession, folder: str) -> DataFrame:
    return marts.ai_share_by_flair_window(ai_share_by_flair_month(spark, folder), comparison_windows(spark, folder))


# --- serving ------------------------------------------------------------------------


@query
def window_labels(spark: SparkSession, folder: str) -> DataFrame:
    return serving.window_labels(comparison_windows(spark, folder))


@query
def serve_headline(spark: SparkSession, folder: str) -> DataFrame:
    return serving.headline(ai_share_change(spark, folder))


@query
def largest_other_move(spark: SparkSession, folder: str) -> DataFrame:
    return serving.largest_other_move(tool_share_change(spark, folder))


@query
def serve_ai_trend(spark: SparkSession, folder: str) -> DataFrame:
    return serving.ai_trend(ai_share_by_month(spark, folder))


@query
def serve_tool_changes(spark: SparkSession, folder: str) -> DataFrame:
    return serving.tool_changes(tool_share_change(spark, folder), fv.POST_TITLES)


@query
def serve_tool_list(spark: SparkSession, folder: str) -> DataFrame:
    return serving.tool_list(tool_mentions_by_month(spark, folder))


@query
def serve_flair_windows(spark: SparkSession, folder: str) -> DataFrame:
    return serving.flair_windows(
        ai_share_by_flair_window(spark, folder), comparison_windows(spark, folder), PICKED_FLAIRS
    )


@query
def serve_compare_tools(spark: SparkSession, folder: str) -> DataFrame:
    mart = tool_mentions_by_month(spark, folder)
    return serving.compare_tools(mart, PICKED_TOOLS, "posts_mentioning_in_title", "title_share_pct")


@query
def serve_compare_tools_comments(spark: SparkSession, folder: str) -> DataFrame:
    mart = comment_tool_mentions_by_month(spark, folder)
    return serving.compare_tools(mart, PICKED_TOOLS, "comments_mentioning", "share_pct")


@query
def population_totals(spark: SparkSession, folder: str) -> DataFrame:
    return serving.population_totals(ai_share_by_month(spark, folder))


@query
def latest_point_per_measure(spark: SparkSession, folder: str) -> DataFrame:
    return serving.latest_point_per_measure(ai_share_by_month(spark, folder))


@query
def latest_two_months(spark: SparkSession, folder: str) -> DataFrame:
    return serving.latest_two_months(ai_share_by_month(spark, folder), t.RUN_DATE)


@query
def digest_movers(spark: SparkSession, folder: str) -> DataFrame:
    return serving.digest_movers(tool_share_change(spark, folder))


# --- data quality -------------------------------------------------------------------


@query
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_null(_posts(spark, folder), "post_id", ["posted_at", "body", "flair", "later_removal_type"])


@query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique(t.table(spark, folder, "lineitem"), "l_orderkey")


@query
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.accepted_values(t.table(spark, folder, "orders"), "o_orderstatus", ["O", "F"])


@query
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return joins.orphans(t.table(spark, folder, "documents"), "doc_id", t.table(spark, folder, "labels"), "doc_id")


@query
def dq_grain_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.grain_unique(t.table(spark, folder, "lineitem"), t.LINE_KEYS)


@query
def dq_window_size(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of six months against a limit of five."""
    return quality.window_size(comparison_windows(spark, folder), 5)


@query
def dq_title_within_total(spark: SparkSession, folder: str) -> DataFrame:
    """Turned around, so that every month whose body adds a mention is reported."""
    mart = tool_mentions_by_month(spark, folder)
    return quality.exceeds(mart, "posts_mentioning", "posts_mentioning_in_title", ["month", "tool"])


@query
def dq_pct_range(spark: SparkSession, folder: str) -> DataFrame:
    """Shares shifted by ten points, which pushes the smallest below 0."""
    shifted = {c: F.col(c) - 10 for c in ("first_share_pct", "last_share_pct")}
    return checks.share_violations(
        ai_share_change(spark, folder).withColumns(shifted), tool_share_change(spark, folder).withColumns(shifted)
    )


@query
def dq_null_implies_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Posts without text that were not removed at capture."""
    return quality.null_without_flag(_posts(spark, folder), "post_id", "body", "is_removed_at_capture")


@query
def dq_expected_terms_found(spark: SparkSession, folder: str) -> DataFrame:
    expected = ["Hot Ring", "Sprocket", "Gizmo", "Flywheel"]
    return joins.never_found(comment_tool_mentions(spark, folder), "tool", expected)


@query
def dq_no_author_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of staging that would expose an author, by model; of the stored marts there are none."""
    models = {"stg_posts": _posts(spark, folder), "stg_comments": _comments(spark, folder), **_stored_models(spark, folder)}
    # a row for each such column, from the schemas alone
    found = F.array(*[F.struct(F.lit(name).alias("model"), F.lit(c).alias("column")) for name, df in models.items() for c in quality.author_columns(df)])
    return t.table(spark, folder, "region").limit(1).select(F.explode(found).alias("c")).select("c.*")


@query
def freshness_gate(spark: SparkSession, folder: str) -> DataFrame:
    sources = [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]
    reports = [quality.freshness(t.table(spark, folder, name), column, name, NOW) for name, column in sources]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


# --- the whole chain ----------------------------------------------------------------


def _stored_models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lines = _stored_lines(spark, folder)
    posts = facts.match_posts(_posts(spark, folder, lines), t.PART_TERMS)
    comments = facts.match_comments(_comments(spark, folder, lines), t.PART_TERMS)
    return builds.store_models(posts, comments, t.PART_TERMS, new_folder(spark, "models"))


@query
def mart_chain(spark: SparkSession, folder: str) -> DataFrame:
    """All facts and marts stored in dependency order; rows and sums over the content of each."""
    return builds.contents(_stored_models(spark, folder))


@query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """All data tests over the stored models; those on single rows are counted as the models are written."""
    row_counts: checks.RowCounts = {}
    lines = _stored_lines(spark, folder)
    path = new_folder(spark, "models")
    staged = builds.store_staging(_posts(spark, folder, lines), _comments(spark, folder, lines), t.PART_TERMS, path, row_counts)
    models = {
        **staged,
        "tools": terms.term_frame(spark, t.PART_TERMS),
        **builds.store_models(*facts.matched_of(staged), t.PART_TERMS, path, row_counts=row_counts),
    }
    return builds.tested(models, new_folder(spark, "tested"), row_counts, expected_terms=["Hot Ring", "Sprocket"])
