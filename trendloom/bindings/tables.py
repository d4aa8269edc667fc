"""Roles played by the driver's tables: orders are posts, line items are comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import timestamp_to_epoch
from trendloom.functions.text import Term
from trendloom.operators.versions import latest_by_key
from trendloom.session import configure
from trendloom.sources.spread import spread

# The dictionary over part names, and one over real words in four languages.
PART_TERMS = [
    Term("Widget", "assembly", "widget"),
    Term("Gear", "assembly", "gear|gears"),
    Term("Hot Ring", "assembly", "hot ring"),
    Term("Anvil", "forge", "anvil"),
    Term("Bolt", "forge", "bolt"),
    Term("Sprocket", "forge", "sprocket"),
    Term("Gizmo", "ai", "gizmo|gizmos"),
    Term("Rod", "ai", "rod|rods", "hot rod"),
]
WORD_TERMS = [
    Term("THE", "english", "the|this"),
    Term("OF", "english", "of"),
    Term("ON", "english", "on", "on the"),
    Term("AI", "french", "ai"),
    Term("LA", "french", "la|le"),
    Term("DER", "german", "der|die"),
    Term("IN IS", "english", "in is"),
]
# patterns that are regexes rather than plain phrases, so nothing can be screened beforehand
REGEX_TERMS = [
    Term("THAT", "english", "th[ae]t?"),
    Term("ENDING", "english", r"\w{2,}ing"),
    Term("ACCENT", "french", "é[a-z]+"),
    Term("UN", "french", "une?", "un[a-z]? (la|le)"),
]
# thousands of words: one or two of these syllables
SYLLABLES = (
    "the and ing er on in at ed ly en re ou ti sh wh ea or is it of to ha st nd th an hi es ent ion hes ble tion ere he de la le un ai el os en "
    "ein der die und ich sch ge be ver keit ung er zu que los las ar as ado mente con por para ad ir et est dans"
).split()
SYLLABLES = sorted(set(SYLLABLES))
MANY_TERMS = [Term(a + b, a, a + b) for a in SYLLABLES for b in ["", *SYLLABLES]]
# phrases and regexes together; the last two meet words on two lines
MIXED_TERMS = [
    *WORD_TERMS,
    *REGEX_TERMS,
    Term("OVER LINES", "english", r"[a-z]+\..the"),
    Term("NOT OVER LINES", "english", "the|of", r"the.of"),
]
# over the priorities that stand in for titles of raw posts; two patterns meet title and body
PRIORITY_TERMS = [
    Term("Urgent", "ai", "urgent"),
    Term("High", "level", "high"),
    Term("Low then O", "level", "low o"),
    Term("Medium", "level", "medium|medium p", "medium o"),
]
# late edits: every so manieth post, moved by so many days
EDITED, MOVED_DAYS = 5, 40
FOCUS_TERMS = [t for t in PART_TERMS if t.category == fv.FOCUS_CATEGORY]
SALT = "weathervane"
RUN_DATE = "2001-11-06"

# newest version of a line: the version column, then every other column as a tie-break
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    """A table with costly work per row ahead, shared out over the cores if its scan isn't."""
    return spread(table(spark, folder, name), *keys)


def current_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = spread_table(spark, folder, "lineitem", *LINE_KEYS)
    return latest_by_key(lines, LINE_KEYS, [F.col(c).desc() for c in LINE_ORDER])


def landed_comments(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Line items as landed comments; the part name is the text. ``lines`` are the newest, if stored.

    The posts join drops lines without an order; saying so here too makes the newest lines one
    subplan, which a query over posts and comments then shuffles once.
    """
    lines = current_lines(spark, folder) if lines is None else lines
    lines = lines.where(F.col("l_orderkey").isNotNull())
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    post = F.concat(F.lit(fv.POST_PREFIX), F.col("l_orderkey").cast("string"))
    first_reply = F.concat(F.lit(fv.COMMENT_PREFIX), F.col("l_orderkey").cast("string"), F.lit("-1"))
    return lines.join(parts, "l_partkey").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        post.alias("link_id"),
        F.when(F.col("l_linenumber") == 1, post).otherwise(first_reply).alias("parent_id"),
        F.when(F.col("l_suppkey") == 1, fv.BOT_ACCOUNT)
        .when(F.col("l_suppkey") % 10 == 0, fv.DELETED_ACCOUNT)
        .otherwise(F.col("l_suppkey").cast("string"))
        .alias("author"),
        F.when(F.col("l_returnflag") == "R", "[removed]").otherwise(F.col("p_name")).alias("body"),
        F.col("l_quantity").cast("int").alias("score"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).cast("smallint").alias("controversiality"),
        (F.col("l_linenumber") == 2).alias("is_submitter"),
        F.when(F.col("l_suppkey") == 1, "moderator").alias("distinguished"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7), "deleted").alias("later_removal_type"),
        F.col("l_shipdate").alias("created_utc"),
        (F.col("l_shipdate") + F.expr("interval 30 seconds")).alias("retrieved_on"),
    )


def landed_posts(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Orders as landed posts; first and last line give title and body. ``lines`` are the newest, if stored.

    The lines are brought down to two part keys per order before any name is joined.
    """
    ends = (
        (current_lines(spark, folder) if lines is None else lines)
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.min_by("l_partkey", "l_linenumber").alias("first_part"),
            F.max_by("l_partkey", "l_linenumber").alias("last_part"),
            F.count("*").cast("int").alias("lines"),
        )
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    titles = parts.select(F.col("p_partkey").alias("first_part"), F.col("p_name").alias("title"))
    bodies = parts.select(F.col("p_partkey").alias("last_part"), F.col("p_name").alias("selftext"))
    texts = ends.join(titles, "first_part", "left").join(bodies, "last_part", "left")
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey").cast("string")
    captured = F.col("o_orderstatus") == "F"
    return orders.join(texts, "o_orderkey", "left").select(
        key.alias("id"),
        F.when(F.col("o_custkey") % 10 == 0, fv.DELETED_ACCOUNT)
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("author"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.when(captured, "[removed]").otherwise(F.coalesce("selftext", F.lit(""))).alias("selftext"),
        F.concat(F.lit("https://forum.example/p/"), key).alias("url"),
        F.concat(F.lit("/p/"), key).alias("permalink"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("link_flair_text"),
        F.col("lines").isNotNull().alias("is_self"),
        (F.col("o_orderpriority") == "1-URGENT").alias("over_18"),
        F.floor("o_totalprice").cast("int").alias("score"),
        F.coalesce("lines", F.lit(0)).alias("num_comments"),
        ((F.col("o_custkey") % 4) / 4).cast("float").alias("upvote_ratio"),
        F.when(captured, "moderator").alias("removed_by_category"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 3 == 0), "deleted").alias(
            "later_removal_type"
        ),
        F.col("o_orderdate").alias("created_utc"),
        (F.col("o_orderdate") + F.expr("interval 30 seconds")).alias("retrieved_on"),
    )


def post_json(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as raw JSON objects; NULL fields are absent, so that defaults have work to do."""
    customer = F.col("o_custkey")
    created = timestamp_to_epoch(F.col("o_orderdate"))
    later = F.when(F.col("o_orderstatus") == "P", F.when(customer % 2 == 0, "deleted").otherwise(""))
    return spread_table(spark, folder, "orders").select(
        F.to_json(
            F.struct(
                F.col("o_orderkey").cast("string").alias("id"),
                F.lit("town").alias("subreddit"),
                customer.cast("string").alias("author"),
                F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("title"),
                F.when(F.col("o_orderstatus") == "F", "[removed]").otherwise(F.col("o_orderstatus")).alias("selftext"),
                F.nullif("o_orderpriority", F.lit("5-LOW")).alias("link_flair_text"),
                F.when(customer % 2 == 0, True).alias("is_self"),
                F.when(customer % 3 != 0, F.floor("o_totalprice").cast("int")).alias("score"),
                F.when(customer % 4 != 3, (customer % 4) / 4).alias("upvote_ratio"),
                F.when(F.col("o_orderstatus") == "F", "moderator").alias("removed_by_category"),
                created.alias("created_utc"),
                F.when(customer % 7 != 0, created + 30).alias("retrieved_on"),
                F.struct(later.alias("removal_type")).alias("_meta"),
            )
        ).alias("raw")
    )


def comment_json(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, all versions, as raw JSON objects of comments."""
    order = F.col("l_orderkey").cast("string")
    created = timestamp_to_epoch(F.col("l_shipdate"))
    return spread_table(spark, folder, "lineitem").select(
        F.to_json(
            F.struct(
                F.concat_ws("-", order, F.col("l_linenumber").cast("string")).alias("id"),
                F.concat(F.lit(fv.POST_PREFIX), order).alias("link_id"),
                F.when(F.col("l_linenumber") == 1, F.concat(F.lit(fv.POST_PREFIX), order)).alias("parent_id"),
                F.col("l_suppkey").cast("string").alias("author"),
                F.nullif("l_returnflag", F.lit("R")).alias("body"),
                F.when(F.col("l_linenumber") != 4, F.col("l_quantity").cast("int")).alias("score"),
                F.when(F.col("l_linestatus") == "F", 1).alias("controversiality"),
                F.when(F.col("l_linenumber") == 2, True).alias("is_submitter"),
                F.when(F.col("l_suppkey") == 1, "moderator").alias("distinguished"),
                created.alias("created_utc"),
                F.when(F.col("l_linenumber") != 5, created + 30).alias("retrieved_on"),
            )
        ).alias("raw")
    )


def event_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON objects of posts, with their UTC day."""
    events = spread_table(spark, folder, "events")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "event_id",
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_type").alias("title"),
            F.col("user_id").cast("string").alias("author"),
            F.floor("value").cast("int").alias("score"),
            timestamp_to_epoch(F.col("ts")).alias("created_utc"),
            F.from_json("props", "k int").alias("_meta"),
        ).alias("object"),
    )


def mixed_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON texts of four shapes: other types for one key, empty objects, missing keys."""
    kind, key = F.col("event_id") % 4, F.format_string('{"id": "%d"', "event_id")
    title = F.concat(F.lit(', "title": "'), "event_type", F.lit('"'))
    score = F.concat(F.lit(', "score": '), F.floor("value").cast("string"))
    text = (
        F.when(kind == 0, F.concat(key, title, score, F.lit(', "_meta": {}}')))
        .when(kind == 1, F.concat(key, title, F.lit(', "score": "12", "_meta": {"removal_type": "deleted", "k": 1}}')))
        .when(kind == 2, F.concat(key, F.lit("}")))
        .otherwise(F.concat(key, title, F.lit(', "author": null, "extra": [1, {"a": {}}]}')))
    )
    return spread_table(spark, folder, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", text.alias("raw"))


def mixed_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Those objects as JSON arrays of one day each, split where a day holds very many."""
    chunk = F.floor(F.col("event_id") / ARRAY_LENGTH).alias("chunk")
    arrays = mixed_objects(spark, folder).groupBy("day", chunk).agg(F.concat_ws(",", F.collect_list("raw")).alias("objects"))
    return arrays.select("day", F.concat(F.lit("["), "objects", F.lit("]")).alias("value"))


def verbatim_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON objects with spacing, numbers and escapes that a JSON writer would change."""
    number, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit('{ "id" : "'), number, F.lit('","ratio":0.90, "big": 1E+2,\n "title":"a \\"quoted\\" \\u00e9 [é] {"}')))
        .when(kind == 1, F.concat(F.lit('{"id":"'), number, F.lit('", "tags":[ ], "path":"c:\\\\", "user":'), user, F.lit("}")))
        .otherwise(F.concat(F.lit('{"id":"'), number, F.lit('","inner":{"k":[1.50,{"]":"}"}]}}')))
    )
    return spread_table(spark, folder, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", text.alias("raw"))


# objects per JSON array, which bounds what one group gathers: event ids are unique
ARRAY_LENGTH = 100_000


def event_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """The same objects as JSON arrays of one day each, split where a day holds very many."""
    chunk = F.floor(F.col("event_id") / ARRAY_LENGTH).alias("chunk")
    arrays = event_objects(spark, folder).groupBy("day", chunk).agg(F.collect_list("object").alias("objects"))
    return arrays.select("day", F.to_json("objects").alias("value"))
