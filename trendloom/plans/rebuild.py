"""The rebuild: freshness gate, matched items, facts, marts, and the build that readers see.

A build is written to a folder of its own, tested, and only then published: one row appended to
the ``published`` table. Readers open the build of the last row, so they see all of it or none.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.text import Term, check_terms, dictionary_key
from trendloom.operators.quality import freshness, require_fresh
from trendloom.operators.windows import comparison_windows, distinct_months
from trendloom.plans import checks, facts, marts
from trendloom.plans.increments import COMMENTS, POSTS, CountStore, MatchedStore
from trendloom.plans.staging import clean_comments, clean_posts
from trendloom.sources.tables import current_state, load_if_present, overwrite_table
from trendloom.sources.terms import term_frame


def store_tables(tables: dict[str, DataFrame], folder: str, row_counts: checks.RowCounts | None = None, prefix: str = "") -> dict[str, DataFrame]:
    """Store independent tables side by side, so that small ones do not wait for each other.

    With ``row_counts`` the failures of the data tests on single rows are counted in the same jobs.
    """

    def store(name: str) -> DataFrame:
        df, seen = checks.watched(name, tables[name]) if row_counts is not None else (tables[name], None)
        stored = overwrite_table(df, f"{folder}/{prefix}{name}")
        if seen is not None:
            row_counts[name] = checks.counts_of(name, seen)
        return stored

    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(zip(tables, pool.map(store, tables), strict=True))


def store_staging(
    posts: DataFrame, comments: DataFrame, terms: Iterable[Term], folder: str, row_counts: checks.RowCounts | None = None
) -> dict[str, DataFrame]:
    """Store staged posts and comments with their mentions, so that facts and data tests share one pass over the text.

    ``facts.matched_of`` gives what ``store_models`` takes.
    """
    terms = check_terms(terms)
    staged = {"stg_posts": facts.match_posts(posts, terms), "stg_comments": facts.match_staged_comments(comments, terms)}
    return store_tables(staged, folder, row_counts)


def store_models(
    matched_posts: DataFrame,
    matched_comments: DataFrame,
    terms: Iterable[Term],
    folder: str,
    window_months: int = fv.WINDOW_MONTHS,
    focus: str = fv.FOCUS_CATEGORY,
    monthly: dict[str, DataFrame] | None = None,
    row_counts: checks.RowCounts | None = None,
) -> dict[str, DataFrame]:
    """Store matched items, then facts and monthly marts, then the change marts.

    The matched items are the only tables computed from text. Facts and marts are narrow scans
    over them, and everything from the monthly marts on is small. ``monthly`` are monthly marts that
    are kept up to date elsewhere.
    """
    terms = check_terms(terms)
    matched = store_tables({"matched_posts": matched_posts, "matched_comments": matched_comments}, folder)
    posts, comments = matched["matched_posts"], matched["matched_comments"]
    fact = facts.posts_fact(posts, focus)
    models = store_tables(
        {
            "fct_post_tool_mentions": facts.post_tool_mentions(posts),
            "fct_comment_tool_mentions": facts.comment_tool_mentions(comments),
            "fct_posts": fact,
            "dim_comparison_windows": comparison_windows(distinct_months(posts, "posted_at"), window_months),
            "mart_tool_mentions_by_month": marts.tool_mentions_by_month(posts, terms),
            "mart_comment_tool_mentions_by_month": marts.comment_tool_mentions_by_month(comments, terms),
            "mart_ai_share_by_flair_month": marts.ai_share_by_flair_month(fact),
            "mart_ai_share_by_month": marts.ai_share_by_month(fact, comments, focus),
        }
        | (monthly or {}),
        folder,
        row_counts,
    )
    windows = models["dim_comparison_windows"]
    by_tool = models["mart_tool_mentions_by_month"]
    by_comment_tool = models["mart_comment_tool_mentions_by_month"]
    changes = {
        "mart_ai_share_change": marts.ai_share_change(models["mart_ai_share_by_month"], windows),
        "mart_tool_share_change": marts.tool_share_change(by_tool, by_comment_tool, windows, focus),
        "mart_ai_share_by_flair_window": marts.ai_share_by_flair_window(
            models["mart_ai_share_by_flair_month"], windows
        ),
    }
    return models | store_tables(changes, folder, row_counts)


def _by_keys(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """A semi or anti join in which null equals null."""
    other = keys.toDF(*[f"_{c}" for c in keys.columns])
    return rows.join(other, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on], how)


def update_matched(
    versions: DataFrame,
    match_each: Callable[[DataFrame, list[Term]], DataFrame],
    terms: Iterable[Term],
    folder: str,
) -> DataFrame:
    """Match the versions that are not matched yet, append them, and return all matched versions.

    A version is known by its id, load stamp and content digest, so a load may come late, carry an
    earlier or an equal stamp, or stand in another table. What was matched is kept per dictionary,
    so a changed dictionary matches everything anew. Keys are compared first, without any text;
    the texts of new versions are then found by their keys, a month's at a time. For versions that are
    whole tables ``MatchedStore`` finds new loads by their files, without a join.
    """
    terms = check_terms(terms)
    spark, path = versions.sparkSession, f"{folder}/{dictionary_key(terms)}"
    known = load_if_present(spark.read.format("parquet"), path)
    if known is not None:
        key = ["id", "_loaded_at", "_digest"]
        place = [*key, "created_month"] if "created_month" in versions.columns else key
        matched_id = next(c for c in known.columns if c in ("post_id", "comment_id"))
        done = known.select(F.col(matched_id).alias("id"), *key[1:])
        new = _by_keys(versions.select(*place), done, key, "left_anti").distinct()
        versions = _by_keys(versions, new, place, "left_semi")
    match_each(versions, terms).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def rebuild(
    spark: SparkSession,
    post_versions: DataFrame,
    comment_versions: DataFrame,
    terms: Iterable[Term],
    folder: str,
    salt: str,
    now: str,
    window_months: int = fv.WINDOW_MONTHS,
    matched_folder: str | None = None,
    row_counts: checks.RowCounts | None = None,
) -> dict[str, DataFrame]:
    """From raw versions to marts; raises before anything is written when a source is stale.

    ``folder`` is that of this build, see ``new_build``. With ``matched_folder``, for versions that are
    whole raw tables, only files that no earlier rebuild matched are matched, and of the monthly
    marts only the months they touch are counted; without, all are. Staging stays a view; what the data
    tests read of it is stored, so that the newest versions are found once for all of them.
    """
    terms = check_terms(terms)
    require_fresh(
        freshness(post_versions, "created_utc", "posts", now).unionByName(
            freshness(comment_versions, "created_utc", "comments", now)
        )
    )
    monthly = None
    if matched_folder is None:
        posts = facts.match_each_post(post_versions, terms)
        comments = facts.match_each_comment(comment_versions, terms)
    else:
        stores = {kind: MatchedStore(spark, f"{matched_folder}/{kind}", terms) for kind in (POSTS, COMMENTS)}
        counts = CountStore(spark, f"{matched_folder}/counts", terms)
        for kind, versions, match_each in ((POSTS, post_versions, facts.match_each_post), (COMMENTS, comment_versions, facts.match_each_comment)):
            stores[kind].update(versions, match_each)
            counts.update(kind, stores[kind])
        posts, comments, monthly = stores[POSTS].versions(), stores[COMMENTS].versions(), counts.monthly()
    matched = facts.newest_posts(posts), facts.newest_comments(comments)
    models = store_models(*matched, terms, folder, window_months, monthly=monthly, row_counts=row_counts)
    return {
        "stg_posts": clean_posts(current_state(post_versions), salt),
        "stg_comments": clean_comments(current_state(comment_versions), salt),
        "tools": term_frame(spark, terms),
        **models,
    }


def tested(models: dict[str, DataFrame], folder: str, row_counts: checks.RowCounts | None = None, **options: object) -> DataFrame:
    """The report of all data tests of a build, on staging stored for them in its folder.

    ``row_counts`` are those of the models that were counted while they were stored; staging that was is
    not stored again.
    """
    counts = dict(row_counts or {})
    staging = checks.narrow_staging(models["stg_posts"], models["stg_comments"])
    if lazy := {name: df for name, df in staging.items() if name not in counts}:
        staging |= store_tables(lazy, folder, counts, "tested_")
    return checks.report({**models, **staging}, row_counts=counts, **options)


STORED = (
    "matched_posts",
    "matched_comments",
    "fct_post_tool_mentions",
    "fct_comment_tool_mentions",
    "fct_posts",
    "dim_comparison_windows",
    "mart_tool_mentions_by_month",
    "mart_comment_tool_mentions_by_month",
    "mart_ai_share_by_flair_month",
    "mart_ai_share_by_month",
    "mart_ai_share_change",
    "mart_tool_share_change",
    "mart_ai_share_by_flair_window",
)


def new_build() -> str:
    """The name of a build that is yet to be written."""
    return uuid.uuid4().hex


def build_folder(folder: str, build: str) -> str:
    return f"{folder}/builds/{build}"


def _published(spark: SparkSession, folder: str) -> DataFrame | None:
    return load_if_present(spark.read.schema("number LONG, build STRING").format("parquet"), f"{folder}/published")


def publish(spark: SparkSession, folder: str, build: str) -> None:
    """Make a complete build the one that readers open; one rebuild at a time publishes."""
    earlier = _published(spark, folder)
    last = earlier.agg(F.max("number")).first()[0] if earlier is not None else 0
    row = spark.range(1).select(F.lit(last + 1).cast("long").alias("number"), F.lit(build).alias("build"))
    row.write.mode("append").parquet(f"{folder}/published")


def open_models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The stored models of the build published last."""
    published = _published(spark, folder)
    last = published.orderBy(F.desc("number")).first() if published is not None else None
    if last is None:
        raise FileNotFoundError(f"no build is published in {folder}")
    return {name: spark.read.parquet(f"{build_folder(folder, last.build)}/{name}") for name in STORED}


def publish_views(models: dict[str, DataFrame]) -> None:
    """Name the models in the session, so that they can be queried with SQL."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def contents(models: dict[str, DataFrame]) -> DataFrame:
    """Per model its rows and sums over its content: characters, days, true flags and numbers.

    Sums of numbers are rounded to four places.
    """

    def total(values: list[Column], kind: str) -> Column:
        sums = [F.coalesce(F.sum(v.cast(kind)), F.lit(0).cast(kind)) for v in values]
        return reduce(add, sums, F.lit(0).cast(kind))

    parts = []
    for name, df in models.items():
        chars, days, flags, numbers = [], [], [], []
        for column, kind in df.dtypes:
            value = F.col(column)
            if kind == "string":
                chars.append(F.length(value))
            elif kind == "date" or kind.startswith("timestamp"):
                days.append(F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")))
            elif kind == "boolean":
                flags.append(value.cast("int"))
            else:
                numbers.append(value)
        sums = [
            F.count("*").alias("rows"),
            total(chars, "long").alias("chars"),
            total(days, "long").alias("days"),
            total(flags, "long").alias("flags"),
            F.round(total(numbers, "double"), 4).alias("numbers"),
        ]
        parts.append(df.agg(*sums).select(F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, parts)
