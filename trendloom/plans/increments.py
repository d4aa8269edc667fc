"""Keeping matched versions and monthly counts up to date without starting over.

``MatchedStore`` holds the matched versions of a raw table by load, and which files of the table each
load has matched. Files of a raw table are never changed, so a rebuild opens those that no load has
matched and nothing else: no text is compared, joined or shuffled. A load counts once its files are
recorded, which is the last thing it does; what a load that failed has left is overwritten.

``CountStore`` holds what every load has changed in the monthly counts: items that got a new version
are taken out as they were and put in as they are now. The counts of the months that a load touched
are the sums of all changes to them, written over the partitions of these months, so that a step that
is run again gives the same. A month that has lost all its items keeps zeros, which readers leave out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import fixed_values as fv
from trendloom.functions.scalars import month_of, pct
from trendloom.functions.text import Term, check_terms, dictionary_key
from trendloom.operators.joins import dense_grid
from trendloom.operators.mentions import mentions_category
from trendloom.plans import facts, marts
from trendloom.sources.tables import load_if_present

Match = Callable[[DataFrame, list[Term]], DataFrame]


class MatchedStore:
    """Matched versions of one kind of item under one dictionary; a changed dictionary is another store."""

    def __init__(self, spark: SparkSession, folder: str, terms: Iterable[Term]) -> None:
        self.spark, self.terms = spark, check_terms(terms)
        self.path = f"{folder}/{dictionary_key(self.terms)}"

    def _loads(self) -> DataFrame | None:
        return load_if_present(self.spark.read.schema("load LONG, file STRING").format("parquet"), f"{self.path}/files")

    @property
    def last(self) -> int:
        """The number of the last load that is complete, 0 before the first."""
        loads = self._loads()
        return (loads.agg(F.max("load")).first()[0] or 0) if loads is not None else 0

    def unmatched(self, versions: DataFrame) -> DataFrame | None:
        """The rows of the files that no load has matched; None if there are none.

        ``versions`` are whole raw tables, as ``read_versions`` gives them: a filter on them would not
        be seen. File names pass through the driver, as they do whenever Spark plans a scan.
        """
        loads = self._loads()
        if loads is None:
            return versions
        new = sorted(set(versions.inputFiles()) - {r.file for r in loads.select("file").toLocalIterator()})
        if not new:
            return None
        kept = [f for f in versions.schema if f.name != "created_month"]  # in no file, and in no match
        return self.spark.read.schema(type(versions.schema)(kept)).parquet(*new)

    def update(self, versions: DataFrame, match_each: Match) -> int:
        """Match what is new as one load; the number of the last load."""
        last, files = self.last, versions.inputFiles()
        rows = self.unmatched(versions)
        if rows is None:
            return last
        new = rows.inputFiles() if last else files
        match_each(rows, self.terms).write.mode("overwrite").parquet(f"{self.path}/versions/load={last + 1}")
        recorded = self.spark.createDataFrame([(last + 1, f) for f in new], "load LONG, file STRING")
        recorded.coalesce(1).write.mode("append").parquet(f"{self.path}/files")
        return last + 1

    def versions(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """Matched versions of the loads beyond ``after``, up to the last one or ``upto``."""
        upto = self.last if upto is None else upto
        rows = self.spark.read.parquet(f"{self.path}/versions")
        return rows.where((F.col("load") > after) & (F.col("load") <= upto)).drop("load")


# --- monthly counts ------------------------------------------------------------------

# What is counted, by month and key: mentions of a tool (a) and those in a title (b); all items (a);
# items of a flair (a) and those with the focus in the title (b); hits of a measure (a) and its items (b).
TOOL, TOTAL, FLAIR, MEASURE = "tool", "total", "flair", "measure"
POSTS, COMMENTS = "posts", "comments"


def _count(what: str, key: Column, category: Column, a: Column, b: Column) -> Column:
    return F.struct(F.lit(what).alias("what"), key.cast("string").alias("key"), category.cast("string").alias("category"), a.cast("long").alias("a"), b.cast("long").alias("b"))


def contributions(items: DataFrame, kind: str, sign: int, focus: str = fv.FOCUS_CATEGORY) -> DataFrame:
    """What each item adds to the counts, or takes from them: ``month, what, key, category, a, b``."""
    nothing, one = F.lit(None), F.lit(sign)
    moment = "posted_at" if kind == POSTS else "commented_at"
    if kind == POSTS:
        hit = mentions_category(focus, only_in_title=True)
        own = [
            _count(TOTAL, nothing, nothing, one, F.lit(0)),
            _count(FLAIR, F.coalesce("flair", F.lit(fv.NO_FLAIR)), nothing, one, F.when(hit, sign).otherwise(0)),
            _count(MEASURE, F.lit(fv.POST_TITLES), nothing, F.when(hit, sign).otherwise(0), one),
        ]
        per_term = F.transform("mentions", lambda m: _count(TOOL, m["tool"], m["category"], one, F.when(m["is_in_title"], sign).otherwise(0)))
    else:
        hit = mentions_category(focus)
        own = [
            _count(TOTAL, nothing, nothing, one, F.lit(0)),
            _count(MEASURE, F.lit(fv.COMMENTS), nothing, F.when(hit, sign).otherwise(0), one),
        ]
        per_term = F.transform("mentions", lambda m: _count(TOOL, m["tool"], m["category"], one, F.lit(0)))
    rows = items.select(month_of(F.col(moment)).alias("month"), F.explode(F.concat(F.array(*own), per_term)).alias("c"))
    return rows.select("month", "c.*")


COUNTED = ["month", "what", "key", "category"]


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*COUNTED).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


class CountStore:
    """Monthly counts of posts and comments, brought up to date by the loads of two matched stores."""

    KINDS = {POSTS: ("post_id", facts.newest_posts), COMMENTS: ("comment_id", facts.newest_comments)}

    def __init__(self, spark: SparkSession, folder: str, terms: Iterable[Term], focus: str = fv.FOCUS_CATEGORY) -> None:
        self.spark, self.focus, self.terms = spark, focus, check_terms(terms)
        self.folder = f"{folder}/{dictionary_key(self.terms)}"

    def _done(self) -> DataFrame | None:
        return load_if_present(self.spark.read.schema("kind STRING, upto LONG").format("parquet"), f"{self.folder}/done")

    def upto(self, kind: str) -> int:
        """The last load that the counts of a kind hold."""
        done = self._done()
        return (done.where(F.col("kind") == kind).agg(F.max("upto")).first()[0] or 0) if done is not None else 0

    def changes(self, kind: str, matched: MatchedStore, after: int, upto: int) -> DataFrame:
        """What the loads beyond ``after`` change in the counts.

        Only items with a new version are looked at. Their earlier versions are found among narrow
        rows, without text, by their ids, which Spark broadcasts where they are few.
        """
        key, newest = self.KINDS[kind]
        new = matched.versions(after, upto)
        touched = new.select(F.col(key).alias("_id")).distinct()
        old = matched.versions(0, after).join(touched, F.col(key).eqNullSafe(F.col("_id")), "left_semi")
        before = contributions(newest(old), kind, -1, self.focus)
        now = contributions(newest(old.unionByName(new)), kind, 1, self.focus)
        return _summed(before.unionByName(now)).where("a <> 0 OR b <> 0")

    def update(self, kind: str, matched: MatchedStore) -> None:
        """Bring the months that new loads touch up to date; nothing is written without new loads."""
        after, upto = self.upto(kind), matched.last
        if after == upto:
            return
        path = f"{self.folder}/changes/{kind}"
        self.changes(kind, matched, after, upto).write.mode("overwrite").parquet(f"{path}/upto={upto}")
        done = [r.upto for r in self._done().where(F.col("kind") == kind).collect()] if after else []  # a number per run
        all_changes = self.spark.read.parquet(path).where(F.col("upto").isin(*done, upto))
        months = all_changes.where(F.col("upto") == upto).select(F.col("month").alias("_month")).distinct()
        rows = _summed(all_changes.join(months, F.col("month").eqNullSafe(F.col("_month")), "left_semi"))
        rows = rows.withColumn("kind", F.lit(kind)).repartition("month")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("kind", "month").parquet(f"{self.folder}/counts")
        self.spark.createDataFrame([(kind, upto)], "kind STRING, upto LONG").coalesce(1).write.mode("append").parquet(f"{self.folder}/done")

    def _counts(self, kind: str, what: str) -> DataFrame:
        rows = self.spark.read.schema("what STRING, key STRING, category STRING, a LONG, b LONG, kind STRING, month DATE").parquet(f"{self.folder}/counts")
        return rows.where((F.col("kind") == kind) & (F.col("what") == what))

    def tool_mentions_by_month(self) -> DataFrame:
        """As ``marts.tool_mentions_by_month`` from all items."""
        totals = self._counts(POSTS, TOTAL).where("a > 0").select("month", F.col("a").alias("posts_in_month"))
        counts = self._counts(POSTS, TOOL).select(
            "month", F.col("key").alias("tool"), F.col("a").alias("posts_mentioning"), F.col("b").alias("posts_mentioning_in_title")
        )
        return marts.with_post_shares(dense_grid(totals, self.terms, counts, "month", ["posts_mentioning", "posts_mentioning_in_title"]))

    def comment_tool_mentions_by_month(self) -> DataFrame:
        totals = self._counts(COMMENTS, TOTAL).where("a > 0").select("month", F.col("a").alias("comments_in_month"))
        counts = self._counts(COMMENTS, TOOL).select("month", F.col("key").alias("tool"), F.col("a").alias("comments_mentioning"))
        return marts.with_comment_share(dense_grid(totals, self.terms, counts, "month", ["comments_mentioning"]))

    def ai_share_by_flair_month(self) -> DataFrame:
        counts = self._counts(POSTS, FLAIR).where("a > 0")
        counts = counts.select("month", F.col("key").alias("flair"), F.col("a").alias("posts"), F.col("b").alias("ai_posts_in_title"))
        return counts.withColumn("ai_title_share_pct", pct(F.col("ai_posts_in_title"), F.col("posts")))

    def ai_share_by_month(self) -> DataFrame:
        both = reduce(DataFrame.unionByName, [self._counts(kind, MEASURE) for kind in (POSTS, COMMENTS)]).where("b > 0")
        return marts.with_share(both.select("month", F.col("key").alias("measure"), F.col("a").alias("mentions_ai"), F.col("b").alias("total")))

    def monthly(self) -> dict[str, DataFrame]:
        """The monthly marts, as a rebuild names them."""
        return {
            "mart_tool_mentions_by_month": self.tool_mentions_by_month(),
            "mart_comment_tool_mentions_by_month": self.comment_tool_mentions_by_month(),
            "mart_ai_share_by_flair_month": self.ai_share_by_flair_month(),
            "mart_ai_share_by_month": self.ai_share_by_month(),
        }
