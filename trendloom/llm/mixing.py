"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order that depends on ids alone. A document
served for the ``e``-th time (from 0) has the virtual finish time

    (e * words of its source + words of the source's documents up to and with it) / target of its source

so in virtual time 1 each source sends its target. All servings are range-sorted by finish time
over all sources and cut where their words reach the budget, the words of all documents.

Nothing here needs a source, or the global order, in one task: prefix sums go over ranges of the
shuffled order (hash prefixes) and ranges of finish time, whose sums are added up first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm import textkit
from trendloom.llm.common import prepare, stored

# Rows of one range of the shuffled order or of finish time, on average; it does not change results.
RANGE_ROWS = 50_000
WEIGHTS = 3
MAX_REPEATS = 3
SEED = "mix-1"


def _add_sizes(position: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(position)
            sizes = np.zeros(len(texts), dtype=np.int64)
            for chunk in textkit.chunks(texts):
                sizes[chunk.first : chunk.first + chunk.n] = textkit.words(chunk).counts
            columns = [c for i, c in enumerate(batch.columns) if i != position]
            names = [n for i, n in enumerate(batch.schema.names) if i != position]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes)], names=[*names, "__size"])

    return add


def sized(docs: DataFrame, id: str, text: str, source: str, carry: Sequence[str] = ()) -> DataFrame:
    """``__id``, ``__source``, the carried columns as ``__c0``…, and ``__size``: the words of the whole text."""
    prepare(docs.sparkSession)
    chosen = docs.select(
        F.col(f"`{id}`").alias("__id"),
        F.col(f"`{source}`").alias("__source"),
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carry)],
        F.col(f"`{text}`").cast("string").alias("__text"),
    )
    kept = [f for f in chosen.schema.fields if f.name != "__text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "__size long"])
    return chosen.mapInArrow(_add_sizes(len(kept)), schema)


def targets(sources: DataFrame) -> DataFrame:
    """Targets by weight that stop at ``MAX_REPEATS`` times a source's words, the rest reshared.

    ``sources`` has one row per source: ``__source``, ``__words``. Sources are ranked by code point,
    null last, and weigh 1, 2, 3, 1, … Taking them by words per weight, a source is capped while its
    share of what the ones before it left is above its cap; from the first uncapped one on, all
    get the same words per weight. Adds ``__rank`` and ``__target``.
    """
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    ranked = sources.withColumn("__rank", F.row_number().over(by_name))
    ranked = ranked.withColumn("__weight", (F.col("__rank") - 1) % WEIGHTS + 1)
    ranked = ranked.withColumn("__cap", F.col("__words") * MAX_REPEATS)
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("__cap") / F.col("__weight"), "__rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("__words").over(whole) - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    weight_left = F.sum("__weight").over(whole) - F.coalesce(F.sum("__weight").over(before), F.lit(0))
    level = left.cast("double") / weight_left.cast("double")
    shared = ranked.withColumn("__level", level)
    shared = shared.withColumn("__capped", F.col("__weight") * F.col("__level") > F.col("__cap"))
    common = F.max(F.when(~F.col("__capped"), F.col("__level"))).over(whole)
    target = F.when(F.col("__capped"), F.col("__cap").cast("double")).otherwise(F.col("__weight") * common)
    return shared.withColumn("__target", F.least(target, F.col("__cap").cast("double"))).select(
        "__source", "__words", "__rank", "__target", "__weight", "__capped"
    )


def _finish(turn: int):
    words = (F.lit(turn).cast("long") * F.col("__words") + F.col("__upto")).cast("double")
    return F.when(F.col("__target") > 0, words / F.col("__target"))


def _place(turn: int):
    """Sort key of a serving: finish time, then source, turn, shuffled order, id."""
    return F.struct(
        _finish(turn).alias("finish"),
        F.col("__rank").alias("rank"),
        F.lit(turn).alias("turn"),
        F.col("__order").alias("order"),
        F.col("__id").alias("id"),
    )


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """Every document with what the mix takes of it.

    Returns ``id``, the carried columns, ``size`` (words), ``source_size``, ``target`` of its source,
    ``taken`` (words, repeats counted: 0 to 3 times the size) and ``finish`` (finish time of its first
    serving, null without words). A null or empty text has size 0 and takes nothing; a null source is
    a source of its own; repeated rows are documents of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = sized(docs, id, text, source, carry)
    # with carried columns the sizes alone are stored, and the rows read again in the last pass
    narrow = stored(sized(docs, id, text, source) if carry else rows, "mix-sizes")
    sums = narrow.groupBy("__source").agg(F.sum("__size").alias("__words"), F.count("*").alias("__rows"), F.max("__size").alias("__longest"))
    sums = stored(sums, "mix-sources")
    sources = targets(sums.drop("__rows", "__longest"))
    shares = stored(sources.join(sums.select(F.col("__source").alias("s"), "__longest", "__rows"), F.col("s").eqNullSafe(F.col("__source"))).drop("s"), "mix-targets")
    total = shares.agg(
        F.coalesce(F.sum("__words"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows"),
        F.sum(F.when(~F.col("__capped"), F.col("__longest"))).alias("lag"),
        F.sum(F.when(~F.col("__capped"), F.col("__target"))).alias("open"),
        F.coalesce(F.max(F.when(F.col("__target") > 0, (F.col("__words") * MAX_REPEATS).cast("double") / F.col("__target"))), F.lit(0.0)).alias("last"),
    ).first()
    digits = max(2, math.ceil(math.log(max(1, total.rows) / RANGE_ROWS + 1, 16)))

    def queued(frame: DataFrame) -> DataFrame:
        placed = frame.withColumn("__order", F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("__id").cast("string"), F.lit("null")))))
        known = shares.select(F.col("__source").alias("__s"), "__words", "__rank", "__target")
        placed = placed.join(known, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s")
        return placed.withColumn("__range", F.substring("__order", 1, digits))

    # words of a source up to and with a document: ranges before its own, then inside the range
    pieces = queued(narrow).groupBy("__rank", "__range").agg(F.sum("__size").alias("__piece"))
    earlier = Window.partitionBy("__rank").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.select("__rank", "__range", F.coalesce(F.sum("__piece").over(earlier), F.lit(0)).alias("__base"))
    bases = stored(bases, "mix-ranges")

    def with_upto(frame: DataFrame) -> DataFrame:
        inside = Window.partitionBy("__rank", "__range").orderBy("__order", F.col("__id"), "__size")
        upto = F.sum("__size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        return queued(frame).join(bases, ["__rank", "__range"]).withColumn("__upto", F.col("__base") + upto)

    placed = with_upto(narrow)
    limit = None
    if total.words:
        # by this time every source is a document behind at most, so mostly the budget is reached; a source that
        # has had all its turns can't make up for one behind, so else the range is doubled up to the last serving
        step = 1.0 + (total.lag or 0) / total.open if total.open else 1.0
        bins = max(1024, 2 * total.rows // RANGE_ROWS)
        every = placed.where("__size > 0").select(
            "__size", "__rank", "__order", "__id", "__words", "__target", "__upto",
            F.explode(F.array(*[_place(e) for e in range(MAX_REPEATS)])).alias("__place"),
        )
        horizon = step
        while True:
            servings = every.where(F.col("__place.finish") <= horizon).select("__size", "__place")
            servings = stored(servings.withColumn("__bin", F.floor(F.col("__place.finish") / step * bins)), "mix-servings")
            per_bin = servings.groupBy("__bin").agg(F.sum("__size").alias("__words"))
            upto_bin = per_bin.withColumn("__upto", F.sum("__words").over(Window.orderBy("__bin")))
            cut = upto_bin.where(F.col("__upto") > total.words).orderBy("__bin").select("__bin", (F.col("__upto") - F.col("__words")).alias("before")).first()
            if cut is not None or horizon >= total.last:
                break
            horizon *= 2
        if cut is not None:
            at = servings.where(F.col("__bin") == cut["__bin"])
            upto = F.sum("__size").over(Window.partitionBy("__bin").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0))
            over = at.withColumn("__upto", upto + cut.before).where(F.col("__upto") > total.words)
            limit = over.agg(F.min("__place").alias("p")).first().p
    if carry:
        placed = with_upto(rows)
    turns = F.lit(0)
    for e in range(MAX_REPEATS):
        inside = F.lit(True) if limit is None else _place(e) < _literal(limit, placed.schema["__id"].dataType)
        turns = turns + F.when(inside & (F.col("__size") > 0), 1).otherwise(0)
    taken = (F.col("__size") * turns).cast("long")
    return placed.select(
        F.col("__id").alias(id),
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)],
        F.col("__size").alias("size"),
        F.col("__words").alias("source_size"),
        F.col("__target").alias("target"),
        taken.alias("taken"),
        F.when(F.col("__size") > 0, _finish(0)).alias("finish"),
    )


def _literal(place, id_type):
    return F.struct(
        F.lit(place.finish).alias("finish"),
        F.lit(place["rank"]).alias("rank"),
        F.lit(place.turn).alias("turn"),
        F.lit(place.order).alias("order"),
        F.lit(place.id).cast(id_type).alias("id"),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The servings of a mix as a global sequence: one row per serving, range-sorted by finish time."""
    times = (F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    served = mixed.where("taken > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), times - 1)))
    again = F.col("turn") * F.col("source_size") / F.col("target")  # what is served has a target
    return served.withColumn("finish", F.col("finish") + again).orderBy("finish")
