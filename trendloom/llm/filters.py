"""How filters of a corpus act on each other: what each order of them removes, at which step.

One pass of the byte transducer measures every text. What a document fails is one of 32 sets of
filters, so a part of the corpus is known by 32 counts, and all orders of the filters are read off
these counts without looking at a document again.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm import textkit, transducer
from trendloom.llm.common import picked, prepare, stored

# Fixed by the rules.
SYMBOLS = b"#$%&*|"
FEWEST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITAL_PERCENT = 50, 65, 5
FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)

MEASURES = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]


def measures(chunk: textkit.Chunk) -> np.ndarray:
    """``MEASURES`` of each document of a chunk."""
    found = transducer.run(chunk, _CLASSES)
    return np.column_stack([found.words, transducer.distinct_words(chunk, found), found.capitals, found.points, found.symbols])


_CLASSES = transducer.classes(SYMBOLS)


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per document: ``__id``, ``part``, ``digest`` of the text, and ``MEASURES``.

    A null text is empty, a null part the empty string. Rows stay as they are, repeated or not.
    """
    prepare(docs.sparkSession)
    rows = picked(docs, text, id, part).toDF("text", "__id", "part")
    rows = rows.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "__id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part")
    )
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measures(c) for c in textkit.chunks(batch.column(0))]
            if parts:
                numbers = [pa.array(m) for m in np.concatenate(parts).astype(np.int64).T.copy()]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *numbers], names=["__id", "part", "digest", *MEASURES])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(measure, f"__id {kind}, part string, digest binary, {', '.join(f'{m} long' for m in MEASURES)}")


def _fails() -> list[Column]:
    """What fails filters A to D."""
    return [
        F.col("n_words") < FEWEST_WORDS,
        100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n_words"),
        100 * F.col("n_capitals") > MOST_CAPITAL_PERCENT * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]


def failed(docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per document ``__id``, ``part`` and ``fails``, a bit per filter it fails, A the lowest.

    A document fails E if a smaller id has its text, anywhere in the table. The smallest id of a text
    is found with partial aggregation and joined by id and text together, so that no group of copies
    is ever in one place. A null id has no smaller id and is no smaller id; rows that repeat an id
    don't fail each other.
    """
    rows = stored(measured(docs, id, text, part), "measures")
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(_fails())), F.lit(0))
    rows = rows.select("__id", "part", "digest", bits.alias("bits"))
    firsts = rows.where("__id IS NOT NULL").groupBy("digest").agg(F.min("__id").alias("__id")).withColumn("first", F.lit(True))
    rows = rows.join(firsts, ["__id", "digest"], "left")
    copy = F.col("__id").isNotNull() & F.col("first").isNull()
    return rows.select("__id", "part", (F.col("bits") + F.when(copy, 1 << 4).otherwise(0)).alias("fails"))


def _summed(counts: str, chosen: str) -> Column:
    """The sum of the counts whose set ``m`` of failed filters is chosen."""
    return F.expr(f"aggregate(sequence(0, {SETS - 1}), 0L, (total, m) -> total + CASE WHEN {chosen} THEN {counts}[m] ELSE 0L END)")


def interactions(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """A row for each part, order of the five filters, and step of it; counts are of documents.

    ``removed`` by the step's filter here, ``kept`` after it, ``redundant``: fail it, but are gone
    already; ``unique_fails``: fail it and no other; ``good_lost`` and ``toxic_lost``: removed here
    and labelled so by any row of ``labels``; ``shapley``: removed by this filter, summed over all
    orders. Without documents there are no rows. Other columns of both tables are not read.
    """
    marks = picked(labels, id, quality, toxic).toDF("__id", "good", "bad").where("__id IS NOT NULL")
    one = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c) for c in ("good", "bad")]
    rows = failed(docs, id, text, part).join(marks.groupBy("__id").agg(*one), "__id", "left")
    sets = rows.groupBy("part", "fails").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("bad").alias("bad"))
    parts = sets.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("fails", F.struct("n", "good", "bad")))).alias("sets"))
    counts = [F.expr(f"transform(sequence(0, {SETS - 1}), m -> coalesce(sets[m].{c}, 0L))").alias(c) for c in ("n", "good", "bad")]
    orders = F.array(*[F.lit("".join(o)) for o in itertools.permutations(FILTERS)])
    steps = parts.select("part", *counts).select("*", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumn("bit", F.expr("shiftleft(1, ascii(substr(filter_order, step, 1)) - 65)"))
    steps = steps.withColumn(
        "before", F.expr("aggregate(sequence(1, 5), 0, (set, k) -> set | CASE WHEN k < step THEN shiftleft(1, ascii(substr(filter_order, k, 1)) - 65) ELSE 0 END)")
    )
    here = "(m & before) = 0 AND (m & bit) <> 0"
    return steps.select(
        "part",
        "filter_order",
        "step",
        _summed("n", "(m & (before | bit)) = 0").alias("kept"),
        _summed("n", here).alias("removed"),
        _summed("n", "(m & before) <> 0 AND (m & bit) <> 0").alias("redundant"),
        _summed("n", "m = bit").alias("unique_fails"),
        _summed("good", here).alias("good_lost"),
        _summed("bad", here).alias("toxic_lost"),
        F.expr(
            # of a set's filters each comes first in an equal share of the 120 orders
            f"aggregate(sequence(0, {SETS - 1}), 0L, (total, m) -> total + CASE WHEN (m & bit) <> 0 THEN n[m] * (120 div bit_count(m)) ELSE 0L END)"
        ).alias("shapley"),
    )
