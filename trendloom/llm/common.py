"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.session import new_folder, ship_package

BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def prepare(spark: SparkSession) -> None:
    """Let Python workers find this package, and bound what they are handed at once.

    Batches are bounded by bytes unless the session says otherwise: ten thousand texts have any size.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    ship_package(spark)


def trimmed(function: Callable) -> Callable:
    """A task's work on batches that gives the memory it no longer uses back to the system.

    Workers are kept for later tasks, and what they have freed would stay with them.
    """

    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
                trim(0)

    return run


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: a cut of the lineage that survives executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document, by the checksum of its id as text; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def in_fold(doc_id: Column, folds: int, held: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == held, F.lit(False))


def labelled_sample(labels: DataFrame, id: str, label: str, most: int, seed: str) -> DataFrame:
    """About ``most`` labelled ids, half of each label as far as there are: ``__id``, ``__label``, ``__weight``.

    Ids are chosen by a hash of the id, so a rerun chooses the same; the weight undoes the choice of
    more rows of one label. Ids with two labels count with the larger one. Null ids and null labels
    are left out. The result has a bounded size, whatever the size of the table.
    """
    rows = labels.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{label}`").cast("int").alias("__label"))
    rows = rows.where("__id IS NOT NULL AND __label IN (0, 1)").groupBy("__id").agg(F.max("__label").alias("__label"))
    counts = {r["__label"]: r["n"] for r in rows.groupBy("__label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(seed), "__id"), F.lit(1 << 30)) / float(1 << 30)
    chosen, weight = F.lit(False), F.lit(1.0)
    for value, n in counts.items():
        share = min(1.0, most / 2 / n)
        chosen = chosen | ((F.col("__label") == value) & (draw < share))
        weight = F.when(F.col("__label") == value, F.lit(1 / share)).otherwise(weight)
    return rows.where(chosen).withColumn("__weight", weight)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def picked(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, also where the table has others that differ from them only in case."""
    lower = [c.lower() for c in df.columns]
    places = [df.columns.index(n) if n in df.columns else lower.index(n.lower()) for n in names]
    numbered = df.toDF(*[f"c{i}" for i in range(len(lower))])
    return numbered.select(*[F.col(f"c{i}").alias(n) for i, n in zip(places, names, strict=True)])
