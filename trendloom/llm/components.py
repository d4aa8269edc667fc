"""Connected components of an edge table, by local contraction and stars that grow until they stand still."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import prepare, stored

# Edges that one task contracts in its memory.
TASK_EDGES = 250_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one task as stars around the smallest node of each of its components."""
    parent: dict = {}
    kinds = None

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        kinds = batch.schema.types
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    if kinds is not None:
        nodes = [x for x in parent if parent[x] != x]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kinds[0]), pa.array([find(x) for x in nodes], kinds[1])], names=["u", "v"])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that is reachable, for every node with an edge.

    Tasks first contract ``TASK_EDGES`` edges each to stars. While that is more than one task, a round
    links the larger neighbours of each node to its smallest neighbour, then all smaller ones, and
    tasks contract again; rounds grow with the logarithm of the longest path. Every round is written
    to the shared folder, minima are pre-aggregated, and joins can be split, so a node with any
    number of edges needs no task for itself.
    """
    prepare(edges.sparkSession)
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    now = stored(pair, "stars")
    while True:
        tasks = math.ceil(now.count() / TASK_EDGES)
        if tasks == 0:
            break
        now = stored(now.repartition(tasks).mapInArrow(_contract, now.schema).distinct(), "stars")
        if tasks == 1 or _are_stars(now):
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        inner = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(inner.union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        if _are_stars(now):
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node points to one root, which points to none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(edges.select("v", F.lit(0), F.lit(1)))
    wrong = ends.groupBy("n").agg(F.sum("out").alias("out"), F.sum("in").alias("in")).where("out > 1 OR out = 1 AND in > 0")
    return wrong.limit(1).count() == 0
