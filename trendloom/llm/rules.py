"""Quality rules: gradient-boosted trees over document statistics, behind fixed base rules.

Trees are grown on a bounded sample of labelled documents with logistic loss, on quantile bins.
Features in ``DIRECTIONS`` are monotonic: with all else equal, the score never rises (-1) with
them. The forest is flattened into node arrays, and a batch of documents walks all trees level by
level in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import docstats, textkit
from trendloom.llm.common import in_fold, labelled_sample, prepare, trimmed

# Most labelled rows that training reads, about.
SAMPLE = 8000
FOLDS, HELD = 5, 0
TREES, DEPTH, RATE, BINS = 60, 3, 0.15, 32
LEAST_WEIGHT, RIDGE = 20.0, 5.0
# A document that passes the base rules is kept at this chance of good quality.
KEEP_AT = 0.3
DIRECTIONS = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_word_share": -1, "upper_share": -1, "exclaim_per_word": -1}
# Fixed base rules.
FEWEST_WORDS, MOST_REPEAT_PERCENT = 50, 50


@dataclass
class Forest:
    """Nodes of all trees: a leaf points to itself. ``roots`` holds each tree's first node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1 for each row of features."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.prior + self.value[at].sum(axis=1))))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, directions: np.ndarray) -> Forest:
    """Boost trees; without both labels the forest is a constant."""
    nodes: list[list] = []
    roots: list[int] = []
    total = weight.sum()
    rate = (weight @ y + 1) / (total + 2) if len(y) else 0.5
    prior = float(np.log(rate / (1 - rate)))
    if len(y) == 0 or y.min() == y.max():
        leaf = np.zeros(1, dtype=np.int64)
        return Forest(leaf, np.zeros(1), leaf, leaf, np.zeros(1), leaf, 0, prior)
    weight = weight * (len(y) / total)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    bins = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)])
    raw = np.full(len(y), prior)

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        node = len(nodes)
        own_g, own_h = g[rows].sum(), h[rows].sum()
        value = float(np.clip(-own_g / (own_h + RIDGE), low, high))
        nodes.append([0, 0.0, node, node, value])
        best = (1e-6, None)
        for f in range(x.shape[1]) if level < DEPTH else ():
            size = len(cuts[f]) + 1
            gs, hs, ws = (np.cumsum(np.bincount(bins[rows, f], v[rows], minlength=size))[:-1] for v in (g, h, weight))
            if not len(gs):
                continue
            left = np.clip(-gs / (hs + RIDGE), low, high)
            right = np.clip(-(own_g - gs) / (own_h - hs + RIDGE), low, high)

            def gain(v, gg, hh):
                return -(gg * v + 0.5 * (hh + RIDGE) * v * v)

            won = gain(left, gs, hs) + gain(right, own_g - gs, own_h - hs) - gain(value, own_g, own_h)
            allowed = (ws >= LEAST_WEIGHT) & (ws[-1] + np.bincount(bins[rows, f], weight[rows], minlength=size)[-1] - ws >= LEAST_WEIGHT)
            allowed &= (right - left) * directions[f] >= 0
            won = np.where(allowed, won, -np.inf)
            k = int(won.argmax())
            if won[k] > best[0]:
                best = (won[k], (f, k, float(left[k]), float(right[k])))
        if best[1] is not None:
            f, k, left, right = best[1]
            middle = (left + right) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(int(directions[f]), ((low, high), (low, high)))
            goes = bins[rows, f] <= k
            a = split(rows[goes], g, h, level + 1, *bounds[0])
            b = split(rows[~goes], g, h, level + 1, *bounds[1])
            nodes[node][:4] = [f, float(cuts[f][k]), a, b]
        return node

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        first = len(nodes)
        roots.append(split(np.arange(len(y)), weight * (p - y), weight * p * (1 - p), 0, -np.inf, np.inf))
        for node in nodes[first:]:
            node[4] *= RATE
        f, t, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
        at = np.full(len(y), roots[-1])
        for _ in range(DEPTH):
            at = np.where(x[np.arange(len(y)), f[at]] <= t[at], left[at], right[at])
        raw += value[at]
    return Forest(f, t, left, right, value, np.array(roots), DEPTH, prior)


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [docstats.statistics(c)[1] for c in textkit.chunks(batch.column(0))]
        ratios = np.concatenate(rows) if rows else np.zeros((0, len(docstats.RATIOS)))
        values = pa.FixedSizeListArray.from_arrays(pa.array(ratios.ravel()), len(docstats.RATIOS)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], values], names=[*batch.schema.names[1:], "__x"])


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Forest:
    """A forest from about ``sample`` labelled documents outside the held-out fold."""
    prepare(docs.sparkSession)
    chosen = labelled_sample(labels.where(~in_fold(F.col(f"`{id}`"), FOLDS, HELD)), id, label, sample, "rules")
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"))
    rows = rows.join(F.broadcast(chosen), "__id").select("__text", "__id", "__label", "__weight")
    id_type = chosen.schema["__id"].dataType.simpleString()
    found = rows.mapInArrow(trimmed(_statistics_of), f"__id {id_type}, __label int, __weight double, __x array<double>")
    one = found.groupBy("__id").agg(F.min(F.struct("__x", "__label", "__weight")).alias("r")).select("__id", "r.*")
    got = one.orderBy("__id").toPandas()
    x = np.array(got["__x"].tolist()).reshape(len(got), len(docstats.RATIOS))
    directions = np.array([DIRECTIONS.get(name, 0) for name in docstats.RATIOS])
    return grow(x, got["__label"].to_numpy(float), got["__weight"].to_numpy(float), directions)


def _judge(counts: np.ndarray, ratios: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    failed = (counts[:, 0] < FEWEST_WORDS) | (100 * counts[:, 4] > MOST_REPEAT_PERCENT * counts[:, 0])
    score = forest.score(ratios)
    return failed, score, ~failed & (score >= KEEP_AT)


def judged(docs: DataFrame, forest: Forest, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics and verdict per document: ``id``, the counts, ``base_failed``, ``kept``, ``score``.

    A null or empty text has zero counts and fails the base rules. Null ids and repeated rows are
    judged like any other; other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(c, r, *_judge(c, r, forest)) for c, r in map(docstats.statistics, textkit.chunks(batch.column(0)))]
            if parts:
                counts, _, failed, score, kept = (np.concatenate(p) for p in zip(*parts, strict=True))
                arrays = [batch.column(1), *[pa.array(c) for c in counts.T.copy()], pa.array(failed), pa.array(kept), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, names=["__id", *docstats.COUNTS, "base_failed", "kept", "score"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"))
    counts = ", ".join(f"{c} long" for c in docstats.COUNTS)
    id_type = rows.schema["__id"].dataType.simpleString()
    out = rows.mapInArrow(trimmed(judge), f"__id {id_type}, {counts}, base_failed boolean, kept boolean, score double")
    return out.withColumnRenamed("__id", id)


def keep_good(docs: DataFrame, forest: Forest, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass base rules and forest, with all their columns."""
    prepare(docs.sparkSession)
    position = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [_judge(*docstats.statistics(c), forest)[2] for c in textkit.chunks(batch.column(position))]
            if verdicts:
                yield batch.filter(pa.array(np.concatenate(verdicts)))

    return docs.mapInArrow(trimmed(keep), docs.schema)
