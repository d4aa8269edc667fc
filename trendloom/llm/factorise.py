"""Quality score by a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(b + w.x + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The pairwise term costs one product with ``v`` and one with its squares, so scoring is linear in
the features of a document. Words are hashed to ``BINS`` bins and count as present or absent,
scaled to unit length; statistics and the stated length are standardised and clipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import docstats, textkit
from trendloom.llm.common import in_fold, labelled_sample, prepare

SAMPLE = 6000
FOLDS, HELD = 5, 0
BINS, FACTORS = 4096, 8
EPOCHS, BATCH, RATE = 12, 128, 0.05
DECAY_LINEAR, DECAY_FACTORS = 1e-3, 1e-3
PREDICT_AT = 0.3
GROUP = 256  # documents scored at once


def word_bins(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed words of each document: document and bin, ascending."""
    found = textkit.words(chunk, textkit.alnum_table())
    bins = (textkit.word_hashes(chunk, found, lower=True) >> np.uint64(64 - 12)).astype(np.int64)
    pairs = np.unique(found.documents() * BINS + bins)
    return pairs // BINS, pairs % BINS


def dense_words(documents: np.ndarray, bins: np.ndarray, n: int) -> np.ndarray:
    x = np.zeros((n, BINS), dtype=np.float32)
    x[documents, bins] = 1
    return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def structure(ratios: np.ndarray, stated: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Statistics, and metadata: the stated length, and how it compares with the text's own."""
    return np.column_stack([ratios, np.log1p(np.maximum(stated, 0)), np.log1p(np.maximum(stated, 0)) - np.log1p(sizes)])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def rows(self, words: np.ndarray, other: np.ndarray) -> np.ndarray:
        z = np.clip((other - self.mean) / self.scale, -3, 3).astype(np.float32)
        return np.hstack([words, z / np.float32(np.sqrt(z.shape[1]))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        sums = x @ self.factors
        pairs = 0.5 * ((sums**2).sum(axis=1) - (x**2) @ (self.factors**2).sum(axis=1))
        return self.bias + x @ self.linear + pairs

    def score(self, words: np.ndarray, other: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(self.rows(words, other)).astype(np.float64)))


def fit(words: np.ndarray, other: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Machine:
    """AdaGrad on logistic loss; without both labels the score is a constant."""
    width = BINS + other.shape[1]
    random = np.random.default_rng(5)
    share = (weight @ y + 1) / (weight.sum() + 2)
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(width, np.float32),
        (random.standard_normal((width, FACTORS)) * 0.01).astype(np.float32),
        other.mean(axis=0) if len(other) else np.zeros(other.shape[1]),
        np.maximum(other.std(axis=0), 1e-6) if len(other) else np.ones(other.shape[1]),
    )
    if len(y) == 0 or y.min() == y.max():
        machine.factors[:] = 0
        return machine
    weight = (weight / weight.mean()).astype(np.float32)
    squares = [1e-6, np.full(width, 1e-6, np.float32), np.full((width, FACTORS), 1e-6, np.float32)]
    for _ in range(EPOCHS):
        order = random.permutation(len(y))
        for at in range(0, len(y), BATCH):
            pick = order[at : at + BATCH]
            x = machine.rows(words[pick], other[pick])
            sums = x @ machine.factors
            error = (1 / (1 + np.exp(-machine.raw(x))) - y[pick]) * weight[pick] / len(pick)
            steps = [
                float(error.sum()),
                x.T @ error + DECAY_LINEAR / len(y) * machine.linear,
                x.T @ (sums * error[:, None]) - ((x**2).T @ error)[:, None] * machine.factors + DECAY_FACTORS / len(y) * machine.factors,
            ]
            for i, g in enumerate(steps):
                squares[i] = squares[i] + np.square(g)
            machine.bias -= RATE * steps[0] / np.sqrt(squares[0])
            machine.linear -= (RATE * steps[1] / np.sqrt(squares[1])).astype(np.float32)
            machine.factors -= (RATE * steps[2] / np.sqrt(squares[2])).astype(np.float32)
    return machine


def _features(chunk: textkit.Chunk, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    documents, bins = word_bins(chunk)
    sizes = docstats.statistics(chunk)
    lengths = textkit.per_document((chunk.data & 0xC0) != 0x80, chunk.offsets)
    return documents, bins, structure(sizes[1], stated[chunk.first : chunk.first + chunk.n], lengths)


def _stated(batch: pa.RecordBatch, column: int, text: int) -> np.ndarray:
    """The stated length; where it is null, zero."""
    return batch.column(column).fill_null(0).to_numpy(zero_copy_only=False).astype(float)


def _inputs(docs: DataFrame, id: str, text: str, length: str | None) -> DataFrame:
    stated = F.col(f"`{length}`").cast("long") if length in docs.columns else F.length(F.col(f"`{text}`").cast("string")).cast("long")
    return docs.select(F.col(f"`{text}`").cast("string").alias("__text"), stated.alias("__length"), F.col(f"`{id}`").alias("__id"))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", length: str | None = "n_chars", label: str = "quality", sample: int = SAMPLE) -> Machine:
    """A machine from about ``sample`` labelled documents outside the held-out fold.

    A task turns its documents into bins and numbers; only those of the sample reach the driver.
    """
    prepare(docs.sparkSession)
    chosen = labelled_sample(labels.where(~in_fold(F.col(f"`{id}`"), FOLDS, HELD)), id, label, sample, "factorise")
    rows = _inputs(docs, id, text, length).join(F.broadcast(chosen), "__id").select("__text", "__length", "__id", "__label", "__weight")

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, numbers = [], []
            stated = _stated(batch, 1, 0)
            for chunk in textkit.chunks(batch.column(0)):
                documents, own, other = _features(chunk, stated)
                cuts = np.searchsorted(documents, np.arange(chunk.n + 1))
                bins += [own[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:], strict=False)]
                numbers += list(other)
            arrays = [*batch.columns[2:], pa.array(bins, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[2:], "__bins", "__x"])

    id_type = chosen.schema["__id"].dataType.simpleString()
    found = rows.mapInArrow(featurise, f"__id {id_type}, __label int, __weight double, __bins array<int>, __x array<double>")
    one = found.groupBy("__id").agg(F.min(F.struct("__x", "__bins", "__label", "__weight")).alias("r")).select("__id", "r.*")
    got = one.orderBy("__id").toPandas()
    words = np.zeros((len(got), BINS), dtype=np.float32)
    for i, bins in enumerate(got["__bins"]):
        words[i, np.asarray(bins, dtype=np.int64)] = 1 / np.sqrt(max(1, len(bins)))
    other = np.array(got["__x"].tolist()).reshape(len(got), len(docstats.RATIOS) + 2)
    return fit(words, other, got["__label"].to_numpy(np.float32), got["__weight"].to_numpy(np.float32))


def scored(docs: DataFrame, machine: Machine, id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``id``, ``score`` (0 to 1) and ``predicted`` for every document.

    A null or empty text is scored on its statistics, all zero; a null length counts as zero. Null ids
    and repeated rows are scored like any other.
    """
    prepare(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stated = _stated(batch, 1, 0)
            scores = np.zeros(batch.num_rows)
            for chunk in textkit.chunks(batch.column(0)):
                documents, bins, other = _features(chunk, stated)
                for at in range(0, chunk.n, GROUP):
                    n = min(GROUP, chunk.n - at)
                    a, b = np.searchsorted(documents, [at, at + n])
                    dense = dense_words(documents[a:b] - at, bins[a:b], n)
                    scores[chunk.first + at : chunk.first + at + n] = machine.score(dense, other[at : at + n])
            predicted = (scores >= PREDICT_AT).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(scores), pa.array(predicted)], names=["__id", "score", "predicted"])

    rows = _inputs(docs, id, text, length)
    out = rows.mapInArrow(score, f"__id {rows.schema['__id'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("__id", id)
