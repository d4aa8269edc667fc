"""Language of texts by sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are read from the UTF-8 bytes of the whole text: letters in lower case (ASCII and
Latin-1), everything in ASCII that is no letter as one space. N-grams of one to three characters are
hashed to ``BINS`` bins; a text is the square roots of its counts times the inverse document
frequency, scaled to unit length. Document frequencies cover every document learned from; weights
are trained on a bounded sample by follow-the-regularised-leader with elastic-net penalties, and a
temperature fitted on a part of the sample turns scores into calibrated probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.llm import textkit
from trendloom.llm.common import in_fold, prepare, trimmed

FOLDS, HELD = 4, 2
BITS = 13
BINS = 1 << BITS
GRAMS = (1, 2, 3)
# Most documents of one language that training reads, and about the most of all; two of each at least.
PER_LANGUAGE, SAMPLE = 300, 12_000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 1e-3, 1e-3
CALIBRATION = 5  # every fifth document of the sample
UNKNOWN = "und"
# The pipeline keeps a document whose language is known with at least this probability.
KEEP_AT = 0.5
GROUP = 64  # documents counted at once

_SPACE = np.uint32(0x20)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], dtype=np.uint32)


def _byte_classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 0x20
    for upper, lower in zip(range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), strict=True):
        table[upper] = table[lower] = lower
    return table


_CLASSES = _byte_classes()


def characters(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of the chunk, runs of spaces as one, and each document's first character."""
    data = np.concatenate([_CLASSES[chunk.data], np.zeros(3, np.uint8)])
    size = len(chunk.data)
    lead = np.flatnonzero((chunk.data & 0xC0) != 0x80)
    first = data[lead].astype(np.uint32)
    second = data[lead + 1].astype(np.uint32)
    # capital letters of Latin-1 stand 32 before their small ones; the multiplication sign has none
    capital = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
    second = second + capital * np.uint32(0x20)
    code = first | np.where(first >= 0xC0, second << np.uint32(8), np.uint32(0))
    long = np.flatnonzero(first >= 0xE0)
    code[long] |= data[lead[long] + 2].astype(np.uint32) << np.uint32(16)
    longer = np.flatnonzero(first >= 0xF0)
    code[longer] |= data[lead[longer] + 3].astype(np.uint32) << np.uint32(24)
    place = np.searchsorted(lead, chunk.offsets)
    starts = np.zeros(len(code) + 1, dtype=bool)
    starts[place] = True
    kept = np.ones(len(code), dtype=bool)
    kept[1:] = (code[1:] != _SPACE) | (code[:-1] != _SPACE) | starts[1:-1]
    sums = np.zeros(len(code) + 1, dtype=np.int64)
    np.cumsum(kept, out=sums[1:])
    assert size == 0 or len(code) <= size
    return code[kept], sums[place]


def gram_counts(chunk: textkit.Chunk) -> Iterator[tuple[int, np.ndarray]]:
    """Counts of hashed n-grams, documents by bins, for ``GROUP`` documents at a time."""
    codes, offsets = characters(chunk)
    for at in range(0, chunk.n, GROUP):
        to = min(at + GROUP, chunk.n)
        own = codes[offsets[at] : offsets[to]]
        documents = np.repeat(np.arange(to - at), np.diff(offsets[at : to + 1]))
        counts = np.zeros((to - at) * BINS, dtype=np.int64)
        mixed = [own * f for f in _FACTORS]
        for n in GRAMS:
            if len(own) < n:
                continue
            gram = mixed[0][: len(own) - n + 1].copy()
            for j in range(1, n):
                gram = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + mixed[j][j : len(own) - n + 1 + j]
            gram = (gram ^ (gram >> np.uint32(16))) * np.uint32(0x297A2D39 + 2 * n)
            bins = (gram >> np.uint32(32 - BITS)).astype(np.int64)
            owner = documents[: len(bins)]
            inside = owner == documents[n - 1 :]
            spaces = own[: len(bins)] == _SPACE if n == 1 else False
            use = inside & ~spaces if n == 1 else inside
            counts += np.bincount((owner * BINS + bins)[use], minlength=len(counts))
        yield chunk.first + at, counts.reshape(to - at, BINS)


def has_letter(texts: pa.Array, chunk: textkit.Chunk) -> np.ndarray:
    """Whether each document has a letter of any script."""
    some = textkit.per_document(_CLASSES[chunk.data] > 0x60, chunk.offsets) > 0
    ascii_some = textkit.per_document((_CLASSES[chunk.data] > 0x60) & (chunk.data < 0x80), chunk.offsets) > 0
    for row in np.flatnonzero(some & ~ascii_some):
        some[row] = any(ch.isalpha() for ch in texts[chunk.first + int(row)].as_py())
    return some


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """How many documents there are, and in how many each bin occurs; ``BINS`` sums in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            total += batch.num_rows
            for chunk in textkit.chunks(batch.column(0)):
                for _, counts in gram_counts(chunk):
                    sums += (counts > 0).sum(axis=0)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(sums[seen], total))], names=["bin", "n"])

    found = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(trimmed(count), "bin long, n long")
    rows = found.groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros(BINS, dtype=np.int64)
    inner = rows[rows["bin"] >= 0]
    sums[inner["bin"].to_numpy()] = inner["n"].to_numpy()
    return int(rows.loc[rows["bin"] < 0, "n"].sum()), sums


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts.astype(np.float32)) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return softmax((self.vectors(counts) @ self.weights + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, width: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; the last coordinate is a bias that isn't penalised."""
    z = np.zeros((width + 1, classes))
    n = np.zeros((width + 1, classes))
    l1 = np.full((width + 1, 1), L1)
    l2 = np.full((width + 1, 1), L2)
    l1[-1] = l2[-1] = 0

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + l2[at])

    random = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            bins, values = rows[i]
            at = np.append(bins, width)
            x = np.append(values, 1.0)
            w = weights(at)
            p = softmax((x @ w)[None, :])[0]
            p[labels[i]] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    final = weights(np.arange(width + 1))
    return final[:-1], final[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, on a fixed grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 5, 60)
    losses = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def train(docs: DataFrame, learn: Column | None = None, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows ``learn`` picks (the default: all outside the held-out fold) with a language.

    Every language is learned: at most ``PER_LANGUAGE`` documents of each are sampled by a hash of their
    id, and fewer where there are so many languages that ``SAMPLE`` would be passed. A model has
    ``BINS`` weights for each language. Without any, the model knows no language.
    """
    prepare(docs.sparkSession)
    pick = ~in_fold(F.col(f"`{id}`"), FOLDS, HELD) if learn is None else learn
    rows = docs.where(pick & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{lang}`").cast("string").alias("__lang"), F.col(f"`{id}`").cast("string").alias("__id"))
    total, frequencies = document_frequencies(rows, "__text")
    sizes = rows.groupBy("__lang").agg(F.count("*").alias("__n")).collect()
    languages = sorted(r["__lang"] for r in sizes)
    idf = np.log((total + 1) / (frequencies + 1)).astype(np.float32) + np.float32(1e-3)
    model = Model(languages, idf, np.zeros((BINS, len(languages))), np.zeros(len(languages)), 1.0)
    if not languages:
        return model
    most = max(2, min(PER_LANGUAGE, SAMPLE // len(languages)))
    draw = F.xxhash64(F.lit("language"), "__id")
    # a row per language, as many as the model has
    known = docs.sparkSession.createDataFrame(sizes, "__lang string, __n long")
    drawn = rows.join(F.broadcast(known), "__lang").where(F.pmod(draw, F.lit(1 << 30)) / float(1 << 30) < 3.0 * most / F.col("__n"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, values = [], []
            for chunk in textkit.chunks(batch.column(0)):
                for _, counts in gram_counts(chunk):
                    for x in model.vectors(counts):
                        own = np.flatnonzero(x)
                        bins.append(own.astype(np.int32))
                        values.append(x[own])
            arrays = [batch.column(1), batch.column(2), pa.array(bins, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "draw", "bins", "x"])

    found = drawn.select("__text", "__lang", draw.alias("draw")).mapInArrow(trimmed(featurise), "lang string, draw long, bins array<int>, x array<float>")
    best = Window.partitionBy("lang").orderBy("draw", "bins")
    got = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= most).orderBy("lang", "r").toPandas()
    place = {name: i for i, name in enumerate(languages)}
    examples = [(np.asarray(b, dtype=np.int64), np.asarray(x, dtype=float)) for b, x in zip(got["bins"], got["x"], strict=True)]
    labels = np.array([place[name] for name in got["lang"]], dtype=np.int64)
    aside = got["r"].to_numpy() % CALIBRATION == 0
    model.weights, model.bias = follow_the_leader([e for e, a in zip(examples, aside, strict=True) if not a], labels[~aside], BINS, len(languages))
    logits = np.array([x @ model.weights[b] + model.bias for (b, x), a in zip(examples, aside, strict=True) if a]).reshape(-1, len(languages))
    model.temperature = calibrate(logits, labels[aside])
    model.weights = model.weights.astype(np.float32)
    model.bias = model.bias.astype(np.float32)
    return model


def predict_column(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Predicted language and its probability; ``und`` and 0 without a letter or a learned language."""
    names = np.full(len(texts), UNKNOWN, dtype=object)
    scores = np.zeros(len(texts))
    known = np.array(model.languages, dtype=object)
    for chunk in textkit.chunks(texts):
        letters = has_letter(texts, chunk)
        for at, counts in gram_counts(chunk):
            if not len(known):
                continue
            p = model.probabilities(counts)
            n = len(counts)
            ok = letters[at - chunk.first : at - chunk.first + n]
            names[at : at + n] = np.where(ok, known[p.argmax(axis=1)], UNKNOWN)
            scores[at : at + n] = np.where(ok, p.max(axis=1), 0.0)
    return names, scores


def predicted(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` for every document.

    A null or empty text, or one without a letter, is ``und`` with score 0. Null ids and repeated
    rows are predicted like any other; other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = predict_column(batch.column(0), model)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["__id", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"))
    out = rows.mapInArrow(trimmed(predict), f"__id {rows.schema['__id'].dataType.simpleString()}, lang_pred string, score double")
    return out.withColumnRenamed("__id", id)


def keep_known(docs: DataFrame, model: Model, text: str = "text", at_least: float = KEEP_AT) -> DataFrame:
    """The rows whose language is known with probability ``at_least``, with all their columns.

    A model that has learned no language rejects only what has no letter.
    """
    prepare(docs.sparkSession)
    position = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(position)
            if model.languages:
                names, scores = predict_column(texts, model)
                kept = (names != UNKNOWN) & (scores >= at_least)
            else:
                kept = np.concatenate([has_letter(texts, chunk) for chunk in textkit.chunks(texts)] or [np.zeros(0, bool)])
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(trimmed(keep), docs.schema)
