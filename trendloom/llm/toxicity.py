"""Toxicity by votes of the nearest labelled examples.

Texts are TF-IDF vectors over all terms, words and beginnings of words, of a bounded sample of examples,
known by 64-bit fingerprints. A term weighs more the more its presence depends on the label in the
sample, beyond what chance gives; frequent terms that tell no more than chance weigh nothing, so that
they need no postings. Document frequencies cover all documents. Examples are kept in an
inverted index: the postings of all terms but the ``HEAD`` most frequent ones, which are kept as a matrix cut into
blocks of ``BLOCK`` similar examples; each of these terms has a largest weight per block. A text's cosines over the
postings, and the sum of its other weights times these bounds, bound the cosine to any example of a
block, so a block is left out if that is below what the text's k-th best cosine is at least: the
neighbours are exact. Their votes, weighted by cosine, are turned into a probability by a logistic curve fitted to
the examples' own votes, each without itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import textkit
from trendloom.llm.common import in_fold, labelled_sample, prepare

# Most labelled examples, about.
SAMPLE = 6000
FOLDS, HELD = 5, 0
BEGINNINGS = (4, 5, 6)  # bytes, of longer words
HEAD = 1024  # terms kept as a matrix; it does not change results
CHANCE = 0.4  # squared standard deviations from what chance gives that count as none
RARE, FLOOR = 3, 1e-3  # terms of so few examples can't tell more than chance; they weigh a little
NEIGHBOURS = 31
BLOCK = 64
GROUP = 256  # texts searched at once
EVIDENCE = 3
PREDICT_AT = 0.5


def _terms(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Document and fingerprint of every word and beginning of a word."""
    found = textkit.words(chunk, textkit.alnum_table())
    documents = found.documents()
    owners, hashes = [documents], [textkit.word_hashes(chunk, found, lower=True)]
    for size in BEGINNINGS:
        longer = np.flatnonzero(found.ends - found.starts > size)
        starts = found.starts[longer]
        owners.append(documents[longer])
        hashes.append(textkit.mix64(textkit.segment_hashes(chunk.data, starts, starts + size, lower=True) + np.uint64(size)))
    return np.concatenate(owners), np.concatenate(hashes)


def _counted(documents: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each document, ascending: document, term, count."""
    order = np.lexsort((terms, documents))
    documents, terms = documents[order], terms[order]
    new = np.ones(len(terms), dtype=bool)
    new[1:] = (terms[1:] != terms[:-1]) | (documents[1:] != documents[:-1])
    at = np.flatnonzero(new)
    return documents[at], terms[at], np.diff(np.append(at, len(terms)))


class Vocabulary:
    """Sorted fingerprints of the terms, looked up from the first place of their first bits."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(np.uint64))
        bits = max(16, len(self.terms).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((self.terms >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = np.append(0, np.cumsum(sizes)).astype(np.int32)

    def __len__(self) -> int:
        return len(self.terms)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each fingerprint, or -1."""
        bucket = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            same = self.terms[at[left]] == hashes[left]
            out[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out

    def counts(self, chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms of the vocabulary in each document, ascending: document, place, count."""
        documents, hashes = _terms(chunk)
        places = self.places(hashes)
        hit = places >= 0
        size = max(1, len(self))
        keys = np.sort(documents[hit].astype(np.int64) * size + places[hit])
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        return keys[at] // size, keys[at] % size, np.diff(np.append(at, len(keys)))


def choose_vocabulary(examples: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The terms that tell of the label, ascending, and how much each of them does.

    That is by how many standard deviations the examples of label 1 with the term differ from what
    chance gives, with a correction for their being whole numbers, and less ``CHANCE`` in squares. Terms
    of at most ``RARE`` examples weigh ``FLOOR`` at least, so that a text with no others finds these; more
    frequent ones with nothing left weigh nothing in any text, and are left out. ``examples`` has ``__label`` and
    ``terms``, the distinct terms of each example. Spark counts them; what reaches the driver is
    bounded by the sample.
    """
    sizes = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("__label"), F.lit(0)).alias("ones")).first()
    share = float(sizes.ones) / max(sizes.n, 1)
    spread = share * (1 - share)
    counted = examples.select(F.col("__label").cast("double").alias("y"), F.explode("terms").alias("term"))
    counted = counted.groupBy("term").agg(F.sum("y").alias("a"), F.count("*").cast("double").alias("b"))
    off = F.greatest(F.abs(F.col("a") - F.col("b") * share) - 0.5, F.lit(0.0))
    squares = F.pow(off, F.lit(2.0)) / (F.col("b") * spread) if spread else F.lit(0.0)
    least = F.when(F.col("b") <= RARE, FLOOR).otherwise(0.0)
    relevance = F.greatest(F.sqrt(F.greatest(squares - CHANCE, F.lit(0.0))), least)
    found = counted.select("term", relevance.alias("relevance")).where("relevance > 0").toArrow()
    terms = found["term"].to_numpy().view(np.uint64)
    order = np.argsort(terms)
    return terms[order], found["relevance"].to_numpy()[order]


def frequencies(docs: DataFrame, text: str, vocabulary: Vocabulary) -> tuple[int, np.ndarray]:
    """How many documents there are, and in how many each term occurs."""
    size = max(1, len(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += batch.num_rows
            for chunk in textkit.chunks(batch.column(0)):
                sums += np.bincount(vocabulary.counts(chunk)[1], minlength=size)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(sums[some], total))], names=["term", "n"])

    found = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "term long, n long")
    rows = found.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms, times = rows["term"].to_numpy(), rows["n"].to_numpy()
    sums = np.zeros(size, dtype=np.int64)
    sums[terms[terms >= 0]] = times[terms >= 0]
    return int(times[terms < 0].sum()), sums[: len(vocabulary)]


@dataclass
class Index:
    """Examples by blocks: ``weights[term, example]`` and ``bounds[term, block]`` of the terms in ``head``.

    ``slots`` has the place of a term in ``head``, or -1; ``starts`` cuts the postings ``examples`` and
    ``values`` of the others by term.
    """

    vocabulary: Vocabulary
    idf: np.ndarray  # times the relevance of the term
    head: np.ndarray
    slots: np.ndarray
    starts: np.ndarray
    examples: np.ndarray
    values: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray
    labels: np.ndarray
    vote_weights: np.ndarray
    ids: np.ndarray
    prior: float
    curve: tuple[float, float] = (1.0, 0.0)
    opened: int = 0
    left_out: int = 0

    def vectors(self, documents: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """The weight of each term in its document; a document's vector has length 1."""
        x = (1 + np.log(counts)) * self.idf[terms]
        length = np.sqrt(np.bincount(documents, weights=x * x, minlength=n))
        return (x / np.maximum(length[documents], 1e-9)).astype(np.float32)

    def split(self, documents: np.ndarray, terms: np.ndarray, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors over the head, and cosines with all examples over the postings of the other terms."""
        slots = self.slots[terms]
        frequent = slots >= 0
        inner = np.zeros((n, len(self.head)), dtype=np.float32)
        inner[documents[frequent], slots[frequent]] = x[frequent]
        documents, terms, x = documents[~frequent], terms[~frequent], x[~frequent]
        rest = np.zeros((n, self.weights.shape[1]), dtype=np.float32)
        cuts = np.searchsorted(documents, np.arange(n + 1))
        for row, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a == b:
                continue
            first = self.starts[terms[a:b]]
            sizes = self.starts[terms[a:b] + 1] - first
            at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            rest[row] = np.bincount(self.examples[at], weights=np.repeat(x[a:b], sizes) * self.values[at], minlength=rest.shape[1])
        return inner, rest

    def search(self, documents: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, itself: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples of ``n`` texts, given by their terms in ascending order of documents."""
        inner, rest = self.split(documents, terms, self.vectors(documents, terms, counts, n), n)
        return self.nearest(inner, itself, rest)

    def nearest(self, x: np.ndarray, itself: np.ndarray | None = None, rest: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and places of the ``NEIGHBOURS`` nearest examples, best first; 0 and -1 beyond them.

        ``x`` are vectors over the head, ``rest`` the cosines over all other terms. ``itself`` is an
        example to leave out for each row. A block is left out where its bound is below the least that
        the k-th best can be, for all rows of the batch.
        """
        n, size = len(x), self.weights.shape[1]
        best = np.zeros((n, NEIGHBOURS), dtype=np.float32)
        where = np.full((n, NEIGHBOURS), -1, dtype=np.int64)
        if not size:
            return best, where
        cosines = np.zeros((n, size), dtype=np.float32) if rest is None else rest.copy()
        if itself is not None:
            cosines[np.arange(n), itself] = 0
        k = min(NEIGHBOURS, size)
        bound = x @ self.bounds + np.float32(1e-5) + np.maximum.reduceat(cosines, np.arange(0, size, BLOCK), axis=1)
        # each row's most promising block first; no weight is negative, so what is known so far is a
        # lower bound of every cosine, and a row's k-th best is at least that of these
        first = np.zeros(bound.shape[1], dtype=bool)
        first[bound.argmax(axis=1)] = True
        self._open(first, x, cosines)
        if itself is not None:
            cosines[np.arange(n), itself] = 0
        least = np.partition(cosines, size - k, axis=1)[:, size - k]
        others = (bound > np.maximum(least, 2e-5)[:, None]).any(axis=0) & ~first
        self._open(others, x, cosines)
        self.left_out += int(len(first) - (first | others).sum())
        if itself is not None:
            cosines[np.arange(n), itself] = 0
        top = np.sort(np.argpartition(cosines, size - k, axis=1)[:, size - k :], axis=1)
        found = np.take_along_axis(cosines, top, axis=1)
        order = np.argsort(-found, axis=1, kind="stable")
        best[:, :k] = np.take_along_axis(found, order, axis=1)
        where[:, :k] = np.take_along_axis(top, order, axis=1)
        where[best <= 0] = -1
        return best, where

    def _open(self, blocks: np.ndarray, x: np.ndarray, cosines: np.ndarray) -> None:
        """Add the head's part of all cosines in some blocks, a run of neighbours at a time."""
        edges = np.flatnonzero(np.diff(blocks.astype(np.int8), prepend=0, append=0))
        for a, b in zip(edges[::2] * BLOCK, edges[1::2] * BLOCK, strict=True):
            cosines[:, a:b] += x @ self.weights[:, a:b]
        self.opened += int(blocks.sum())

    def votes(self, cosines: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours by squared cosine; the prior counts as a weak vote."""
        weight = np.where(places >= 0, cosines.astype(np.float64) ** 2 * self.vote_weights[places], 0)
        pull = 0.02
        return ((weight * self.labels[places]).sum(axis=1) + pull * self.prior) / (weight.sum(axis=1) + pull)

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        slope, shift = self.curve
        v = np.clip(votes, 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-(slope * np.log(v / (1 - v)) + shift)))


def fit_curve(votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the votes' log-odds, by damped Newton steps."""
    v = np.clip(votes, 1e-4, 1 - 1e-4)
    x = np.column_stack([np.log(v / (1 - v)), np.ones(len(v))])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        g = x.T @ (weight * (p - y)) + 1e-2 * (beta - np.array([1.0, 0.0]))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(h, g), -1, 1)
    return max(float(beta[0]), 1e-3), float(beta[1])


def build(ids: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray, vocabulary: Vocabulary, idf: np.ndarray) -> Index:
    """The index over examples given as (terms, counts); examples without a term have no postings."""
    size, n = len(idf), len(y)
    share = float((weight @ y + 1) / (weight.sum() + 2)) if n else 0.5
    none, empty = np.zeros(0, np.int64), np.zeros((0, 0), np.float32)
    index = Index(vocabulary, idf, none, np.full(size, -1), np.zeros(size + 1, np.int64), none, np.zeros(0, np.float32), empty, empty, np.zeros(1), np.ones(1), np.zeros(1, object), share)
    if not n:
        return index
    terms, counts = np.concatenate([t for t, _ in rows]).astype(np.int32), np.concatenate([c for _, c in rows]).astype(np.float32)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t, _ in rows])
    x = index.vectors(owner, terms, counts, n)
    # similar examples into one block: by label, then by their heaviest terms
    heavy = np.zeros((n, 2), dtype=np.int64)
    by_weight = np.lexsort((terms, -x, owner))
    sizes = np.bincount(owner, minlength=n)
    first = np.cumsum(sizes) - sizes
    for i in (0, 1):
        at = by_weight[first[sizes > i] + i]
        heavy[owner[at], i] = terms[at]
    del by_weight
    order = np.lexsort((heavy[:, 1], heavy[:, 0], y))
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    index.labels, index.ids = y[order].astype(float), ids[order]
    # each label votes as it would if the examples were a plain sample
    index.vote_weights = (weight / weight.max())[order] ** 0.5
    found = np.bincount(terms, minlength=size)
    index.head = np.sort(np.argsort(-found, kind="stable")[:HEAD])
    index.slots[index.head] = np.arange(len(index.head))
    slots = index.slots[terms]
    frequent = slots >= 0
    index.weights = np.zeros((len(index.head), n), dtype=np.float32)
    index.weights[slots[frequent], place[owner[frequent]]] = x[frequent]
    blocks = np.arange(0, n, BLOCK)
    index.bounds = np.maximum.reduceat(index.weights, blocks, axis=1) if size else np.zeros((0, len(blocks)), np.float32)
    rare = np.flatnonzero(~frequent)
    rare = rare[np.lexsort((place[owner[rare]], terms[rare]))]
    index.examples, index.values = place[owner[rare]].astype(np.int32), x[rare]
    index.starts = np.append(0, np.cumsum(np.bincount(terms[rare], minlength=size)))
    votes = np.zeros(n)  # in the order given
    for low in range(0, n, GROUP):
        some = min(GROUP, n - low)
        a, b = np.searchsorted(owner, [low, low + some])
        votes[low : low + some] = index.votes(*index.search(owner[a:b] - low, terms[a:b], counts[a:b], some, place[low : low + some]))
    index.curve = fit_curve(votes, y.astype(float), weight / weight.mean())
    return index


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Index:
    """An index of about ``sample`` labelled documents outside the held-out fold."""
    prepare(docs.sparkSession)
    chosen = labelled_sample(labels.where(~in_fold(F.col(f"`{id}`"), FOLDS, HELD)), id, label, sample, "toxicity")
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"))
    rows = rows.join(F.broadcast(chosen), "__id").select("__text", "__id", "__label", "__weight")

    def all_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for chunk in textkit.chunks(batch.column(0)):
                documents, terms, _ = _counted(*_terms(chunk))
                cuts = np.searchsorted(documents, np.arange(chunk.n + 1))
                lists += [terms[a:b].view(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(lists, pa.list_(pa.int64()))], names=["__label", "terms"])

    terms, relevance = choose_vocabulary(rows.mapInArrow(all_terms, "__label int, terms array<long>"))
    vocabulary = Vocabulary(terms)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, counts = [], []
            for chunk in textkit.chunks(batch.column(0)):
                documents, own, times = vocabulary.counts(chunk)
                cuts = np.searchsorted(documents, np.arange(chunk.n + 1))
                places += [own[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:], strict=False)]
                counts += [times[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:], strict=False)]
            arrays = [*batch.columns[1:], pa.array(places, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[1:], "places", "counts"])

    id_type = chosen.schema["__id"].dataType.simpleString()
    found = rows.mapInArrow(featurise, f"__id {id_type}, __label int, __weight double, places array<int>, counts array<int>")
    one = found.groupBy("__id").agg(F.min(F.struct("places", "counts", "__label", "__weight")).alias("r")).select("__id", "r.*")
    got = one.orderBy("__id").toArrow()  # numbers stay packed: an example has hundreds of terms
    total, counted = frequencies(docs, text, vocabulary)
    idf = ((np.log((total + 1) / (counted + 1)) + 1e-3) * relevance).astype(np.float32)
    examples = [(p.values.to_numpy(), c.values.to_numpy()) for p, c in zip(got["places"], got["counts"], strict=True)]
    ids = np.array(got["__id"].to_pylist(), dtype=object)
    return build(ids, examples, got["__label"].to_numpy().astype(np.int64), got["__weight"].to_numpy(), vocabulary, idf)


def scored(docs: DataFrame, index: Index, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``score`` (0 to 1), ``predicted``, and ``evidence``: the nearest examples as text.

    A text without a term of any example, as a null or empty one, has no neighbours: its score is
    the share of label 1, calibrated. Null ids and repeated rows are scored like any other.
    """
    prepare(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            evidence: list[str] = []
            for chunk in textkit.chunks(batch.column(0)):
                documents, terms, counts = index.vocabulary.counts(chunk)
                for at in range(0, chunk.n, GROUP):
                    n = min(GROUP, chunk.n - at)
                    a, b = np.searchsorted(documents, [at, at + n])
                    cosines, places = index.search(documents[a:b] - at, terms[a:b], counts[a:b], n)
                    scores[chunk.first + at : chunk.first + at + n] = index.calibrated(index.votes(cosines, places))
                    for c, p in zip(cosines[:, :EVIDENCE], places[:, :EVIDENCE], strict=True):
                        evidence.append(" ".join(f"{index.ids[j]}:{v:.3f}" for v, j in zip(c, p, strict=True) if j >= 0))
            predicted = (scores >= PREDICT_AT).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(scores), pa.array(predicted), pa.array(evidence, pa.string())], names=["__id", "score", "predicted", "evidence"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"))
    out = rows.mapInArrow(score, f"__id {rows.schema['__id'].dataType.simpleString()}, score double, predicted int, evidence string")
    return out.withColumnRenamed("__id", id)
