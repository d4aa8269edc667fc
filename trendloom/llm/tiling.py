"""Finding benchmark items in documents by greedy string tiling.

A *tile* is a run of words that stands in the document and in the item, neither of which shares a
word with another tile. Tiles are marked longest first, so an item is recognised when its parts come
in another order or with text between them. An item is contaminated by a document if tiles cover
at least ``COVERAGE`` of its words; words are runs of letters and digits in lower case.

The pairs to tile come from a join on seeds, windows of ``SHORTEST`` words. Documents are scanned once
against a bit table of the seeds, of fixed size, that only ever lets too many windows pass; the
windows that pass are counted over all documents and joined with an item's seeds. An item leaves out its
most frequent seeds, as many as can't cover enough of it by themselves: a pair that reaches the
coverage shares another one, so openings that all items and many documents share make no pairs. Pairs
whose shared windows don't cover enough of the item go before any text is moved. The benchmark is
not broadcast, and may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import textkit
from trendloom.llm.common import prepare, stored, trimmed, unused
from trendloom.llm.jaccard import row_key, small

SHORTEST = 5
COVERAGE_PERCENT = 50
TABLE_BITS = 24  # two megabytes


def _hashed(texts: pa.Array) -> Iterator[tuple[textkit.Chunk, np.ndarray, textkit.Words]]:
    lowered = pc.utf8_lower(texts.fill_null(""))
    for chunk in textkit.chunks(lowered):
        found = textkit.words(chunk, textkit.alnum_table())
        yield chunk, textkit.word_hashes(chunk, found), found


def word_fingerprints(texts: pa.Array) -> list[np.ndarray]:
    """The fingerprints of the words of each text."""
    out = []
    for chunk, hashes, found in _hashed(texts):
        out += [hashes[found.offsets[i] : found.offsets[i + 1]] for i in range(chunk.n)]
    return out


# --- greedy string tiling -----------------------------------------------------------------------


class Rolling:
    """Karp-Rabin fingerprints of all windows of a length, from running sums over the words."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, words: np.ndarray):
        n = len(words)
        factors = np.full(n + 1, self.BASE, dtype=np.uint64)
        factors[0] = 1
        self.powers = np.multiply.accumulate(factors)
        inverse = np.full(n + 1, pow(self.BASE, -1, 2**64), dtype=np.uint64)
        inverse[0] = 1
        self.inverses = np.multiply.accumulate(inverse)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * self.powers[:n], out=self.sums[1:])
        self.n = n

    def windows(self, length: int, at: np.ndarray) -> np.ndarray:
        return textkit.mix64((self.sums[at + length] - self.sums[at]) * self.inverses[at])


def _free_runs(free: np.ndarray) -> np.ndarray:
    """For each word, how many unmarked words start at it."""
    n = len(free)
    taken = np.flatnonzero(~free)
    stop = np.append(taken, n)
    return stop[np.searchsorted(stop, np.arange(n))] - np.arange(n)


def tiles(document: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles as (length, place in the item, place in the document), longest first.

    Of matches of one length the first in the item, then in the document, is marked. The longest match
    is found by halving over its length, as a match holds matches of every smaller length; each trial
    compares the rolling fingerprints of all unmarked windows.
    """
    out: list[tuple[int, int, int]] = []
    a, b = Rolling(item), Rolling(document)
    free_a, free_b = np.ones(a.n, dtype=bool), np.ones(b.n, dtype=bool)
    most = min(a.n, b.n)
    while most >= shortest:
        run_a, run_b = _free_runs(free_a), _free_runs(free_b)

        def match(length: int, run_a=run_a, run_b=run_b):
            at_a, at_b = np.flatnonzero(run_a >= length), np.flatnonzero(run_b >= length)
            if not len(at_a) or not len(at_b):
                return None
            seen = b.windows(length, at_b)
            order = np.argsort(seen, kind="stable")
            own = a.windows(length, at_a)
            place = np.minimum(np.searchsorted(seen, own, sorter=order), len(order) - 1)
            hit = np.flatnonzero(seen[order[place]] == own)
            return (int(at_a[hit[0]]), int(at_b[order[place[hit[0]]]])) if len(hit) else None

        low, best, high = shortest, match(shortest), most
        if best is None:
            break
        while low < high:
            middle = (low + high + 1) // 2
            found = match(middle)
            if found is None:
                high = middle - 1
            else:
                low, best = middle, found
        i, j = best
        free_a[i : i + low] = False
        free_b[j : j + low] = False
        out.append((low, i, j))
        most = low
    return out


# --- seeds --------------------------------------------------------------------------------------


def _seeds(hashes: np.ndarray, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of windows of a length, told apart by it, and their first words."""
    windows, first = textkit.shingles(hashes, owners, length)
    return textkit.mix64(windows ^ np.uint64(length)), first


def _item_seeds(shortest: int):
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, key, item in zip(word_fingerprints(batch.column(0)), batch.column(1), batch.column(2), strict=True):
                if not len(words):
                    continue
                length = min(shortest, len(words))
                own = _seeds(words, np.zeros(len(words), np.int64), length)[0]
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64)), pa.array(np.arange(n)), pa.array([length] * n, pa.int32()), pa.array([len(words)] * n, pa.int64()), pa.array([key.as_py()] * n, pa.binary()), pa.array([item.as_py()] * n, item.type)],
                    names=["seed", "place", "length", "words", "item_key", "__item"],
                )

    return seeds


def covered(places: np.ndarray, length: int) -> int:
    """Words that windows of a length at ascending places cover."""
    return int(np.minimum(np.diff(places, append=places[-1] + length if len(places) else 0), length).sum())


def rarest(places: list[np.ndarray], times: np.ndarray, length: int, words: int, percent: int) -> np.ndarray:
    """Which seeds of an item to look for: all but the most frequent that together cover too little.

    ``places`` holds the places of each seed in the item, ``times`` in how many documents it stands.
    """
    look = np.ones(len(places), dtype=bool)
    taken = np.zeros(words + 1, dtype=bool)
    for seed in np.argsort(-times, kind="stable"):
        more = taken.copy()
        for at in places[seed]:
            more[at : at + length] = True
        if 100 * int(more.sum()) >= percent * words:
            break
        taken, look[seed] = more, False
    return look


def _looked_for(percent: int):
    """The seeds of each item to look for; an item's rows stand together, in order of their seeds."""

    def chosen(rows: list[tuple]) -> list[tuple]:
        own: dict[int, list] = {}
        for seed, place, times, length, words, key in rows:
            own.setdefault(seed, [[], times])[0].append(place)
        times = np.array([t for _, t in own.values()])
        look = rarest([np.array(p) for p, _ in own.values()], times, length, words, percent)
        return [(seed, key) for seed, ok in zip(own, look, strict=True) if ok and own[seed][1]]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if group and row[-1] != group[0][-1]:
                    out += chosen(group)
                    group = []
                group.append(row)
            if out:
                yield _look_batch(out)
        if group:
            yield _look_batch(chosen(group))

    return look


def _look_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["seed", "item_key"])


def _covering(percent: int):
    """Pairs whose shared windows cover enough of the item."""

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for own, seeds, places, length, words in zip(*[c.to_pylist() for c in batch.columns[:5]], strict=True):
                shared = set(own)
                at = np.array(sorted(p for s, p in zip(seeds, places, strict=True) if s in shared), dtype=np.int64)
                kept.append(100 * covered(at, length) >= percent * words)
            yield pa.RecordBatch.from_arrays(batch.columns[5:], names=batch.schema.names[5:]).filter(pa.array(kept, pa.bool_()))

    return cover


def _probes(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << TABLE_BITS) - 1)
    return seeds & mask, (seeds >> np.uint64(32)) & mask


def bit_table(seeds: DataFrame) -> np.ndarray:
    """Two bits per seed in a table of ``2**TABLE_BITS`` bits, OR-combined by Spark."""
    mask = F.lit((1 << TABLE_BITS) - 1).cast("long")
    places = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(mask), F.shiftrightunsigned("seed", 32).bitwiseAND(mask))).alias("p"))
    words = places.groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 31 AS int))")).alias("bits"))
    got = words.toPandas()
    table = np.zeros(1 << (TABLE_BITS - 5), dtype=np.uint32)
    table[got["w"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint32)
    return table


def _scan(table: np.ndarray, lengths: list[int]):
    """Documents with a window that passes the bit table, with those windows."""

    def is_set(place: np.ndarray) -> np.ndarray:
        return (table[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists = [], []
            for chunk, hashes, found in _hashed(batch.column(0)):
                owners = found.documents()
                passed, holders = [], []
                for length in lengths:
                    seeds, first = _seeds(hashes, owners, length)
                    one, two = _probes(seeds)
                    hit = np.flatnonzero(is_set(one))
                    hit = hit[is_set(two[hit])]
                    passed.append(seeds[hit])
                    holders.append(owners[first[hit]])
                passed, holders = np.concatenate(passed), np.concatenate(holders)
                for row in np.unique(holders):
                    rows.append(chunk.first + int(row))
                    lists.append(np.unique(passed[holders == row]).view(np.int64))
            if rows:
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(lists, pa.list_(pa.int64()))], names=[*batch.schema.names, "seeds"])

    return scan


def _tile(shortest: int, percent: int):
    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents, items = word_fingerprints(batch.column(0)), word_fingerprints(batch.column(1))
            counts = []
            for document, item in zip(documents, items, strict=True):
                found = tiles(document, item, min(shortest, len(item)))
                lengths = [t[0] for t in found]
                counts.append((len(found), max(lengths, default=0), sum(lengths), len(item)))
            table = np.array(counts, dtype=np.int64).reshape(-1, 4)
            arrays = [*batch.columns[2:], *[pa.array(c) for c in table.T.copy()]]
            out = pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[2:], "n_tiles", "longest_tile", "covered_words", "item_words"])
            yield out.filter(pa.array(100 * table[:, 2] >= percent * np.maximum(table[:, 3], 1)))

    return tile


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    shortest: int = SHORTEST,
    percent: int = COVERAGE_PERCENT,
) -> DataFrame:
    """Pairs of a document and a benchmark item whose tiles cover ``percent`` of the item's words.

    Returns ``id``, ``item``, ``n_tiles``, ``longest_tile``, ``covered_words``, ``item_words``, ``coverage``
    and ``row_key``. An item shorter than ``shortest`` counts if it stands in the document as a whole;
    null and empty texts, on either side, match nothing. Null ids are kept; repeated rows are reported
    once; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.col(f"`{item_text}`").cast("string").alias("__text"), row_key(item, item_text).alias("item_key"), F.col(f"`{item}`").alias("__item"))
    item_type = items.schema["__item"].dataType.simpleString()
    seeds = items.mapInArrow(_item_seeds(shortest), f"seed long, place long, length int, words long, item_key binary, __item {item_type}")
    seeds = stored(seeds.distinct(), "tiling-seeds")
    lengths = sorted(r["length"] for r in seeds.select("length").distinct().collect())  # 1 to ``shortest``
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"), row_key(id, text).alias("row_key"))
    id_type = rows.schema["__id"].dataType.simpleString()
    found = rows.mapInArrow(_scan(bit_table(seeds), lengths), f"__text string, __id {id_type}, row_key binary, seeds array<long>") if lengths else rows.where("false").withColumn("seeds", F.array().cast("array<long>"))
    hits = stored(found, "tiling-hits")

    # the most frequent windows are counted in each task before they meet
    times = hits.select("row_key", F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count("*").alias("times"))
    counted = seeds.join(times, "seed", "left").select("seed", "place", F.coalesce("times", F.lit(0)).alias("times"), "length", "words", "item_key")
    looked_for = counted.repartition("item_key").sortWithinPartitions("item_key", "seed").mapInArrow(_looked_for(percent), "seed long, item_key binary")
    found = hits.select("row_key", F.explode("seeds").alias("seed")).join(looked_for, "seed").select("row_key", "item_key").distinct()
    windows = seeds.groupBy("item_key").agg(
        F.collect_list(F.struct("seed", "place")).alias("w"), F.max("length").alias("length"), F.max("words").alias("words"), F.min("__item").alias("__item")
    )
    found = found.join(hits.select("row_key", "seeds").dropDuplicates(["row_key"]), "row_key").join(windows, "item_key")
    found = found.select("seeds", F.col("w.seed").alias("item_seeds"), F.col("w.place").alias("places"), "length", "words", "row_key", "item_key", "__item")
    pairs = found.mapInArrow(_covering(percent), f"row_key binary, item_key binary, __item {item_type}")
    texts = hits.select("row_key", "__text", "__id").dropDuplicates(["row_key"])
    item_texts = items.select("item_key", F.col("__text").alias("__item_text")).dropDuplicates(["item_key"])
    joined = pairs.join(texts, "row_key").join(item_texts, "item_key").select("__text", "__item_text", "__id", "__item", "row_key")
    counts = "n_tiles long, longest_tile long, covered_words long, item_words long"
    tiled = joined.mapInArrow(trimmed(_tile(shortest, percent)), f"__id {id_type}, __item {item_type}, row_key binary, {counts}")
    return tiled.select(
        F.col("__id").alias(id), F.col("__item").alias(item), "n_tiles", "longest_tile", "covered_words", "item_words",
        (F.col("covered_words") / F.col("item_words")).alias("coverage"), "row_key",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contaminate no item, with all their columns."""
    key = unused(docs, "__key")
    flagged = contaminated(docs, benchmark, id, text, item, item_text).select(F.col("row_key").alias(key)).distinct()
    flagged = stored(flagged, "tiling-flagged")
    keyed = docs.withColumn(key, row_key(id, text))
    return keyed.join(small(flagged), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
