"""Joining texts whose sets of word shingles overlap: exact Jaccard similarity by signature trees.

1. Texts become sets of 64-bit shingle fingerprints. Equal sets are one *class*, by a 128-bit digest.
2. Classes that could be linked are brought together without listing pairs. Two sets of similarity
   ``percent`` or more differ in at most ``H`` shingles, a number that follows from their size
   class. Shingles are dealt into more than ``H`` parts by hash, so some parts of two such sets are
   equal; classes with an equal part belong to one *candidate group*. Parts with few shingles,
   and shingles that many texts share, are left out as far as enough is left, so unrelated texts
   hardly ever meet; ``part_keys`` says why this step misses nothing.
3. Each group is joined in blocks of bounded size by a *signature tree*: nodes hold the OR of their
   sets' bitmaps and the range of their sizes. Two nodes are walked down together while the largest
   overlap these allow reaches what the smallest sizes need. Surviving pairs are compared shingle by
   shingle. Nodes that are known to be of one component are not compared again, so a large group
   of near copies costs as many comparisons as it has members, not pairs.
4. A group of more than one block is cut into bands of sizes. It is finished by joining one text per
   found component of all its blocks, and, where it still falls apart, the pairs of blocks of
   one band and of neighbouring bands.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm import textkit
from trendloom.llm.common import prepare, stored, trimmed, unused
from trendloom.llm.components import components

# Sets of one size class differ in size by up to this percentage of the smaller one.
CLASS_GROWTH = 130
# Shingles are counted by hash in so many bins; those of a bin that this share of the texts hits are common.
COMMON_BITS, COMMON_SHARE = 22, 0.0005
# Up to so many rows of keys, of about 100 bytes, are broadcast to a join with texts.
BROADCAST_ROWS = 200_000
# A block of a candidate group: about so many sets, or shingles in all.
BLOCK_SETS = 4096
BLOCK_SHINGLES = 500_000
FANOUT = 8


# --- sets --------------------------------------------------------------------------------------


def shingle_sets(chunk: textkit.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each document, one after the other, and where each begins.

    Words are lower-cased (A-Z). A text with fewer than ``k`` words has its whole sequence as one
    shingle; one without words has none.
    """
    found = textkit.words(chunk)
    hashes = textkit.word_hashes(chunk, found, lower=True)
    owners = found.documents()
    values, first = textkit.shingles(hashes, owners, k)
    begin = np.searchsorted(first, found.offsets)
    counts = found.counts
    sets = []
    for row in range(chunk.n):
        if counts[row] >= k:
            sets.append(np.unique(values[begin[row] : begin[row + 1]]))
        elif counts[row]:
            short = hashes[found.offsets[row] : found.offsets[row + 1]]
            total = np.uint64(counts[row])
            for h in short:
                total = textkit.mix64(np.array([total ^ h]))[0]
            sets.append(np.array([total], dtype=np.uint64))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), offsets


def _sums(values: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
    """Sums of 64-bit values by place, as a fingerprint; both halves are summed exactly."""
    low = np.bincount(place, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), size).astype(np.uint64)
    high = np.bincount(place, (values >> np.uint64(32)).astype(np.float64), size).astype(np.uint64)
    return low * np.uint64(0x9E3779B97F4A7C15) + textkit.mix64(high)


def digests(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 bits per set, as two columns."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    sizes = np.diff(offsets).astype(np.uint64)
    columns = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        mixed = textkit.mix64(values ^ np.uint64(salt))
        columns.append(textkit.mix64(_sums(mixed, owner, len(offsets) - 1) + sizes))
    return np.column_stack(columns)


class SizeClasses:
    """Ranges of set sizes such that sets that can be linked are in one range or in neighbouring ones.

    For each class of the smaller set of a pair: into how many ``parts`` shingles are dealt.
    ``least`` is the number of shingles that a part must hold for its key to count. Both follow from
    the share of shingles that linked sets can differ in: of Poisson-filled parts, enough must be
    filled that some are left after each difference has spoilt one.
    """

    def __init__(self, percent: int, largest: int):
        self.percent = percent
        growth = max(CLASS_GROWTH, -(-10_000 // percent))
        bounds = [1]
        while bounds[-1] <= largest:
            bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * growth // 100)))
        self.bounds = np.array(bounds)
        self.least, fill = _part_fill(percent)
        top = self.bounds[1:] - 1
        self.parts = np.maximum(np.ceil(top / fill).astype(np.int64), self.differ(top, top * 100 // percent) + 1)

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Most shingles that are in one of two linked sets of these sizes only."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def levels(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The classes of the smaller set of the pairs a set can be in, which sets have them, and the
        most shingles in which a set can differ from its partner there."""
        own = np.searchsorted(self.bounds, sizes, side="right") - 1
        below = self.bounds[np.maximum(own, 0)] - 1
        larger = (own > 0) & (sizes <= below * 100 // self.percent)
        return [(own, sizes > 0, self.differ(sizes, sizes * 100 // self.percent)), (own - 1, larger, self.differ(sizes, below))]


@functools.cache
def _part_fill(percent: int) -> tuple[int, float]:
    """Most shingles that a part can be asked to hold, and how many parts should hold on average."""
    share = (100 - percent) / percent
    for least in (4, 3, 2, 1):
        for fill in np.arange(12, 0.05, -0.05):
            empty = sum(math.exp(-fill) * fill**j / math.factorial(j) for j in range(least))
            if (1 - empty) / fill >= 1.1 * share:
                return least, float(fill)
    return 1, 0.05


def part_keys(values: np.ndarray, offsets: np.ndarray, classes: SizeClasses, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of each set, and the set of each key.

    A set's parts are made of its shingles outside the ``common`` bins, a table that is the same for
    all sets: these differ in no more places than the whole sets, so of ``parts`` of them all but the
    differing ones are equal. A set with fewer parts that are too small than equal ones shares the
    key of some large enough part with each partner. Any other set is *sparse*, and has the parts
    of all its shingles as well, which two sparse sets share; and if too many of these are empty,
    also the keys of empty parts. So whichever kind two linked sets are, they share a key.
    """
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rare = ~common[(values >> np.uint64(64 - COMMON_BITS)).astype(np.int64)]
    keys, sets = [], []

    def deal(level: np.ndarray, use: np.ndarray, chosen: np.ndarray, differ: np.ndarray, least: int, space: int) -> tuple[np.ndarray, ...]:
        parts = np.where(use, classes.parts[np.maximum(level, 0)], 0)
        start = np.concatenate([[0], np.cumsum(parts)])
        inside = use[owner] & chosen
        holder = owner[inside]
        salt = textkit.mix64(level.astype(np.uint64) + np.uint64(77 + 1000 * space))
        mixed = textkit.mix64(values[inside] ^ salt[holder])
        place = start[holder] + (mixed % np.maximum(parts[holder], 1).astype(np.uint64)).astype(np.int64)
        total = int(start[-1])
        sums = _sums(textkit.mix64(mixed), place, total)
        filled = np.bincount(place, minlength=total) >= least
        of_part = np.repeat(np.arange(len(sizes)), parts)
        number = (np.arange(total) - start[of_part]).astype(np.uint64)
        key = textkit.mix64(sums ^ textkit.mix64(salt[of_part] + number * np.uint64(0xD6E8FEB86659FD93)))
        sparse = use & (textkit.per_document(~filled, start) >= parts - differ)
        return key, of_part, filled, sparse

    for level, use, differ in classes.levels(sizes):
        key, of_part, filled, sparse = deal(level, use, rare, differ, classes.least, 0)
        keys.append(key[filled])
        sets.append(of_part[filled])
        if sparse.any():
            key, of_part, filled, bare = deal(level, sparse, np.ones(len(values), dtype=bool), differ, 1, 1)
            kept = filled | bare[of_part]
            keys.append(key[kept])
            sets.append(of_part[kept])
    keys, sets = np.concatenate(keys), np.concatenate(sets)
    order = np.argsort(sets, kind="stable")
    return keys[order], sets[order]


# --- signature trees ---------------------------------------------------------------------------


@dataclass
class Node:
    bits: np.ndarray
    smallest: int
    largest: int
    excess: int
    members: range
    children: list[Node] = field(default_factory=list)
    whole: bool = False  # known to be of one component


class SignatureTree:
    """Sets in order of size under nodes of OR-combined bitmaps, joined with itself by dual traversal."""

    def __init__(self, sets: list[np.ndarray], percent: int, known: list | None = None):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0))
        self.order, self.percent = order, percent
        self.sets = [sets[i] for i in order]
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        width = 1 << int(np.clip(np.ceil(np.log2(4 * max(1, int(self.sizes.max(initial=1))))), 8, 15))
        bits = np.zeros((len(sets), width // 8), dtype=np.uint8)
        for i, s in enumerate(self.sets):
            row = np.zeros(width, dtype=bool)
            row[(s % np.uint64(width)).astype(np.int64)] = True
            bits[i] = np.packbits(row)
        self.bits = bits.view(np.uint64)
        # shingles beyond one per bit: two sets share at most so many more than they share bits
        self.excess = self.sizes - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.parent = np.arange(len(sets))
        if known is not None:
            heads: dict = {}
            for i, at in enumerate(order):
                self.parent[i] = heads.setdefault(known[at], i)
        self.links: list[tuple[int, int]] = []
        self.compared = 0

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def build(self) -> Node:
        level = []
        for at in range(0, len(self.sets), FANOUT):
            to = min(at + FANOUT, len(self.sets))
            level.append(Node(np.bitwise_or.reduce(self.bits[at:to]), int(self.sizes[at]), int(self.sizes[to - 1]), int(self.excess[at:to].max()), range(at, to)))
        while len(level) > 1:
            above = []
            for at in range(0, len(level), FANOUT):
                own = level[at : at + FANOUT]
                above.append(
                    Node(np.bitwise_or.reduce([c.bits for c in own]), own[0].smallest, own[-1].largest, max(c.excess for c in own), range(own[0].members.start, own[-1].members.stop), own)
                )
            level = above
        return level[0]

    def one_component(self, node: Node) -> bool:
        if not node.whole:
            root = self.find(node.members.start)
            node.whole = all(self.find(i) == root for i in node.members)
        return node.whole

    def possible(self, a: Node, b: Node) -> bool:
        """Whether some set of ``a`` could reach the similarity with some set of ``b``."""
        if 100 * a.largest < self.percent * b.smallest or 100 * b.largest < self.percent * a.smallest:
            return False
        shared = int(np.bitwise_count(a.bits & b.bits).sum(dtype=np.int64)) + min(a.excess, b.excess)
        shared = min(shared, a.largest, b.largest)
        return (100 + self.percent) * shared >= self.percent * (a.smallest + b.smallest)

    def join(self) -> list[tuple[int, int]]:
        """Enough links to connect the components, as positions in the given list."""
        if len(self.sets) > 1:
            root = self.build()
            waiting = [(root, root)]
            while waiting:
                a, b = waiting.pop()
                if self.one_component(a) and self.one_component(b) and self.find(a.members.start) == self.find(b.members.start):
                    continue
                if a is not b and not self.possible(a, b):
                    continue
                if not a.children and not b.children:
                    self.leaves(a, b)
                elif a is b:
                    pairs = [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
                    waiting += sorted(pairs, key=lambda p: p[0] is p[1])  # pairs of one node are walked first
                elif b.children and (not a.children or len(b.members) > len(a.members)):
                    waiting += [(a, y) for y in b.children]
                else:
                    waiting += [(x, b) for x in a.children]
        return [(self.order[i], self.order[j]) for i, j in self.links]

    def leaves(self, a: Node, b: Node) -> None:
        left, right = np.array(a.members), np.array(b.members)
        shared = np.bitwise_count(self.bits[left][:, None, :] & self.bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
        shared += np.minimum(self.excess[left][:, None], self.excess[right][None, :])
        needed = self.percent * (self.sizes[left][:, None] + self.sizes[right][None, :])
        for i, j in zip(*np.nonzero((100 + self.percent) * shared >= needed), strict=True):
            x, y = int(left[i]), int(right[j])
            if x < y and self.find(x) != self.find(y) and self.linked(x, y):
                self.parent[self.find(y)] = self.find(x)
                self.links.append((x, y))

    def linked(self, x: int, y: int) -> bool:
        self.compared += 1
        a, b = self.sets[x], self.sets[y]
        at = np.searchsorted(b, a)
        overlap = int((b[np.minimum(at, len(b) - 1)] == a).sum())
        return 100 * overlap >= self.percent * (len(a) + len(b) - overlap)


# --- the join ----------------------------------------------------------------------------------


def _sets_of(texts: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for chunk in textkit.chunks(texts):
        yield shingle_sets(chunk, k)


def _signed(k: int):
    """The size and the digest of each text's set; at its end a task adds its counts of shingles by bin."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COMMON_BITS, dtype=np.int32)
        total, kinds, names = 0, None, ["__id", "row_key", "n", "short", "digest", "bin", "times"]
        for batch in batches:
            kinds = batch.schema.types[1:]
            sizes, marks = [], []
            for values, offsets in _sets_of(batch.column(0), k):
                sizes.append(np.diff(offsets))
                marks.append(digests(values, offsets))
                counts += np.bincount((values >> np.uint64(64 - COMMON_BITS)).astype(np.int64), minlength=len(counts)).astype(np.int32)
            if sizes:
                both = np.concatenate(marks)
                total += len(both)
                digest = pa.array([m.tobytes() for m in both], pa.binary())
                nothing = pa.nulls(len(both), pa.int64())
                arrays = [*batch.columns[1:], pa.array(np.concatenate(sizes)), pa.array(both[:, 0].copy().view(np.int64)), digest, nothing, nothing]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        if total:
            # a bin that is common over all is so in some tasks; what is rare in a task is left out
            seen = np.flatnonzero(counts >= max(2, total * COMMON_SHARE / 2))
            rows = len(seen)
            arrays = [*(pa.nulls(rows, kind) for kind in [*kinds, pa.int64(), pa.int64(), pa.binary()]), pa.array(seen), pa.array(counts[seen].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return sign


def _keyed(k: int, percent: int, common: np.ndarray):
    """The part keys of each set, sent once from a task; a row holds those of one text."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            for values, offsets in _sets_of(batch.column(0), k):
                own = np.diff(offsets)
                marks = digests(values, offsets)
                new = np.zeros(len(own), dtype=bool)
                for row in np.flatnonzero(own):
                    name = marks[row].tobytes()
                    new[row] = name not in sent
                    sent.add(name)
                kept = np.repeat(new, own)
                values, own = values[kept], own[new]
                if not len(own):
                    continue
                keys, sets = part_keys(values, np.concatenate([[0], np.cumsum(own)]), SizeClasses(percent, int(own.max())), common)
                short = marks[new, 0].copy().view(np.int64)
                keys, sets = one_of_each(keys, sets, short)
                cuts = np.searchsorted(sets, np.arange(len(own) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(short), lists], names=["short", "keys"])

    return parts


def one_of_each(keys: np.ndarray, sets: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their sets, by sets, with each key kept at one set only: that of the smallest ``short``.

    The other sets that had it are tied to this one by a key of their own for the two, so that the
    same sets are connected, and a key that very many texts have leaves a task once for many of them.
    """
    order = np.lexsort((short[sets], keys))
    keys, sets = keys[order], sets[order]
    first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    head = sets[first][np.cumsum(first) - 1]
    tied = np.unique(np.column_stack([sets, head])[~first & (sets != head)], axis=0)
    low, high = short[tied[:, 1]].view(np.uint64), short[tied[:, 0]].view(np.uint64)
    own = textkit.mix64(textkit.mix64(low) * np.uint64(3) + high)
    keys = np.concatenate([keys[first], own, own])
    sets = np.concatenate([sets[first], tied[:, 0], tied[:, 1]])
    order = np.argsort(sets, kind="stable")
    return keys[order], sets[order]


def common_bins(signed: DataFrame, total: int) -> np.ndarray:
    """The bins of shingles that about ``COMMON_SHARE`` of the texts hold: a table of fixed size.

    It only says which shingles to leave out of the parts; any table gives the same result.
    """
    counted = signed.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("times").alias("n"))
    found = counted.where(F.col("n") >= max(4, total * COMMON_SHARE)).select("bin").toPandas()["bin"].to_numpy(np.int64)
    table = np.zeros(1 << COMMON_BITS, dtype=bool)
    table[found] = True
    return table


def row_key(id: str, text: str):
    """What tells the rows of a table apart; equal for repeated rows."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))))


def _block_heads(k: int, percent: int):
    """Join the sets of each block; rows come sorted by block, and a block has a bounded size."""

    def join_block(names: list[bytes], texts: list[str], heads: list[bytes]) -> dict[bytes, bytes]:
        sets = []
        for values, offsets in _sets_of(pa.array(texts, pa.large_string()), k):
            sets += [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
        kept = list({name: i for i, name in enumerate(names)}.values())
        tree = SignatureTree([sets[i] for i in kept], percent, [heads[i] for i in kept])
        parent = {h: h for h in heads}

        def find(h: bytes) -> bytes:
            while parent[h] != h:
                h = parent[h]
            return h

        for i, j in tree.join():
            x, y = find(heads[kept[i]]), find(heads[kept[j]])
            parent[max(x, y)] = min(x, y)
        return {h: find(h) for h in parent if parent[h] != h}

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, names, texts, heads, out = None, [], [], [], []

        def batch_of(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            blocks, digest, text, head = (batch.column(i) for i in range(4))
            for row in range(batch.num_rows):
                now = blocks[row].as_py()
                if now != block:
                    out += join_block(names, texts, heads).items()
                    block, names, texts, heads = now, [], [], []
                    if len(out) > 10_000:
                        yield batch_of(out)
                        out = []
                names.append(digest[row].as_py())
                texts.append(text[row].as_py())
                heads.append(head[row].as_py())
        out += join_block(names, texts, heads).items()
        yield batch_of(out)

    return link


def _placed(members: DataFrame, percent: int) -> DataFrame:
    """The block of each class of a candidate group: ``band`` and ``part``, and ``near``, the blocks of its group
    that it has to be joined with.

    A group of one block's size is one block. A ``wide`` one is cut into bands of sizes, so that linked
    sets are in one band or in neighbouring ones, and bands into parts by hash.
    """

    def blocks(sets: str, shingles: str):
        return F.greatest(F.ceil(F.col(sets) / BLOCK_SETS), F.ceil(F.col(shingles) / BLOCK_SHINGLES))

    sizes = members.groupBy("grp").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = sizes.where("sets > 1").select("grp", (blocks("sets", "shingles") > 1).alias("wide"))
    growth = max(CLASS_GROWTH, 101 + 10_000 // percent) / 100
    band = F.when(F.col("wide"), F.floor(F.log(F.col("n").cast("double")) / math.log(growth))).otherwise(0)
    banded = members.join(sizes, "grp").withColumn("band", band.cast("int"))
    bands = banded.groupBy("grp", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    bands = bands.select("grp", "band", blocks("sets", "shingles").cast("int").alias("parts"))
    names = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda part: F.concat_ws(".", F.col("band").cast("string"), part.cast("string")))
    named = bands.withColumn("names", names).withColumn("around", F.array(*[F.col("band") + step for step in (-1, 0, 1)]))
    near = named.select("grp", "names", F.explode("around").alias("band")).groupBy("grp", "band").agg(F.flatten(F.collect_list("names")).alias("near"))
    placed = banded.join(bands, ["grp", "band"]).join(near, ["grp", "band"])
    part = F.when(F.col("wide"), F.pmod(F.xxhash64("digest"), F.col("parts"))).otherwise(0)
    return placed.select("row_key", "digest", "n", "grp", "wide", "band", part.cast("int").alias("part"), F.when(F.col("wide"), F.col("near")).alias("near"))


def _joined(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows of ``block``, ``digest``, ``__text`` and ``head``, the component a text is known to be in: pairs
    ``a``, ``b`` of a head and the smallest head that its block links it with, if that is another one."""
    placed = rows.select("block", "digest", "__text", "head").repartition("block").sortWithinPartitions("block", "digest")
    return placed.mapInArrow(trimmed(_block_heads(k, percent)), "a binary, b binary")


def _moved(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows with ``head`` replaced where ``heads`` has another one for it."""
    known = heads.select(F.col("a").alias("head"), "b")
    return rows.join(known, "head", "left").withColumn("head", F.coalesce("b", "head")).drop("b")


def near_groups(docs: DataFrame, k: int, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its component of texts linked at ``percent`` similarity of ``k``-word shingle sets.

    Returns ``id``, ``n_shingles``, ``component_id`` (the smallest id reachable by links; null ids
    count last, and a component of null ids has null), ``row_key`` and ``leader`` (the ``row_key`` that
    stands for the component). A null or empty text has no shingles and stands alone. Repeated rows
    are equal sets; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"), F.col(f"`{id}`").alias("__id"), row_key(id, text).alias("row_key"))
    id_type = rows.schema["__id"].dataType.simpleString()
    kinds = f"__id {id_type}, row_key binary, n long, short long, digest binary, bin long, times long"
    found = stored(rows.mapInArrow(trimmed(_signed(k)), kinds), "jaccard-sets")
    signed = found.where("bin IS NULL").drop("bin", "times")

    # candidate groups
    common = common_bins(found, signed.count())
    keyed = rows.select("__text").mapInArrow(trimmed(_keyed(k, percent, common)), "short long, keys array<long>").select("short", F.explode("keys").alias("key"))
    first = F.expr("min(short) OVER (PARTITION BY key ORDER BY short ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    meet = keyed.withColumn("head", first).where("head != short").select("short", "head").distinct()
    groups = stored(components(meet, "short", "head").withColumnRenamed("root", "grp"), "jaccard-groups")

    # one row of each class of a group, and the block it goes to
    classes = signed.where("n > 0").groupBy("digest", "short").agg(F.min("row_key").alias("row_key"), F.max("n").alias("n"))
    members = classes.join(groups, F.col("short") == F.col("node")).select("digest", "row_key", "n", "grp")
    members = stored(members, "jaccard-members")
    placed = stored(_placed(members, percent), "jaccard-placed")
    texts = rows.select("row_key", "__text").join(small(placed), "row_key").withColumn("head", F.col("digest"))
    heads = stored(_joined(texts.withColumn("block", F.concat_ws(":", "grp", "band", "part")), k, percent), "jaccard-heads")
    found = _moved(placed.select("digest", F.col("digest").alias("head")), heads)

    if placed.where("wide").limit(1).count():
        # groups of several blocks: one text per component found so far, then the pairs of blocks
        big = stored(_moved(texts.where("wide").dropDuplicates(["digest"]), heads), "jaccard-wide")
        one = big.where("digest = head")
        fewer = one.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("again"))
        bridged = one.join(fewer, "grp").withColumn("block", F.concat_ws(":", "grp", F.pmod(F.xxhash64("digest"), F.col("again"))))
        bridges = stored(_joined(bridged, k, percent), "jaccard-bridges")
        big = _moved(big, bridges)
        apart = big.groupBy("grp").agg(F.min("head").alias("x"), F.max("head").alias("y")).where("x != y").select("grp")
        own = F.concat_ws(".", "band", "part")
        other = big.join(apart, "grp", "left_semi").withColumn("other", F.explode("near")).where(F.col("other") != own)
        pair = F.concat_ws(":", "grp", F.least(own, "other"), F.greatest(own, "other"))
        across = stored(_joined(other.withColumn("block", pair), k, percent), "jaccard-across")
        last = components(across, "a", "b").select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = _moved(_moved(found, bridges), last)

    roots = stored(found.select("digest", F.col("head").alias("root")), "jaccard-roots")
    ids = signed.where("n > 0").groupBy("digest").agg(F.min("__id").alias("__least"), F.min(F.struct(F.col("__id").isNull(), "__id", "row_key")).alias("__leader"))
    ids = ids.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    heads = ids.groupBy("root").agg(F.min("__least").alias("component_id"), F.min("__leader").alias("leader"))
    known = ids.select("digest", "root").join(heads, "root").select("digest", "component_id", F.col("leader.row_key").alias("leader"))
    found = signed.select("__id", "row_key", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest")).join(known, "digest", "left")
    return found.select(
        F.col("__id").alias(id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("__id")).alias("component_id"),
        "row_key",
        F.when(F.col("n") > 0, F.col("leader")).otherwise(F.col("row_key")).alias("leader"),
    )


def keep_one(docs: DataFrame, k: int, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each component left, all columns kept.

    The row with the smallest id stays; repeated rows stay once, also those without words.
    """
    key, place, lead = unused(docs, "__key"), unused(docs, "__place"), unused(docs, "__lead")
    rows = near_groups(docs, k, percent, id, text)
    marks = rows.groupBy("row_key").agg(F.count("*").alias("n"), F.min(F.col("row_key") == F.col("leader")).alias("leads"))
    # only rows that go, or that stand for repeated ones, are joined with the texts
    marks = stored(marks.where("n > 1 OR NOT leads").select(F.col("row_key").alias(key), F.col("leads").alias(lead)), "jaccard-marks")
    marked = docs.withColumn(key, row_key(id, text)).join(small(marks), key, "left")
    again = marked.where(lead).withColumn(place, F.expr(f"row_number() OVER (PARTITION BY {key} ORDER BY 1)")).where(f"{place} = 1")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(f"{lead} IS NULL").select(*columns).union(again.select(*columns))


def small(keys: DataFrame) -> DataFrame:
    """Stored keys, to be broadcast if they are counted to be few; else Spark plans the join."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
