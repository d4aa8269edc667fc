"""Words, lines and shingles of many texts at once, as 64-bit fingerprints in numpy arrays.

All functions work on a ``Chunk``: the UTF-8 bytes of some whole documents. Texts are cut into
words by byte tables, and a word, line or shingle is known by a 64-bit polynomial fingerprint
over all its bytes, so no text is ever shortened. Chunks hold about ``CHUNK_BYTES`` bytes, or one
longer document; temporary arrays of eight bytes per input byte are made for ``WINDOW`` bytes at
a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
WINDOW = 1 << 18

# The separators of the word pattern [^\x20\x09-\x0D]+, and the bytes of A-Z, a-z and 0-9.
SEPARATORS = [0x20, *range(0x09, 0x0E)]


@functools.cache
def separator_table() -> np.ndarray:
    """True for bytes of a word that is cut at ASCII white space."""
    table = np.ones(256, dtype=bool)
    table[SEPARATORS] = False
    return table


@functools.cache
def alnum_table() -> np.ndarray:
    """True for ASCII letters and digits, and for every byte of a character beyond ASCII."""
    table = np.zeros(256, dtype=bool)
    table[128:] = True
    for first, last in ((b"0", b"9"), (b"A", b"Z"), (b"a", b"z")):
        table[first[0] : last[0] + 1] = True
    return table


@functools.cache
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)
    tables = []
    for factor in (base, inverse):
        table = np.full(WINDOW + 1, factor, dtype=np.uint64)
        table[0] = 1
        tables.append(np.multiply.accumulate(table))
    return tables[0], tables[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Chunk:
    """Bytes of the documents ``first`` to ``first + len(offsets) - 1`` of an Arrow batch."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(texts: pa.Array) -> Iterator[Chunk]:
    """Whole documents of an Arrow string column, about ``CHUNK_BYTES`` at a time; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    n, buffers = len(texts), texts.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield Chunk(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit fingerprints of the byte ranges ``[starts, ends)``, which are ascending and disjoint."""
    out = np.empty(len(starts), dtype=np.uint64)
    powers, inverses = _powers()
    values = _byte_values(lower)
    at = 0
    while at < len(starts):
        origin = int(starts[at])
        to = int(np.searchsorted(ends, origin + WINDOW, side="right"))
        if to == at:  # one range beyond the window
            whole = data[origin : int(ends[at])].tobytes()
            digest = hashlib.blake2b(whole.lower() if lower else whole, digest_size=8).digest()
            out[at] = int.from_bytes(digest, "little")
            at += 1
            continue
        piece = data[origin : int(ends[to - 1])]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(values[piece] * powers[: len(piece)], out=sums[1:])
        begin, end = starts[at:to] - origin, ends[at:to] - origin
        out[at:to] = (sums[end] - sums[begin]) * inverses[begin] + (end - begin).astype(np.uint64)
        at = to
    return mix64(out)


@dataclass
class Words:
    """Words of a chunk: byte ranges, and the place of each document's first word."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)


def words(chunk: Chunk, table: np.ndarray | None = None) -> Words:
    """Runs of word bytes; a run never crosses two documents."""
    mask = (separator_table() if table is None else table)[chunk.data]
    size = len(mask)
    edge = np.zeros(size + 1, dtype=bool)
    edge[chunk.offsets] = True
    before = np.empty(size, dtype=bool)
    before[:1] = False
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge[:size]))
    after = np.empty(size, dtype=bool)
    after[-1:] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.offsets))


def word_hashes(chunk: Chunk, found: Words, lower: bool = False) -> np.ndarray:
    return segment_hashes(chunk.data, found.starts, found.ends, lower)


def shingles(hashes: np.ndarray, documents: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all windows of ``k`` words inside one document, and the first word of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(documents[:n] == documents[k - 1 :])
    out = hashes[first]
    for j in range(1, k):
        out = (out * np.uint64(0x9FB21C651E98DF25)) ^ hashes[first + j]
        out ^= out >> np.uint64(29)
    return mix64(out), first


def lines(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of the \\n-split lines, and the document of each."""
    breaks = np.flatnonzero(chunk.data == 0x0A)
    starts = np.concatenate([chunk.offsets[:-1], breaks + 1])
    # a break belongs to the document that holds it, and so does the line after it
    owner = np.searchsorted(chunk.offsets, breaks, side="right") - 1
    documents = np.concatenate([np.arange(chunk.n), owner])
    order = np.lexsort((starts, documents))
    starts, documents = starts[order], documents[order]
    ends = np.empty_like(starts)
    last = np.ones(len(starts), dtype=bool)
    last[:-1] = documents[1:] != documents[:-1]
    ends[last] = chunk.offsets[1:][documents[last]]
    ends[~last] = starts[1:][~last[:-1]] - 1
    return starts, ends, documents


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each document's range."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def salted(hashes: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Fingerprints told apart by document, so that one sort serves a chunk."""
    return hashes ^ mix64(documents.astype(np.uint64) + np.uint64(1))
