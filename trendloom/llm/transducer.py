"""A table-driven transducer over UTF-8 bytes, with a hash table that verifies what it finds.

``NEXT`` and ``OUTPUT`` are the whole machine: a byte's class and the state before it give the next
state and what is put out, which is any of: a code point, a capital, a symbol, the begin of a word,
the end of a word. The next state follows from the class alone, so the state before every byte of a
chunk is read off the byte before it, and numpy takes all steps of the one pass at once.

Word spans go into an open-addressing table. A span found there is the same word only if all its
bytes are equal, so hashes decide the place of a word and never whether it is one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from trendloom.llm import textkit

# Classes of bytes. The separators of [^\x20\x09-\x0D]+, A-Z, the symbols of the caller, the bytes
# that go on with a character, and all others, which are a character or begin one.
SPACE, CAPITAL, SYMBOL, LEAD, TAIL = range(5)
GAP, WORD = range(2)
POINT, UPPER, MARK, BEGIN, END = 1, 2, 4, 8, 16

NEXT = np.array([GAP, WORD, WORD, WORD, WORD], dtype=np.uint8)
_COUNTED = np.array([POINT, POINT | UPPER, POINT | MARK, POINT, 0], dtype=np.uint8)
OUTPUT = np.array(
    [
        [_COUNTED[c] | (BEGIN if NEXT[c] == WORD else 0) for c in range(5)],
        [_COUNTED[c] | (END if NEXT[c] == GAP else 0) for c in range(5)],
    ],
    dtype=np.uint8,
)

# Words longer than this are compared byte range by byte range.
LONG = 4096


def classes(symbols: bytes) -> np.ndarray:
    """The class of each byte."""
    table = np.full(256, LEAD, dtype=np.uint8)
    table[0x80:0xC0] = TAIL
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[list(symbols)] = SYMBOL
    table[textkit.SEPARATORS] = SPACE
    return table


@dataclass
class Pass:
    """What the machine has put out: counts per document, and the span and document of each word."""

    points: np.ndarray
    capitals: np.ndarray
    symbols: np.ndarray
    words: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    owners: np.ndarray


def run(chunk: textkit.Chunk, table: np.ndarray) -> Pass:
    """One pass over the bytes of a chunk; every document starts in a gap and ends its last word."""
    kinds = table[chunk.data]
    after = NEXT[kinds]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    starts = chunk.offsets[:-1]
    full = chunk.offsets[1:] > starts
    before[starts[full]] = GAP
    out = OUTPUT.ravel()[before * np.uint8(5) + kinds]
    begins = np.flatnonzero(out & BEGIN)
    open_at_end = chunk.offsets[1:][full]
    open_at_end = open_at_end[after[open_at_end - 1] == WORD]
    ends = np.sort(np.concatenate([np.flatnonzero(out & END), open_at_end]))
    offsets = np.searchsorted(begins, chunk.offsets)
    words = np.diff(offsets)

    def count(bit: int) -> np.ndarray:
        return textkit.per_document((out & bit) != 0, chunk.offsets)

    return Pass(count(POINT), count(UPPER), count(MARK), words, begins, ends, np.repeat(np.arange(chunk.n), words))


class Spans:
    """Byte ranges of a chunk that can be hashed and compared many at a time."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        self.data, self.begins, self.sizes = data, begins, ends - begins
        padded = np.zeros(len(data) + 8, dtype=np.uint8)
        padded[: len(data)] = data
        self._eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))

    def _head(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Up to eight bytes from ``at``, as one number."""
        drop = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
        return self._eights[at] << drop

    def hashes(self, owners: np.ndarray) -> np.ndarray:
        """Told apart by owner; spans of up to 16 bytes differ if their first or last eight bytes do."""
        first = self._head(self.begins, self.sizes)
        last = self._head(self.begins + np.maximum(self.sizes - 8, 0), self.sizes)
        out = textkit.mix64(first + textkit.mix64(last + self.sizes.astype(np.uint64)))
        long = np.flatnonzero(self.sizes > 16)
        out[long] = textkit.segment_hashes(self.data, self.begins[long], self.begins[long] + self.sizes[long])
        return textkit.salted(out, owners)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether span ``a[i]`` has the bytes of span ``b[i]``."""
        same = self.sizes[a] == self.sizes[b]
        for i in np.flatnonzero(same & (self.sizes[a] > LONG)):
            x, y, size = self.begins[a[i]], self.begins[b[i]], self.sizes[a[i]]
            same[i] = np.array_equal(self.data[x : x + size], self.data[y : y + size])
        live, done = np.flatnonzero(same & (self.sizes[a] <= LONG)), 0
        while len(live):
            left = self.sizes[a[live]] - done
            differ = self._head(self.begins[a[live]] + done, left) != self._head(self.begins[b[live]] + done, left)
            same[live[differ]] = False
            live, done = live[~differ & (left > 8)], done + 8
        return same


def distinct(spans: Spans, owners: np.ndarray) -> np.ndarray:
    """True for one span of each different word of an owner.

    All spans that are not placed yet look at their slot: an empty one goes to one of those that
    look at it; whoever finds an equal span of the same owner is done; the others go one slot on.
    """
    n = len(owners)
    chosen = np.zeros(n, dtype=bool)
    hashes = spans.hashes(owners)
    mask = (1 << max(4, (2 * n - 1).bit_length())) - 1
    slots = np.full(mask + 1, -1, dtype=np.int64)
    waiting, place = np.arange(n), (hashes & np.uint64(mask)).astype(np.int64)
    while len(waiting):
        free = slots[place] < 0
        slots[place[free]] = waiting[free]
        there = slots[place]
        own = there == waiting
        chosen[waiting[own]] = True
        met = own.copy()
        maybe = np.flatnonzero(~own & (hashes[there] == hashes[waiting]) & (owners[there] == owners[waiting]))
        met[maybe] = spans.equal(waiting[maybe], there[maybe])
        waiting, place = waiting[~met], (place[~met] + 1) & mask
    return chosen


def distinct_words(chunk: textkit.Chunk, found: Pass) -> np.ndarray:
    """The number of different words of each document."""
    chosen = distinct(Spans(chunk.data, found.begins, found.ends), found.owners)
    return np.bincount(found.owners[chosen], minlength=chunk.n)
