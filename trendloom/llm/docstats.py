"""Statistics of whole texts, a row of numbers per document."""

from __future__ import annotations

import numpy as np

from trendloom.llm import textkit

# Fixed by the rules: the symbols counted, and the window of repeated words.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 3

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = [
    "log_words",
    "chars_per_word",
    "symbols_per_word",
    "dup_line_share",
    "repeat_word_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "exclaim_per_word",
    "distinct_word_share",
    "words_per_line",
    "beyond_ascii_share",
    "stops_per_word",
]


def _bytes_in(*groups: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for group in groups:
        table[list(group)] = True
    return table


_TABLES = {
    "symbol": _bytes_in(SYMBOLS),
    "upper": _bytes_in(bytes(range(ord("A"), ord("Z") + 1))),
    "lower": _bytes_in(bytes(range(ord("a"), ord("z") + 1))),
    "digit": _bytes_in(bytes(range(ord("0"), ord("9") + 1))),
    "mark": _bytes_in(bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())),
    "exclaim": _bytes_in(b"!"),
    "stop": _bytes_in(b".?"),
    "lead": _bytes_in(bytes(b for b in range(256) if b & 0xC0 != 0x80)),
    "beyond": _bytes_in(bytes(range(0xC0, 0x100))),
}


def statistics(chunk: textkit.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """``COUNTS`` as integers and ``RATIOS`` as floats, one row per document of the chunk.

    Words are runs without ASCII white space. A line counts as repeated if it has a word and equals
    an earlier line of its text; a word counts as repeated if a window of three words that holds it
    stands in the text twice or more. An empty text has zeros throughout.
    """
    data, offsets, n = chunk.data, chunk.offsets, chunk.n
    found = textkit.words(chunk)
    hashes = textkit.word_hashes(chunk, found)
    owners = found.documents()
    n_words = found.counts

    def count(name: str) -> np.ndarray:
        return textkit.per_document(_TABLES[name][data], offsets)

    word_chars = textkit.per_document(_TABLES["lead"][data] & textkit.separator_table()[data], offsets)

    starts, ends, line_owner = textkit.lines(chunk)
    full = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends, line_owner = starts[full], ends[full], line_owner[full]
    n_lines = np.bincount(line_owner, minlength=n)
    _, kept = np.unique(textkit.salted(textkit.segment_hashes(data, starts, ends), line_owner), return_index=True)
    n_dup_lines = n_lines - np.bincount(line_owner[kept], minlength=n)

    windows, first = textkit.shingles(hashes, owners, REPEAT_WINDOW)
    _, place, times = np.unique(textkit.salted(windows, owners[first]), return_inverse=True, return_counts=True)
    repeated = first[times[place] > 1]
    covered = np.zeros(len(hashes), dtype=bool)
    for j in range(REPEAT_WINDOW):
        covered[repeated + j] = True
    n_repeat = np.bincount(owners[covered], minlength=n)

    _, kept = np.unique(textkit.salted(hashes, owners), return_index=True)
    n_distinct = np.bincount(owners[kept], minlength=n)

    counts = np.column_stack([n_words, word_chars, count("symbol"), n_dup_lines, n_repeat]).astype(np.int64)
    each = np.maximum(n_words, 1)
    chars = np.maximum(word_chars, 1)
    upper, lower = count("upper"), count("lower")
    ratios = np.column_stack(
        [
            np.log1p(n_words),
            word_chars / each,
            counts[:, 2] / each,
            n_dup_lines / np.maximum(n_lines, 1),
            n_repeat / each,
            upper / np.maximum(upper + lower, 1),
            count("digit") / chars,
            count("mark") / chars,
            count("exclaim") / each,
            n_distinct / each,
            n_words / np.maximum(n_lines, 1),
            count("beyond") / chars,
            count("stop") / each,
        ]
    )
    return counts, ratios
