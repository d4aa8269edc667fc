from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from trendloom.llm import docstats, textkit

import plain

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n\x0b#*!中😀", max_size=60)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    seen: dict = {}
    for chunk in textkit.chunks(pa.array(texts, pa.string())):
        found = textkit.words(chunk)
        hashes = textkit.word_hashes(chunk, found, lower=True)
        for row in range(chunk.n):
            own = hashes[found.offsets[row] : found.offsets[row + 1]]
            words = plain.WORD.findall((texts[chunk.first + row] or "").translate(plain.LOWER))
            assert len(own) == len(words)
            for h, w in zip(own.tolist(), words, strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def plain_counts(text):
    from collections import Counter

    words = plain.WORD.findall(text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if plain.WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_counts_equal_the_plain_ones(texts):
    got = [row.tolist() for chunk in textkit.chunks(pa.array(texts, pa.string())) for row in docstats.statistics(chunk)[0]]
    assert got == [plain_counts(t) for t in texts]


def test_long_texts_and_long_words_are_whole():
    word = "x" * (textkit.WINDOW + 5)
    text = f"{word} {word}y " + "a b c " * 200_000
    (chunk,) = textkit.chunks(pa.array([text]))
    found = textkit.words(chunk)
    hashes = textkit.word_hashes(chunk, found)
    assert found.counts.tolist() == [600_002]
    assert hashes[0] != hashes[1] and len(np.unique(hashes)) == 5


def test_sliced_batches_keep_their_place():
    column = pa.array(["one two", None, "three", ""]).slice(1, 3)
    counts = [textkit.words(c).counts.tolist() for c in textkit.chunks(column)]
    assert counts == [[0, 1, 0]]
