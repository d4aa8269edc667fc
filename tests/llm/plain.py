"""Plain versions of the operators, and small tables, for the tests."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra: str = ""):
    """Rows of (doc_id, text[, lang[, source]]); ``extra`` adds columns that hold the value 7."""
    full = [((*r, *[None] * 4)[:4]) for r in rows]
    out = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in full], DOCS)
    for name in extra.split():
        out = out.selectExpr("*", f"7 AS {name}")
    return out


def shingle_set(text: str | None, k: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def similar_groups(texts: dict, k: int, percent: int) -> dict:
    """The smallest reachable key of each key, by comparing all pairs."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                head[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def tile(document: list, item: list, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling by trying all places."""
    out, used_d, used_i = [], set(), set()
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(document)):
                n = 0
                while i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n] and i + n not in used_i and j + n not in used_d:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < shortest:
            return out
        n, i, j = best
        used_i |= set(range(i, i + n))
        used_d |= set(range(j, j + n))
        out.append(best)
