from __future__ import annotations

import hashlib
import random

import pytest

import plain
from compare import connect, difference
from trendloom.llm import mixing
from trendloom.llm.oracle import ORACLE
from trendloom.llm.queries import QUERIES


def plain_mix(rows):
    """(doc_id, words, source) to taken words, by laying all servings out."""
    names = sorted({s for _, _, s in rows if s is not None}) + [None] * any(s is None for _, _, s in rows)
    words = {s: sum(n for _, n, x in rows if x == s) for s in names}
    total = sum(words.values())
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped: set = set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3 * words[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level > 3 * words[s]]
        if not over:
            break
        capped |= set(over)
    target = {s: 3 * words[s] if s in capped else weight[s] * level for s in names}
    servings = []
    for s in names:
        own = sorted((hashlib.md5(f"{mixing.SEED}:{'null' if i is None else i}".encode()).hexdigest(), i is not None, i or 0, n, k) for k, (i, n, x) in enumerate(rows) if x == s)
        upto = 0
        for order, _, i, n, k in own:
            upto += n
            servings += [((e * words[s] + upto) / target[s], names.index(s), e, order, i, n, k) for e in range(3) if n]
    taken, spent = [0] * len(rows), 0
    for *_, n, k in sorted(servings):
        spent += n
        if spent > total:
            break
        taken[k] += n
    return [(i, n, words[s], target[s], taken[k]) for k, (i, n, s) in enumerate(rows)]


def check(spark, rows):
    docs = plain.documents(spark, [(i, None if n is None else " ".join("w" * n), None, s) for i, n, s in rows], "size taken rank")
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = plain_mix([(i, n or 0, s) for i, n, s in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[4])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert (*a[:3], a[4]) == (*b[:3], b[4])
        assert a[3] == pytest.approx(b[3])


def test_against_the_plain_mix(spark):
    r = random.Random(4)
    check(spark, [(i, r.choice([0, 1, 5, 20, 90]), r.choice(["a", "a", "a", "b", "Z", None])) for i in range(300)])


def test_small_sources_are_capped_and_the_rest_is_reshared(spark):
    check(spark, [(i, 10, "big") for i in range(60)] + [(100, 3, "c"), (101, 2, "d"), (102, 1, "e")])


def test_a_source_without_turns_left_does_not_end_the_search_for_the_cut(spark):
    ids = sorted(range(11), key=lambda i: hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest())
    sizes = [(n, "a") for n in (20, 60, 5000, 200, 1)] + [(n, "b") for n in (1000, 60, 5, 20, 1000, 200)]
    rows = [(i, *r) for i, r in zip(ids, sizes, strict=True)]
    check(spark, rows)
    assert sum(r[4] for r in plain_mix(rows)) == 80 + 6855


def test_null_ids_texts_and_sources_and_repeated_rows(spark):
    check(spark, [(None, 5, "a"), (1, None, "a"), (2, 7, None), (2, 7, None), (2, 7, None), (3, 0, "z")])


def test_no_rows_and_no_words(spark):
    assert mixing.mix(plain.documents(spark, [])).count() == 0
    (row,) = mixing.mix(plain.documents(spark, [(1, "", None, "a")])).collect()
    assert (row.size, row.target, row.taken, row.finish) == (0, 0.0, 0, None)


def test_ranges_do_not_change_the_result(spark, monkeypatch):
    docs = plain.documents(spark, [(i, "w " * (i % 17), None, "abc"[i % 3 :: 3][:1]) for i in range(400)])
    one = sorted(mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    assert sorted(mixing.mix(docs).collect()) == one


def test_carried_columns_and_the_sequence(spark):
    docs = plain.documents(spark, [(i, "w " * 10, "en", "ab"[i % 2]) for i in range(40)])
    mixed = mixing.mix(docs, carry=["text", "lang"])
    assert mixed.columns[:3] == ["doc_id", "text", "lang"]
    sequence = mixing.in_order(mixed).collect()
    assert [r.finish for r in sequence] == sorted(r.finish for r in sequence)
    assert sum(r.size for r in sequence) == sum(r.taken for r in mixed.collect())


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES["op7_mix_sources"](spark, folder), connect(folder), ORACLE["op7_mix_sources"]) == ""
