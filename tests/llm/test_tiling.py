from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

import plain
from trendloom.llm import tiling
from trendloom.llm.queries import QUERIES


def test_tiles_equal_the_plain_ones():
    r = random.Random(3)
    for _ in range(150):
        item = [r.randrange(6) for _ in range(r.randrange(1, 25))]
        document = [r.randrange(6) for _ in range(r.randrange(1, 40))]
        if r.random() < 0.5:
            at = r.randrange(len(document))
            document[at:at] = item[len(item) // 2 :] + [9] + item[: len(item) // 2]
        hashes = [np.array([x + 1 for x in words], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for words in (document, item)]
        assert tiling.tiles(*hashes, 2) == plain.tile(document, item, 2)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 AS seed", "2 AS words")


WORDS = [f"word{i}" for i in range(400)]
PASSAGE = WORDS[:40]


def pairs(spark, docs, bench):
    got = tiling.contaminated(plain.documents(spark, docs, "seeds item_id row_key"), items(spark, bench)).collect()
    return {(r.doc_id, r.item_id): (r.n_tiles, r.covered_words) for r in got}


def test_whole_reordered_and_interrupted_passages(spark):
    around = " ".join(WORDS[100:160])
    docs = [
        (1, around + " " + " ".join(PASSAGE).upper() + ", " + around),
        (2, " ".join(PASSAGE[20:]) + ". " + around + " " + " ".join(PASSAGE[:20])),
        (3, " ".join(w + (" gap" if i % 8 == 7 else "") for i, w in enumerate(PASSAGE))),
        (4, around),
        (5, " ".join(PASSAGE[:10]) + " " + around),
        (6, " ".join(w + (" gap" if i % 4 == 3 else "") for i, w in enumerate(PASSAGE))),
        (7, ""),
        (8, None),
    ]
    bench = [(1, " ".join(PASSAGE)), (2, None), (3, ""), (4, "...")]
    assert pairs(spark, docs, bench) == {(1, 1): (1, 40), (2, 1): (2, 40), (3, 1): (5, 40)}


def test_short_items_count_as_a_whole(spark):
    assert pairs(spark, [(1, "xx alpha Beta yy"), (2, "alpha xx beta")], [(1, "alpha beta"), (2, "alpha beta gamma delta")]) == {(1, 1): (1, 2)}


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(PASSAGE)
    assert pairs(spark, [(None, text), (1, text), (1, text)], [(None, text), (5, text), (5, text)]) == {(d, i): (1, 40) for d in (None, 1) for i in (None, 5)}
    kept = tiling.keep_clean(plain.documents(spark, [(None, text), (2, "clean"), (2, "clean"), (3, None)], "__key"), items(spark, [(5, text)]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 2, 3] and kept.columns[-1] == "__key"


def test_what_is_left_out_can_not_cover_an_item():
    r = random.Random(9)
    for _ in range(500):
        words, length = r.randrange(5, 60), 5
        seeds = [r.randrange(12) for _ in range(words - length + 1)]
        own = sorted(set(seeds))
        places = [np.array([i for i, s in enumerate(seeds) if s == o]) for o in own]
        look = tiling.rarest(places, np.array([r.randrange(100) for _ in own]), length, words, 50)
        left = np.array(sorted(p for o, ok in zip(places, look, strict=True) if not ok for p in o), dtype=np.int64)
        plainly = len({w for p in left for w in range(p, p + length)})
        assert tiling.covered(left, length) == plainly and 2 * plainly < words and look.any()


def test_a_shared_opening_makes_no_pairs(spark):
    """All documents and all items begin alike; two items stand in a document as well."""
    opening = " ".join(WORDS[:10])
    bench = [(i, opening + " " + " ".join(f"item{i}w{j}" for j in range(30))) for i in range(50)]
    docs = [(d, opening + " " + " ".join(f"doc{d}w{j}" for j in range(40))) for d in range(600)]
    docs += [(900, "before " + bench[7][1]), (901, bench[8][1] + " after")]
    assert pairs(spark, docs, bench) == {(900, 7): (1, 40), (901, 8): (1, 40)}
    times = np.array([602] * 6 + [1] * 30)
    look = tiling.rarest([np.array([i]) for i in range(36)], times, 5, 40, 50)
    assert not look[:6].any() and look[15:].all()


def test_empty_tables(spark):
    assert pairs(spark, [], [(1, "a b c d e f")]) == {} and pairs(spark, [(1, "a b c d e f")], []) == {}


def test_query_against_the_plain_tiling(spark):
    folder = "/root/testdata/sf0.001"
    read = lambda name, key: {r[key]: r.text for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()}
    docs, bench = read("documents", "doc_id"), read("benchmark", "item_id")
    words = lambda texts: {i: w.tolist() for i, w in zip(texts, tiling.word_fingerprints(pa.array(texts.values())), strict=True)}
    docs, bench = words(docs), words(bench)
    want = set()
    for i, item in bench.items():
        seeds = {tuple(item[n : n + 5]) for n in range(len(item) - 4)}
        for d, document in docs.items():
            if any(tuple(document[n : n + 5]) in seeds for n in range(len(document) - 4)):
                if 2 * sum(t[0] for t in plain.tile(document, item, 5)) >= len(item):
                    want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_contamination"](spark, folder).collect()}
    assert got == want
