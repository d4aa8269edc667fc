from __future__ import annotations

import random

import numpy as np
import pytest

import plain
from trendloom.llm import components as connected
from trendloom.llm import jaccard
from trendloom.llm.components import components
from trendloom.llm.queries import QUERIES


def near_copies(seed: int, families: int, size: int, words: int, changes: int) -> dict[int, str]:
    """Families of texts that differ from their first one in up to ``changes`` places."""
    r = random.Random(seed)
    texts = {}
    for f in range(families):
        base = [f"w{r.randrange(400)}" for _ in range(words + r.randrange(20))]
        for _ in range(size):
            own = list(base)
            for _ in range(r.randrange(changes + 1)):
                own[r.randrange(len(own))] = f"x{r.randrange(10_000)}"
            texts[len(texts) + 1] = " ".join(own)
    return texts


def found(spark, texts: dict, k: int, percent: int) -> dict:
    docs = plain.documents(spark, list(texts.items()), "digest keys n row_key head")
    got = jaccard.near_groups(docs, k, percent).collect()
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(plain.shingle_set(t, k)) for i, t in texts.items()}
    return {r.doc_id: r.component_id for r in got}


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_against_all_pairs(spark, k, percent):
    texts = near_copies(1, 12, 8, 60, 4) | {1000 + i: t for i, t in near_copies(2, 10, 4, 8, 1).items()}
    texts |= {2000: "A b", 2001: "a B", 2002: "a", 2003: "", 2004: None, 2005: "a b c", 2006: "A  b\nc", 2007: "é É", 2008: "é é"}
    want = plain.similar_groups(texts, k, percent)
    assert sum(i != c for i, c in want.items()) > 20
    assert found(spark, texts, k, percent) == want


def test_groups_of_several_blocks_and_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(connected, "TASK_EDGES", 7)
    texts = near_copies(5, 4, 20, 70, 5)
    assert found(spark, texts, 3, 85) == plain.similar_groups(texts, 3, 85)


def test_texts_of_common_passages(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMMON_SHARE", 0.05)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {i: f"{t} {passage}" for i, t in near_copies(6, 25, 3, 30, 3).items()} | {900 + i: passage + f" e{i}" for i in range(6)}
    want = plain.similar_groups(texts, 5, 80)
    assert 10 < len(set(want.values())) < 60
    assert found(spark, texts, 5, 80) == want


def test_a_hot_group_needs_few_comparisons():
    r = random.Random(7)
    base = [np.uint64(r.getrandbits(64)) for _ in range(200)]
    sets = [np.unique(np.array(base + [np.uint64(r.getrandbits(64)) for _ in range(5)])) for _ in range(600)]
    tree = jaccard.SignatureTree(sets, 90)
    assert len(tree.join()) == 599 and tree.compared < 3 * 600


def test_tree_finds_every_component_of_unrelated_and_chained_sets():
    r = random.Random(9)
    chain = [np.array(range(i, i + 40), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(30)]
    noise = [np.unique(np.array([r.getrandbits(64) for _ in range(r.randrange(1, 60))], dtype=np.uint64)) for _ in range(80)]
    sets = [np.unique(s) for s in chain] + noise
    links = jaccard.SignatureTree(sets, 90).join()
    assert len(links) == 29 and all(a < 30 and b < 30 for a, b in links)


@pytest.mark.parametrize("percent", [90, 80, 55])
def test_no_possible_link_misses_a_common_part(percent):
    r = random.Random(11)
    for _ in range(600):
        n = r.randrange(1, 120)
        a = {r.getrandbits(64) for _ in range(n)}
        most = 1 + n * (100 - percent) // 100
        b = set(r.sample(sorted(a), max(1, n - r.randrange(most)))) | {r.getrandbits(64) for _ in range(r.randrange(most))}
        sets = [np.array(sorted(x), dtype=np.uint64) for x in (a, b)]
        if 100 * len(a & b) < percent * len(a | b):
            continue
        share = r.choice([0, 0.2, 0.6, 1])
        common = np.zeros(1 << jaccard.COMMON_BITS, dtype=bool)
        for x in a | b:
            common[x >> (64 - jaccard.COMMON_BITS)] |= r.random() < share
        keys = []
        for s in sets:
            classes = jaccard.SizeClasses(percent, len(s))
            keys.append(set(jaccard.part_keys(s, np.array([0, len(s)]), classes, common)[0].tolist()))
        assert keys[0] & keys[1]


def test_null_ids_and_repeated_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, long), (7, long + " x"), (5, long), (5, long), (None, "other text here now"), (9, None), (9, None)]
    got = jaccard.near_groups(plain.documents(spark, rows), 3, 90).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0) for r in got) == [(False, 5, 5), (False, 5, 5), (False, 7, 5), (False, 9, 9), (False, 9, 9), (True, 0, 0), (True, 0, 5)]
    kept = jaccard.keep_one(plain.documents(spark, rows, "__key leader"), 3, 90)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "__key", "leader"]
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in kept.collect()), key=lambda x: x[:2]) == [(False, 5, long), (False, 9, None), (True, 0, "other text here now")]


def test_empty_table(spark):
    assert jaccard.near_groups(plain.documents(spark, []), 3, 90).count() == 0
    assert jaccard.keep_one(plain.documents(spark, []), 5, 80).count() == 0


@pytest.mark.parametrize("task_edges", [9, 100_000])
def test_components_of_long_paths_and_hubs(spark, monkeypatch, task_edges):
    monkeypatch.setattr(connected, "TASK_EDGES", task_edges)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 200)] + [(300, 300), (400, 401), (401, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 200)} | {400: 400, 401: 400}


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r.component_id for r in QUERIES["op2_ngram_jaccard_join"](spark, folder).collect()}
    assert got == plain.similar_groups(docs, 3, 90)


def test_a_key_of_many_sets_is_sent_once_and_connects_them():
    random = np.random.default_rng(4)
    for _ in range(200):
        n = int(random.integers(1, 12))
        sets = np.sort(random.integers(0, n, int(random.integers(0, 30))))
        keys = random.integers(0, 6, len(sets)).astype(np.uint64)
        short = random.permutation(100)[:n].astype(np.int64)

        def linked(keys, sets):
            root = list(range(n))
            for _ in range(n):
                for k in set(keys.tolist()):
                    own = [int(s) for s in sets[keys == k]]
                    least = min(root[s] for s in own)
                    for s in own:
                        root[s] = least
            return root

        few, own = jaccard.one_of_each(keys, sets, short)
        assert linked(few, own) == linked(keys, sets) and (np.diff(own) >= 0).all()
        given = np.isin(few, keys)
        assert len(np.unique(few[given])) == given.sum() == len(np.unique(keys))
