from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa

import plain
from compare import connect, difference
from trendloom.llm import filters, textkit, transducer
from trendloom.llm.oracle import ORACLE
from trendloom.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def plain_measures(text):
    words = plain.WORD.findall(text)
    return [len(words), len(set(words)), sum("A" <= c <= "Z" for c in text), len(text), sum(c in "#$%&*|" for c in text)]


def plain_audit(docs, labels):
    """Every order walked document by document."""
    smallest: dict = {}
    for i, text, _ in docs:
        if i is not None:
            smallest[text or ""] = min(smallest.get(text or "", i), i)
    rows, known = [], [r for r in labels if r[0] is not None]
    for i, text, part in docs:
        words, distinct, capitals, points, symbols = plain_measures(text or "")
        fails = "A" * (words < 50) + "B" * (100 * distinct < 65 * words) + "C" * (100 * capitals > 5 * points) + "D" * (symbols > 0)
        fails += "E" * (i is not None and smallest[text or ""] < i)
        rows.append((part or "", fails, any(k == i and q == 1 for k, q, _ in known), any(k == i and t == 1 for k, _, t in known)))
    out, shapley = [], Counter()
    for part in {p for p, *_ in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                now = [r for r in left if f in r[0]]
                redundant = sum(f in r[0] for r in gone)
                left, gone = [r for r in left if f not in r[0]], gone + now
                shapley[part, f] += len(now)
                good, bad = sum(g for _, g, _ in now), sum(b for _, _, b in now)
                out.append([part, "".join(order), step, len(left), len(now), redundant, sum(r[0] == f for r in own), good, bad])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audit(spark, docs, labels, extra=""):
    frame = plain.documents(spark, [(i, t, None, s) for i, t, s in docs], extra)
    return sorted(map(tuple, filters.interactions(frame, spark.createDataFrame(labels, LABELS)).collect()))


def some_documents(r):
    words = ["A", "bb", "ça", "Zwölf", "#x", "word", "longer-than-sixteen-bytes", "longer-than-sixteen-bytez", "日本語"]
    texts = [None, "", " \t", "A", "a" * 9000 + " " + "a" * 9000 + " " + "a" * 8999 + "b"]
    texts += [r.choice(" \n\x0b").join(r.choices(words, k=r.choice([3, 49, 50, 51, 200]))) for _ in range(20)]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in (49, 50, 77)]
    return [(i if r.random() < 0.95 else None, r.choice(texts), r.choice(["a", "b", "", None])) for i in range(150)] + [(3, "twice", "a"), (3, "twice", "a")]


def test_against_every_order_walked(spark):
    r = random.Random(12)
    docs = some_documents(r)
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    assert audit(spark, docs, labels, "TEXT PART fails digest") == plain_audit(docs, labels)


def test_without_documents_or_labels(spark):
    assert audit(spark, [], []) == []
    assert audit(spark, [(1, None, None)], []) == plain_audit([(1, None, None)], [])
    assert len(audit(spark, [(1, None, None)], [])) == 600


def test_one_text_in_most_rows_and_a_very_long_one(spark):
    docs = [(i, "the same text", f"s{i % 3}") for i in range(600)] + [(900, "x é# " * 400_000, "s0"), (901, "y" * 3_000_000, None)]
    assert audit(spark, docs, []) == plain_audit(docs, [])


def test_the_machine_counts_as_patterns_do():
    r = random.Random(5)
    texts = ["".join(r.choices("aB #\n\t\x0b\x85é日😀", k=r.choice([0, 1, 2, 40, 400]))) for _ in range(300)]
    for chunk in textkit.chunks(pa.array(texts)):
        assert filters.measures(chunk).tolist() == [plain_measures(t) for t in texts]
        found = transducer.run(chunk, transducer.classes(b"#"))
        spans = [bytes(chunk.data[a:b]).decode() for a, b in zip(found.begins, found.ends, strict=True)]
        assert spans == [w for t in texts for w in plain.WORD.findall(t)]


def test_equal_hashes_do_not_make_equal_words(monkeypatch):
    monkeypatch.setattr(transducer.Spans, "hashes", lambda self, owners: np.zeros(len(owners), np.uint64))
    texts = ["a b a c", "a", "", "prefix-of-sixteen-x prefix-of-sixteen-y prefix-of-sixteen-x", "z" * 5000 + " " + "z" * 5000]
    for chunk in textkit.chunks(pa.array(texts)):
        assert filters.measures(chunk)[:, 1].tolist() == [len(set(plain.WORD.findall(t))) for t in texts]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert difference(QUERIES["op12_filter_audit"](spark, folder), connect(folder), ORACLE["op12_filter_audit"]) == ""
