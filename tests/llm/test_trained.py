"""The four trained operators: their methods against plain versions, and their queries on held-out rows."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

import plain
from test_textkit import plain_counts
from trendloom.llm import docstats, factorise, language, rules, textkit, toxicity
from trendloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
CLASHES = "score predicted kept bins draw n"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "1 AS __label", "2 AS n")


def held(doc_id, folds, fold) -> bool:
    return crc32(str(doc_id).encode()) % folds == fold


def joined(spark, name):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES[name](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    return got, docs, labels


def area(scores, y) -> float:
    """Share of pairs of a one and a zero that are in order."""
    ones, zeros = (np.array([s for s, v in zip(scores, y, strict=True) if v == k]) for k in (1, 0))
    return float(((ones[:, None] > zeros) + 0.5 * (ones[:, None] == zeros)).mean())


# --- quality rules ---------------------------------------------------------------------------


def walk(forest, x):
    raw = forest.prior
    for at in forest.roots:
        for _ in range(forest.depth):
            at = forest.left[at] if x[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
        raw += forest.value[at]
    return 1 / (1 + np.exp(-raw))


def test_flat_trees_score_as_walked_and_keep_to_their_directions():
    random = np.random.default_rng(1)
    x = random.random((800, 3))
    y = ((x[:, 0] + x[:, 1] + 0.3 * random.standard_normal(800)) > 1).astype(float)
    forest = rules.grow(x, y, np.ones(800), np.array([1, -1, 0]))
    assert np.allclose(forest.score(x[:50]), [walk(forest, row) for row in x[:50]])
    for f, direction in ((0, 1), (1, -1)):
        for row in x[:40]:
            line = np.repeat(row[None, :], 60, axis=0)
            line[:, f] = np.linspace(-0.2, 1.2, 60)
            assert (np.diff(forest.score(line)) * direction >= -1e-12).all()
    free = rules.grow(x, y, np.ones(800), np.zeros(3))
    assert area(free.score(x), y) > area(forest.score(x), y) > 0.7


def test_quality_rules_query(spark):
    got, docs, labels = joined(spark, "op8_quality_rules")
    for r in got:
        assert [r[c] for c in docstats.COUNTS] == plain_counts(docs[r.doc_id].text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    rest = [r for r in got if not r.base_failed and held(r.doc_id, rules.FOLDS, rules.HELD) and r.doc_id in labels]
    right = [r.kept == (labels[r.doc_id].quality == 1) for r in rest]
    assert len(right) > 30 and np.mean(right) > 0.95


# --- factorisation machine -------------------------------------------------------------------


def test_pairs_by_the_identity_equal_all_pairs():
    random = np.random.default_rng(2)
    width = factorise.BINS + 2
    machine = factorise.Machine(0.3, random.standard_normal(width).astype(np.float32), random.standard_normal((width, 4)).astype(np.float32), np.zeros(2), np.ones(2))
    x = np.zeros((1, width), np.float32)
    at = [3, 70, 500, width - 1]
    x[0, at] = [1, 0.5, 2, -1]
    pairs = sum(x[0, i] * x[0, j] * (machine.factors[i] @ machine.factors[j]) for n, i in enumerate(at) for j in at[n + 1 :])
    assert machine.raw(x)[0] == pytest.approx(0.3 + x[0] @ machine.linear + pairs, rel=1e-4)


def test_factors_learn_an_interaction():
    random = np.random.default_rng(3)
    words = np.zeros((600, factorise.BINS), np.float32)
    a, b = random.integers(0, 2, 600), random.integers(0, 2, 600)
    words[:, 5], words[:, 9] = a, b
    y = (a & b).astype(float)
    machine = factorise.fit(words, np.zeros((600, 1)), y, np.ones(600))
    assert area(machine.score(words, np.zeros((600, 1))), y) == 1.0


def test_quality_score_query(spark):
    got, docs, labels = joined(spark, "op5_quality_score")
    assert all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    rest = [r for r in got if r.held_out and r.doc_id in labels]
    assert area([r.score for r in rest], [labels[r.doc_id].quality for r in rest]) > 0.9


# --- language --------------------------------------------------------------------------------


def test_characters_are_lowered_and_spaces_joined():
    (chunk,) = textkit.chunks(pa.array(["ÀB, 1c", "", " é×中😀 ", "x"]))
    codes, offsets = language.characters(chunk)
    own = [codes[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]
    code = lambda ch: int.from_bytes(ch.encode(), "little")
    assert own == [[code(c) for c in "àb c"], [], [code(c) for c in " é×中😀 "], [code("x")]]


def test_counts_do_not_depend_on_the_neighbours_in_a_batch():
    texts = ["the cat", "", "über", "a", None, "the cat"]
    whole = np.concatenate([c for ch in textkit.chunks(pa.array(texts)) for _, c in language.gram_counts(ch)])
    alone = [np.concatenate([c for ch in textkit.chunks(pa.array([t], pa.string())) for _, c in language.gram_counts(ch)])[0] for t in texts]
    assert (whole == np.array(alone)).all() and whole.sum(axis=1).tolist()[1] == 0


def test_ftrl_is_sparse_and_separates():
    random = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(300):
        c = i % 3
        rows.append((np.array([c, 3 + random.integers(50)]), np.array([1.0, 0.2])))
        labels.append(c)
    old = language.L1
    try:
        language.L1 = 0.5
        weights, bias = language.follow_the_leader(rows, np.array(labels), 100, 3)
    finally:
        language.L1 = old
    assert (weights[60:] == 0).all() and (weights[3:53] == 0).mean() > 0.3
    assert all((x @ weights[b] + bias).argmax() == c for (b, x), c in zip(rows, labels, strict=True))


def test_temperature_is_that_of_least_loss():
    random = np.random.default_rng(5)
    logits = random.standard_normal((4000, 3)) * 2
    labels = np.array([random.choice(3, p=p) for p in language.softmax(logits / 2.0)])
    assert 1.6 < language.calibrate(logits, labels) < 2.5


def test_language_query(spark):
    got, docs, _ = joined(spark, "op4_language")
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]) > 0.97


def test_language_edge_cases(spark):
    rows = [(i, ("the cat and the dog sat " if i % 2 else "der hund und die katze sind ") * 4, ("en", "de")[i % 2 == 0]) for i in range(40)]
    model = language.train(plain.documents(spark, rows, CLASHES))
    odd = plain.documents(spark, [(1, None), (2, ""), (3, "12 #$% \n"), (4, "—…"), (None, "the dog and the cat"), (5, "中"), (6, "the dog " * 50_000), (6, "the dog " * 50_000)], CLASHES + " lang_pred")
    got = language.predicted(odd, model).collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3, 4)} == {i: ("und", 0.0) for i in (1, 2, 3, 4)}
    assert [r.lang_pred for r in got if r.doc_id in (None, 6)] == ["en"] * 3
    assert [r.lang_pred for r in got if r.doc_id == 5][0] in ("en", "de")
    assert sorted((r.doc_id or 0) for r in language.keep_known(odd, model).collect() if r.doc_id != 5) == [0, 6, 6]
    nothing = language.train(plain.documents(spark, [(1, "abc", None), (2, None, "en")]))
    assert [(r.lang_pred, r.score) for r in language.predicted(odd.limit(1), nothing).collect()] == [("und", 0.0)]
    assert sorted((r.doc_id or 0) for r in language.keep_known(odd, nothing).collect()) == [0, 5, 6, 6]
    assert language.predicted(plain.documents(spark, []), model).count() == 0


def test_every_language_is_learned(spark):
    """Many more languages than are common, two of them with most of the rows."""
    names = [f"l{i:03}" for i in range(500)]
    word = lambda i: "".join(("abcdefghij", "klmnopqrst", "uvwxyzàèìò")[n][int(d)] for n, d in enumerate(f"{i:03}")) * 3
    rows = [(i * 8 + j, f"{word(i)} {word(i)}", name) for i, name in enumerate(names) for j in range(8 if i > 1 else 200)]
    rows = [(k, text, name) for k, (_, text, name) in enumerate(rows)]
    model = language.train(plain.documents(spark, rows))
    assert model.languages == names
    got = language.predicted(plain.documents(spark, [(i, word(i), None) for i in range(0, 500, 7)]), model).collect()
    assert np.mean([r.lang_pred == names[r.doc_id] for r in got]) > 0.9


def test_gram_counts_and_one_epoch_equal_plain_ones():
    texts = ["The cat, the CAT 12 é", "ünï çode x", "", "a b a b a"]
    (chunk,) = textkit.chunks(pa.array(texts))
    codes, offsets = language.characters(chunk)
    counts = np.concatenate([c for _, c in language.gram_counts(chunk)])
    for own, a, b in zip(counts, offsets, offsets[1:], strict=False):
        grams: dict = {}
        for n in language.GRAMS:
            for at in range(a, b - n + 1):
                key = tuple(codes[at : at + n].tolist())
                if key != (0x20,):
                    grams[key] = grams.get(key, 0) + 1
        # few grams, so that hardly two of them fall into one bin
        assert own.sum() == sum(grams.values()) and len(grams) - 2 <= (own > 0).sum() <= len(grams)

    random = np.random.default_rng(5)
    rows = [(np.unique(random.integers(0, 12, 5)), None) for _ in range(40)]
    rows = [(bins, random.random(len(bins))) for bins, _ in rows]
    labels = random.integers(0, 3, 40)
    weights, bias = language.follow_the_leader(rows, labels, 12, 3)
    z, n = [[0.0] * 3 for _ in range(13)], [[0.0] * 3 for _ in range(13)]

    def weight(j, c):
        l1, l2 = (0, 0) if j == 12 else (language.L1, language.L2)
        if abs(z[j][c]) <= l1:
            return 0.0
        sign = 1 if z[j][c] > 0 else -1
        return -(z[j][c] - sign * l1) / ((language.BETA + n[j][c] ** 0.5) / language.ALPHA + l2)

    order = np.random.default_rng(3)
    for _ in range(language.EPOCHS):
        for i in order.permutation(40):
            x = [*zip(rows[i][0].tolist(), rows[i][1].tolist(), strict=True), (12, 1.0)]
            w = {(j, c): weight(j, c) for j, _ in x for c in range(3)}
            raw = [sum(w[j, c] * v for j, v in x) for c in range(3)]
            p = [np.exp(r - max(raw)) for r in raw]
            for c in range(3):
                e = p[c] / sum(p) - (labels[i] == c)
                for j, v in x:
                    g = e * v
                    z[j][c] += g - ((n[j][c] + g * g) ** 0.5 - n[j][c] ** 0.5) / language.ALPHA * w[j, c]
                    n[j][c] += g * g
    assert np.allclose(weights, [[weight(j, c) for c in range(3)] for j in range(12)], atol=1e-9)
    assert np.allclose(bias, [weight(12, c) for c in range(3)], atol=1e-9)


# --- toxicity --------------------------------------------------------------------------------


def test_neighbours_are_those_of_all_cosines():
    random = np.random.default_rng(6)
    n, size = 700, 80
    y = random.integers(0, 2, n)
    rows = []
    for label in y:
        terms = np.unique(np.concatenate([random.integers(0, 20, 3) + 20 * label, random.integers(0, size, random.integers(0, 5))]))
        rows.append((terms, random.integers(1, 4, len(terms))))
    rows[5] = (np.zeros(0, int), np.zeros(0, int))
    index = toxicity.build(np.arange(n), rows, y, np.ones(n), toxicity.Vocabulary(np.arange(size)), random.random(size).astype(np.float32) + 0.1)
    queries = index.weights.T[random.permutation(n)[:60]]
    cosines, places = index.nearest(queries)
    every = queries @ index.weights
    want = -np.sort(-every, axis=1)[:, : toxicity.NEIGHBOURS]
    assert np.allclose(cosines, np.maximum(want, 0), atol=1e-5)
    hit = places >= 0
    assert np.allclose(np.take_along_axis(every, np.maximum(places, 0), axis=1)[hit], cosines[hit], atol=1e-5)
    assert (index.bounds >= index.weights[:, : toxicity.BLOCK].max(axis=1, keepdims=True)).any()


def test_all_terms_of_the_examples_count(monkeypatch):
    random = np.random.default_rng(7)
    n, size = 300, 900
    y = random.integers(0, 2, n)
    rows = [(np.unique(np.append(random.integers(0, 40, 6), random.integers(0, size, 12))), None) for _ in y]
    rows = [(terms, random.integers(1, 4, len(terms))) for terms, _ in rows]
    idf = random.random(size).astype(np.float32) + 0.1
    every = np.zeros((n, size), np.float32)
    for i, (terms, counts) in enumerate(rows):
        every[i, terms] = (1 + np.log(counts)) * idf[terms]
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    want = -np.sort(-(every @ every.T), axis=1)[:, : toxicity.NEIGHBOURS]
    for head in (0, 30, size):
        monkeypatch.setattr(toxicity, "HEAD", head)
        index = toxicity.build(np.arange(n), rows, y, np.ones(n), toxicity.Vocabulary(np.arange(size)), idf)
        owner = np.repeat(np.arange(n), [len(t) for t, _ in rows])
        cosines, places = index.search(owner, np.concatenate([t for t, _ in rows]), np.concatenate([c for _, c in rows]), n)
        assert np.allclose(cosines, want, atol=1e-5) and (index.ids[places[:, 0]] == np.arange(n)).all()


def test_blocks_that_can_not_matter_are_left_out():
    """Texts of one kind, searched among two kinds that share few words."""
    random = np.random.default_rng(8)
    n, size = 1280, 120
    y = random.integers(0, 2, n)
    rows = [np.unique(random.integers(0, 55, 20) + 55 * label) for label in y]
    rows = [(np.append(terms, 110 + i % 10), random.integers(1, 4, len(terms) + 1)) for i, terms in enumerate(rows)]
    index = toxicity.build(np.arange(n), rows, y, np.ones(n), toxicity.Vocabulary(np.arange(size)), np.append(np.ones(110), np.full(10, 0.1)).astype(np.float32))
    every = np.zeros((n, size), np.float32)
    for i, (terms, counts) in enumerate(rows):
        every[i, terms] = (1 + np.log(counts)) * index.idf[terms]
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    one = np.flatnonzero(y)[:200]
    index.opened = index.left_out = 0
    cosines, _ = index.nearest(every[one])
    assert np.allclose(cosines, -np.sort(-(every[one] @ every.T), axis=1)[:, : toxicity.NEIGHBOURS], atol=1e-5)
    assert index.left_out > 0.4 * (index.left_out + index.opened)


def test_words_of_few_examples_find_them(spark):
    train = [(i, " ".join(f"{'bad' if i % 2 else 'kind'}{(i * 7 + j) % 400:03}" for j in range(12))) for i in range(1000)]
    docs, labels = plain.documents(spark, train), labels_of(spark, [(i, 1, i % 2) for i, _ in train])
    rare = plain.documents(spark, [(5001, "zzqq1"), (5002, "zzqq1")])
    marked = labels_of(spark, [(i, 1, i % 2) for i, _ in train] + [(5001, 1, 1), (5002, 1, 1)])
    index = toxicity.train(docs.union(rare), marked)
    assert len(index.vocabulary) > 800
    (row,) = toxicity.scored(plain.documents(spark, [(1, "zzqq1")]), index).collect()
    assert row.evidence and row.evidence.split(":")[0] in ("5001", "5002")


def test_terms_are_words_and_their_beginnings_in_any_case():
    (chunk,) = textkit.chunks(pa.array(["Abcdefgh, abcd ABCDefgh x", "abcdx"]))
    documents, terms, counts = toxicity._counted(*toxicity._terms(chunk))
    assert np.bincount(documents).tolist() == [6, 2]  # three words and three beginnings; a word and one
    assert counts.sum() == 4 + 2 * 3 + 1 + 1
    chosen = toxicity.Vocabulary(terms[documents == 0])
    own, places, times = chosen.counts(chunk)
    assert (own == 0).sum() == 6 and (own == 1).sum() == 1 and times[own == 0].sum() == 10


def test_toxicity_query(spark):
    got, docs, labels = joined(spark, "op3_toxicity")
    assert all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    rest = [r for r in got if r.held_out and r.doc_id in labels]
    assert area([r.score for r in rest], [labels[r.doc_id].toxic for r in rest]) > 0.75
    clean = [r for r in rest if labels[r.doc_id].toxic == 0]
    assert np.mean([r.predicted for r in clean]) < 0.05


# --- cases that all share ----------------------------------------------------------------------


ODD = [(None, "clean words " * 30), (1, None), (2, ""), (3, " \n\t"), (4, "bad nasty " * 100_000), (5, "bad nasty words"), (5, "bad nasty words"), (6, "#|# 中 😀")]


@pytest.mark.parametrize("operator, label", [(rules, "quality"), (factorise, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_labels(spark, operator, label):
    apply = operator.judged if operator is rules else operator.scored
    train = [(i, ("bad nasty rude " if i % 3 == 0 else "kind clean good ") * 20) for i in range(100, 220)]
    marks = [(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(100, 220)]
    marks += [(100, 1, 1), (100, 1, 1), (None, 1, 1), (101, None, None), (102, 5, 5), (9999, 1, 0)]
    docs, labels = plain.documents(spark, train, CLASHES), labels_of(spark, marks)
    model = operator.train(docs, labels)
    odd = plain.documents(spark, ODD, CLASHES + " __id __x")
    got = apply(odd, model).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3, 4, 5, 5, 6]
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1 and len({r.score for r in got if r.doc_id == 5}) == 1
    assert sorted(apply(odd, operator.train(docs, labels)).collect(), key=str) == sorted(got, key=str)
    none = plain.documents(spark, [])
    assert apply(none, model).count() == 0
    for rest in (labels.limit(0), labels.where(f"{label} = 1")):  # no labels, and one label
        constant = operator.train(docs, rest)
        assert all(0 <= r.score <= 1 for r in apply(odd, constant).collect())
    assert apply(odd, operator.train(none, labels)).count() == len(ODD)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = plain.documents(spark, [(i, ("bad nasty " if i % 2 else "kind good ") * (10 + i)) for i in range(80)])
    marks = [(i, 1 - i % 2, i % 2) for i in range(80)]
    other = [(i, i % 2, 1 - i % 2) if held(i, 5, 0) else (i, q, t) for i, q, t in marks]
    for operator, apply in ((factorise, factorise.scored), (toxicity, toxicity.scored), (rules, rules.judged)):
        one, two = (sorted(apply(docs, operator.train(docs, labels_of(spark, m))).collect()) for m in (marks, other))
        assert one == two


def test_keep_good_keeps_all_columns(spark):
    model = rules.Forest(np.zeros(1, int), np.zeros(1), np.zeros(1, int), np.zeros(1, int), np.zeros(1), np.zeros(1, int), 0, 2.0)
    docs = plain.documents(spark, [(1, " ".join(f"w{i}" for i in range(60))), (2, "few words"), (3, None), (4, "same words here " * 40)], "kept score")
    kept = rules.keep_good(docs, model)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
