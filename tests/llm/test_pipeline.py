from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage, and the result of the last."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(rows.collect(), rows.schema)
        out.append(docs.collect())
    return out


def test_columns_and_rows_are_kept(spark, stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for before, after in zip(stages, stages[1:], strict=False):
        assert len(after) <= len(before)
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == columns
        assert set(rows) <= set(stages[0])
    assert list(stages[-1][0].asDict())[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_rejects_only_what_has_no_language(stages):
    assert len(stages[1]) >= 0.98 * len(stages[0])


def test_quality_rules_take_effect_and_keep_good_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[2]}
    for r in stages[1]:
        words = plain.WORD.findall(r.text)
        if len(words) < 50:
            assert r.doc_id not in kept
    good = [r.doc_id for r in stages[1] if labels.get(r.doc_id) == 1 and len(plain.WORD.findall(r.text)) >= 80]
    assert sum(i in kept for i in good) > 0.9 * len(good)


def test_one_document_of_each_group_stays(stages):
    heads = plain.similar_groups({r.doc_id: r.text for r in stages[2]}, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    assert sorted(r.doc_id for r in stages[3]) == sorted(set(heads.values()))


def test_no_document_holds_a_benchmark_item(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {r.doc_id for r in stages[3] if any(item in r.text for item in items)}
    kept = {r.doc_id for r in stages[4]}
    assert not held & kept and len(stages[3]) - len(stages[4]) <= len(held) + 2


def test_the_mix_takes_about_its_budget(stages):
    words = {r.doc_id: len(plain.WORD.findall(r.text)) for r in stages[4]}
    total = sum(words.values())
    taken = sum(r.taken for r in stages[5])
    assert 0.95 * total < taken <= total
    assert all(r.taken in (words[r.doc_id], 2 * words[r.doc_id], 3 * words[r.doc_id]) for r in stages[5])


def test_odd_rows_pass_every_stage(spark):
    long = " ".join(f"the word{i} and" for i in range(80))
    odd = [(None, long), (1, None), (2, ""), (3, long), (3, long), (4, "x " * 50_000), (5, long + " more", None, None)]
    docs = plain.documents(spark, odd, "size score __key")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns
        kept.collect()
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    mixed = corpus_pipeline.mix_sources(spark, docs, FOLDER)
    assert mixed.select(F.sum("taken")).first()[0] > 0
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), FOLDER).count() == 0


def test_run_writes_each_stage_and_gives_the_last(spark, stages):
    got = sorted((r.doc_id, r.taken) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == sorted((r.doc_id, r.taken) for r in stages[-1])


