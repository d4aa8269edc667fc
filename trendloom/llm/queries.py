"""The queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm import conversations, factorise, filters, html, jaccard, language, licences, mixing, rules, secrets, tiling, toxicity, warc
from trendloom.llm.common import in_fold
from trendloom.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extracted(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_groups(table(spark, folder, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = toxicity.scored(docs, toxicity.train(docs, table(spark, folder, "labels")))
    held = in_fold(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD)
    return scores.select("doc_id", held.alias("held_out"), "score", "predicted", "evidence")


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.predicted(docs, language.train(docs))
    held = in_fold(F.col("doc_id"), language.FOLDS, language.HELD)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op5_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = factorise.train(docs, table(spark, folder, "labels"))
    scores = factorise.scored(docs, machine)
    return scores.select("doc_id", in_fold(F.col("doc_id"), factorise.FOLDS, factorise.HELD).alias("held_out"), "score", "predicted")


@query
def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"))


@query
def op7_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return rules.judged(docs, rules.train(docs, table(spark, folder, "labels")))


@query
def op9_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    warc.register(spark)
    path = new_folder(spark, "archive")
    warc.page_records(table(spark, folder, "pages")).write.format("warc").mode("append").save(path)
    records = spark.read.format("warc").option("payload", "digest").load(path)
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


@query
def op10_contamination(spark: SparkSession, folder: str) -> DataFrame:
    pairs = tiling.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return pairs.drop("row_key")


@query
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"), secrets.fresh_ledger(spark))


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filters.interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.drill(table(spark, folder, "conversations"))
