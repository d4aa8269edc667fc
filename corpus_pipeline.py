"""From raw documents to a training mix: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendloom.llm import jaccard, language, mixing, rules, tiling
from trendloom.session import new_folder

# Near copies: shingles of five words, a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80

# Trained models, shuffled mixes and tilings can't be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, or whose language the model doesn't know with confidence."""
    return language.keep_known(docs, language.train(docs))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or the trees."""
    return rules.keep_good(docs, rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near copies."""
    return jaccard.keep_one(docs, SHINGLE, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return tiling.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with the words of them that it takes, repeats counted."""
    own = ("doc_id", "size", "source_size", "target", "taken", "finish")
    columns = [c for c in docs.columns if c.lower() not in own]
    return mixing.mix(docs, carry=columns).where("taken > 0")


STAGES = [
    ("language", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_copies", drop_near_copies),
    ("decontaminate", decontaminate),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
