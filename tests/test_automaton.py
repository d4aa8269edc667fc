from __future__ import annotations

import random

from pyspark.sql import functions as F

from trendloom.functions.automaton import matcher, with_mentions_of_many
from trendloom.functions.text import Term
from trendloom.operators.mentions import with_mentions
from trendloom.sources.terms import shipped_terms

TERMS = [
    Term("Sql Server", "db", "sql server"),
    Term("Sql", "db", "sql", "sql server|sql server agent"),
    Term("C", "lang", "c|c-like"),
    Term("Agent", "ai", "agent|agents|agentic", "sql server agent|user-agent"),
    Term("Regex", "x", r"data ?bricks"),
    Term("Both", "x", "spark", r"spark(ling)? water"),
    Term("Twice", "a", "sql"),
    Term("Twice", "b", "sql"),
]
PIECES = ["sql", "SQL", "server", "Server", "agent", "agents", "user-agent", "c", "C", "c-like", "_", "é", "-", " ", "  ", "\n", ".", "databricks", "Spark", "sparkling water", "ſql", "K", "İ", "9"]


def rows(df):
    return sorted((r.i, sorted(tuple(m) for m in r.mentions)) for r in df.collect())


def both(spark, texts, terms, titles=None):
    data = [(i, t, None if titles is None else titles[i]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "i long, text string, title string")
    title = None if titles is None else "title"
    many = with_mentions_of_many(df, F.col("text"), terms, title)
    return rows(many), rows(with_mentions(df.fillna(""), F.col("text"), terms, title))


def test_the_rows_are_those_of_the_expressions(spark):
    r = random.Random(6)
    texts = ["".join(r.choices(PIECES, k=r.choice([1, 2, 5, 9]))) for _ in range(600)] + ["", None, "x" * 50_000 + " sql"]
    titles = ["".join(r.choices(PIECES, k=2)) for _ in texts]
    titles[3] = None
    for terms in (TERMS, shipped_terms(), TERMS[:4], [TERMS[4]], []):
        many, each = both(spark, texts, terms)
        assert many == each
    texts = [a and f"{b or ''} {a}" for a, b in zip(texts, titles, strict=True)]
    many, each = both(spark, texts, TERMS, titles)
    assert many == each and any(m[2] for _, own in many for m in own)


def test_the_plan_does_not_grow_with_the_dictionary(spark):
    df = spark.createDataFrame([("spark",)], "text string")
    few, many = ([Term(f"t{i}", "x", f"word{i}") for i in range(n)] for n in (10, 5000))
    sizes = [len(with_mentions_of_many(df, F.col("text"), terms)._jdf.queryExecution().executedPlan().toString()) for terms in (few, many)]
    assert sizes[1] < sizes[0] + 100


def test_a_worker_builds_a_dictionary_once():
    terms = tuple(Term(f"t{i}", "x", f"word{i}") for i in range(100))
    assert matcher(terms) is matcher(tuple(Term(*t) for t in terms))
    assert [terms[n].tool for n in matcher(terms).found("Word3 word33 xword4 word5_ (word6)")] == ["t3", "t6", "t33"]
