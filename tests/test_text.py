"""Whole-word matching against Python's own regex engine in ASCII mode."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from trendloom.functions import text as text_module
from trendloom.functions.text import Term, any_term_regex, check_terms, mentions, phrases, whole_word
from trendloom.operators.mentions import explode_mentions, with_mentions
from trendloom.sources.terms import shipped_terms

ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def expected(text: str, term: Term) -> bool:
    lowered = text.translate(ASCII_LOWER)
    if term.exclude_pattern:
        lowered = re.sub(rf"\b({term.exclude_pattern})\b", " ", lowered, flags=re.ASCII)
    return re.search(rf"\b({term.pattern})\b", lowered, flags=re.ASCII) is not None


def matched(spark, texts: list[str], terms: list[Term], titles: list[str] | None = None) -> set[tuple]:
    titles = titles or texts
    rows = spark.createDataFrame(list(enumerate(zip(texts, titles, strict=True))), "i int, t struct<text:string,title:string>")
    df = rows.select("i", "t.text", "t.title")
    found = with_mentions(df, F.col("text"), terms, title="title")
    return {(r.i, r.tool, r.is_in_title) for r in explode_mentions(found).collect()}


def brute_force(texts, terms, titles=None) -> set[tuple]:
    titles = titles or texts
    return {
        (i, t.tool, expected(title, t))
        for i, (text, title) in enumerate(zip(texts, titles, strict=True))
        for t in terms
        if expected(text, t)
    }


CASES = [
    "spark", "Spark!", "pyspark rocks", "sparkling", "spark_sql", "my-spark", "éspark", "sparké", "SPARK é",
    "power bi", "power  bi", "Power BI.", "powerbi", "power\nbi", "power-bi",
    "sql server agent", "SQL Server Agent and an agent", "user-agent", "agents", "agentic agent",
    "sql server agents", "hot sql server agenté", "", " ", "ai", "l'ai", "ai-driven", "aïai", "AI2", "K8s Kafka kafkaK",
    "İai", "delta lake", "delta lakes", "delta tables delta table", "ms fabric", "fabrics",
]


def test_shipped_dictionary_has_35_tools_and_one_exclusion():
    terms = shipped_terms()
    assert len(terms) == 35
    assert len({t.category for t in terms}) == 12
    assert [t.tool for t in terms if t.category == "ai"] == ["AI (general)", "LLM", "AI Agent", "MCP", "RAG"]
    assert [t.tool for t in terms if t.exclude_pattern] == ["AI Agent"]


def test_edge_cases_match_ascii_word_boundaries(spark):
    terms = shipped_terms()
    assert matched(spark, CASES, terms) == brute_force(CASES, terms)


REGEX_TERMS = [
    Term("plus", "x", r"c\+\+"),
    Term("dot", "x", r"\.net|net"),
    Term("digits", "x", r"v\d+"),
    Term("any", "x", r"a.b"),
    Term("open", "x", r"foo(bar)?", r"foo+ bar"),
    Term("hyphen", "x", "user-agent"),
]


def random_texts(words: list[str], count: int) -> list[str]:
    picker = random.Random(7)
    joins = [" ", " ", "  ", "-", "_", ".", ", ", "é", "\n", ""]
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(picker.randint(1, 8)):
            word = picker.choice(words)
            parts += [word.upper() if picker.random() < 0.3 else word, picker.choice(joins)]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("group", [64, 1, 7])
def test_random_texts_match_brute_force(spark, monkeypatch, group):
    """Groups of any size, with plain phrases and with regexes, and both in one dictionary."""
    monkeypatch.setattr(text_module, "GROUP", group)
    plain = shipped_terms()
    words = [w for t in plain for w in t.pattern.split("|")] + ["sql server agent", "user-agent", "the", "é", "x1"]
    texts = random_texts(words, 400)
    titles = random_texts(words, 400)
    assert matched(spark, texts, plain, titles) == brute_force(texts, plain, titles)
    odd = random_texts(["c++", ".net", "net", "v12", "v", "a.b", "axb", "foo", "foobar", "foo bar", "user", "agent", "é"], 400)
    assert matched(spark, odd, REGEX_TERMS) == brute_force(odd, REGEX_TERMS)
    both = plain + REGEX_TERMS
    assert matched(spark, texts + odd, both) == brute_force(texts + odd, both)


def test_a_dot_takes_line_breaks_in_a_pattern_but_not_in_an_exclusion(spark):
    terms = [Term("A", "x", "sql.server"), Term("B", "x", "server", "sql.server")]
    found = matched(spark, ["sql\nserver", "sql server", "sql\r\nserver"], terms)
    assert {(i, tool) for i, tool, _ in found} == {(0, "A"), (0, "B"), (1, "A"), (2, "B")}


def test_a_large_dictionary(spark):
    terms = [Term(f"tool {i}", "x", f"w{i}|w{i} x") for i in range(300)]
    texts = random_texts([f"w{i}" for i in range(310)] + ["x"], 100)
    assert matched(spark, texts, terms) == brute_force(texts, terms)


def test_an_exclusion_only_concerns_its_own_term(spark):
    found = matched(spark, ["sql server agent"], shipped_terms())
    assert {tool for _, tool, _ in found} == {"SQL Server"}


@pytest.mark.parametrize("blank", ["", None])
def test_a_blank_exclusion_excludes_nothing(spark, blank):
    rows = spark.createDataFrame([("power bi",)], "t string")
    assert rows.select(mentions(F.col("t"), "power bi", blank)).first()[0] is True


def test_a_null_text_mentions_nothing(spark):
    rows = spark.createDataFrame([(1, None)], "i int, t string")
    assert with_mentions(rows, F.col("t"), shipped_terms()).first().mentions == []


def test_patterns_must_be_lower_case():
    with pytest.raises(ValueError, match="lower case"):
        check_terms([Term("X", "x", "Spark")])
    assert check_terms([Term("X", "x", r"spark\S")])


def test_only_plain_phrases_are_screened():
    assert phrases("power bi|powerbi") == ["power bi", "powerbi"]
    assert phrases("c\\+\\+") is None
    assert phrases("two  spaces") is None
    assert "(?i)" in whole_word("spark")


ODD_PATTERNS = [
    "th[ae]t?", r"\w{2,}ing", "é[a-z]+", "une?", r"[a-z]+\..the", r"\.net|net", "x?ab", "a|(b|c)", "a{0,2}b", "a{1,2}b", "(ab)c",
    "a|", "[^a]b", "[.-]x|-y", "[a-é]x", r"a|\|b", "[|]a|b", r"\d+|-\w", "[a[b]]c", r"\Qa|b\E", "_a", "[0-9a-f]b|c", " b|é",
]


def test_a_regex_looks_at_one_character_before_it_looks_around():
    starts = {p: whole_word(p).split("(?:" + p)[0].removeprefix("(?i)").replace(text_module.BOUNDARY, "B") for p in ODD_PATTERNS}
    word = f"(?<!{text_module.WORD})"
    assert starts["th[ae]t?"] == f"(?=t){word}" and starts[r"\w{2,}ing"] == rf"(?=\w){word}"
    assert starts["é[a-z]+"] == "(?=é)B" and starts[r"\.net|net"] == r"(?=[\.n])B" and starts["[.-]x|-y"] == "(?=-|[.-])B"
    assert {p for p, s in starts.items() if s == "B"} == {"x?ab", "a|(b|c)", "a{0,2}b", "(ab)c", "a|", "[a[b]]c", r"\Qa|b\E"}
    assert any_term_regex([Term("a", "x", "of|the"), Term("b", "x", "on")]).startswith("(?i)(?=[ot])")


def test_looking_at_the_first_character_changes_no_match(spark):
    texts = random_texts(["THAT", "tha", "sing", "ing", "éa", "Un", "une", "x.\nthe", ".net", "aab", "ab", "c", "-x", "-y", "|b", "1a", "_a", "ſ", "K", "a|b", "éx"], 400)
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    for how in ("(?s)", ""):
        plain = [F.regexp_replace("text", f"{how}(?i){text_module.BOUNDARY}(?:{p}){text_module.BOUNDARY}", "#") for p in ODD_PATTERNS]
        ahead = [F.regexp_replace("text", how + whole_word(p), "#") for p in ODD_PATTERNS]
        wrong = rows.agg(*[F.count_if(a != b) for a, b in zip(ahead, plain, strict=True)]).first()
        changed = rows.agg(*[F.count_if(a != F.col("text")) for a in ahead]).first()
        assert [p for p, n in zip(ODD_PATTERNS, wrong, strict=True) if n] == []
        assert sum(n > 0 for n in changed) >= 15
