"""Whole-word matching of dictionaries with thousands of terms, by one automaton over all phrases.

An expression per term grows the plan with the dictionary. Here all plain phrases go into one
Aho-Corasick automaton, which every Python worker builds once and keeps; it passes over a text once,
whatever the number of phrases, and only its hits are looked at: that they stand between word
boundaries, and, for a term that excludes phrases, that its regex still matches with them blanked
out. Terms that are no plain phrases are matched by expressions as in ``text``. Both give the rows of
``mention_array``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.text import WORD, Searched, Term, check_terms, mention_array, phrases, screenable
from trendloom.session import ship_package

_WORD_CHARACTERS = frozenset("0123456789_abcdefghijklmnopqrstuvwxyz")


class Matcher:
    """Finds the terms of a dictionary in one text after another."""

    def __init__(self, terms: tuple[Term, ...]) -> None:
        import ahocorasick

        self.terms = terms
        by_phrase: dict[str, list[int]] = {}
        for number, term in enumerate(terms):
            for phrase in phrases(term.pattern):
                by_phrase.setdefault(phrase, []).append(number)
        self.automaton = ahocorasick.Automaton()
        for phrase, numbers in by_phrase.items():
            self.automaton.add_word(phrase, (len(phrase), numbers))
        self.automaton.make_automaton()
        self.excluding = {n: (self._regex(t.exclude_pattern), self._regex(t.pattern)) for n, t in enumerate(terms) if t.exclude_pattern}

    @staticmethod
    def _regex(pattern: str) -> re.Pattern:
        return re.compile(f"(?<!{WORD})(?:{pattern})(?!{WORD})", re.IGNORECASE | re.ASCII)

    def found(self, text: str) -> list[int]:
        """Numbers of the terms that the text mentions, ascending. Only ASCII letters lose their case."""
        if not self.terms:
            return []
        lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        hits: set[int] = set()
        for end, (size, numbers) in self.automaton.iter(lowered):
            before, after = lowered[max(end - size, 0) : end - size + 1], lowered[end + 1 : end + 2]
            if before not in _WORD_CHARACTERS and after not in _WORD_CHARACTERS:
                hits.update(numbers)
        return sorted(n for n in hits if n not in self.excluding or self._left(text, *self.excluding[n]))

    @staticmethod
    def _left(text: str, excluded: re.Pattern, pattern: re.Pattern) -> bool:
        return pattern.search(excluded.sub(" ", text)) is not None


@functools.lru_cache(maxsize=4)
def matcher(terms: tuple[Term, ...]) -> Matcher:
    return Matcher(terms)


def _column(found: list[list[int]], terms: tuple[Term, ...], in_title: list[set[int]] | None) -> pa.Array:
    """``array<struct<tool, category[, is_in_title]>>`` from the numbers of each text."""
    numbers = [n for own in found for n in own]
    offsets = pa.array([0, *[len(own) for own in found]], pa.int32())
    fields = {"tool": pa.array([terms[n].tool for n in numbers], pa.string()), "category": pa.array([terms[n].category for n in numbers], pa.string())}
    if in_title is not None:
        fields["is_in_title"] = pa.array([n in title for own, title in zip(found, in_title, strict=True) for n in own], pa.bool_())
    rows = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
    return pa.ListArray.from_arrays(pc.cumulative_sum(offsets), rows)


def with_mentions_of_many(df: DataFrame, text: Column, terms: Iterable[Term], title: str | None = None) -> DataFrame:
    """As ``mentions.with_mentions``, for dictionaries of any size: the plan does not grow with them.

    A null text mentions nothing. Columns of ``df`` pass through the workers as they are.
    """
    ship_package(df.sparkSession)
    terms = check_terms(terms)
    plain = tuple(t for t in terms if screenable(t))
    others = [t for t in terms if not screenable(t)]
    columns = df.columns
    titled = title is not None
    rows = df.withColumn("_text", F.coalesce(text, F.lit("")))
    if titled:
        rows = rows.withColumn("_title", F.coalesce(title, F.lit("")))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher(plain)
        for batch in batches:
            found = [own.found(x) for x in batch.column("_text").to_pylist()]
            titles = None if not titled else [set(own.found(x)) if f else set() for x, f in zip(batch.column("_title").to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _column(found, plain, titles)], names=[*batch.schema.names, "mentions"])

    kind = f"array<struct<tool:string,category:string{',is_in_title:boolean' if titled else ''}>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows = rows.mapInArrow(match, f"{schema}, mentions {kind}")
    if not others:
        return rows.select(*columns, "mentions")
    rows = rows.withColumn("_lowered", F.lower("_text"))
    in_title = None if not titled else Searched(F.col("_title"), F.lower("_title"))
    more = mention_array(Searched(F.col("_text"), F.col("_lowered")), others, in_title)
    return rows.select(*columns, F.concat("mentions", more.cast(kind)).alias("mentions"))
