"""Whole-word dictionary matching as column expressions.

A term is a lower-case regex that must stand between two word boundaries, where only
``[0-9A-Za-z_]`` are word characters. Java's ``\\b`` counts accented letters too, so the
boundary is spelled out with lookarounds.

Scanning every text with every regex is what costs. Terms that are plain words or phrases
(the usual case) are therefore screened first: one regex asks whether any term of a group
can occur at all, then ``contains`` asks it for one term, and only then its regex runs. Both
screens can only let too much through, so the result stays exact. Terms with regex syntax
have no screen and run beside the groups; they don't slow the others down.

A regex first looks at one character, wherever it is known what a match must begin with: the
lookarounds of a boundary cost several times as much at each place of a text.

In a term's pattern ``.`` takes line breaks too; in the phrases it excludes it doesn't.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "[0-9A-Za-z_]"
BOUNDARY = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# A word, or words joined by single spaces or hyphens: no regex syntax, no letter case, and a
# word character at both ends. Two separators in a row are left out, so that a blanked
# exclusion (its neighbours are never word characters) cannot create a phrase.
_PHRASE = re.compile(r"[a-z0-9_]+(?:[ -][a-z0-9_]+)*")

# The first piece of a regex that no match can do without: a character, \w, \d or a plain class.
_FIRST = re.compile(r"(?:[^.^$*+?{}()\[\]|\\]|\\[wd]|\\[^0-9A-Za-z]|\[\^?[^\[\]\\&^]+\])(?![?*]|\{(?![1-9]))")
_WORDLY = re.compile(r"[0-9A-Za-z_]|\\[wd]|\[(?:a-z|0-9|[0-9a-z_](?!-))+\]")
_PIECE = re.compile(r"\\.|\[(?:\\.|[^\]\\])*\]|.", re.DOTALL)
# quoted text, and classes that hold classes, cannot be cut into pieces this way
_NO_PIECES = re.compile(r"\\[QE]|\[[^\]]*\[|\[\^?\]|&&")

# Terms that share a screen and an array in the plan; a dictionary of any size is a list of such groups.
GROUP = 64


class Term(NamedTuple):
    """One dictionary row."""

    tool: str
    category: str
    pattern: str
    exclude_pattern: str | None = None


def phrases(pattern: str) -> list[str] | None:
    """The alternatives of a pattern made of plain phrases, else None."""
    alternatives = pattern.split("|")
    return alternatives if all(_PHRASE.fullmatch(a) for a in alternatives) else None


def first_pieces(pattern: str) -> list[str] | None:
    """What the matches of the pattern begin with, a piece per alternative at most; None if that isn't plain to see."""
    if _NO_PIECES.search(pattern):
        return None
    starts, depth = [""], 0
    for piece in _PIECE.findall(pattern):
        depth += (piece == "(") - (piece == ")")
        if piece == "|" and not depth:
            starts.append("")
        else:
            starts[-1] += piece
    found = [_FIRST.match(start) for start in starts]
    return sorted({f.group() for f in found}) if all(found) else None


def _ahead(pieces: list[str]) -> str:
    """Lookahead for one of the pieces, as one class if that can be written."""
    if len(pieces) == 1 or any(p.startswith("[") for p in pieces):
        return f"(?={'|'.join(pieces)})"
    return f"(?=[{''.join(p if p.isalnum() or p.startswith(chr(92)) else chr(92) + p for p in pieces)}])"


def whole_word(pattern: str) -> str:
    """Regex for the pattern between two ASCII word boundaries, in any ASCII letter case."""
    first = first_pieces(pattern)
    ahead = _ahead(first) if first else ""
    # a match that begins with a word character has a boundary before it if no other precedes
    before = f"(?<!{WORD})" if first and all(_WORDLY.fullmatch(p) for p in first) else BOUNDARY
    after = f"(?!{WORD})" if phrases(pattern) else BOUNDARY
    return f"(?i){ahead}{before}(?:{pattern}){after}"


def across_lines(regex: str) -> str:
    """The regex with a dot that takes line breaks."""
    return f"(?s){regex}"


def check_terms(terms: Iterable[Term]) -> list[Term]:
    """Terms as a list; patterns must be lower case, since texts are matched lower-cased."""
    terms = list(terms)
    for term in terms:
        for pattern in (term.pattern, term.exclude_pattern or ""):
            if re.search("[A-Z]", re.sub(r"\\.", "", pattern)):
                raise ValueError(f"pattern of {term.tool!r} must be lower case: {pattern!r}")
    return terms


def dictionary_key(terms: Iterable[Term]) -> str:
    """Short name of a dictionary's content."""
    return hashlib.sha256(repr(sorted(map(tuple, terms), key=repr)).encode()).hexdigest()[:16]


def screenable(term: Term) -> list[str] | None:
    """The phrases of a term that is made of plain phrases, exclusions too; else None."""
    if term.exclude_pattern and not phrases(term.exclude_pattern):
        return None
    return phrases(term.pattern)


def term_matches(text: Column, lowered: Column, term: Term) -> Column:
    """Whether the text mentions the term, once its excluded phrases are blanked out.

    ``lowered`` is ``lower(text)``, passed in so that it is computed once for all terms.
    """
    searched = text
    if term.exclude_pattern:
        searched = F.regexp_replace(text, whole_word(term.exclude_pattern), " ")
    found = F.rlike(searched, F.lit(across_lines(whole_word(term.pattern))))
    words = screenable(term)
    if words is None:
        return found
    return reduce(or_, [F.contains(lowered, F.lit(w)) for w in words]) & found


def mentions(text: Column, pattern: str, exclude_pattern: str | None = None) -> Column:
    """Whole-word match of one pattern, on its own."""
    term = check_terms([Term("", "", pattern, exclude_pattern or None)])[0]
    return term_matches(text, F.lower(text), term)


def any_term_regex(terms: Sequence[Term]) -> str:
    """A regex that every text mentioning any of these screened terms matches."""
    by_first_letter: dict[str, list[str]] = {}
    for term in terms:
        for word in screenable(term):
            by_first_letter.setdefault(word[0], []).append(word[1:])
    branches = [f"{first}(?:{'|'.join(rest)})" for first, rest in by_first_letter.items()]
    return f"(?i){_ahead(sorted(by_first_letter))}(?<!{WORD})(?:{'|'.join(branches)})"


class Searched(NamedTuple):
    """A text column and its lower-case form, computed once beforehand."""

    text: Column
    lowered: Column


def _unrolled(whole: Searched, terms: Sequence[Term], title: Searched | None) -> Column:
    def row(term: Term) -> Column:
        fields = [F.lit(term.tool).alias("tool"), F.lit(term.category).alias("category")]
        if title is not None:
            fields.append(term_matches(*title, term).alias("is_in_title"))
        return F.struct(*fields)

    return F.array_compact(F.array(*[F.when(term_matches(*whole, t), row(t)) for t in terms]))


def mention_array(whole: Searched, terms: Sequence[Term], title: Searched | None = None) -> Column:
    """The dictionary rows a text mentions: ``array<struct<tool, category[, is_in_title]>>``.

    Empty, never NULL, for a text without any; in no particular order. With ``title`` each row
    also says whether the title alone mentions the tool.
    """
    screened = [t for t in terms if screenable(t)]
    others = [t for t in terms if not screenable(t)]
    parts = []
    for at in range(0, len(screened), GROUP):
        group = screened[at : at + GROUP]
        found = F.when(F.rlike(whole.text, F.lit(any_term_regex(group))), _unrolled(whole, group, title))
        parts.append(F.coalesce(found, F.array()))
    for at in range(0, len(others), GROUP):
        parts.append(F.coalesce(_unrolled(whole, others[at : at + GROUP], title), F.array()))
    return F.concat(*parts) if parts else F.array()
