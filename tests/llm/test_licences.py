from __future__ import annotations

import pytest

import plain
from trendloom.llm import licences
from trendloom.llm.queries import QUERIES

MIT = "\n".join(licences.SENTENCES[k][0] for k in ("MIT-GRANT", "MIT-NOTICE", "MIT-WARRANTY", "MIT-LIABILITY"))
BSD = "\n".join(licences.SENTENCES[k][0] for k in ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"))


def names(text):
    return [hit[0] for hit in licences.scan(text)]


def wrapped(text, width=40, mark=""):
    lines, line = [], ""
    for word in text.split():
        if len(line) + len(word) > width:
            lines.append(line)
            line = ""
        line += word + " "
    return "\n".join(mark + x for x in [*lines, line])


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []),
        ("no terms here.", []),
        ("Some prose.\nReleased under the MIT License.\nMore prose", ["MIT"]),
        ("Released under the MIT License", ["MIT"]),
        ("MIT License\n\nCopyright (c) 2020 Me\n\n" + MIT, ["MIT"]),
        (MIT.upper(), ["MIT"]),
        (wrapped(MIT), ["MIT"]),
        (wrapped(MIT, mark=" * "), ["MIT"]),
        (wrapped(MIT, mark="// "), ["MIT"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD + "\nNeither the name of the Regents nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ["BSD-3-Clause"]),
        (licences.SENTENCES["BSD-GRANT"][0], ["incomplete"]),
        ("Licensed under CC BY-NC 4.0. Released under the MIT License. Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0", "MIT", "CC-BY-NC-4.0"]),
        ("# SPDX-License-Identifier: Apache-2.0\n", ["Apache-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("I like the MIT License a lot, as it is short", []),
    ],
)
def test_scan(text, want):
    assert names(text) == want


@pytest.mark.parametrize(
    "expression, want",
    [
        ("MIT", ["MIT"]),
        ("GPL-2.0-only", ["GPL-2.0"]),
        ("ISC", ["ISC"]),
        ("MPL-2.0", ["MPL-2.0"]),
        ("BSD-2-Clause", ["BSD-2-Clause"]),
        ("Apache-2.0 OR MIT", ["Apache-2.0", "MIT"]),
        ("(lgpl-2.1-or-later WITH Some-exception) */", ["LGPL-2.1"]),
        ("LicenseRef-Own", []),
    ],
)
def test_licence_expressions(expression, want):
    text = f"// SPDX-License-Identifier: {expression}\nint x;"
    assert names(text) == want
    ends = [hit[2] for hit in licences.scan(text)]
    assert all(text[:e].lower().endswith(("mit", "2.0", "isc", "only", "clause", "later")) for e in ends)


HEADS = {
    "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n",
    "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n                            Preamble\n",
    "GPL-2.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,\n",
    "LGPL-2.1": "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n\n",
    "LGPL-3.0": "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n",
    "AGPL-3.0": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n\n",
    "MPL-2.0": "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n",
    "EPL-2.0": "Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is",
    "ISC": "ISC License\n\nCopyright (c) 2020",
}


@pytest.mark.parametrize("licence", HEADS)
def test_heads_of_whole_licence_texts(licence):
    assert names(HEADS[licence]) == [licence]


def test_long_sentences_take_no_time():
    import time

    started = time.perf_counter()
    for words in (" ".join("abcdefghijkl" for _ in range(30)), "word " * 1000, "to the extent possible under law " * 40):
        for head in ("Licensed under the MIT License ", "Neither the name of ", "To the extent possible under law, "):
            licences.identify(head + words)
            licences.sentences(head + words)
    assert time.perf_counter() - started < 1


def plain_sentence(text):
    """The identifier by comparing words, gaps of up to twelve words tried one by one."""

    def fits(parts, words):
        if not parts:
            return not words
        own = licences.normalised(parts[0]).split()
        for gap in range(13):
            rest = words[gap:]
            if rest[: len(own)] == own and fits(parts[1:], rest[len(own) :]):
                return True
        return False

    words = licences.normalised(text).split()
    for name, wordings in licences.SENTENCES.items():
        for wording in wordings:
            first, *others = wording.split("<…>")
            own = licences.normalised(first).split()
            if words[: len(own)] == own and fits(others, words[len(own) :]):
                return name
    return None


def test_known_sentences_are_those_of_a_comparison_by_words():
    import random

    r = random.Random(6)
    every = [w for wordings in licences.SENTENCES.values() for w in wordings]
    for _ in range(400):
        wording = r.choice(every).replace("<…>", " ".join(r.choices(["some", "name", "2020", "the"], k=r.choice([0, 1, 5, 12, 13]))))
        words = wording.split()
        if r.random() < 0.3:
            words.insert(r.randrange(len(words) + 1), "more")
        text = " ".join(words)
        if len(text) <= licences.LONGEST:
            assert licences.identify(text) == plain_sentence(text), text


def test_spans_hold_the_sentences():
    text = "é Prose here.\n\nReleased under the MIT License. More."
    ((name, begin, end, own),) = licences.scan(text)
    assert (name, own, text[begin:end].strip()) == ("MIT", "MIT-RELEASED", "Released under the MIT License.")


def test_every_known_sentence_is_found_and_has_an_anchor():
    import re

    for name, wordings in licences.SENTENCES.items():
        for wording in wordings:
            text = wording.replace("<…>", "some name")
            assert licences.identify(text) == name
            assert re.search(licences.ANCHORS, text, re.I), text
    assert {part.rstrip("?") for _, rule in licences.RULES for part in rule} == set(licences.SENTENCES)


def test_wrapped_anchors_and_sentences_with_many_marks(spark, monkeypatch):
    texts = ["All rights\nreserved.", "All  rights  reserved.", "// All rights\n// reserved."]
    docs = plain.documents(spark, list(enumerate(texts)))
    assert [r.doc_id for r in licences.licences(docs).orderBy("doc_id").collect()] == [0, 1, 2]
    monkeypatch.setitem(licences.EXACT, "one two three four five", "MANY")
    monkeypatch.setattr(licences, "STARTS", (*licences.STARTS, "one two thre"))
    assert licences.sentences("One. Two. Three. Four. Five. Six.")[0][0] == "MANY"


def test_rows(spark):
    text = "Released under the MIT License."
    docs = plain.documents(spark, [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "word " * 200_000 + "\n" + text)], "licence begin sentences")
    got = sorted((r.doc_id or 0, r.licence, r.begin) for r in licences.licences(docs).collect())
    assert got == [(0, "MIT", 0), (1, "MIT", 0), (1, "MIT", 0), (4, "MIT", 1_000_001)]
    assert licences.licences(docs.limit(0)).count() == 0


def test_query_against_a_scan_without_anchors(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = sorted((r.doc_id, *hit) for r in docs for hit in licences.scan(r.text or ""))
    assert sorted(map(tuple, QUERIES["op6_licences"](spark, folder).collect())) == want and want
