"""Licence scans by sentence rules.

Texts are cut into sentences, which are normalised (lower case, letters and digits only, comment marks
and line breaks dropped) and looked up among known licence sentences. The identifiers found, in the
order of the text, are matched against ordered rules, sequences of identifiers: the first rule that
fits takes its sentences, and later rules see the rest. Sentences that no rule takes are reported as
an incomplete licence.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import prepare

# Wordings of public licences and notices, as their authors publish them. ``<…>`` stands
# for up to twelve words, as a name or a year.
SENTENCES = {
    "MIT-NAME": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "MIT-RELEASED": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This project is licensed under the MIT License",
        "This work is licensed under the MIT License",
        "Distributed under the MIT License",
        "Licensed under the MIT License <…>",
        "This project is licensed under the MIT License <…>",
    ],
    "MIT-GRANT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
    ],
    "MIT-NOTICE": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "MIT-WARRANTY": [
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    ],
    "MIT-LIABILITY": [
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ],
    "ISC-GRANT": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "BSD-GRANT": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSD-SOURCE": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSD-BINARY": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ],
    "BSD-ENDORSE": [
        "Neither the name of <…> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ],
    "BSD-RELEASED": ["Released under the BSD License", "Licensed under the BSD License", "Released under the BSD 3-Clause License", "Licensed under the BSD 3-Clause License"],
    "APACHE-RELEASED": [
        'Licensed under the Apache License, Version 2.0 (the "License")',
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache License, Version 2.0",
        "This work is licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License 2.0",
        "Released under the Apache License 2.0",
    ],
    "APACHE-COMPLIANCE": ["you may not use this file except in compliance with the License"],
    "APACHE-COPY": ["You may obtain a copy of the License at <…>"],
    "APACHE-WARRANTY": [
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ],
    "GPL3-RELEASED": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
        "Released under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License v3.0",
        "Licensed under the GPL v3",
    ],
    "GPL2-RELEASED": [
        "This work is licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License, version 2",
        "Released under the GNU General Public License, version 2",
    ],
    "GPL3-GRANT": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ],
    "GPL2-GRANT": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ],
    "GPL-WARRANTY": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ],
    "GPL-DETAILS": ["See the GNU General Public License for more details."],
    "LGPL-RELEASED": ["Licensed under the GNU Lesser General Public License, version 3", "This work is licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-RELEASED": ["Licensed under the GNU Affero General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3"],
    "MPL-RELEASED": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0",
    ],
    "CC-BY": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "This work is licensed under CC BY 4.0"],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "This work is licensed under CC BY-SA 4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "This work is licensed under CC BY-NC 4.0",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
        "This work is licensed under CC BY-ND 4.0",
    ],
    "CC0": ["This work is dedicated to the public domain under CC0 1.0", "Licensed under CC0 1.0", "To the extent possible under law, <…> has waived all copyright and related or neighboring rights to <…>"],
    "UNLICENSE": ["This is free and unencumbered software released into the public domain."],
    "RESERVED": ["All rights reserved."],
    "SPDX-MIT": ["SPDX-License-Identifier: MIT"],
    "SPDX-APACHE": ["SPDX-License-Identifier: Apache-2.0"],
    "SPDX-GPL3": ["SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "SPDX-BSD3": ["SPDX-License-Identifier: BSD-3-Clause"],
    "APACHE-TITLE": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", "Apache License, Version 2.0", "Apache License 2.0"],
    "APACHE-TERMS": ["TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "GPL3-TITLE": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL2-TITLE": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL3-TITLE": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL21-TITLE": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "AGPL3-TITLE": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "GNU-COPYRIGHT": ["Copyright (C) <…> Free Software Foundation, Inc. <…> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."],
    "MPL-TITLE": ["Mozilla Public License Version 2.0", "Mozilla Public License, version 2.0"],
    "EPL-TITLE": ["Eclipse Public License - v 2.0"],
    "BSL-TITLE": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "BSD3-TITLE": ["BSD 3-Clause License"],
    "BSD2-TITLE": ["BSD 2-Clause License"],
    "ISC-TITLE": ["ISC License", "The ISC License"],
}
# Identifiers in licence expressions that have no sentence of their own above, and their licences.
SPDX_NAMES = {
    "MIT-0": "MIT-0", "ISC": "ISC", "0BSD": "0BSD", "Zlib": "Zlib", "BSL-1.0": "BSL-1.0", "Unlicense": "Unlicense", "CC0-1.0": "CC0-1.0", "EPL-2.0": "EPL-2.0",
    "BSD-2-Clause": "BSD-2-Clause", "MPL-2.0": "MPL-2.0", "MPL-1.1": "MPL-1.1", "Artistic-2.0": "Artistic-2.0", "PostgreSQL": "PostgreSQL", "WTFPL": "WTFPL",
    "GPL-2.0": "GPL-2.0", "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0", "GPL-3.0": "GPL-3.0",
    "LGPL-2.1": "LGPL-2.1", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1", "LGPL-3.0": "LGPL-3.0", "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0",
    "AGPL-3.0": "AGPL-3.0", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0", "CC-BY-4.0": "CC-BY-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0",
}
SENTENCES |= {f"SPDX-{name}": [f"SPDX-License-Identifier: {name}"] for name in SPDX_NAMES}

# Ordered rules: a licence, and the sentences that make it; a sentence ending in ? may be missing.
RULES = [
    ("MIT", ["MIT-NAME?", "MIT-GRANT", "MIT-NOTICE", "MIT-WARRANTY", "MIT-LIABILITY?"]),
    ("ISC", ["ISC-GRANT"]),
    ("BSD-3-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"]),
    ("BSD-2-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"]),
    ("Apache-2.0", ["APACHE-RELEASED", "APACHE-COMPLIANCE?", "APACHE-COPY?", "APACHE-WARRANTY?"]),
    ("GPL-3.0", ["GPL3-GRANT", "GPL-WARRANTY?", "GPL-DETAILS?"]),
    ("GPL-2.0", ["GPL2-GRANT", "GPL-WARRANTY?", "GPL-DETAILS?"]),
    ("GPL-3.0", ["GPL3-RELEASED"]),
    ("GPL-2.0", ["GPL2-RELEASED"]),
    ("LGPL-3.0", ["LGPL-RELEASED"]),
    ("AGPL-3.0", ["AGPL-RELEASED"]),
    ("MPL-2.0", ["MPL-RELEASED"]),
    ("MIT", ["MIT-RELEASED"]),
    ("BSD", ["BSD-RELEASED"]),
    ("CC-BY-4.0", ["CC-BY"]),
    ("CC-BY-SA-4.0", ["CC-BY-SA"]),
    ("CC-BY-NC-4.0", ["CC-BY-NC"]),
    ("CC-BY-ND-4.0", ["CC-BY-ND"]),
    ("CC0-1.0", ["CC0"]),
    ("Unlicense", ["UNLICENSE"]),
    ("MIT", ["SPDX-MIT"]),
    ("Apache-2.0", ["SPDX-APACHE"]),
    ("GPL-3.0", ["SPDX-GPL3"]),
    ("BSD-3-Clause", ["SPDX-BSD3"]),
    ("MIT", ["MIT-NAME"]),
    ("Apache-2.0", ["APACHE-TITLE", "APACHE-TERMS?"]),
    ("Apache-2.0", ["APACHE-TERMS"]),
    ("GPL-3.0", ["GPL3-TITLE", "GNU-COPYRIGHT?"]),
    ("GPL-2.0", ["GPL2-TITLE", "GNU-COPYRIGHT?"]),
    ("LGPL-3.0", ["LGPL3-TITLE", "GNU-COPYRIGHT?"]),
    ("LGPL-2.1", ["LGPL21-TITLE", "GNU-COPYRIGHT?"]),
    ("AGPL-3.0", ["AGPL3-TITLE", "GNU-COPYRIGHT?"]),
    ("MPL-2.0", ["MPL-TITLE"]),
    ("EPL-2.0", ["EPL-TITLE"]),
    ("BSL-1.0", ["BSL-TITLE"]),
    ("BSD-3-Clause", ["BSD3-TITLE"]),
    ("BSD-2-Clause", ["BSD2-TITLE"]),
    ("ISC", ["ISC-TITLE"]),
    *[(licence, [f"SPDX-{name}"]) for name, licence in SPDX_NAMES.items()],
    ("All-rights-reserved", ["RESERVED"]),
]
INCOMPLETE = "incomplete"

# Every known sentence holds one of these, so a text without any has no licence sentence.
# Between the words of one may stand what `normalised` joins, and the mark of a line.
_GAP = r"[^a-z0-9]+(?:[0-9]{1,2}[.)][^a-z0-9]*)?"
ANCHORS = f"licen|copyright|permission|warrant|public{_GAP}domain|redistribut|rights{_GAP}reserved|creative{_GAP}commons|liable|terms{_GAP}and{_GAP}conditions"

_NOT_WORD = re.compile(r"[^a-z0-9]+")
_MARKS = re.compile(r"^[ \t]*(?://+|#+|/?\*+/?|;+|--+|>+|\(?\d{1,2}[.)]|[-•])?[ \t]*", re.M)
# A sentence may end after these, at a line end, or at a blank line.
_STRONG = re.compile(r"[.;:!?](?=\s|$)|\n[ \t]*\n")
_LINE = re.compile(r"\n")


def normalised(sentence: str) -> str:
    return _NOT_WORD.sub(" ", sentence.lower()).strip()


def _known() -> tuple[dict[str, str], list[tuple[re.Pattern, str]]]:
    exact, patterns = {}, []
    for name, wordings in SENTENCES.items():
        for wording in wordings:
            if "<…>" in wording:
                # whole words between whole words: a word can be read in one way only
                first, *others = [re.escape(normalised(p)) for p in wording.split("<…>")]
                gap = r"(?: [^ ]++){0,12}"
                patterns.append((re.compile(first + "".join(f"{gap} {p}" if p else gap for p in others)), name))
            else:
                exact[normalised(wording)] = name
    return exact, patterns


EXACT, PATTERNS = _known()
# How known sentences begin: most places of a text need no look at their ends.
START = 12
STARTS = tuple({normalised(s.split("<…>")[0])[:START] for names in SENTENCES.values() for s in names})
LONGEST = max(len(s) for names in SENTENCES.values() for s in names) * 2
# A licence expression on its line, and the identifiers in it.
_SPDX = re.compile(r"[ \t]*SPDX-License-Identifier:([^\n]*)", re.I)
_SPDX_NAME = re.compile(r"[A-Za-z0-9.-]+")
SPDX = {wording.split(": ")[1].lower(): name for name, wordings in SENTENCES.items() if name.startswith("SPDX-") for wording in wordings}


def identify(sentence: str) -> str | None:
    """The identifier of a known sentence."""
    if len(sentence) > LONGEST:
        return None
    key = normalised(sentence)
    if key in EXACT:
        return EXACT[key]
    return next((name for pattern, name in PATTERNS if pattern.fullmatch(key)), None)


def sentences(text: str) -> list[tuple[str, int, int]]:
    """Known sentences as (identifier, begin, end), in order and without overlap.

    The identifiers of a licence expression count as a sentence each.
    A sentence begins at a line or after another sentence. It ends at a sentence mark, which may be
    lines further down, or at the end of its line; the first reading that is known counts.
    """
    clean = _MARKS.sub(lambda m: " " * (m.end() - m.start()), text)
    strong = sorted({m.end() for m in _STRONG.finditer(clean)} | {len(clean)})
    breaks = sorted({m.end() for m in _LINE.finditer(clean)} | {len(clean)})
    starts = sorted({0, *strong, *breaks})
    out: list[tuple[str, int, int]] = []
    free = 0
    for begin in starts:
        if begin < free or begin >= len(clean):
            continue
        if (line_found := _SPDX.match(clean, begin)) is not None:
            known = [(SPDX[m[0].lower()], m) for m in _SPDX_NAME.finditer(clean, *line_found.span(1)) if m[0].lower() in SPDX]
            for name, m in known:
                out.append((name, out[-1][2] if m is not known[0][1] else begin, m.end()))
            free = line_found.end()
            continue
        head = normalised(clean[begin : begin + 64])
        if len(head) >= START and not head.startswith(STARTS):
            continue
        at = bisect_right(strong, begin)
        line = breaks[bisect_right(breaks, begin)]
        near = strong[at : max(at + 1, bisect_right(strong, begin + LONGEST))]
        for end in dict.fromkeys([*near[:3], line, *near[3:]]):
            name = identify(clean[begin:end])
            if name is not None:
                out.append((name, begin, end))
                free = end
                break
    return out


def match_rules(found: list[str]) -> list[tuple[str, list[int]]]:
    """Licences with the positions of their sentences; sentences of no rule are ``incomplete``."""
    left = list(range(len(found)))
    out: list[tuple[str, list[int]]] = []
    for licence, rule in RULES:
        at = 0
        while at < len(left):
            taken, here = [], at
            for part in rule:
                if here < len(left) and found[left[here]] == part.rstrip("?"):
                    taken.append(here)
                    here += 1
                elif not part.endswith("?"):
                    taken = []
                    break
            if taken:
                out.append((licence, [left[i] for i in taken]))
                del left[taken[0] : taken[-1] + 1]
            else:
                at += 1
    out += [(INCOMPLETE, [i]) for i in left]
    return sorted(out, key=lambda x: (x[1], x[0]))


def scan(text: str) -> list[tuple[str, int, int, str]]:
    """Licences of a text: name, begin, end, and the identifiers of their sentences."""
    found = sentences(text)
    return [(licence, found[own[0]][1], found[own[-1]][2], " ".join(found[i][0] for i in own)) for licence, own in match_rules([f[0] for f in found])]


def licences(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per licence in a document: ``id``, ``licence``, ``begin``, ``end``, ``sentences``.

    Places are code points of the whole text. Texts without a licence sentence, as null and empty
    ones, give no rows; null ids and repeated rows are scanned like any other. Texts without any of
    ``ANCHORS`` never leave the JVM.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{id}`").alias("__id"))
    rows = rows.where(F.col("__text").rlike(f"(?i){ANCHORS}"))
    kind = rows.schema["__id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, *hit) for i, t in zip(range(batch.num_rows), batch.column(0), strict=True) for hit in scan(t.as_py())]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            ids = batch.column(1).take(pa.array(columns[0], pa.int64()))
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns[1:], types, strict=True)]], names=["__id", "licence", "begin", "end", "sentences"])

    return rows.mapInArrow(find, f"__id {kind}, licence string, begin long, end long, sentences string").withColumnRenamed("__id", id)
