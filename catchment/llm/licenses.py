"""Licence scans by sentence rules.

A text is cut into parts at line ends, list marks and full stops before white space; a part
is normalised (lower case, letters and digits only, single blanks). Known licence sentences
have identifiers, and parts that follow one another are joined to the longest of them, so a
sentence may be wrapped anywhere between words. What is not known ends a run, other than
list marks, copyright notices (sign or year, and names) and reserved rights. The sequence of identifiers of each text is then matched against ordered
rules: a rule names a licence and the identifiers that must follow one another, in order,
without another known sentence in between. The longest rule that matches at a position
wins, and matching goes on behind it. A tag line holds an expression: its names, joined by
"or" and "and", with known exceptions left out, give one identifier each; an older name with
a plus sign is that of the later versions. Full licence texts are known by their titles.

Each text is worked on by itself, so nothing is shuffled. The tables of sentences and rules
are parameters of fixed size.

Nulls and ties: a null or empty text has no licence. A null id stays null. Rows that repeat
are scanned each; a licence that occurs several times is listed once and counted. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SCANNED = pa.schema([("doc_id", pa.int64()), ("licenses", pa.list_(pa.string())), ("n_matches", pa.int64()), ("n_sentences", pa.int64())])
SPLIT = re.compile(r"[\r\n]+|(?<=[.;:!?])\s+")
WORDS = re.compile(r"[^\W_]+")
LIST = re.compile(r"[^\w\s]*\s*[^\w\s]*(?:\d{1,2}|[a-zA-Z]|[ivxIVX]{2,4})[.)](?:\s+|$)")
TAG_LINE = re.compile(r"SPDX-License-Identifier:[^\r\n]*", re.I)
PLUS = re.compile(r"(?<=\d)\+(?![\w+])")
NOTICE = re.compile(r"[\W_]*(?:copyright[\s:,]*(?:\(c\)|©|&copy;|\d{4})|\(c\)\s*\d{4}|©|all rights reserved\W*$)", re.I)

# Sentences of public licences and their identifiers.
SENTENCES: dict[str, str] = {
    "apache-grant": "Licensed under the Apache License, Version 2.0.",
    "apache-grant-long": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-short": "You may obtain a copy of the License at",
    "apache-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache-asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-implied": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "mit-released": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "apache-copyright-grant": "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    "apache-notice": "See the NOTICE file distributed with this work for additional information regarding copyright ownership.",
    "apache-asf": 'The ASF licenses this file to You under the Apache License, Version 2.0 (the "License");',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "gpl2-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl3-only": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3.",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    "gpl-copy-see": "If not, see <https://www.gnu.org/licenses/>.",
    "lgpl-free": "This library is free software;",
    "lgpl21-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "lgpl-see": "See the GNU Lesser General Public License for more details.",
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-only": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3.",
    "agpl-see": "See the GNU Affero General Public License for more details.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-terms": "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file.",
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit0-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.',
    "bsd-governed": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "bsd-asis": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "isc-asis": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "zero-bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl2-incompatible": 'This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License, v. 2.0.',
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    "epl1": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution,",
    "epl1-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "bsl": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-liable": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented;",
    "zlib-claim": "you must not claim that you wrote the original software.",
    "wtfpl": "This work is free. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2,",
    "ms-pl": "This code is licensed under the Microsoft Public License (Ms-PL).",
    "artistic2": "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
    "cc-by-nd-4": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa-4": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd-4": "Licensed under CC BY-NC-ND 4.0.",
    "cc0-dedicated": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
    "cc0-licensed": "Licensed under CC0 1.0.",
    "apache-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    "apache-title-plain": "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    "apache-means": '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.',
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "mpl2-title": "Mozilla Public License Version 2.0 1. Definitions",
    "epl2-title": 'Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT").',
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "cc0-title": "Creative Commons Legal Code CC0 1.0 Universal",
}
# The wording of public Creative Commons licences by identifier.
CREATIVE = {
    "CC-BY": "Attribution",
    "CC-BY-SA": "Attribution-ShareAlike",
    "CC-BY-ND": "Attribution-NoDerivatives",
    "CC-BY-NC": "Attribution-NonCommercial",
    "CC-BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
# SPDX identifiers that tags may name.
TAGS = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 "
    "CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later "
    "LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-2.0 MS-PL Unlicense WTFPL Zlib"
).split()
# Older names that tags still use, and the exceptions that may follow a name.
OLDER = {f"{name}-{version}": f"{name}-{version}-only" for name, version in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))}
EXCEPTIONS = "Autoconf-exception-3.0 Bison-exception-2.2 Classpath-exception-2.0 GCC-exception-3.1 LLVM-exception Linux-syscall-note".split()
for _name, _words in CREATIVE.items():
    for _version in ("3.0", "4.0"):
        _kind = "Unported" if _version == "3.0" else "International"
        SENTENCES[f"{_name}-{_version}-deed"] = f"This work is licensed under a Creative Commons {_words} {_version} {_kind} License."
        SENTENCES[f"{_name}-{_version}-the-deed"] = f"This work is licensed under the Creative Commons {_words} {_version} {_kind} License."
for _name in (*TAGS, *OLDER):
    SENTENCES[f"tag-{_name}"] = f"SPDX-License-Identifier: {_name}"
# Licences (SPDX identifiers) and the sentence sequences that grant them.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-grant",)),
    ("Apache-2.0", ("apache-grant-long",)),
    ("Apache-2.0", ("apache-grant-long", "apache-comply")),
    ("Apache-2.0", ("apache-grant-long", "apache-comply", "apache-copy", "apache-asis")),
    ("Apache-2.0", ("apache-grant-long", "apache-comply", "apache-copy-short", "apache-url", "apache-asis")),
    ("GPL-3.0-only", ("gpl3-work",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms", "gpl-hope", "gpl-implied", "gpl-see")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2",)),
    ("Unlicense", ("unlicense",)),
    ("Apache-2.0", ("apache-grant-long", "apache-comply", "apache-copy", "apache-asis", "apache-see")),
    ("Apache-2.0", ("apache-grant-long", "apache-comply", "apache-copy-short", "apache-url", "apache-asis", "apache-see")),
    ("Apache-2.0", ("apache-copyright-grant", "apache-notice", "apache-asf", "apache-comply")),
    ("Apache-2.0", ("apache-copyright-grant", "apache-notice", "apache-asf", "apache-comply", "apache-copy-short", "apache-url", "apache-asis", "apache-see")),
    ("GPL-2.0-only", ("gpl2-work",)),
    ("GPL-2.0-only", ("gpl-free", "gpl2-only")),
    ("GPL-2.0-only", ("gpl-free", "gpl2-only", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-3.0-only", ("gpl-free", "gpl3-only")),
    ("GPL-3.0-only", ("gpl-free", "gpl3-only", "gpl-hope", "gpl-implied", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms", "gpl-hope", "gpl-implied", "gpl-see", "gpl-copy", "gpl-copy-see")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms", "gpl-hope", "gpl-implied", "gpl-see", "gpl-copy", "gpl-copy-see")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-terms")),
    ("LGPL-2.1-or-later", ("lgpl-free", "lgpl21-terms", "lgpl-hope", "gpl-implied", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-terms")),
    ("LGPL-3.0-or-later", ("lgpl-free", "lgpl3-terms", "lgpl-hope", "gpl-implied", "lgpl-see")),
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl3-terms", "gpl-hope", "gpl-implied", "agpl-see")),
    ("AGPL-3.0-only", ("gpl-free", "agpl3-only")),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("mit-terms",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-asis", "mit-liable")),
    ("MIT-0", ("mit0-grant", "mit-asis")),
    ("BSD-3-Clause", ("bsd-governed",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-asis")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-asis")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising")),
    ("ISC", ("isc-grant", "isc-asis")),
    ("0BSD", ("zero-bsd-grant", "isc-asis")),
    ("MPL-2.0", ("mpl2", "mpl2-copy")),
    ("MPL-2.0-no-copyleft-exception", ("mpl2", "mpl2-copy", "mpl2-incompatible")),
    ("EPL-2.0", ("epl2",)),
    ("EPL-1.0", ("epl1",)),
    ("EPL-1.0", ("epl1-terms",)),
    ("BSL-1.0", ("bsl",)),
    ("Zlib", ("zlib-asis", "zlib-liable", "zlib-grant")),
    ("Zlib", ("zlib-asis", "zlib-liable", "zlib-grant", "zlib-origin", "zlib-claim")),
    ("WTFPL", ("wtfpl",)),
    ("MS-PL", ("ms-pl",)),
    ("Artistic-2.0", ("artistic2",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("CC0-1.0", ("cc0-licensed",)),
    *((f"{name}-{version}", (f"{name}-{version}-{deed}",)) for name in CREATIVE for version in ("3.0", "4.0") for deed in ("deed", "the-deed")),
    *(("Apache-2.0", (title, *more)) for title in ("apache-title", "apache-title-plain") for more in ((), ("apache-means",))),
    ("GPL-3.0-only", ("gpl3-title",)),
    ("GPL-2.0-only", ("gpl2-title",)),
    ("LGPL-3.0-only", ("lgpl3-title",)),
    ("LGPL-2.1-only", ("lgpl21-title",)),
    ("AGPL-3.0-only", ("agpl3-title",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("EPL-2.0", ("epl2-title",)),
    ("BSL-1.0", ("bsl-title",)),
    ("CC0-1.0", ("cc0-title",)),
    *((name, (f"tag-{name}",)) for name in TAGS),
    *((name, (f"tag-{older}",)) for older, name in OLDER.items()),
]


def normalise(sentence: str) -> str:
    """Lower-case words of a sentence, single blanks between them."""
    return " ".join(WORDS.findall(sentence.lower()))


def parts_of(text: str) -> list[tuple[str, bool]]:
    """Normalised parts of a text in order, each with whether it may be left out between sentences."""
    out = []
    text = TAG_LINE.sub(lambda m: PLUS.sub("-or-later", m[0]), text)
    for part in SPLIT.split(text):
        notice = NOTICE.match(part) is not None
        if not notice and (mark := LIST.match(part)):
            out.append((normalise(mark[0]), True))
            part = part[mark.end() :]
        out.append((normalise(part), notice))
    return [x for x in out if x[0]]


#: The words that begin a tag, those that join its names, and the exceptions.
TAG_WORDS = normalise("SPDX-License-Identifier:")
TAG = tuple(TAG_WORDS.split())
JOINS = {("or",), ("and",)}
WITH = {tuple(normalise(f"with {x}").split()) for x in EXCEPTIONS}


def by_first_word(known: dict[str, str]) -> dict[str, list[str]]:
    """Normalised sentences by their first words."""
    heads: dict[str, list[str]] = {}
    for whole in known:
        heads.setdefault(whole.split(" ", 1)[0], []).append(whole)
    return heads


def tag_names(known: dict[str, str]) -> dict[tuple[str, ...], str]:
    """Identifiers of the sentences that are tags, by the words of the name."""
    return {tuple(whole.split()[len(TAG) :]): i for whole, i in known.items() if tuple(whole.split()[: len(TAG)]) == TAG}


def expression(parts: list[tuple[str, bool]], k: int, names: dict[tuple[str, ...], str]) -> tuple[list[str], int, bool]:
    """Identifiers of the tag that begins with part ``k``, how many parts it takes, and whether it ends within the last one.

    Names may be wrapped over parts like any other sentence.
    """
    words: list[str] = []
    ends: list[int] = []

    def longest(at: int, of) -> int:
        most = max(map(len, of))
        while len(words) < at + most and k + len(ends) < len(parts):
            words.extend(parts[k + len(ends)][0].split())
            ends.append(len(words))
        return next((n for n in range(min(most, len(words) - at), 0, -1) if tuple(words[at : at + n]) in of), 0)

    found: list[str] = []
    at = last = len(TAG)
    while n := longest(at, names):
        found.append(names[tuple(words[at : at + n])])
        at = last = at + n
        if n := longest(at, WITH):
            at = last = at + n
        if not longest(at, JOINS):
            break
        at += 1
    taken = next((j for j, end in enumerate(ends) if end >= last), 0)
    return found, taken + 1, bool(found) and ends[taken] > last


def identify(text: str | None, known: dict[str, str], heads: dict[str, list[str]], tags: dict[tuple[str, ...], str] | None = None) -> list[str | None]:
    """Identifiers of the text's sentences in order; None where unknown sentences stand.

    ``known`` is keyed by the normalised sentence, ``heads`` lists by first word the
    normalised sentences that may be spread over several parts, ``tags`` the names that
    expressions may join.
    """
    out: list[str | None] = []
    parts = parts_of(text or "")
    k = 0
    while k < len(parts):
        first, loose = parts[k]
        if tags and first.startswith(TAG_WORDS):
            some, step, within = expression(parts, k, tags)
            if some:
                out += [*some, None] if within else some
                k += step
                continue
        found, step = known.get(first), 1
        for whole in heads.get(first.split(" ", 1)[0], ()):
            joined, j = first, k + 1
            while len(joined) < len(whole) and j < len(parts) and whole.startswith(joined):
                joined, j = f"{joined} {parts[j][0]}", j + 1
            if joined == whole and j - k > step:
                found, step = known[whole], j - k
        if found is not None or not loose and (not out or out[-1] is not None):
            out.append(found)
        k += step
    return out


def match(ids: list[str | None], rules: list[tuple[str, tuple[str, ...]]]) -> list[str]:
    """Licences of the longest rules that match from left to right."""
    by: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
    for rule in sorted(rules, key=lambda r: -len(r[1])):
        by.setdefault(rule[1][0], []).append(rule)
    out, k = [], 0
    while k < len(ids):
        for name, seq in by.get(ids[k], ()):
            if tuple(ids[k : k + len(seq)]) == seq:
                out.append(name)
                k += len(seq) - 1
                break
        k += 1
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, str] | None = None, rules: list[tuple[str, tuple[str, ...]]] | None = None) -> DataFrame:
    """Per row: doc_id, licenses (sorted, distinct), n_matches, n_sentences (known ones)."""
    known = {normalise(s): i for i, s in (sentences or SENTENCES).items()}
    heads, tags = by_first_word(known), tag_names(known)
    order = rules or RULES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, count, held = [], [], []
            for t in batch.column(1).to_pylist():
                ids = identify(t, known, heads, tags)
                names = match(ids, order)
                found.append(sorted(set(names)))
                count.append(len(names))
                held.append(sum(i is not None for i in ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string())), pa.array(count, pa.int64()), pa.array(held, pa.int64())], schema=SCANNED)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, "doc_id long, licenses array<string>, n_matches long, n_sentences long")
