"""License scans: whole texts, blocks and lines looked up by the digest of a canonical form.

The canonical form is lower case without copyright lines and punctuation, with one spelling
for words that are written in several ways. Known licences go through the same expressions,
so a unit of a document is a known licence exactly if the digests are equal: one hash join.
Words that every known licence must have one of tell beforehand which texts can hold any.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from functools import reduce
from operator import or_
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A known list up to this many rows is broadcast; a longer one is joined by shuffle.
BROADCAST_KNOWN = 10_000
#: More anchors than this are not looked for; all texts are then put in canonical form.
MOST_ANCHORS = 24
#: Words of notices that many texts hold.
COMMON = frozenset(
    "under the this is work project software program file code content article see for details or any later"
    " released distributed available published only version by universal free public general all rights are".split()
)

# --- fixed values: names of licences as notices spell them, the id first ---------------
NAMES = (
    ("MIT", "MIT License", "Expat License", "MIT/X11 License"),
    ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License, Version 2.0", "Apache 2", "Apache License 2", "Apache Software License 2", "ASL 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License", "Simplified BSD License", "2-Clause BSD License", "FreeBSD License"),
    ("BSD-3-Clause", "BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-Clause BSD License"),
    ("GPL-2.0", "GNU General Public License, version 2", "GPLv2", "GNU GPL v2"),
    ("GPL-3.0", "GNU General Public License, version 3", "GPLv3", "GNU GPL v3"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1", "LGPLv2.1", "GNU LGPL v2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3", "LGPLv3", "GNU LGPL v3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3", "AGPLv3", "GNU AGPL v3"),
    ("MPL-2.0", "Mozilla Public License, version 2.0", "MPLv2"),
    ("EPL-2.0", "Eclipse Public License, version 2.0", "EPLv2"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0",
     "Creative Commons BY 4.0"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
     "Creative Commons Attribution-ShareAlike 4.0", "Creative Commons BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
     "Creative Commons Attribution-NonCommercial 4.0", "Creative Commons BY-NC 4.0"),
    ("CC0-1.0", "Creative Commons Zero 1.0 Universal License", "CC0 1.0 Universal", "Creative Commons Zero 1.0",
     "Creative Commons CC0 1.0 Universal", "CC0"),
    ("Unlicense", "The Unlicense"),
    ("Zlib", "zlib License"),
    ("BSL-1.0", "Boost Software License, version 1.0", "Boost License 1.0"),
)
#: Licences whose notices also say "or any later version".
OR_LATER = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
#: Names that are no notice if they stand alone: a university, a consortium, a library.
NOT_ALONE = ("MIT", "ISC", "Zlib")
#: Notices that name a licence; {} is the name.
NOTICES = (
    "{}",
    "Licensed under the {}",
    "Released under the {}",
    "Distributed under the {}",
    "Available under the {}",
    "Published under the {}",
    "License: {}",
    "License {}",
    "SPDX-License-Identifier: {}",
    "This work is licensed under the {}",
    "This project is licensed under the {}",
    "This project is licensed under the {} - see the LICENSE file for details",
    "See the LICENSE file for details. Licensed under the {}",
    "This software is licensed under the {}",
    "This software is released under the {}",
    "This software is distributed under the {}",
    "This program is licensed under the {}",
    "This program is distributed under the {}",
    "This file is licensed under the {}",
    "This code is licensed under the {}",
    "This content is licensed under the {}",
    "This article is licensed under the {}",
)
#: Notices that name no licence because they grant none.
RESERVED = ("All-Rights-Reserved", ("All rights reserved", "All rights are reserved", "License: All rights reserved"))
_GNU = "This {what} is free software{s} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation{t}"
#: The standard headers of licences, of long ones the part that names the licence.
HEADERS = (
    *(
        ("Apache-2.0", f"""{first} Apache License, Version 2.0 (the "License");
you may not use this {what} except in compliance with the License.
You may obtain a copy of the License at{rest}""")
        for first in ("Licensed under the",)
        for what in ("file", "software", "work", "project")
        for rest in (
            "",
            " http://www.apache.org/licenses/LICENSE-2.0",
            """ http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
        )
    ),
    ("Apache-2.0", """Licensed to the Apache Software Foundation (ASF) under one
or more contributor license agreements.  See the NOTICE file
distributed with this work for additional information
regarding copyright ownership.  The ASF licenses this file
to you under the Apache License, Version 2.0 (the
"License"); you may not use this file except in compliance
with the License.  You may obtain a copy of the License at"""),
    *(
        (i, _GNU.format(what=what, s=s, name=name, t=t.format(n=n)))
        for i, name, n in (
            ("GPL-2.0", "GNU General Public License", "2"),
            ("GPL-3.0", "GNU General Public License", "3"),
            ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
            ("LGPL-3.0", "GNU Lesser General Public License", "3"),
            ("AGPL-3.0", "GNU Affero General Public License", "3"),
        )
        for what in ("program", "library", "file", "software")
        for s in (":", "; ")
        for t in (
            "; either version {n} of the License, or (at your option) any later version.",
            ", either version {n} of the License.",
            ", version {n}.",
            "; version {n} of the License.",
        )
    ),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("EPL-2.0", """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/"""),
    ("BSL-1.0", """Distributed under the Boost Software License, Version 1.0.
(See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"""),
)
#: Where whole licences lie that are not below, as ``id.txt``.
TEXT_FOLDER = Path(__file__).parent / "license_texts"
#: Whole licences with a title and the place of the holder.
TEXTS = (
    (
        "MIT",
        """MIT License
Copyright (c) <year> <holder>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """ISC License
Copyright (c) <year> <holder>
Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    ),
)
#: Spellings that mean the same, after lower-casing and removal of punctuation.
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("share alike", "sharealike"),
    ("fulfilment", "fulfillment"),
    ("merchantibility", "merchantability"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("the the", "the"),
)
#: A version is written 2, 2.0, v2 or version 2; all become the bare number.
_VERSION = (r"\b(?:version|ver|v) ?(\d)", "$1")
_POINT_ZERO = (r"\b(\d+) 0\b", "$1")
_GNU_VERSION = (r"\b([al]?gpl|mpl|epl)v(\d)", "$1 $2")
_URL = (r"\bhttps? (?:www )?", "http ")
_ARTICLE = (r"\bunder (?:the terms of )?(?:(?:the|an?) )?", "under ")
_OR_LATER = (r" or (?:any|at your option any) later(?: version)?$", " or later")
# --------------------------------------------------------------------------------------

_COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n©(]*(?:copyright\b(?! (?:notice|holder|owner))|\(c\)|©)[^\n]*$"


def rough(text: Column) -> Column:
    """Lower case, without copyright lines; line ends stay."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    marked = lower.contains("copyright") | lower.contains("(c)") | lower.contains("©")
    return F.when(marked, F.regexp_replace(lower, _COPYRIGHT_LINE, "")).otherwise(lower)


def canonical(unit: Column) -> Column:
    """The canonical form of a unit that ``rough`` has prepared: words and single spaces."""
    out = F.trim(F.regexp_replace(unit, r"[^\p{L}\p{N}]+", " "))
    for said, meant in SPELLINGS:
        out = F.replace(out, F.lit(said), F.lit(meant))
    for pattern, meant in (_GNU_VERSION, _VERSION, _POINT_ZERO, _URL, _ARTICLE, _OR_LATER):
        out = F.regexp_replace(out, pattern, meant)
    return out


def known_texts() -> list[tuple[str, str]]:
    """(license, text): whole licences, their headers, and every notice with every name."""
    out = [*TEXTS, *HEADERS, *((RESERVED[0], x) for x in RESERVED[1])]
    for file in sorted(TEXT_FOLDER.glob("*.txt")):
        text = file.read_text(encoding="utf-8")
        # With and without the appendix on how to apply it; list items with and without number.
        body, end, _ = text.partition("END OF TERMS AND CONDITIONS")
        texts = {text, body + end, body, re.sub(r"(?m)^ *\d+\. ", "", text)}
        out += [(file.stem, x) for x in sorted(texts)]
        names = next(n for n in NAMES if n[0] == file.stem)
        out += [(file.stem, f"{n}\n{text}") for n in names]
    for names in NAMES:
        forms = {*names, *(n if "licen" in n.lower() else f"{n} License" for n in names)}
        later = ("or later", "or any later version") if names[0] in OR_LATER else ()
        forms |= {f"{n} {x}" for n in forms for x in later} | {f"{n}-only" for n in names[:1] if later}
        out += [
            (names[0], notice.format(name))
            for name in sorted(forms)
            for notice in NOTICES
            if notice != "{}" or name not in NOT_ALONE
        ]
    return out


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license, text): what ``known_texts`` has, as a table."""
    rows = json.dumps([{"license": i, "text": t} for i, t in known_texts()])
    schema = "array<struct<license:string,text:string>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), schema)))


def anchors(forms: list[str]) -> list[str] | None:
    """Words of which every form has one, or None if it takes more than MOST_ANCHORS.

    Only letters, digits after one, and no word that a spelling of several words is written
    as: such a word stands in a text exactly as in its canonical form, once spellings of one
    word are replaced. So a text without an anchor holds no form.
    """
    merged = {w for said, meant in SPELLINGS if " " in said for w in meant.split()}
    word = re.compile(r"[^\W\d_]+|[a-z][a-z0-9]*")
    left = [{w for w in f.split() if word.fullmatch(w)} - merged for f in forms]
    out: list[str] = []
    while left:
        # Words that stand in every other text are the last choice.
        count = Counter(w for f in left for w in (f - COMMON or f))
        if not count or len(out) == MOST_ANCHORS:
            return None
        # The most frequent; of several the longest, which fewest texts hold by chance.
        out.append(max(count, key=lambda w: (count[w], len(w), w)))
        left = [f for f in left if not any(out[-1] in w for w in f)]
    return out


def may_hold(text: Column, words: list[str] | None) -> Column:
    """False only for texts without any of the words, in any spelling of one word."""
    if words is None:
        return F.lit(True)
    lower = F.lower(F.coalesce(text, F.lit("")))
    for said, meant in SPELLINGS:
        if " " not in said:
            lower = F.replace(lower, F.lit(said), F.lit(meant))
    # As an element of an array the lower-cased text is made once for all words.
    return F.exists(F.array(lower), lambda x: reduce(or_, [x.contains(w) for w in words], F.lit(False)))


def digests(known: DataFrame) -> DataFrame:
    """(digest, form, license), one row per digest; of two licences with one text the smaller id."""
    form = canonical(rough(F.col("text")))
    return (
        known.select(form.alias("form"), "license")
        .where("form <> ''")
        .groupBy("form")
        .agg(F.min("license").alias("license"))
        .select(F.sha2("form", 256).alias("digest"), "form", "license")
    )


def matches(
    docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(_id, _tag, unit, license): units of each text that are a known licence.

    Units are the ``whole`` text, its ``block`` s between empty lines, and its ``line`` s.
    ``_tag`` is a digest of the text, for rows that share an id.
    """
    table = digests(known)
    size = table.agg(F.count("*"), F.max(F.length("form")), F.min(F.length("form"))).first()
    most, least = size[1] or 0, size[2] or 0
    few = size[0] <= BROADCAST_KNOWN
    words = anchors([r.form for r in table.select("form").collect()]) if few else None
    docs = docs.where(may_hold(F.col(text), words))
    whole = rough(F.col(text))
    held = docs.select(
        F.col(doc_id).alias("_id"), _tag(text).alias("_tag"), whole.alias("_whole")
    )
    blocks = F.split("_whole", r"\n[ \t\r]*(?:\n[ \t\r]*)+")
    kinds = F.array(
        F.struct(F.lit("whole").alias("unit"), F.array("_whole").alias("parts")),
        F.struct(F.lit("block").alias("unit"), blocks.alias("parts")),
        F.struct(F.lit("line").alias("unit"), F.split("_whole", "\n").alias("parts")),
    )
    units = (
        held.select("_id", "_tag", F.explode(kinds).alias("_kind"))
        .select("_id", "_tag", "_kind.unit", F.posexplode("_kind.parts").alias("_at", "_part"))
        # The shortest form has as many word characters as its words; nothing shorter can match.
        .where((F.length("_part") >= least) & may_hold(F.col("_part"), words))
        .select(
            "_id", "_tag", "unit", "_at", F.regexp_replace("_part", r"[^\p{L}\p{N}]+", " ").alias("_part")
        )
        # Equivalent spellings at most halve a form.
        .where(F.length("_part") <= 2 * most + 64)
        .select("_id", "_tag", "unit", "_at", F.sha2(canonical(F.col("_part")), 256).alias("digest"))
    )
    table = table.select("digest", "license")
    looked_up = F.broadcast(table) if few else table
    # Rows that repeat a document say the same of each place in it.
    return units.join(looked_up, "digest").select("_id", "_tag", "unit", "_at", "license").distinct()


def _tag(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def scan(
    docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id, text_license, licenses and n_license_lines.

    ``text_license`` is the licence that the entire text is, or null; ``licenses`` are the
    sorted distinct ones of all units, and ``n_license_lines`` counts the
    lines that matched. A null or empty text has none.
    """
    found = (
        matches(docs, known, doc_id, text)
        .groupBy("_id", "_tag", "unit", "license")
        .agg(F.count("*").alias("n"))
        .groupBy("_id", "_tag")
        .agg(
            F.min(F.when(F.col("unit") == "whole", F.col("license"))).alias("text_license"),
            F.sort_array(F.collect_set("license")).alias("licenses"),
            F.sum(F.when(F.col("unit") == "line", F.col("n")).otherwise(0)).alias("n_lines"),
        )
    )
    own = docs.select(F.col(doc_id), _tag(text).alias("_tag2"))
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_tag2") == F.col("_tag"))
    return own.join(found, same, "left").select(
        doc_id,
        "text_license",
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_license_lines"),
    )


def op10(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text_license, licenses (joined by a space), n_license_lines."""
    made = scan(docs.select("doc_id", "text"), known_licenses(docs.sparkSession))
    return made.withColumn("licenses", F.array_join("licenses", " "))
