"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences, each normalised (lower case, everything but letters and digits
one blank).  A map gives known sentences their identifiers; the identifiers of a text, in
their order, are matched against ordered rules.  All of it is one projection: no shuffle, no
join, and a text without a cue word (every known sentence has one) is passed over cheaply.

A text is cut in two ways, since notices are wrapped at any width: into sentences (at sentence ends
and blank lines), and those into their lines.  A sentence that is known as a whole counts, and so does
a known line within it, in the order of the text; where the sentence is one line it counts once.

A rule's identifiers must follow one another; what stands between does not matter.  One fold over the
identifiers counts, for all rules at once, how often each is met from its first identifier to
its last.  A rule whose identifiers another one contains counts only as often as it is met
beside that one: the text of a licence does not report the shorter licence inside it, two
texts report both.  "All rights reserved" alone means proprietary; beside a licence it adds nothing.

Defined cases
    null or empty text  no sentences, no rules, no licences
    repeated rows       one output row per input row
    null doc_id         passed through
    repeated sentences  stay in the sequence; a rule is reported once
    very long texts     time in proportion to the length, whatever repeats
    empty table         no rows
    further columns     not read
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licences and notices, by identifier.  Sentences end at . ; : ! or ?
# before white space, so a clause before a colon is a sentence of its own.
SENTENCES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-notice-3": "This project is licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "gpl-notice-2": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-notice-3": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-share": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl-share-3": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-later-2": "either version 2 of the License, or (at your option) any later version.",
    "gpl-no-warranty": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "apache-define": '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.',
    "apache-grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    "gnu-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "gnu-2": "Version 2, June 1991",
    "gnu-2.1": "Version 2.1, February 1999",
    "gnu-3": "Version 3, 29 June 2007",
    "agpl-3": "Version 3, 19 November 2007",
    "lgpl-share": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl-share-3": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-later-2.1": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-see": "See the GNU Lesser General Public License for more details.",
    "agpl-share-3": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-see": "See the GNU Affero General Public License for more details.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "cc0-dedicated": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "epl-1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "epl-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0.",
    "public-domain": "This is free and unencumbered software released into the public domain.",
    "rights": "All rights reserved.",
}
SENTENCES |= {
    f"cc-{kind}-{version}": f"Licensed under CC {kind.upper()} {version}."
    for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for version in ("2.0", "3.0", "4.0")}

# Names that follow "SPDX-License-Identifier:".
SPDX = ("MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "MPL-2.0",
        "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only",
        "LGPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "Unlicense")
SENTENCES |= {f"spdx-{name.lower()}": f"SPDX-License-Identifier {name}" for name in SPDX}

# Ordered rules (rule, licence, identifiers in the order in which they must follow
# one another; other known sentences may stand between).  ``mpl-subject`` ends in "v. 2.0", so it
# is cut after "v.": the rule names the first half.
RULES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit-text", "MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    ("mit-grant-only", "MIT", ("mit-grant", "mit-keep")),
    ("mit-notice", "MIT", ("mit-notice",)),
    ("mit-notice-2", "MIT", ("mit-notice-2",)),
    ("mit-notice-3", "MIT", ("mit-notice-3",)),
    ("mit-title", "MIT", ("mit-title",)),
    ("mit-title-2", "MIT", ("mit-title-2",)),
    ("apache-2-header", "Apache-2.0", ("apache-header", "apache-comply", "apache-as-is", "apache-see")),
    ("apache-2-short", "Apache-2.0", ("apache-header", "apache-comply")),
    ("apache-2-first", "Apache-2.0", ("apache-header",)),
    ("apache-2-notice", "Apache-2.0", ("apache-notice",)),
    ("apache-2-text", "Apache-2.0", ("apache-define", "apache-grant")),
    ("bsd-3-text", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("bsd-2-text", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("gpl-2-header", "GPL-2.0-or-later", ("gpl-share", "gpl-later-2", "gpl-no-warranty")),
    ("gpl-3-header", "GPL-3.0-or-later", ("gpl-share-3", "gpl-no-warranty", "gpl-see")),
    ("gpl-2-text", "GPL-2.0", ("gpl-title", "gnu-2", "gnu-verbatim")),
    ("gpl-3-text", "GPL-3.0", ("gpl-title", "gnu-3", "gnu-verbatim")),
    ("lgpl-2.1-header", "LGPL-2.1-or-later", ("lgpl-share", "lgpl-later-2.1", "lgpl-see")),
    ("lgpl-3-header", "LGPL-3.0-or-later", ("lgpl-share-3", "lgpl-see")),
    ("lgpl-2.1-text", "LGPL-2.1", ("lgpl-title", "gnu-2.1", "gnu-verbatim")),
    ("lgpl-3-text", "LGPL-3.0", ("lgpl-title", "gnu-3", "gnu-verbatim")),
    ("agpl-3-header", "AGPL-3.0-or-later", ("agpl-share-3", "agpl-see")),
    ("agpl-3-text", "AGPL-3.0", ("agpl-title", "agpl-3", "gnu-verbatim")),
    ("isc-text", "ISC", ("isc-grant", "isc-as-is")),
    ("isc-grant-only", "ISC", ("isc-grant",)),
    ("zlib-text", "Zlib", ("zlib-as-is", "zlib-grant", "zlib-altered")),
    ("cc0-dedication", "CC0-1.0", ("cc0-dedicated",)),
    ("epl-1-notice", "EPL-1.0", ("epl-1",)),
    ("epl-2-notice", "EPL-2.0", ("epl-2",)),
    ("boost-notice", "BSL-1.0", ("boost-notice",)),
    ("gpl-2-notice", "GPL-2.0", ("gpl-notice-2",)),
    ("gpl-3-notice", "GPL-3.0", ("gpl-notice-3",)),
    ("mpl-2-notice", "MPL-2.0", ("mpl-subject",)),
    ("unlicense-notice", "Unlicense", ("public-domain",)),
    ("all-rights-reserved", "proprietary", ("rights",)),
] + [(k, "CC-" + k[3:].upper(), (k,)) for k in SENTENCES if k.startswith("cc-")] + [
    (f"spdx-{name.lower()}", name, (f"spdx-{name.lower()}",)) for name in SPDX]
ALONE = "proprietary"       # counts only where no other licence is found

# Every known sentence has one of these, each within a word, so however it is wrapped.
CUES = "licen|permission|warrant|redistribut|copyright|unencumbered|reserved|version"

PARAGRAPH_END = r"\n[ \t\r]*\n"
SENTENCE_END = r"([.;:!?])[ \t\r\n]+"
SPDX_LINE = r"(?i)(spdx-license-identifier):[ \t]*"       # its colon does not end a sentence
CUT = "\u0001"


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def identifiers() -> dict[str, str]:
    """Identifier by normalised sentence (of a text cut again where sentences end)."""
    return {normalised(re.split(SENTENCE_END, text + "\n")[0]): k for k, text in SENTENCES.items()}


def containing() -> list[list[int]]:
    """For each rule, the rules whose identifiers contain all of its own in their order."""
    def within(a: tuple[str, ...], b: tuple[str, ...]) -> bool:
        rest = iter(b)
        return len(a) < len(b) and all(x in rest for x in a)
    return [[k for k, (_, _, b) in enumerate(RULES) if within(a, b)] for _, _, a in RULES]


def recognised(text: Column) -> Column:
    """Identifiers of the known sentences and lines of ``text``, in their order."""
    known = F.create_map(*[F.lit(x) for pair in identifiers().items() for x in pair])
    marked = F.regexp_replace(F.translate(text, CUT, " "), SPDX_LINE, "$1 ")
    marked = F.regexp_replace(F.regexp_replace(marked, PARAGRAPH_END, CUT), SENTENCE_END, "$1" + CUT)
    # what has no cue word is not known, nor is a line of it
    sentences = F.filter(F.split(marked, CUT), lambda s: F.lower(s).rlike(CUES))
    lines = F.transform(sentences, lambda s: F.filter(
        F.transform(F.split(s, "\n"), lambda x: F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))), lambda x: x != ""))

    def hits(of: Column) -> Column:
        each = F.transform(of, lambda x, j: F.struct(j.alias("at"), F.element_at(known, x).alias("id")))
        whole = F.struct(F.lit(0).alias("at"), F.when(F.size(of) > 1, F.element_at(known, F.array_join(of, " "))).alias("id"))
        return F.array_sort(F.filter(F.concat(F.array(whole), each), lambda h: h["id"].isNotNull()))["id"]

    return F.flatten(F.transform(lines, hits))


def counted(ids: Column) -> Column:
    """How often each rule is met in ``ids``, one after the other (array in the order of the rules)."""
    steps = F.array(*[F.array(*map(F.lit, seq)) for _, _, seq in RULES])
    start = F.array(*[F.struct(F.lit(0).alias("met"), F.lit(0).alias("n"))] * len(RULES))

    def moved(state: Column, found: Column) -> Column:
        def step(s: Column, rule: Column) -> Column:
            seq = F.get(steps, rule)
            last = s["met"] + 1 == F.size(seq)
            return F.when(F.get(seq, s["met"]) == found, F.struct(
                F.when(last, 0).otherwise(s["met"] + 1).alias("met"), F.when(last, s["n"] + 1).otherwise(s["n"]).alias("n"))
            ).otherwise(s)
        return F.transform(state, step)

    return F.aggregate(ids, start, moved, lambda state: state["n"])


def licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_sentences`` (known ones), ``sentence_ids``, ``rules``, ``licenses`` (joined by
    commas: in the order of the text, of the rules, of the alphabet), one row per row."""
    none = F.array().cast("array<string>")
    cue = F.lower("text").rlike(CUES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.when(cue, recognised(F.col("text"))), none).alias("ids"))
    rows = rows.withColumn("n", F.when(F.size("ids") > 0, counted(F.col("ids"))))
    # met beside the rules that contain it: the longest first, each less what those around it have
    around, alone = containing(), {}
    for k in sorted(range(len(RULES)), key=lambda k: -len(RULES[k][2])):
        n = F.col("n")[k]
        for outer in around[k]:
            n = n - alone[outer]
        alone[k] = F.greatest(n, F.lit(0)) if around[k] else n
    hits = F.filter(F.array(*[F.when(alone[k] > 0, F.struct(F.lit(rule).alias("rule"), F.lit(licence).alias("licence")))
                              for k, (rule, licence, _) in enumerate(RULES)]), lambda r: r.isNotNull())
    rows = rows.select("doc_id", "ids", F.when(F.col("n").isNotNull(), hits).alias("hits"))
    named = F.filter("hits", lambda r: r["licence"] != ALONE)
    rows = rows.withColumn("hits", F.when(F.size(named) > 0, named).otherwise(F.col("hits")))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.coalesce(F.array_join(F.col("hits.rule"), ","), F.lit("")).alias("rules"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct("hits.licence")), ","), F.lit("")).alias("licenses"))


def oracle() -> str:
    """The same rows in DuckDB SQL; a rule is met as often as its pattern is found in the joined identifiers."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    known = ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in identifiers().items())
    met = ", ".join("len(regexp_extract_all(line, {}))".format(quoted(".*?".join("<" + re.escape(x) + ">" for x in seq)))
                    for _, _, seq in RULES)
    around, alone = containing(), {}
    for k in sorted(range(len(RULES)), key=lambda k: -len(RULES[k][2])):
        less = "".join(f" - {alone[outer]}" for outer in around[k])
        alone[k] = f"greatest(met[{k + 1}]{less}, 0)"
    hits = ", ".join(f"CASE WHEN {alone[k]} > 0 THEN [{quoted(rule)}, {quoted(lic)}] END" for k, (rule, lic, _) in enumerate(RULES))
    marked = f"regexp_replace(translate(coalesce(text, ''), chr(1), ' '), '{SPDX_LINE}', '\\1 ', 'g')"
    marked = f"regexp_replace(regexp_replace({marked}, '{PARAGRAPH_END}', chr(1), 'g'), '{SENTENCE_END}', '\\1' || chr(1), 'g')"
    return f"""
WITH k AS (SELECT MAP {{{known}}} AS m),
cut AS (
  SELECT row_number() OVER () AS r, doc_id, list_transform(string_split({marked}, chr(1)), lambda s: list_filter(list_transform(
    string_split(s, chr(10)), lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '')) AS sentences
  FROM documents),
lines AS (SELECT r, doc_id, unnest(range(1, len(sentences) + 1)) AS s, unnest(sentences) AS parts FROM cut),
named AS (
  SELECT r, s, 0 AS j, array_to_string(parts, ' ') AS x FROM lines WHERE len(parts) > 1
  UNION ALL
  SELECT r, s, unnest(range(0, len(parts))) AS j, unnest(parts) AS x FROM lines),
found AS (SELECT r, s, j, element_at(m, x)[1] AS id FROM named, k WHERE map_contains(m, x)),
seq AS (SELECT r, doc_id, coalesce(ids, []) AS ids FROM cut LEFT JOIN (
  SELECT r, list(id ORDER BY s, j, id) AS ids FROM found GROUP BY r) USING (r)),
line AS (SELECT doc_id, ids, '<' || array_to_string(ids, '><') || '>' AS line FROM seq),
met AS (SELECT doc_id, ids, [{met}] AS met FROM line),
hit AS (SELECT doc_id, ids, list_filter([{hits}], lambda x: x IS NOT NULL) AS h FROM met),
named_hit AS (SELECT *, list_filter(h, lambda x: x[2] <> '{ALONE}') AS others FROM hit),
ranked AS (SELECT doc_id, ids, CASE WHEN len(others) > 0 THEN others ELSE h END AS h FROM named_hit)
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_transform(h, lambda x: x[1]), ',') AS rules,
  array_to_string(list_sort(list_distinct(list_transform(h, lambda x: x[2]))), ',') AS licenses
FROM ranked"""
