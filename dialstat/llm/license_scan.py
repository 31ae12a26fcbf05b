"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences (at lines without letters and digits, after copyright lines, and after . ! ? ; :
before white space), each normalised (A-Z lower-cased, every run of other characters than a-z and 0-9 one
space), so wrapped lines and comment marks do not matter; a sentence of several lines that is not known
is cut at its line ends. Known licence sentences
have identifiers; a text becomes the sequence of the identifiers it contains, in order. Licence rules
are sequences of identifiers: they are looked for longest first, next to each other in the text's
sequence, and what a rule has matched no shorter rule can match again.

Everything happens inside the row: no shuffle, no join; the sentence table is a constant of the plan.
Texts without any anchor word are not cut; every known sentence has an anchor, so none is missed.

Defined cases: null and empty texts have no sentences and no licence; equal sentences count each time;
repeated rows each get their result; an empty table gives an empty result; any number of blank lines or of lines
with marks alone is one cut (the patterns repeat single classes only, which Java matches without recursion).
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialstat.llm.common import ascii_lower, read_table

#: Known sentences, normalised (fixed values): identifier -> sentence.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the mit license",
    3: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
       "documentation files the software to deal in the software without restriction",
    4: "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
       "of the software",
    5: "the software is provided as is without warranty of any kind express or implied",
    6: "licensed under the apache license version 2 0",
    7: "licensed under the apache license version 2 0 the license",
    8: "you may not use this file except in compliance with the license",
    9: "you may obtain a copy of the license at",
    10: "this work is licensed under the gnu general public license version 3",
    11: "this program is free software",
    12: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation",
    13: "either version 3 of the license or at your option any later version",
    14: "either version 2 of the license or at your option any later version",
    15: "licensed under cc by nc 4 0",
    16: "licensed under cc by 4 0",
    17: "licensed under cc by sa 4 0",
    18: "this work is licensed under a creative commons attribution 4 0 international license",
    19: "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    20: "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
    21: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    22: "this software is provided by the copyright holders and contributors as is",
    23: "all rights reserved",
    24: "this is free and unencumbered software released into the public domain",
}
#: Parts of words; every sentence above has one of them.
ANCHORS = ("licen", "software", "copyright", "redistribut", "reserved")
#: Licence rules: name -> ordered identifiers (fixed values).
RULES = {
    "mit-text": (3, 4, 5), "mit-text-short": (3, 4), "mit-grant": (3,), "mit-released": (1,), "mit-notice": (2,),
    "apache-header": (7, 8, 9), "apache-notice": (6,), "gpl3-header": (11, 12, 13), "gpl2-header": (11, 12, 14),
    "gpl3-notice": (10,), "cc-by-nc": (15,), "cc-by": (16,), "cc-by-sa": (17,), "cc-by-long": (18,),
    "bsd-text": (19, 20, 21, 22), "bsd-conditions": (19, 20), "proprietary": (23,), "unlicense": (24,),
}
#: Rule -> licence.
LICENSES = {
    "mit-text": "MIT", "mit-text-short": "MIT", "mit-grant": "MIT", "mit-released": "MIT", "mit-notice": "MIT",
    "apache-header": "Apache-2.0", "apache-notice": "Apache-2.0", "gpl3-header": "GPL-3.0-or-later",
    "gpl2-header": "GPL-2.0-or-later", "gpl3-notice": "GPL-3.0", "cc-by-nc": "CC-BY-NC-4.0", "cc-by": "CC-BY-4.0",
    "cc-by-sa": "CC-BY-SA-4.0", "cc-by-long": "CC-BY-4.0", "bsd-text": "BSD", "bsd-conditions": "BSD",
    "proprietary": "Proprietary", "unlicense": "Unlicense",
}

_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by
the Free Software Foundation, either version {1} of the License, or (at your option) any later version."""
_GNU_OLD = """This {2} is free software; you can redistribute it and/or modify it under the terms of the GNU {0} as published by
the Free Software Foundation; either version {1} of the License, or (at your option) any later version."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_CLAUSE3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
#: Published texts, whole (the long licences by their titles, which begin the full texts): rule -> (licence, text).
PUBLISHED = {
    "mit-published": ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    "isc-published": ("ISC", _ISC),
    "isc-published-and": ("ISC", _ISC.replace("and/or", "and")),
    "bsd2-published": ("BSD-2-Clause", _BSD.format("", "HOLDER")),
    "bsd2-published-owner": ("BSD-2-Clause", _BSD.format("", "OWNER")),
    "bsd3-published": ("BSD-3-Clause", _BSD.format(_CLAUSE3, "HOLDER")),
    "bsd3-published-owner": ("BSD-3-Clause", _BSD.format(_CLAUSE3, "OWNER")),
    "apache-header": ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at"""),
    "apache-title": ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    "gpl3-published": ("GPL-3.0-or-later", _GNU.format("General Public License", "3")),
    "gpl2-header": ("GPL-2.0-or-later", _GNU_OLD.format("General Public License", "2", "program")),
    "lgpl3-published": ("LGPL-3.0-or-later", _GNU.format("Lesser General Public License", "3")),
    "lgpl21-published": ("LGPL-2.1-or-later", _GNU_OLD.format("Lesser General Public License", "2.1", "library")),
    "agpl3-published": ("AGPL-3.0-or-later", _GNU.format("Affero General Public License", "3")),
    "gpl3-title": ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "gpl2-title": ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "lgpl3-title": ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "lgpl21-title": ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "agpl3-title": ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "mpl2-title": ("MPL-2.0", "Mozilla Public License Version 2.0"),
    "mpl2-published": ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at"""),
}


def _published() -> tuple[dict, dict]:
    """Identifier of every sentence, and the rules of the published texts."""
    ids, rules = {s: i for i, s in SENTENCES.items()}, {}
    for rule, (_, text) in PUBLISHED.items():
        parts = [re.sub("[^a-z0-9]+", " ", p.lower()).strip() for p in re.split(r"(?<=[.!?;:])\s+", text)]
        rules[rule] = tuple(ids.setdefault(p, len(ids) + 1) for p in parts if any(a in p for a in ANCHORS))
    return ids, rules


KNOWN, PUBLISHED_RULES = _published()


def _marks(ids) -> str:
    return "".join(f"<{i}>" for i in ids)


def _ordered_rules(rules=RULES) -> list[str]:
    return sorted(rules, key=lambda r: (-len(rules[r]), r))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sentence_ids ("<6><8>" in order), n_sentences, rules and licenses (sorted, comma-joined)."""
    low = ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), low.alias("low"))
    anchored = reduce(lambda a, b: a | b, [F.contains("low", F.lit(a)) for a in ANCHORS])
    parted = F.regexp_replace("low", r"(?m)^([^a-z0-9\n]*copyright[ \t]+(?:\(c\)|\u00a9|[0-9])[^\n]*)$", "$1\n")
    parts = F.split(parted, r"(?<=[.!?;:])[ \t\r\n]+|\n[^a-z0-9]*\n", -1)
    known = F.create_map(*[F.lit(x) for sentence, i in KNOWN.items() for x in (sentence, f"<{i}>")])
    id_of = lambda s: F.try_element_at(known, F.btrim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    by_line = lambda s: F.when(F.contains(s, F.lit("\n")), F.array_join(F.transform(F.split(s, "\n", -1), id_of), ""))
    ids = F.array_join(F.transform(parts, lambda s: F.coalesce(id_of(s), by_line(s))), "")
    rows = rows.select("doc_id", F.when(anchored, ids).otherwise("").alias("sentence_ids"))
    left, found, rules = F.col("sentence_ids"), [], RULES | PUBLISHED_RULES
    for rule in _ordered_rules(rules):
        marks = _marks(rules[rule])
        found.append((rule, F.contains(left, F.lit(marks))))
        left = F.replace(left, F.lit(marks), F.lit("|"))
    names = F.array_compact(F.array(*[F.when(hit, F.lit(rule)) for rule, hit in found]))
    rows = rows.withColumn("names", F.when(F.col("sentence_ids") == "", F.array().cast("array<string>")).otherwise(names))
    of = F.create_map(*[F.lit(x) for pair in (LICENSES | {r: x for r, (x, _) in PUBLISHED.items()}).items() for x in pair])
    return rows.select(
        "doc_id", "sentence_ids",
        (F.length("sentence_ids") - F.length(F.translate("sentence_ids", "<", ""))).cast("long").alias("n_sentences"),
        F.array_join(F.array_sort("names"), ",").alias("rules"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("names", lambda r: F.try_element_at(of, r)))), ",")
        .alias("licenses"))


def query(spark, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same in SQL: sentences as rows, identifiers by a join, rules one after another."""
    known = ", ".join(f"({i}, '{s}')" for s, i in KNOWN.items())
    steps, rules = [], RULES | PUBLISHED_RULES
    for rule in _ordered_rules(rules):
        marks = _marks(rules[rule])
        steps.append((rule, marks))
    of = ", ".join(f"('{r}', '{x}')" for r, x in (LICENSES | {r: x for r, (x, _) in PUBLISHED.items()}).items())
    # each rule works on what the longer ones have left: one step of SQL a rule
    chain = "\n".join(
        f"r{n + 1} AS (SELECT doc_id, replace(rest, '{marks}', '|') rest, hits || CASE WHEN contains(rest, '{marks}') "
        f"THEN ['{rule}'] ELSE [] END hits FROM r{n}),"
        for n, (rule, marks) in enumerate(steps))
    return f"""
WITH known(i, s) AS (VALUES {known}), of_rule(r, x) AS (VALUES {of}),
low AS (
  SELECT doc_id, regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '(?m)^([^a-z0-9\\n]*copyright[ \\t]+(?:\\(c\\)|\u00a9|[0-9])[^\\n]*)$', '\\1' || chr(10), 'g') t FROM documents),
parts AS (
  SELECT doc_id, unnest(ps) part, unnest(range(len(ps))) place FROM (
    SELECT doc_id, string_split(regexp_replace(regexp_replace(t, '([.!?;:])[ \\t\\r\\n]+', '\\1' || chr(1), 'g'),
      '\\n[^a-z0-9\\x01]*\\n', chr(1), 'g'), chr(1)) ps FROM low)),
whole AS (
  SELECT doc_id, place, part, i FROM parts LEFT JOIN known ON trim(regexp_replace(part, '[^a-z0-9]+', ' ', 'g')) = s),
lines AS (
  SELECT doc_id, place, unnest(ls) line, unnest(range(len(ls))) k
  FROM (SELECT doc_id, place, string_split(part, chr(10)) ls FROM whole WHERE i IS NULL AND contains(part, chr(10)))),
found AS (
  SELECT doc_id, place, 0 k, i FROM whole WHERE i IS NOT NULL UNION ALL
  SELECT doc_id, place, k, known.i FROM lines JOIN known ON trim(regexp_replace(line, '[^a-z0-9]+', ' ', 'g')) = s),
r0 AS (
  SELECT doc_id, string_agg('<' || i || '>', '' ORDER BY place, k) rest, CAST([] AS VARCHAR[]) hits FROM found GROUP BY doc_id),
ids AS (SELECT doc_id, rest sentence_ids, len(rest) - len(replace(rest, '<', '')) n FROM r0),
{chain}
named AS (SELECT doc_id, array_to_string(list_sort(hits), ',') rules FROM r{len(steps)}),
lic AS (SELECT doc_id, string_agg(x, ',' ORDER BY x) licenses FROM (
  SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(hits) r FROM r{len(steps)}) JOIN of_rule USING (r)) GROUP BY doc_id)
SELECT d.doc_id, coalesce(sentence_ids, '') sentence_ids, coalesce(n, 0)::BIGINT n_sentences,
  coalesce(rules, '') rules, coalesce(licenses, '') licenses
FROM documents d LEFT JOIN ids USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN lic USING (doc_id)
"""


ORACLE = _oracle()
