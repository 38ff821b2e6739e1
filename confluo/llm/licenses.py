"""Licence scan: passages of a text compared to licence templates by the Dice coefficient over word bigrams.

Texts are normalised to words: runs of ASCII letters and digits, lower-cased. Licence text can stand anywhere, so a document is
compared by lines, by sentences within lines, by paragraphs of several lines, and by word windows across line ends (below). Dice is ``2 |A and B| / (|A| + |B|)`` over sets of
bigrams, so a passage can reach the threshold ``t`` only where ``t / (2 - t) <= |A| / |B| <= (2 - t) / t``: templates outside these bounds
are not compared.

Before that, documents and passages without any signal bigram are passed over. A match shares at least ``s`` of a template's ``b`` bigrams, so it
contains one of any ``b - s + 1`` of them (prefix filtering); those with the longest words are chosen.

Notices that are hard-wrapped inside a longer paragraph or a comment header, or stand in the middle of a sentence, are no passage of their own. For
a licence that no passage shows, the words of the whole text are taken as one sequence, line ends and comment marks being no words. At every bigram
of a template a window of the template's length in words begins (shorter at the end of the text). Windows over two or more lines are compared like
passages; a window inside one line is a piece of a longer sentence, which a short notice may resemble by chance ("released under the MIT Foundation"), and
must reach ``INLINE``. Templates of which the text holds too few words or bigrams for a match have no windows.

Licences word their notices alike. A passage or window therefore speaks for the licence nearest to it only (for all that are equally near): the notice of
the LGPL is none of the GPL. What two-clause and three-clause BSD texts share word for word counts as BSD-3-Clause.

Everything is one expression per row, built from SQL functions: no shuffle, no join, no Python. Templates are literals in the plan.

Defined results: a NULL or empty text matches nothing and still has its row; of several passages, or else windows, that match a licence the best counts; ties
between licences go to the one that sorts first; rows with equal ids are scanned one by one; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import pick

THRESHOLD = 0.7
# What a window inside one line must reach: with a notice of five words, no other word.
INLINE = 0.8

# Notices as licences word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        "language governing permissions and limitations under the License.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
        "Released under the BSD 3-Clause License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
        "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:",
    ],
    "reserved": ["All rights reserved.", "Copyright. All rights reserved."],
}

# Tags name a licence by its identifier; those of the GNU licences say besides whether later versions count.
TAGS = {name: [name + end for end in (("", "-only", "-or-later") if "GPL" in name else ("",))] for name in TEMPLATES if name != "reserved"}
for _name, _tags in TAGS.items():
    TEMPLATES[_name] += [f"SPDX-License-Identifier: {tag}" for tag in _tags]


def template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def bounds(size: int, threshold: float) -> tuple[int, int]:
    """Sizes a passage may have to reach the threshold with a template of ``size`` bigrams."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def least_shared(size: int, threshold: float) -> int:
    """How many bigrams of a template of ``size`` bigrams every match shares."""
    return math.ceil(threshold * (size + bounds(size, threshold)[0]) / 2 - 1e-9)


def signal_bigrams(templates: dict[str, list[str]], threshold: float) -> list[str]:
    """Bigrams of which every matching passage contains one."""
    out: set[str] = set()
    for text in (t for texts in templates.values() for t in texts):
        grams = template_bigrams(text)
        if grams:
            shared = least_shared(len(grams), threshold)
            out.update(sorted(grams, key=lambda g: (-max(map(len, g.split())), g))[: len(grams) - shared + 1])
    return sorted(out)


def any_of_words(words: list[str]) -> str:
    """A pattern for one of the words (or bigrams, whatever is between their words) that shares their beginnings, so that a text is not tried
    against each of them at every place."""
    by_letter: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        by_letter.setdefault(w[:1], []).append(w[1:])
    ends = by_letter.pop("", None) is not None
    branches = [("[^a-z0-9]+" if c == " " else re.escape(c)) + any_of_words(rest) for c, rest in by_letter.items()]
    if not branches:
        return ""
    return f"(?:{'|'.join(branches)}){'?' if ends else ''}" if ends or len(branches) > 1 else branches[0]


def normal_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def word_pairs(words: Column) -> Column:
    """Pairs of neighbouring words, in order."""
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return F.array_distinct(word_pairs(words))


def passages(text: Column) -> Column:
    """Lines, sentences and paragraphs of several lines."""
    lines = F.split(text, "\n")
    sentences = F.split(F.regexp_replace(text, "([.!?])[ \t]+", "$1\n"), "\n")
    paragraphs = F.split(F.regexp_replace(text, "\n[ \t\r]*\n", "\f"), "\f")
    return F.array_union(F.array_union(lines, sentences), paragraphs)


def _dice(own: list[str], low: int, high: int) -> Callable[[Column], Column]:
    """Dice of a passage's bigrams with a template's, or NULL outside the size bounds."""
    literal = F.array(*[F.lit(g) for g in own])
    return lambda g: F.when(F.size(g).between(low, high), 2 * F.size(F.array_intersect(g, literal)) / (F.size(g) + len(own)))


def _window_grams(template: str, threshold: float) -> Column | None:
    """Windows of a template that reach the threshold, with their distinct bigrams ``g``; NULL where the text cannot match.

    ``all`` has the text's distinct bigrams, ``pairs`` all in order, ``line`` a line number for every word.
    """
    own = template_bigrams(template)
    if not own:
        return None
    length = len(re.findall("[a-z0-9]+", template.lower()))
    literal = F.array(*[F.lit(g) for g in own])
    begins = F.filter(F.transform("pairs", lambda g, i: F.when(F.array_contains(literal, g), i + 1)), lambda i: i.isNotNull())
    across = lambda i: F.element_at("line", i) < F.element_at("line", F.least(i + length - 1, F.size("line")))
    windows = F.transform(begins, lambda i: F.struct(F.array_distinct(F.slice("pairs", i, length - 1)).alias("g"), across(i).alias("across")))
    dice = _dice(own, *bounds(len(own), threshold))
    near = F.filter(windows, lambda w: dice(w["g"]) >= F.when(w["across"], threshold).otherwise(max(threshold, INLINE)))
    possible = F.size(F.array_intersect("all", literal)) >= least_shared(len(own), threshold)
    return F.when(possible, near)


def _has_words(texts: list[str], threshold: float) -> Column:
    """Whether the words ``held`` by the text suffice for a match: every template word that is missing takes a bigram of its own with it."""
    out = F.lit(False)
    for own in filter(None, map(template_bigrams, texts)):
        words = sorted({w for g in own for w in g.split()})
        out = out | (F.size(F.array_intersect("held", F.array(*map(F.lit, words)))) >= len(words) - len(own) + least_shared(len(own), threshold))
    return out


def scan_licenses(
    docs: DataFrame, threshold: float = THRESHOLD, templates: dict[str, list[str]] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_matches, licenses, best_license, best_dice``: one row per document.

    ``licenses`` lists the licences with a passage at or above the threshold, sorted and comma-joined; ``n_matches`` counts them.
    """
    templates = TEMPLATES if templates is None else templates
    signal = r"(?<![a-z0-9])(?:" + any_of_words(signal_bigrams(templates, threshold)) + r")(?![a-z0-9])"
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    with_signal = F.filter(passages(F.col("text")), lambda p: F.lower(p).rlike(signal))
    grams = F.when(F.lower("text").rlike(signal), F.transform(with_signal, lambda p: bigrams(normal_words(p))))

    none = F.array().cast("array<struct<d:double,licence:string>>")

    def dice(texts: list[str], g: Column) -> Column:
        best = [_dice(own, *bounds(len(own), threshold))(g) for own in filter(None, map(template_bigrams, texts))]
        return F.greatest(*best) if len(best) > 1 else best[0] if best else F.lit(None).cast("double")

    def scores(g: Column) -> Column:
        """The licences that a passage or window reaches the threshold with."""
        each = [F.struct((-dice(texts, g)).alias("d"), F.lit(name).alias("licence")) for name, texts in sorted(templates.items())]
        return F.filter(F.array(*each), lambda x: -x["d"] >= threshold) if each else none

    def nearest(found: Column) -> Column:
        return F.filter(found, lambda x: x["d"] == F.array_min(found)["d"])

    def best_of_each(found: Column) -> Column:
        """One entry per licence, the best, in the order of names."""
        names = F.array_sort(F.array_distinct(F.transform(found, lambda x: x["licence"])))
        return F.transform(names, lambda name: F.array_min(F.filter(found, lambda x: x["licence"] == name)))

    def windows(name: str, text: str) -> Column | None:
        """The windows near one template of a licence that is open, with its name."""
        near = _window_grams(text, threshold)
        return None if near is None else F.transform(F.when(F.array_contains("open", name), near), lambda w: F.struct(F.lit(name).alias("licence"), w["g"].alias("g")))

    # Every step is a column of its own, so that none is computed twice.
    scored = rows.select("doc_id", "text", grams.alias("grams")).select(
        "doc_id", F.when(F.size("grams") > 0, F.transform("grams", scores)).alias("scores"), F.when(F.col("grams").isNotNull(), F.col("text")).alias("text")
    )
    reached = scored.select("doc_id", F.flatten(F.transform("scores", nearest)).alias("near"), "text")
    scanned = reached.select("doc_id", best_of_each(F.col("near")).alias("found"), "text")
    known = sorted({w for texts in templates.values() for t in texts for g in template_bigrams(t) for w in g.split()})
    scanned = scanned.select("doc_id", "found", "text", normal_words(F.col("text")).alias("words"))
    held = F.array_intersect("words", F.array(*map(F.lit, known)).cast("array<string>"))
    seen = F.coalesce(F.transform("found", lambda x: x["licence"]), F.array().cast("array<string>"))
    scanned = scanned.select("*", held.alias("held"), seen.alias("seen"))
    may = [F.when(~F.array_contains("seen", name) & _has_words(texts, threshold), F.lit(name)) for name, texts in sorted(templates.items())]
    scanned = scanned.select("doc_id", "found", "text", "words", F.when(F.size("held") > 0, F.array_compact(F.array(*may))).alias("open"))
    paired = scanned.select(
        "doc_id", "found", "open", F.when(F.size("open") > 0, word_pairs(F.col("words"))).alias("pairs"), F.when(F.size("open") > 0, F.split("text", "\n")).alias("lines")
    )
    # As many numbers for a line as it has words.
    numbers = F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.size(normal_words(x)))))
    paired = paired.select("doc_id", "found", "open", "pairs", numbers.alias("line"))
    distinct = paired.select("*", F.array_distinct("pairs").alias("all"))
    shape = "array<struct<licence:string,g:array<string>>>"
    near = [w for name, texts in sorted(templates.items()) for w in (windows(name, t) for t in texts) if w is not None]
    every = F.concat(F.array().cast(shape), *[F.coalesce(w, F.array().cast(shape)) for w in near])
    wrapped = distinct.select("doc_id", "found", F.when(F.size("all") > 0, every).alias("windows"))
    wrapped = wrapped.select("doc_id", "found", F.transform("windows", lambda w: F.struct(w["licence"].alias("licence"), scores(w["g"]).alias("scores"))).alias("windows"))
    own = F.transform("windows", lambda w: F.filter(nearest(w["scores"]), lambda x: x["licence"] == w["licence"]))
    wrapped = wrapped.select("doc_id", "found", F.flatten(own).alias("shown"))
    both = F.when(F.size("shown") > 0, best_of_each(F.concat(F.coalesce("found", none), "shown"))).otherwise(F.col("found"))
    scanned = wrapped.select("doc_id", both.alias("found"))
    best = F.array_min("found")
    return scanned.select(
        "doc_id",
        F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_matches"),
        F.coalesce(F.array_join(F.transform("found", lambda x: x["licence"]), ","), F.lit("")).alias("licenses"),
        best["licence"].alias("best_license"),
        (-best["d"]).alias("best_dice"),
    )


def sql_licenses(threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL, every passage and window against every template."""
    quote = "'"
    rows = ", ".join(
        f"('{name}', [{', '.join(quote + g + quote for g in template_bigrams(t))}], {len(re.findall('[a-z0-9]+', t.lower()))})"
        for name, texts in sorted(TEMPLATES.items())
        for t in texts
    )
    return f"""WITH tpl(licence, grams, words) AS (VALUES {rows}),
d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
p AS (SELECT row, unnest(list_distinct(list_concat(list_concat(string_split(text, chr(10)),
    string_split(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10))),
    string_split(regexp_replace(text, '\n[ \t\r]*\n', chr(12), 'g'), chr(12))))) AS p FROM d),
w AS (SELECT row, regexp_extract_all(lower(p), '[a-z0-9]+') AS w FROM p),
g AS (SELECT DISTINCT row, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w WHERE len(w) >= 2),
n AS (SELECT row, g, licence, max(2 * len(list_intersect(g, grams)) / (len(g) + len(grams))) AS dice FROM g, tpl GROUP BY ALL),
s AS (SELECT row, licence, max(dice) AS dice FROM (SELECT * FROM n WHERE dice >= {threshold} QUALIFY dice = max(dice) OVER (PARTITION BY row, g)) GROUP BY ALL),
tw AS (SELECT row, regexp_extract_all(lower(text), '[a-z0-9]+') AS w, flatten(list_transform(string_split(lower(text), chr(10)),
    lambda x, i: list_transform(regexp_extract_all(x, '[a-z0-9]+'), lambda y: i))) AS line FROM d WHERE text IS NOT NULL),
tp AS (SELECT row, line, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS pairs FROM tw WHERE len(w) >= 2),
td AS (SELECT row, line, pairs, list_distinct(pairs) AS own FROM tp),
o AS (SELECT row, line, pairs, licence, grams, words FROM td, tpl
  WHERE len(list_intersect(own, grams)) >= {threshold} * len(grams) / (2 - {threshold}) - 1e-9 AND NOT EXISTS (SELECT 1 FROM s WHERE s.row = td.row AND s.licence = tpl.licence)),
b AS (SELECT row, licence, grams, list_distinct(list_slice(pairs, i, i + words - 2)) AS g, line[i] < line[least(i + words - 1, len(line))] AS across
  FROM (SELECT *, unnest(list_filter(range(1, len(pairs) + 1), lambda i: list_contains(grams, pairs[i]))) AS i FROM o)),
c AS (SELECT DISTINCT row, licence, g FROM b WHERE 2 * len(list_intersect(g, grams)) / (len(g) + len(grams)) >= CASE WHEN across THEN {threshold} ELSE {max(threshold, INLINE)} END),
f AS (SELECT c.row, c.licence, c.g, tpl.licence AS other, max(2 * len(list_intersect(c.g, tpl.grams)) / (len(c.g) + len(tpl.grams))) AS dice FROM c, tpl GROUP BY ALL),
x AS (SELECT * FROM f QUALIFY dice = max(dice) OVER (PARTITION BY row, licence, g)),
m AS (SELECT row, licence, max(dice) AS dice FROM (SELECT * FROM s UNION ALL SELECT row, licence, dice FROM x WHERE licence = other) GROUP BY ALL),
r AS (SELECT row, count(*) AS n, string_agg(licence, ',' ORDER BY licence) AS licenses, arg_min(licence, ROW(-dice, licence)) AS best_license,
  max(dice) AS best_dice FROM m GROUP BY row)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(licenses, '') AS licenses, best_license, best_dice FROM d LEFT JOIN r USING (row)"""
