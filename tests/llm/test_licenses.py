from __future__ import annotations

import functools
import re

import duckdb
import pandas as pd

from confluo.llm import licenses as L
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, prose, rows_of


@functools.cache
def grams(text):
    w = re.findall("[a-z0-9]+", text.lower())
    return set(zip(w, w[1:], strict=False))


def nearest(a, threshold):
    """The licences nearest to a set of bigrams."""
    scores = {name: max((2 * len(a & b) / (len(a) + len(b)) for b in map(grams, texts) if a and b), default=0) for name, texts in L.TEMPLATES.items()}
    return {n: d for n, d in scores.items() if d >= threshold and d == max(scores.values())}


def passage_matches(text, threshold=L.THRESHOLD):
    pieces = set(text.split("\n")) | set(re.sub(r"([.!?])[ \t]+", r"\1\n", text).split("\n")) | set(re.sub(r"\n[ \t\r]*\n", "\f", text).split("\f"))
    best = {}
    for p in pieces:
        for name, d in nearest(grams(p), threshold).items():
            best[name] = max(best.get(name, 0), d)
    return best


def brute(text, threshold=L.THRESHOLD):
    """Passages, then for the licences these do not show windows of template length that begin with a bigram of the template."""
    if not text:
        return (0, "", None, None)
    shown = passage_matches(text, threshold)
    best, placed = dict(shown), [(w, n) for n, line in enumerate(text.split("\n")) for w in re.findall("[a-z0-9]+", line.lower())]
    words = [w for w, _ in placed]
    for name in set(L.TEMPLATES) - set(shown):
        for t in L.TEMPLATES[name]:
            own, length = grams(t), len(re.findall("[a-z0-9]+", t.lower()))
            for i in range(len(words) - 1):
                window = grams(" ".join(words[i : i + length])) if (words[i], words[i + 1]) in own else set()
                least = threshold if placed[i][1] < placed[min(i + length, len(words)) - 1][1] else max(threshold, L.INLINE)
                if window and 2 * len(window & own) / (len(window) + len(own)) >= least and name in (near := nearest(window, threshold)):
                    best[name] = max(best.get(name, 0), near[name])
    if not best:
        return (0, "", None, None)
    d, name = min((-d, n) for n, d in best.items())
    return (len(best), ",".join(sorted(best)), name, -d)


def cases():
    mit, apache = L.TEMPLATES["MIT"], L.TEMPLATES["Apache-2.0"]
    long = mit[2]
    return [
        f"{prose(1, 20)}\n{mit[0]}\n{prose(2, 9)}", f"{prose(3, 8)}. {apache[0]} {prose(4, 8)}.", f"{prose(5, 8)}\n\n" + long.replace(", ", ",\n") + "\n\nx y z",
        long.upper(), " ".join(long.split()[: len(long.split()) // 2]), "released under the terms", "Licensed under CC BY-NC 4.0 by us", "license",
        "This work is licensed under the GNU General Public License, version 3", "All rights reserved.\n" + apache[2] + "\n" + mit[1], prose(6, 3000),
        "the mit license is released under the mit license", "Copyright 2020. All rights reserved.",
    ]


def test_equals_brute_force(spark):
    rows = [*enumerate(cases())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in L.scan_licenses(docs).collect()}
    for i, text in rows:
        assert got[i] == brute(text), text
    loose = {r[0]: tuple(r)[1:] for r in L.scan_licenses(docs, threshold=0.4).collect()}
    assert loose == {i: brute(t, 0.4) for i, t in rows}


def test_prefix_filter_is_sound():
    for threshold in (0.3, 0.5, 0.7, 0.9):
        signal = set(L.signal_bigrams(L.TEMPLATES, threshold))
        for texts in L.TEMPLATES.values():
            for t in texts:
                g = L.template_bigrams(t)
                low, _ = L.bounds(len(g), threshold)
                shared = -(-threshold * (len(g) + low) // 2)
                # Without any signal bigram a match would be impossible.
                assert sum(x not in signal for x in g) < shared


def test_words_that_share_beginnings():
    words = ["license", "licenses", "lib", "library", "a", "apache", "2"]
    for w in ("licens", "license", "licenses", "licensess", "lib", "libra", "library", "a", "ap", "apache", "2", "", "x"):
        assert bool(re.fullmatch(L.any_of_words(words), w)) == (w in words), w
    assert re.fullmatch(L.any_of_words(["mit license", "mit"]), "mit -- license") and not re.fullmatch(L.any_of_words(["mit license"]), "mitlicense")


def test_no_python_and_no_shuffle(spark):
    plan = L.scan_licenses(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    out = L.scan_licenses(crowded(odd_docs(spark)))
    assert rows_of(out, "*") == sorted([(r[0], *brute(r[1])) for r in odd_rows()], key=repr)
    assert L.scan_licenses(empty_docs(spark)).count() == 0


def wrapped(text, width, mark):
    words, lines = text.split(), []
    for i in range(0, len(words), width):
        lines.append(mark + " ".join(words[i : i + width]))
    return "\n".join(lines)


def test_wrapped_notices(spark):
    name = {"MIT": 2, "GPL-3.0": 1, "BSD-3-Clause": 0, "Apache-2.0": 2}
    rows = [(licence, f"{mark}Copyright (c) 2020 some authors\n{mark.rstrip()}\n{wrapped(L.TEMPLATES[licence][k], 9, mark)}\n{mark.rstrip()}\n{wrapped(prose(k, 120), 9, mark)}") for licence, k in name.items() for mark in (" * ", "# ", "// ")]
    rows.append(("MIT", f"{prose(1, 9)}. This is released under the MIT\nLicense. {prose(2, 12)}. {prose(3, 9)}."))
    rows.append(("MIT", f"{prose(1, 40)}\nmore is released under the\r\n MIT\n\nLicense"))
    rows += [("", f"{prose(1, 9)} under the\nlicense of {prose(2, 12)}"), ("", "released under the MIT Foundation and much else besides that\nreleased later on under other terms")]
    assert not any(passage_matches(t) for _, t in rows)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(docs).collect()}
    for i, (licence, text) in enumerate(rows):
        assert (got[i].licenses, got[i].best_license, got[i].best_dice) == (licence, licence or None, 1.0 if licence else None), text


def window_cases():
    """Notices that are no passage: (licences expected, text)."""
    lesser, affero = L.TEMPLATES["LGPL-2.1"][0], L.TEMPLATES["AGPL-3.0"][0]
    return [
        ("MIT", "In 2019 the tool was released under the MIT License and everyone went on using it as before for years and years to come"),
        ("LGPL-2.1", lesser), ("LGPL-2.1", wrapped(f"{prose(3, 30)} {lesser} {prose(4, 30)}", 9, "# ")), ("LGPL-2.1", f"{prose(5, 40)} {lesser} {prose(6, 40)}"),
        ("AGPL-3.0", affero), ("AGPL-3.0,GPL-3.0", wrapped(f"{affero} {prose(7, 60)} {L.TEMPLATES['GPL-3.0'][1]}", 9, " * ")),
        ("ISC", f"{prose(8, 9)}\n\n{L.TEMPLATES['ISC'][1]}\n"), ("MIT", f"x\n{L.TEMPLATES['MIT'][4]}"), ("Unlicense", f"{prose(9, 30)} {L.TEMPLATES['Unlicense'][0]}"),
        ("Zlib", wrapped(f"{L.TEMPLATES['Zlib'][0]} {L.TEMPLATES['Zlib'][1]}", 7, "// ")), ("EPL-2.0", f"{prose(2, 50)} {L.TEMPLATES['EPL-2.0'][0]} {prose(1, 9)}"),
        ("BSD-2-Clause", "// SPDX-License-Identifier: BSD-2-Clause\nint main() { return 0; }"), ("GPL-3.0", f"# SPDX-License-Identifier: GPL-3.0-or-later {prose(1, 5)}"),
        ("", "it was released under the MIT Foundation and much else"), ("", f"{prose(1, 50)} the license of {prose(2, 50)} software"), ("", "word " * 3000), ("MIT", "spam " * 3000 + "released under the MIT License " + "spam " * 3000),
    ]


def test_windows_and_near_twins(spark):
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(window_cases())], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan_licenses(docs).collect()}
    for i, (licences, text) in enumerate(window_cases()):
        assert tuple(got[i])[1:] == brute(text), text
        assert got[i].licenses == licences, text


def test_sql_twin_has_windows():
    """The twin on texts that make windows fire, against brute force."""
    texts = [None, "", *cases(), *(t for _, t in window_cases())]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    base = duckdb.connect()
    base.register("documents", documents)
    for i, *row in base.execute(L.sql_licenses()).fetchall():
        assert tuple(row) == brute(texts[i]), texts[i]
