import re

import edge
import pytest

from creditloom.llm import licenses


def normal_words(text):
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams(words):
    return {(a, b) for a, b in zip(words, words[1:])}


def brute(rows, templates, threshold):
    for r in rows:
        text = r[1] or ""
        body = re.sub(r"[^\w\n]|_", " ", text.lower())
        parts = {tuple(p.split()) for p in body.split("\n")} | {tuple(body.split())}
        parts |= {tuple(p.split()) for p in re.split(r"\n *\n[ \n]*", body)}
        for name, template in templates.items():
            want = bigrams(normal_words(template))
            dice = []
            for part in parts:
                have = bigrams(part)
                if have:
                    dice.append(2 * len(have & want) / (len(have) + len(want)))
            dice = [d for d in dice if d >= threshold]
            if dice:
                yield (r[0], name, round(max(dice), 9), len(dice))


def corpus():
    mit = licenses.TEMPLATES["MIT"]
    words = mit.split()
    rows = edge.texts()
    rows += [
        (20, "Before it.\n\n" + mit.replace(". ", ".\n") + "\n \nAfter it.", None, None),
        (21, mit.upper() + " " + edge.prose(1, 30), None, None),
        (22, " ".join(words[:100]), None, None),
        (23, "x\nReleased, under -- the MIT license!\nReleased under the MIT License.", None, None),
        (24, "This work is licensed under the GNU General Public License, version 2.\ny", None, None),
        (25, "under the MIT License", None, None),
        (26, "\n\n" + licenses.TEMPLATES["ISC"] + "\n", None, None),
        (27, "released under the mit license. " * 40, None, None),
    ]
    return rows + rows[-6:-4]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_equals_brute_force(spark, threshold):
    rows = corpus()
    frame = edge.with_clashes(edge.documents(spark, rows))
    found = licenses.scan(frame, threshold=threshold)
    got = sorted((r.doc_id, r.license_id, round(r.dice, 9), r.n_parts) for r in found.collect())
    assert got == sorted(brute(rows, licenses.TEMPLATES, threshold))
    assert {r[0] for r in got} >= {20, 23, 26}
    assert (27 in {r[0] for r in got}) == (threshold < 8 / 9)


def test_empty_and_bad_template(spark):
    assert licenses.scan(edge.documents(spark, [])).count() == 0
    with pytest.raises(ValueError, match="two words"):
        licenses.scan(edge.documents(spark), {"x": "word"})


def test_bounds_hold_everything_that_can_match():
    for n in range(1, 200):
        low, high = licenses.size_bounds(n, 0.8)
        for m in range(1, 500):
            if 2 * min(n, m) / (n + m) >= 0.8:
                assert low <= m <= high


def test_no_python_and_no_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_main_licenses_are_found(spark):
    samples = {
        "BSD-3-Clause": licenses.TEMPLATES.get("BSD-3-Clause", "a b"),
        "GPL-2.0-header": "x\n\nThis program is free software; you can redistribute it and/or modify\n"
        "it under the terms of the GNU General Public License as published by\nthe Free Software "
        "Foundation; either version 2 of the License, or\n(at your option) any later version.\n\ny",
        "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, "
        "v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
        "CC-BY-SA-4.0-text": "a\nThis work is licensed under a Creative Commons Attribution-ShareAlike "
        "4.0 International License.\nb",
    }
    rows = [(i, text, None, None) for i, text in enumerate(samples.values())]
    best = {}
    for r in licenses.scan(edge.documents(spark, rows)).collect():
        best[r.doc_id] = max(best.get(r.doc_id, (0, "")), (r.dice, r.license_id))
    assert [best.get(i, (0, None))[1] for i in range(len(rows))] == list(samples)
    # the SQL puts the texts between single quotes
    assert not any("'" in text for text in licenses.TEMPLATES.values())
