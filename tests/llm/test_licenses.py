"""License scans against all stretches in plain Python."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from demandmill.llm import licenses
from demandmill.llm.license_texts import TEMPLATES

SMALL = {
    "a": "released under the mit license",
    "b": "permission is granted to any person to use the software and the software only",
}


def brute(text, templates, threshold=0.8):
    """Every stretch of words against every template: (template, best score), none under the threshold."""
    words = licenses.normalised(text)
    grams = list(zip(words, words[1:]))
    out = {}
    for name, body in templates.items():
        tw = licenses.normalised(body)
        own = Counter(zip(tw, tw[1:]))
        n = sum(own.values())
        best = 0
        for i in range(len(grams)):
            for j in range(i + 1, len(grams) + 1):
                shared = sum((Counter(grams[i:j]) & own).values())
                best = max(best, 2 * shared / (n + j - i))
        if best >= threshold - 1e-12:
            out[name] = best
    return out


def best_of(matches):
    out = {}
    for name, score, *_ in matches:
        out[name] = max(out.get(name, 0), score)
    return out


def test_against_all_stretches():
    rng = random.Random(2)
    scan = licenses.Templates(SMALL)
    words = sorted({w for t in SMALL.values() for w in t.split()}) + ["x", "y", "Licence"]
    for _ in range(150):
        text = rng.choices(words, k=rng.randint(0, 8))
        for _ in range(rng.randint(0, 2)):
            body = rng.choice(list(SMALL.values())).split()
            for _ in range(rng.randint(0, 3)):
                body[rng.randrange(len(body))] = rng.choice(words)
            text += body + rng.choices(words, k=rng.randint(0, 6))
        text = " ".join(text)
        got, want = best_of(scan.matches(text)), brute(text, SMALL)
        assert got.keys() == want.keys(), text
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want), text


def test_every_template_finds_itself():
    scan = licenses.Templates(TEMPLATES)
    for name, text in TEMPLATES.items():
        noisy = "Some words first.\n" + re.sub(r"\s+", "\n * ", text.upper()) + "\nand words after"
        assert max(s for n, s, *_ in scan.matches(noisy) if n == name) > 0.999 or "NC" in name


def test_two_notices_are_two_matches():
    text = "Released under the MIT License. foo bar Released under the MIT Licence."
    found = licenses.Templates(TEMPLATES).matches(text)
    assert [(n, a, b) for n, _, a, b in found] == [("MIT-notice", 0, 5), ("MIT-notice", 7, 12)]


def test_documents_hold_their_lines(documents):
    """Every planted line is found, and nothing in texts without the word license or licensed."""
    for r in licenses.scan_licenses(documents).collect():
        names = {m["template"] for m in r.licenses}
        for name, line in TEMPLATES.items():
            if name.endswith("notice") and line in r.text:
                assert name in names
        if "licens" not in r.text.lower():
            assert not names


def test_neighbouring_licences_are_told_apart():
    """The best template of every notice, header and text is its own family and version."""
    scan = licenses.Templates(TEMPLATES)
    lgpl = """This library is free software; you can redistribute it and/or modify it under the terms of the
        GNU Lesser General Public License as published by the Free Software Foundation; either version {} of
        the License, or (at your option) any later version. This library is distributed in the hope that it
        will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."""
    gpl = lgpl.replace("Lesser ", "").replace("library", "program")
    mpl = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    texts = [
        ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
        ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
        ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
        ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
        ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
        ("GPL-2.0", gpl.format("2")), ("GPL-3.0", gpl.format("3")),
        ("LGPL-2.1", lgpl.format("2.1")), ("LGPL-3.0", lgpl.format("3")),
        ("LGPL-3.0", lgpl.format("3").replace("library", "program")),
        ("AGPL-3.0", gpl.format("3").replace("GNU", "GNU Affero")),
        ("MPL-2.0", mpl),
    ]
    texts += [(n, t) for n, t in TEMPLATES.items() if not n.endswith(("header", "notice"))]
    for want, text in texts:
        best = max(scan.matches(f"words before {text} and after"), key=lambda m: m[1])
        assert best[0] in (want, f"{want}-header", f"{want}-library-header", f"{want}-notice"), (want, best)


def test_frames(docs_of):
    rows = [(1, None), (2, ""), (3, "word"), (4, "x " * 100_000), (None, TEMPLATES["MIT"]), (5, "a b"), (5, "a b")]
    df = docs_of(rows).withColumn("licenses", F.lit("clash"))
    out = {r.doc_id: r.licenses for r in licenses.scan_licenses(df).collect()}
    assert [m["template"] for m in out[None]] == ["MIT"]
    assert all(not out[i] for i in (1, 2, 3, 4, 5))
    assert licenses.scan_licenses(docs_of([])).count() == 0
