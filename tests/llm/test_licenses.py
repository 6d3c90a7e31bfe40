"""License scans against edit distances of every template to every text, without index or band."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tallymart.llm import licenses
from tallymart.llm.license_texts import HEADERS, NOTICES, SPDX_IDS, TEMPLATES, TEXTS

T = licenses.Templates(TEMPLATES)
SHORT = licenses.Templates([t for t in TEMPLATES if len(licenses.TOKEN.findall(t[1])) <= 40])


def least_edits(template: list, words: list) -> tuple[int, int]:
    """(edits, words matched) of the best part of ``words``, by the whole table."""
    row = [(0, 0)] * (len(words) + 1)
    for wanted in template:
        here = [(row[0][0] + 1, row[0][1])]
        for at, word in enumerate(words):
            same = word == wanted
            here.append(min(
                (row[at][0] + (not same), row[at][1] - same),
                (row[at + 1][0] + 1, row[at + 1][1]),
                (here[at][0] + 1, here[at][1]),
            ))
        row = here
    edits, matched = min(row)
    return edits, -matched


def accepted(template: list, words: list) -> bool:
    least, most = licenses.edits_allowed(len(template))
    edits, matched = least_edits(template, words)
    return edits <= most and matched >= least


def tokens_of(text: str) -> list[str]:
    return licenses.TOKEN.findall(licenses.lowered(text))


def candidates(text: str) -> set[int]:
    """Templates that the winnowed index leads to and that align within the allowed edits."""
    tokens = tokens_of(text)
    numbers = np.array([SHORT.numbers.get(t, 0) for t in tokens], np.int64)
    found = set()
    for template, diagonals in SHORT.hits(numbers).items():
        least, most = SHORT.limits[template]
        for d in diagonals:
            edits, pairs = licenses.aligned(SHORT.words[template], numbers.tolist(), d - most, d + most)
            if edits <= most and len(pairs) >= least:
                found.add(template)
    return found


def test_alignment_is_the_least_edits():
    rng = random.Random(5)
    for _ in range(600):
        template = rng.choices(range(1, 6), k=rng.randrange(1, 9))
        words = rng.choices(range(6), k=rng.randrange(0, 14))
        edits, pairs = licenses.aligned(template, words, -len(template), len(words))
        if words:
            assert (edits, len(pairs)) == least_edits(template, words)
        assert all(template[r] == words[p] for r, p in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:], strict=False))


def test_winnowing_keeps_one_of_each_window():
    """No run of the guaranteed length is without a kept gram, and longer templates drop some."""
    fewer = 0
    for words, kept in zip(T.words, T.kept, strict=True):
        gram, window = licenses.gram_and_window(len(words))
        matched, edits = licenses.edits_allowed(len(words))
        assert gram + window - 1 == -(-matched // (edits + 1))
        grams = len(words) - gram + 1
        assert all(any(s <= p < s + window for p in kept) for s in range(grams - window + 1))
        fewer += len(kept) < grams
    assert fewer > 20
    assert licenses.winnowed([3, 1, 2, 1, 5], 2) == [1, 3] and licenses.winnowed([7], 4) == [0]


def test_no_text_within_the_edits_is_missed():
    """Random edits, as many as are allowed, at any place; the index must lead to the template."""
    rng = random.Random(6)
    for template, words in enumerate(SHORT.words):
        plain = [w for w, _ in sorted(SHORT.numbers.items(), key=lambda x: x[1])]
        tokens = [plain[w - 1] for w in words]
        for _ in range(12):
            made = list(tokens)
            for _ in range(rng.randrange(SHORT.limits[template][1] + 2)):
                at = rng.randrange(len(made) or 1)
                kind = rng.randrange(3)
                made[at : at + (kind < 2)] = [] if kind == 0 else [rng.choice(["new", rng.choice(plain)])]
            text = " ".join(["some", *made, "more"])
            if accepted(tokens, tokens_of(text)):
                assert template in candidates(text), text


def test_documents_against_full_alignment(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = licenses.scan(docs).collect()
    assert got
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    short = [(name, tokens_of(text)) for name, text in NOTICES]
    for r in docs.select("doc_id", "text").collect():
        tokens = tokens_of(r.text)
        full = set()
        if len(tokens) < 1500:
            full = {name for name, words in short if set(words) <= set(tokens) and accepted(words, tokens)}
        names = {f.license for f in by_doc.get(r.doc_id, [])}
        assert bool(names) >= bool(full)
        for f in by_doc.get(r.doc_id, []):
            span = tokens_of(r.text[f.start : f.end])
            sizes = [len(w) for w in map(tokens_of, (t for _, t in TEMPLATES)) if len(w) * f.coverage == f.matched]
            assert sizes and len(span) >= f.matched


@pytest.mark.parametrize("text, want", [
    ("Released under the GPL license.", []),
    ("Released under the BSD License.", []),
    ("Released under the Apache License.", []),
    ("Released under MIT License", ["MIT"]),
    ("Released under an MIT License", ["MIT"]),
    ("Licensed under CC BY-ND 4.0.", []),
    ("Licensed under CC BY-NC-ND 4.0.", []),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("Licensed under CC BY-NC 3.0.", ["CC-BY-NC"]),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL"]),
    ("This work is licensed under the GNU General Public License, version 1.", ["GPL"]),
    ("This work is licensed under the GNU General Public License, version 2.1.", ["GPL"]),
    ("This work is licensed under the GNU General Public License, version 2.0.", ["GPL-2.0"]),
    ("this work is hereby licensed under the GNU General Public License v 3", ["GPL-3.0"]),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: MIT AND more", ["MIT"]),
    ("SPDX-License-Identifier: LicenseRef-Own", []),
    ("All new rights reserved", ["all-rights-reserved"]), ("All rights are gone", []),
    ("released to the public under a licence of the author", []), ("", []), ("MIT", []),
])
def test_names(text, want):
    assert [f[0] for f in T.found(f"x {text} y")] == want


@pytest.mark.parametrize("name, text", TEMPLATES)
def test_each_template_is_itself(name, text):
    """Also where another differs by a word only: every near pair is told apart."""
    (find,) = T.found(f"# Header 17\n{text.upper()}\n\nint main() {{}}")
    assert find[:3] == (name, 1.0, len(tokens_of(text)))
    assert find[3] == 12 and find[4] <= 12 + len(text)


def test_longer_texts_with_edits():
    for name, text in HEADERS + TEXTS:
        words = text.split()
        every = 8
        telling = licenses.IDENTITY | {"2", "3", "2.1", "1", "0"}
        edited = [
            "changed" if k % every == 3 and not telling & set(tokens_of(w)) else w for k, w in enumerate(words)
        ]
        (find,) = T.found(" ".join(["/*", *edited, "*/"]))
        assert find[0] == name and 0.8 <= find[1] < 1
    assert len({name for name, _ in TEMPLATES}) > 25 and len(SPDX_IDS) == 24


def test_copies_and_spans():
    assert [f[0] for f in T.found("Released under the MIT License. " * 50)] == ["MIT"] * 50
    text = "X. This work is  licensed under the GNU\nLesser General Public License, version 3. Y"
    (find,) = T.found(text)
    assert find[0] == "LGPL-3.0" and find[1] == 1.0 and text[find[3] : find[4]].endswith("version 3")


def test_odd_rows(spark):
    rows = [(None, "Released under the MIT License.", 1), (1, None, 1), (1, "", 1),
            (2, "é " * 30000 + "all RIGHTS reserved", None), (2, "é " * 30000 + "all RIGHTS reserved", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = sorted(map(tuple, licenses.scan(docs).collect()), key=str)
    assert got == sorted([
        (None, "MIT", 1.0, 5, 0, 30),
        *[(2, "all-rights-reserved", 1.0, 3, 60000, 60019)] * 2,
    ], key=str)
    assert licenses.scan(docs.limit(0)).count() == 0
