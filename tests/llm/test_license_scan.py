import random
import re

import pytest

from cotrend.llm import license_scan

from .conftest import WORDS

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words_of(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def base(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        found = [i for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
        places += found
        labels |= {label} if found else set()
    return len(words), sorted(places), sorted(labels)


RULES = [(rule, label, re.compile(expression), priority, worth) for rule, label, expression, priority, worth in license_scan.rules()]


def detections(text):
    """All matches of all rules over the whole joined words, then suppression, by loops."""
    joined, found = " ".join(words_of(text)), []
    for rule, label, expression, priority, worth in RULES:
        for m in expression.finditer(joined):
            first = joined[: m.start()].count(" ")
            found.append((first, first + m.group().count(" ") + 1, rule, label, priority, worth))
    order = sorted(found, key=lambda d: (d[0], -d[1], -d[4], d[2]))
    kept = [d for k, d in enumerate(order) if not any(e[1] >= d[1] and e[4] >= d[4] for e in order[:k])]
    return sorted(kept)


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License. And the mit\nlicense again; MIT-LICENSE",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License v2.1 or the general public licence",
    "SPDX-License-Identifier: BSD-3-Clause",
    "Licensed under CC BY-NC 4.0. All rights reserved.",
    "in the public domain, eula, copyright 2020",
    "mit lizenz und mit license", "license", "mit", "license mit license license", "général public license",
    "Apache License 1.1, Apache Software License", "creative commons attribution share alike 4.0 international",
    None, "", " \n", "!!! ...", "ſpdx İ", "mit license " * 3000,
]


@pytest.fixture(scope="module")
def texts():
    random.seed(9)
    parts = "mit apache license licence general public gnu gpl version 2 3 0 under the licensed released cc by nc bsd clause".split()
    return TEXTS + [" ".join(random.choice(parts + WORDS[:3]) for _ in range(random.randint(1, 60))) for _ in range(60)]


def test_against_loops(documents, texts):
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in license_scan.scan(documents(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(texts):
        n_words, places, labels = base(text)
        row = got[i]
        assert (row.n_words, sorted(row.base_places), row.base_labels) == (n_words, places, labels), text
        found = detections(text)
        assert sorted((d.start, d.end, d.rule, d.label, d.priority) for d in row.detections or []) == [d[:5] for d in found], text
        assert row.labels == sorted(set(labels) | {d[3] for d in found})
        assert row.score == max([d[5] for d in found] + [0.5 if labels else 0.0])


def test_suppression_keeps_the_most_telling(documents):
    rows = [(1, TEXTS[0], "en", "a"), (2, TEXTS[4], "en", "a"), (3, TEXTS[5], "en", "a")]
    got = {r.doc_id: r for r in license_scan.scan(documents(rows)).collect()}
    assert got[1].labels == ["apache", "apache-2.0"] and got[1].score == 0.95
    assert [d.label for d in got[1].detections] == ["apache-2.0"]
    assert got[2].labels == ["bsd-3-clause"] and got[2].score == 0.99
    assert got[3].labels == ["cc-by-nc-4.0", "proprietary"]


def test_rows_that_repeat_and_empty_table(documents):
    rows = [(1, TEXTS[0], "en", "a"), (1, TEXTS[0], "en", "a"), (1, "other", "en", "a"), (None, TEXTS[1], None, None)]
    got = license_scan.scan(documents(rows)).collect()
    assert sorted(len(r.labels) for r in got) == [0, 1, 2, 2]
    assert license_scan.scan(documents([])).collect() == []


def test_native_plan(spark):
    from cotrend.llm.queries import QUERIES

    result = QUERIES["op6_license_scan"](spark, "/root/testdata/sf0.001")
    text = result._jdf.queryExecution().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if x in text]
    assert len(license_scan.rules()) > 200
