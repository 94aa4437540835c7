"""The scan against all rules run over the whole joined words, without anchors and windows."""

import random
import re

from cotrend.llm import license_scan

from .test_license_scan import base, detections

def check(documents, texts):
    got = {r.doc_id: r for r in license_scan.scan(documents([(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        found, labels = detections(text), base(text)[2]
        assert sorted((d.start, d.end, d.rule, d.label, d.priority) for d in got[i].detections or []) == [d[:5] for d in found], text
        assert got[i].labels == sorted(set(labels) | {d[3] for d in found}), text
        assert got[i].score == max([d[5] for d in found] + [0.5 if labels else 0.0]), text


def test_every_name_is_found_without_a_license_word(documents):
    texts = [
        "Released under MPL 2.0.", "Simplified BSD", "available under the terms of EUPL-1.2", "wtfpl", "new BSD code", "CDDL 1.0", "GPLv2",
        "Licensed under the terms and conditions of the do what the fuck you want to public license",
        "epl 2.0 " + "word " * 40 + "licensed under the GPL 3.0 " + "word " * 40 + "osl 3.0",
    ]
    random.seed(4)
    for _, name, spdx in license_scan.known_licenses():
        spelled = sorted(license_scan.spellings(name))
        texts += ["under " + t for t in random.sample(spelled, min(4, len(spelled)))]
        texts.append(f"SPDX-License-Identifier: {spdx}")
    check(documents, texts)


def test_every_spelling_holds_an_anchor_of_its_rule():
    for (_, name, _), own in zip(license_scan.known_licenses(), license_scan.RULE_ANCHORS[-len(license_scan.known_licenses()) :]):
        for text in license_scan.spellings(name):
            assert re.fullmatch(name, text) and text.split() == text.split(" ") and set(own) & set(text.split())
    longest = "licensed under the terms and conditions of the creative commons attribution non commercial no derivatives international version 4 0"
    assert len(longest.split()) <= license_scan.REACH + 1


def test_every_place_of_a_rule_is_found(documents):
    random.seed(5)
    parts = "mit apache license licence general public gnu gpl version v2 2 3 0 under the licensed cc by nc bsd clause spdx identifier mpl".split()
    texts = ["mit license or mit license", "GNU GPL 2.0 and GNU GPL", "bsd 2 clause bsd license", "mit license " * 3000, None, ""]
    for gap in range(2 * license_scan.REACH - 1, 2 * license_scan.REACH + 4):
        texts.append(("gnu gpl 2.0 " + "word " * gap) * 3)
    for odds in (0, 0, 20, 60):
        words = parts + ["alpha"] * odds
        texts += [" ".join(random.choice(words) for _ in range(random.randint(1, 300))) for _ in range(15)]
    check(documents, texts)
    repeated = license_scan.scan(documents([(i, t, "en", "a") for i, t in enumerate(texts[:2])])).orderBy("doc_id").collect()
    assert [(d.start, d.end) for d in repeated[0].detections] == [(0, 2), (3, 5)]
    assert repeated[1].labels == ["gpl", "gpl-2.0"]
