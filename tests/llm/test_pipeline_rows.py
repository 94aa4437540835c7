"""Rows whose doc_id is null or repeated go through the stages of the pipeline one by one."""

import random
from collections import Counter, defaultdict

import corpus_pipeline as pipeline

from .conftest import WORDS
from .test_mixing import targets


def test_mix_takes_rows_one_by_one(spark, documents):
    random.seed(3)
    rows = []
    for n in range(300):
        doc_id = None if n % 3 == 0 else 7 if n % 3 == 1 else n
        # the source and the first word tell the row
        rows.append((doc_id, " ".join([f"row{n}", *random.choices(WORDS, k=random.randint(5, 30))]), "en", random.choice("abc")))
    mixed = pipeline.mix_sources(spark, documents(rows), "").collect()
    per_source, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source in rows:
        per_source[source] += len(text.split())
    for r in mixed:
        taken[r.source] += len(r.text.split())
    for source, target in targets(per_source).items():
        assert abs(taken[source] - target) <= max(5, 0.02 * target)
    copies = Counter(r.text for r in mixed)
    assert max(copies.values()) <= 2
    known = {t: (i, s) for i, t, _, s in rows}
    assert all(known[r.text] == (r.doc_id, r.source) for r in mixed)


def test_near_copies_are_dropped_row_by_row(spark, documents):
    random.seed(6)
    text = [" ".join(random.choices(WORDS, k=60)) for _ in range(8)]
    rows = [
        (1, text[0], "en", "a"), (2, text[0] + " more", "en", "a"), (2, text[1], "en", "a"),  # the other text of 2 is unlike any
        (None, text[1], "en", "b"), (None, text[2], "en", "a"), (None, text[2] + " more", "en", "a"), (None, text[3], "en", "a"),
        (5, text[4], "en", "a"), (5, text[4], "en", "a"), (5, text[4] + " more", "en", "a"), (6, "", "en", "a"), (None, None, "en", "a"),
    ]
    near = [(r.doc_id, r.text) for r in pipeline.drop_near_copies(spark, documents(rows), "").collect()]
    first = [(i, t) for i, t in near if t and t.startswith(text[2])]
    fifth = [t for i, t in near if i == 5]
    assert len(first) == 1 and len(fifth) == 1 and fifth[0].startswith(text[4])
    others = [x for x in near if x not in first and x[0] != 5]
    assert sorted(others, key=repr) == sorted([(1, text[0]), (2, text[1]), (None, text[3]), (6, ""), (None, None)], key=repr)
