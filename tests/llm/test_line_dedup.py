import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from cotrend.llm import line_dedup

from .conftest import WORDS


def brute(rows, least):
    """(doc_id, n_lines, n_dropped, text) for each row."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    docs = defaultdict(set)
    for row, (doc_id, text, *_) in enumerate(rows):
        for line in (text or "").split("\n"):
            docs[key(line)].add(("row", row) if doc_id is None else doc_id)
    common = {k for k, ids in docs.items() if k and len(ids) >= least}
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key(line) not in common]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df, least, **options):
    kept = line_dedup.drop_repeated_lines(df, least, **options)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in kept.collect()), key=repr)


ROWS = [
    (1, "Same line\nown one\n", "en", "a"),
    (2, " same LINE\t\r\nother", "en", "a"),
    (3, "SAME line", "en", None),
    (4, "x\nx\nx\nx", "en", "a"),  # four times in one document
    (5, None, None, None),
    (6, "", "en", "a"),
    (7, "\n\n \n", "en", "a"),
    (8, "Éa\nunique", "en", "a"),
    (9, "éa", "en", "a"),  # only A-Z is lower-cased
    (3, "x", "en", None),  # rows of one doc_id are one document
    (1, "Same line\nown one\n", "en", "a"),
]


@pytest.mark.parametrize("least", [2, 3, 10])
def test_against_brute_force(documents, least):
    assert result(documents(ROWS), least) == brute(ROWS, least)


def test_random_lines(documents):
    random.seed(3)
    rows = [(i, "\n".join(random.choice(WORDS) + " " * random.randint(0, 2) for _ in range(random.randint(0, 9))), "en", "a") for i in range(150)]
    rows += [(1000 + i, "hot line\n" + WORDS[i % 7].upper(), "en", "a") for i in range(80)]
    rows.append((5000, "long\n" * 30_000 + "hot line", "en", "a"))
    assert result(documents(rows), 10) == brute(rows, 10)


@pytest.mark.parametrize("known, unknown, shared", [(10, 2, True), (9, 1, True), (8, 1, False), (0, 10, True), (0, 9, False)])
def test_rows_without_a_doc_id_are_documents_of_their_own(documents, spark, tmp_path, known, unknown, shared):
    rows = [(i, f"Shared\nown {i}", "en", "a") for i in range(known)] + [(None, f"shared \nnull {i}", "en", "a") for i in range(unknown)]
    rows += [(50, "x", "en", "a"), (50, "x\ny", "en", "b"), (None, None, None, None), (None, "", "en", "a")]
    docs = documents(rows)
    found = result(docs, 10)
    assert found == brute(rows, 10)
    assert any(n for _, _, n, _ in found) == shared
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    from cotrend.llm.queries import QUERIES, SQL

    ours = QUERIES["op5_line_dedup"](spark, str(tmp_path))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert sorted(map(tuple, ours.collect()), key=repr) == sorted(db.sql(SQL["op5_line_dedup"]).fetchall(), key=repr)


def test_full_filters_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "LINES_PER_SLICE", 2)
    monkeypatch.setattr(line_dedup, "BITS_PER_LINE", 4)
    assert result(documents(ROWS), 2) == brute(ROWS, 2)


def test_first_occurrence_may_stay(documents):
    got = {(d, t) for d, _, _, t in result(documents(ROWS[:4], clash=False), 3, keep_first=True)}
    assert (1, "Same line\nown one\n") in got and (2, "other") in got and (3, "") in got


def test_empty_table_and_long_null(documents):
    assert result(documents([]), 2) == []
    assert result(documents([(1, None, None, None)]), 2) == [(1, 1, 0, "")]
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(documents(ROWS), 1)


def test_bloom_has_no_false_negatives():
    random_hashes = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    bloom = line_dedup.Bloom(12)
    bloom.add(random_hashes)
    assert bloom.holds(random_hashes).all()
    wide = line_dedup.Bloom(18)
    wide.add(random_hashes)
    others = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    assert wide.holds(others).mean() < 0.01


def test_query_digest(spark):
    from cotrend.llm.queries import QUERIES

    row = QUERIES["op5_line_dedup"](spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    assert row.n_lines >= row.n_dropped and len(row.kept_sha256) == len(hashlib.sha256(b"").hexdigest())
