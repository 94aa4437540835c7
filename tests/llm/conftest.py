from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture
def documents(spark):
    """A function that makes a documents table from (doc_id, text, lang, source) and columns with clashing names."""

    def make(rows, clash=True):
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
        if clash:
            for name in ("score", "ids", "n", "key", "row", "stats", "hash", "size", "copies", "block", "words", "digest", "_word", "_row", "_stat_chars", "_file", "_at"):
                df = df.selectExpr("*", f"'x' as `{name}`")
        return df.repartition(3)

    return make


def table_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
