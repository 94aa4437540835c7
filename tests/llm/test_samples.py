"""What reaches the driver for training is bounded in rows, also when one doc_id has most of them."""

import numpy as np

from cotrend.llm import language, quality

from .conftest import WORDS


def crowded(n=400):
    return [(7, f"row number {i} {WORDS[i % len(WORDS)]}", "en", "a") for i in range(n)] + [
        (100 + i, f"text {i} {WORDS[i % len(WORDS)]}", "de" if i % 2 else "en", "a") for i in range(40)
    ]


def test_quality_learns_from_one_text_for_each_label(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_rules", lambda x, y, names, seed: seen.append(x.shape[0]))
    labels = spark.createDataFrame([(7, 1), (7, 1)] + [(100 + i, i % 2) for i in range(40)], "doc_id long, quality int")
    quality.fit(documents(crowded()).select("doc_id", "text"), labels, sample_rows=50)
    quality.fit(documents(crowded()).select("doc_id", "text"), labels, sample_rows=10)
    assert seen == [41, 10]


def test_language_learns_from_one_text_for_each_pair(documents, monkeypatch):
    seen = []

    def descend(inputs, target, learned, n_languages, *rest):
        seen.append(len(inputs))
        return np.zeros((1 << language.TABLE_BITS, 1), np.float32), np.zeros((1, n_languages), np.float32), np.zeros(n_languages)

    monkeypatch.setattr(language, "descend", descend)
    language.fit(documents(crowded()).select("doc_id", "text", "lang"), sample_rows=2400)
    assert seen == [41]
