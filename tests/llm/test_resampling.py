import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cotrend.llm import resampling

from .conftest import WORDS, table_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def brute(docs, target, percent=25, least=20, seed=7):
    """``doc_id, n_features, weight, score, rank`` as the contract says."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s += counts_of(text)[1]
    for text in target:
        t += counts_of(text)[1]
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000))))
    out = []
    for i, text in docs:
        n_words, counts = counts_of(text)
        n = sum(counts.values())
        weight = sum(gain(b) * c for b, c in counts.items()) // n if n else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    order = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(order[: percent * len(order) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def result(documents, spark, docs, target, **more):
    table = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    drawn = resampling.resample(documents([(i, t, "en", "a") for i, t in docs]), table, **more)
    return table_of(drawn.select("doc_id", "n_features", "weight", "score", "rank"))


def make(n):
    random.seed(n)
    parts = WORDS + ["Alpha", "x1", "é", "ſ", "don't", "--", "\x00", "日本 語", "w" * 60, "v" * 49, "u" * 48, "\n"]
    docs = [(i, " ".join(random.choice(parts) for _ in range(random.randint(0, 90)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " .\n"), (None, docs[0][1]), (None, None), (3, docs[5][1]), (3, docs[3][1])]
    docs += [(n + 3, "the same " * 4000), (n + 4, "y" * 5000), (n + 5, "a " + "z" * 3000 + " b " + "z" * 3000)]
    return docs, [" ".join(random.choice(parts) for _ in range(40)) for _ in range(12)] + [None, "", "w" * 60]


def test_against_loops(documents, spark):
    docs, target = make(60)
    assert result(documents, spark, docs, target) == brute(docs, target)


@pytest.mark.parametrize("part_bytes", [1, 5, 16, 64, 1 << 20])
def test_parts_of_long_texts_count_the_same(monkeypatch, part_bytes):
    monkeypatch.setattr(resampling, "PART_BYTES", part_bytes)
    texts = [t or "" for _, t in make(15)[0]] + ["ab" * 40 + " c", "  ..  x", "x  .. "]
    for batch in (texts, [], [""], ["", "a", ""]):
        found = [(0, Counter())] * len(batch)
        column = pa.record_batch([pa.array(batch, pa.string())], ["text"])
        for run, words, rows, buckets, counts in resampling.counts_of_texts(column):
            for place in range(run.start, run.stop):
                own = rows == place - run.start
                found[place] = (words[place - run.start], Counter(dict(zip(buckets[own].tolist(), counts[own].tolist()))))
        assert found == [counts_of(t) for t in batch]


def test_planes_hold_the_counts_and_sums_are_exact():
    rng = np.random.default_rng(1)
    gains = rng.integers(-9000, 9000, resampling.BUCKETS)
    gains[:5] = 0
    dense = rng.integers(0, 4, (7, resampling.BUCKETS)) * rng.integers(0, 70_000, (7, resampling.BUCKETS)) * (rng.random((7, resampling.BUCKETS)) < 0.1)
    dense[3] = 0
    texts, buckets = np.nonzero(dense)
    values = dense[texts, buckets]
    rebuilt = np.zeros_like(dense)
    for k, own, planes in resampling.bit_planes(texts, buckets, values):
        bits = np.unpackbits(planes.view(np.uint8), axis=1, bitorder="little")[:, : resampling.BUCKETS].astype(np.int64)
        rebuilt[own] += bits << k
    assert (rebuilt == dense).all()
    sums = resampling.gain_sums(7, texts, buckets, values, resampling.signed_planes(gains))
    assert sums.tolist() == (dense @ gains).tolist()


def test_one_doc_id_in_a_third_of_all_rows(documents, spark):
    text = "alpha beta " * 15
    docs = [(7, text)] * 200 + [(i, text) for i in range(100, 300)] + [(None, text)] * 200
    assert result(documents, spark, docs, ["alpha"], percent=60) == brute(docs, ["alpha"], percent=60)


def test_empty_tables(documents, spark):
    docs, target = make(10)
    assert result(documents, spark, [], target) == []
    assert result(documents, spark, docs, []) == brute(docs, [])
    few = [(1, "alpha " * 19), (2, None)]
    assert result(documents, spark, few, target) == brute(few, target)
    assert result(documents, spark, few, target, percent=100, least_words=0) == brute(few, target, percent=100, least=0)


def test_more_rows_of_the_target_raise_the_weight(documents, spark):
    docs = [(1, "alpha beta gamma " * 10), (2, "pi rho sigma " * 10)]
    rows = {r[0]: r[2] for r in result(documents, spark, docs, ["alpha beta gamma"] * 50)}
    assert rows[1] > rows[2]
