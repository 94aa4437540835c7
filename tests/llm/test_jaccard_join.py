import random

import numpy as np
import pytest

from cotrend.llm import jaccard_join
from cotrend.llm.components import components

from .conftest import WORDS


def shingles(text, words):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     ")
    w = [x for x in (text or "").translate(table).split(" ") if x]
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t, *_ in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, *_) in enumerate(rows))


def edited(words, share):
    return " ".join(random.choice(WORDS) + "x" if random.random() < share else w for w in words)


def make(seed, n=60):
    random.seed(seed)
    text = lambda k: [f"{random.choice(WORDS)}{random.randint(0, 40)}" for _ in range(k)]
    rows = [(1000 - i, " ".join(text(random.randint(0, 60))), "en", "a") for i in range(n)]
    base, passage = text(80), text(30)
    rows += [(2000 + i, edited(base, random.choice([0, 0.005, 0.01, 0.02, 0.05])), "en", "hot") for i in range(n)]
    rows += [(3000 + i, " ".join(passage + text(10 + i)), "en", "hot") for i in range(n)]  # a passage all share
    rows += [(4000 + i, "The  SAME\tfour words\nagain", "en", None) for i in range(n)]
    rows += [(5000, None, None, None), (5001, "", "en", "a"), (5002, " \n", "en", "a"), (5003, "one", "x", "x"), (5004, "One ", "x", "x")]
    rows += [(5005, "one two three", "x", "x"), (5006, "one two three four", "x", "x"), (5007, edited(base, 0), "x", "x")]
    rows += [(5007, "a row of the same id with another text of its own", "x", "x"), (5008, " ".join(text(20_000)), "x", "x")]
    return rows


def result(df, words, percent):
    found = jaccard_join.similar_groups(df, words, percent)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())


@pytest.mark.parametrize(("words", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_against_brute_force(documents, words, percent, seed):
    rows = make(seed)
    assert result(documents(rows), words, percent) == brute(rows, words, percent)


def test_small_tiles_buckets_and_slices(documents, monkeypatch):
    """Large buckets in many tiles, nothing frequent, several slices, few groups: the same result."""
    for name, value in (("TILE", 8), ("LEAF", 3), ("SMALL_BUCKET", 2), ("HASHES_PER_SLICE", 50), ("FREQUENT", 10**6), ("LEAST_GROUPS", 2)):
        monkeypatch.setattr(jaccard_join, name, value)
    monkeypatch.setattr(jaccard_join, "MOST_GROUPS", 16)
    rows = make(4, 40)
    assert result(documents(rows), 4, 85) == brute(rows, 4, 85)


def test_everything_frequent(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 0)
    monkeypatch.setattr(jaccard_join, "OVER_MEAN", 0)
    rows = make(5, 40)
    assert result(documents(rows), 4, 85) == brute(rows, 4, 85)


def test_empty_tables(documents):
    assert result(documents([]), 4, 85) == []
    assert result(documents([(7, None, None, None)]), 4, 85) == [(7, 0, 7)]


def test_bound_is_never_below_the_overlap():
    random_ = np.random.default_rng(1)
    for n in (1, 40, 300, 3000):
        x = np.unique(random_.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], random_.integers(0, 1 << 63, n).astype(np.uint64)]))
        a, b = (jaccard_join.counts_of(jaccard_join.group_counts(s)) for s in (x, y))
        assert a.sum() == len(x) and b.sum() == len(y)
        groups = min(len(a), len(b))
        bound = np.minimum(jaccard_join.folded(a, groups), jaccard_join.folded(b, groups)).sum()
        assert len(np.intersect1d(x, y)) <= bound
    same_group = (np.arange(1, 400, dtype=np.uint64) << np.uint64(40)) + np.uint64(3)
    assert jaccard_join.counts_of(jaccard_join.group_counts(same_group)).sum() == 399


def test_r_tree_finds_what_a_full_search_finds():
    random_ = np.random.default_rng(2)
    points = random_.poisson(2, (150, 32)).astype(np.uint8)
    points[60:] = points[random_.integers(0, 20, 90)] + (random_.random((90, 32)) < 0.05)
    n = points.sum(axis=1).astype(np.int64)
    side = np.zeros(150, int)
    a, b, _ = jaccard_join.tile_survivors(n, points, side, 85)
    full = {
        (i, j)
        for j in range(150)
        for i in range(j)
        if np.minimum(points[i], points[j]).sum() >= jaccard_join.needed(n[i], n[j], 85) and 100 * min(n[i], n[j]) >= 85 * max(n[i], n[j])
    }
    assert set(zip(a.tolist(), b.tolist())) == full and len(full) > 50


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(1, i) for i in range(2, 60)]
    edges = spark.createDataFrame(chain + star + [(7, 7), (59, 1), (500, 400)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 1 for i in range(1, 60)}, 400: 400, 500: 400}
    assert components(edges.where("false")).collect() == []
