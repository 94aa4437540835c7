import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cotrend.llm import block_search


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, step, k):
    vectors = {}
    for i, v in rows:
        if i is not None and usable(v):
            vectors[i] = min(v, vectors.get(i, v))
    out = []
    for q, a in vectors.items():
        if q % step:
            continue
        near = sorted((math.sqrt(sum_in_order(a, b)), i) for i, b in vectors.items() if i != q and len(a) == len(b))
        out += [(q, r, i, d) for r, (d, i) in enumerate(near[:k], 1)]
    return sorted(out)


def sum_in_order(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += (y - x) * (y - x)
    return total


def result(spark, rows, step, k):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("n", F.lit(0))
    found = block_search.nearest(df, F.col("id") % step == 0, k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def make(n, d, seed):
    values = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    common = rows[5][1]
    rows += [(n + i, common) for i in range(60)]  # many equal vectors
    rows += [(2000, None), (2001, [0.0] * d), (2002, [None] * d), (2003, [float("nan")] * d), (2004, [float("inf")] * d)]
    rows += [(None, common), (10, common), (2005, [1.0] * (d + 1)), (2010, [2.0] * (d + 1)), (2006, [])]
    return rows


@pytest.mark.parametrize("blocks", [(1024, 8192, 2048, 32), (7, 30, 11, 2)])
def test_against_brute_force(spark, monkeypatch, blocks):
    names = ("QUERIES_PER_BLOCK", "CANDIDATES_PER_BLOCK", "CANDIDATES_AT_ONCE", "FAN_IN")
    for name, value in zip(names, blocks):
        monkeypatch.setattr(block_search, name, value)
    rows = make(300, 12, 1)
    assert result(spark, rows, 5, 10) == brute(rows, 5, 10)


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, [0.5, 2.0])]
    assert result(spark, rows, 2, 10) == brute(rows, 2, 10)
    assert result(spark, rows[:1], 2, 10) == [] and result(spark, [], 2, 10) == []


def test_bounds_hold_and_products_are_whole():
    import pandas as pd

    values = np.random.default_rng(2).normal(size=(40, 2100)) * np.geomspace(1e-6, 1e6, 40)[:, None]
    block = block_search.Block(pd.DataFrame({"id": range(40), "vector": list(values)}))
    products = block_search.whole_products(block.whole, block.whole)
    assert (products == block.whole.astype(np.int64) @ block.whole.astype(np.int64).T).all()
    rounded = block.whole * block.scale[:, None]
    for i in range(40):
        true, rough = block_search.distances(values[i], values), block_search.distances(rounded[i], rounded)
        assert (np.abs(true - rough) <= block.error[i] + block.error + 1e-9 * (1 + true)).all()
