"""Nearest neighbours of a stated query set by a block matrix join.

Queries and candidates are dealt into blocks of bounded size, and every pair of a query block with a candidate block is one
tile. Vectors are also held as 8-bit whole numbers with a scale; a tile multiplies these, which gives the distance of the
quantised vectors without rounding, and by the triangle inequality the true distance lies within the two quantisation
errors of it. The k-th smallest upper bound of a query, together with what its heap already holds, decides which pairs
survive; only those are computed again in double precision on the original vectors. Each query keeps a heap of its
k nearest; heaps of different candidate blocks are merged in rounds of bounded fan-in.

The result is exact: bounds only ever rule out pairs that cannot be among the k nearest.

Cases: a null id, a null vector, a zero vector, and vectors with null or non-finite components take no part; vectors of
different length do not meet; of rows that repeat an id the smallest vector counts; a query has its own id left out; ties
go to the smaller id; with fewer candidates than k all are returned; without candidates a query has no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import ship_package, stored

QUERIES_PER_BLOCK = 1024
CANDIDATES_PER_BLOCK = 8192
CANDIDATES_AT_ONCE = 2048
#: Heaps of so many candidate blocks are merged at once.
FAN_IN = 32
#: Dimensions of one exact product: sums of 8-bit products stay whole in single precision.
DIMENSIONS_AT_ONCE = 1024
#: Relative slack for rounding in the bounds themselves.
SLACK = 1e-9


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``vector`` (doubles) of the rows that take part, one per id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0.0)
    good = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & some)
    return good.groupBy("id").agg(F.min("vector").alias("vector"))


class Block:
    """Vectors of one block as doubles and as scaled 8-bit whole numbers."""

    def __init__(self, frame: pd.DataFrame):
        self.ids = frame["id"].to_numpy(np.int64)
        self.exact = np.array(frame["vector"].tolist(), np.float64)
        self.scale = np.abs(self.exact).max(axis=1) / 127.0
        scale = np.where(self.scale > 0, self.scale, 1.0)
        self.whole = np.rint(self.exact / scale[:, None]).astype(np.int8)
        rounded = self.whole * self.scale[:, None]
        self.error = np.sqrt(((self.exact - rounded) ** 2).sum(axis=1))
        self.square = (rounded**2).sum(axis=1)


def whole_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 8-bit rows as whole numbers, in parts that single precision holds exactly."""
    out = np.zeros((len(a), len(b)))
    for start in range(0, a.shape[1], DIMENSIONS_AT_ONCE):
        part = slice(start, start + DIMENSIONS_AT_ONCE)
        out += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return out


def distances(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed in the order of the components."""
    total = np.zeros(len(candidates))
    for d in range(len(query)):
        total += (candidates[:, d] - query[d]) ** 2
    return np.sqrt(total)


def search_tile(queries: Block, candidates: Block, k: int) -> list[list[tuple[float, int]]]:
    """The ``k`` nearest of each query in one tile, as sorted (distance, id)."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]  # of (-distance, -id): the worst on top
    for start in range(0, len(candidates.ids), CANDIDATES_AT_ONCE):
        part = slice(start, start + CANDIDATES_AT_ONCE)
        ids, exact, error = candidates.ids[part], candidates.exact[part], candidates.error[part]
        products = whole_products(queries.whole, candidates.whole[part])
        products *= queries.scale[:, None] * candidates.scale[part][None, :]
        squares = queries.square[:, None] + candidates.square[part][None, :] - 2 * products
        rough = np.sqrt(np.maximum(squares, 0))
        # rounding of the bound itself is far below this
        margin = queries.error[:, None] + error[None, :] + SLACK * (1 + np.sqrt(queries.square)[:, None] + rough)
        margin += np.sqrt(SLACK * SLACK * (queries.square[:, None] + candidates.square[part][None, :]))
        low, high = rough - margin, rough + margin
        own = queries.ids[:, None] == ids[None, :]
        low[own], high[own] = np.inf, np.inf
        enough = high.shape[1] >= k
        most = np.partition(high, k - 1, axis=1)[:, k - 1] if enough else np.full(len(queries.ids), np.inf)
        for i, heap in enumerate(heaps):
            worst = min(most[i], -heap[0][0]) if len(heap) == k else most[i]
            near = np.flatnonzero((low[i] <= worst) & ~own[i])
            if not len(near):
                continue
            found = distances(queries.exact[i], exact[near])
            best = np.lexsort((ids[near], found))[:k]
            for distance, own_id in zip(found[best].tolist(), ids[near][best].tolist()):
                item = (-distance, -own_id)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
    return [sorted((-d, -i) for d, i in heap) for heap in heaps]


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest of every query among all other rows.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stored(
        usable_vectors(vectors, id_col, vector_col).select("id", "vector", F.size("vector").alias("n"), is_query.alias("q")),
        "vectors",
    )
    counts = rows.agg(F.count("*").alias("all"), F.count_if("q").alias("queries")).first()
    query_blocks = max(1, -(-counts["queries"] // QUERIES_PER_BLOCK))
    candidate_blocks = max(1, -(-counts["all"] // CANDIDATES_PER_BLOCK))
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.where("q").select("id", "vector", "n", place(query_blocks, 1).alias("qb"))
    queries = queries.select("*", every(candidate_blocks).alias("cb"), F.lit(True).alias("asks"))
    candidates = rows.select("id", "vector", "n", place(candidate_blocks, 2).alias("cb"))
    candidates = candidates.select("*", every(query_blocks).alias("qb"), F.lit(False).alias("asks"))

    def tile(group: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int, float]] = []
        left, right = group[group["asks"]], group[~group["asks"]]
        if len(left) and len(right):
            qb, cb = int(left["qb"].iloc[0]), int(left["cb"].iloc[0])
            queries = Block(left)
            for query, heap in zip(queries.ids.tolist(), search_tile(queries, Block(right), k)):
                out += [(qb, cb // FAN_IN, query, i, d) for d, i in heap]
        return pd.DataFrame(out, columns=["qb", "part", "query_id", "vec_id", "score"])

    schema = "qb int, part int, query_id long, vec_id long, score double"
    found = queries.unionByName(candidates).groupBy("n", "qb", "cb").applyInPandas(tile, schema)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int, float]] = []
        qb, part = int(group["qb"].iloc[0]), int(group["part"].iloc[0])
        for query, own in group.groupby("query_id", sort=True):
            near = heapq.nsmallest(k, zip(own["score"].tolist(), own["vec_id"].tolist()))
            out += [(qb, part // FAN_IN, query, i, d) for d, i in near]
        return pd.DataFrame(out, columns=["qb", "part", "query_id", "vec_id", "score"])

    parts = -(-candidate_blocks // FAN_IN)
    found = found.groupBy("qb", "part").applyInPandas(merge, schema)
    while parts > 1:
        found = found.groupBy("qb", "part").applyInPandas(merge, schema)
        parts = -(-parts // FAN_IN)

    def number(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["query_id", "score", "vec_id"], kind="stable")
        rank = ordered.groupby("query_id").cumcount() + 1
        return ordered.assign(rank=rank)[["query_id", "rank", "vec_id", "score"]]

    return found.groupBy("qb").applyInPandas(number, "query_id long, rank int, vec_id long, score double")
