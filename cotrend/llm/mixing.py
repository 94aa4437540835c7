"""Mixing sources to target weights with cube-method balanced sampling.

A source's target is a share of the wanted total by weight, but at most ``limit`` times its size; what is over goes to the
others by weight until none is above. A document of a source with target / size = r is taken floor(r) times, and
once more with probability p = r - floor(r). The extra copies are drawn by the cube method: the vector of probabilities
moves along directions that leave two totals of the source unchanged, its words and its documents, until all but
two documents are decided at 0 or 1. So the words taken come out near the target, not only on average.

Flights run in blocks of at most ``BLOCK`` documents of a source, in parallel; each leaves two documents or fewer
undecided, and as long documents fly first, these are short. They go to the next, much smaller round of blocks, until every source has one block; its last two, with
a dozen shorter documents, are the landing problem, and of all its outcomes the one nearest to the totals is taken.

Cases: a null text has size 0 and is never taken; empty documents likewise; a source may be null (last in order); a source
of size 0 has target 0; rows that repeat a doc_id are drawn one by one, in any order of equal rows; ties in the landing
go to the outcome that is first in binary order; an empty table gives an empty table; the seed decides all draws, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotrend.llm.common import SPACE, ship_package, stored

BLOCK = 4096
#: Decided documents that may change in a landing, of sizes spread evenly up to the longest open one.
COMPANIONS = 12
#: A probability this near to 0 or 1 is decided.
EDGE = 1e-9


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def weigh_sources(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """``source``, ``source_size`` with ``weight``: the weights in turn by code point of the source, null last.

    Ranks are counted per range of sources, so no task sees all of them.
    """
    ranged = stored(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranked")
    before, start = {}, 0
    for row in ranged.groupBy("part").count().orderBy("part").collect():  # one row per range
        before[row["part"]] = start
        start += row["count"]
    if not before:
        return sources.withColumn("weight", F.lit(0.0)).limit(0)
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("part")]
    turn = F.pmod(place + offset, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    return ranged.withColumn("weight", weight).drop("part")


def set_targets(weighed: DataFrame, share: float, limit: float) -> DataFrame:
    """``target`` for each source; only totals reach the driver, once per round of resharing."""
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    wanted, most = share * total, limit * F.col("source_size")
    level, n_full = 0.0, -1
    while True:  # the level only rises, so a source that is full stays full
        full = F.lit(level) * F.col("weight") > most
        row = weighed.agg(
            F.sum(F.when(full, most).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.count_if(full).alias("n"),
        ).first()
        if not row["weight"] or row["n"] == n_full:
            break
        level, n_full = (wanted - row["given"]) / row["weight"], row["n"]
    return weighed.withColumn("target", F.least(F.lit(level) * F.col("weight"), most))


def flight(size: np.ndarray, chance: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Move ``chance`` along the null space of (words, documents) until at most two entries are undecided.

    Three undecided entries at a time: two totals fix a direction that leaves both unchanged.
    """
    p = chance.tolist()
    x = (size / max(float(size.max()), 1.0)).tolist()
    held: list[int] = []
    for i in range(len(p)):
        if EDGE < p[i] < 1 - EDGE:
            held.append(i)
        else:
            p[i] = float(p[i] > 0.5)
        if len(held) < 3:
            continue
        a, b, c = held
        # orthogonal to the rows (x_a, x_b, x_c) and (1, 1, 1)
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
        if u == (0.0, 0.0, 0.0):  # equal sizes: any direction that keeps the number of documents
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[k]) / d if d > 0 else -p[k] / d for k, d in zip(held, u) if d)
        down = min(p[k] / d if d > 0 else (p[k] - 1) / d for k, d in zip(held, u) if d)
        # the chance of either end is such that the expectation stays; the draw depends on the seed and the document
        move = up if uniform(int(place[i]), p[c]) * (up + down) < down else -down
        for k, d in zip(held, u):
            p[k] += move * d
        left = []
        for k in held:
            if EDGE < p[k] < 1 - EDGE:
                left.append(k)
            else:
                p[k] = float(p[k] > 0.5)
        held = left
    return np.array(p)


def uniform(place: int, salt: float) -> float:
    """A number in [0, 1) from a document's place and the state it is met in."""
    h = (place ^ hash(salt) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)
    h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & ((1 << 64) - 1)
    return (h ^ h >> 32) / 2.0**64


def land(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Decide the last two entries or fewer, and let ``COMPANIONS`` decided ones change with them.

    Of all outcomes of these few entries the one nearest to their words and number before the landing is taken.
    """
    p = chance.copy()
    is_open = (p > EDGE) & (p < 1 - EDGE)
    if not is_open.any():
        return p
    shorter = np.flatnonzero(~is_open & (size <= size[is_open].max()))
    shorter = shorter[np.argsort(size[shorter], kind="stable")]
    spread = np.unique(np.linspace(0, len(shorter) - 1, COMPANIONS).astype(int)) if len(shorter) else []
    own = np.concatenate([np.flatnonzero(is_open), shorter[spread]]).astype(int)
    outcomes = (np.arange(1 << len(own))[:, None] >> np.arange(len(own)) & 1).astype(float)
    words = np.abs(outcomes @ size[own] - size[own] @ p[own]) / max(size[own].mean(), 1.0)
    number = np.abs(outcomes.sum(1) - p[own].sum())
    p[own] = outcomes[np.argmin(words + 0.1 * number)]
    return p


def draw_extra(rows: DataFrame, seed: int, key: tuple[str, ...] = ()) -> DataFrame:
    """``chance`` decided to 0 or 1: rows of ``doc_id``, ``source``, ``size``, ``chance``, balanced within each source.

    The columns in ``key``, whole numbers, come along.
    """
    spark = rows.sparkSession
    ship_package(spark)
    own = list(key)
    schema = "doc_id long, source string, size long, chance double, place long" + "".join(f", `{k}` long" for k in own)
    place = F.xxhash64("doc_id", "size", F.lit(seed)).alias("place")
    undecided = rows.select("doc_id", "source", "size", "chance", place, *own)
    decided: list[DataFrame] = []
    while True:
        sizes = undecided.groupBy(F.col("source").alias("of")).agg(F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") / BLOCK)
        last = not sizes.where(F.col("n") > BLOCK).limit(1).count()
        dealt = undecided.join(sizes, F.col("source").eqNullSafe(F.col("of"))).select(
            *undecided.columns, F.pmod(F.xxhash64("place", F.lit(len(decided))), blocks).alias("block")
        )

        def fly(group: pd.DataFrame) -> pd.DataFrame:
            # long documents first: what stays open for the landing is short
            group = group.sort_values(["size", "place", "doc_id"], ascending=False, kind="stable")
            size = group["size"].to_numpy(float)
            p = flight(size, group["chance"].to_numpy(float), group["place"].to_numpy())
            return group.drop(columns="block").assign(chance=land(size, p) if last else p)

        flown = stored(dealt.groupBy("source", "block").applyInPandas(fly, schema), "flight")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        decided.append(flown.where(~open_))
        undecided = flown.where(open_)
        if last:
            break
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "source", "size", F.col("chance").cast("long").alias("extra"), *own)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    seed: int = 17,
    key: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` (words, repeats counted).

    ``key`` names columns of whole numbers that tell rows apart where ``doc_id`` does not; they come last in the result.
    """
    own = list(key)
    sized = stored(docs.select(F.col("doc_id").cast("long"), "source", size_of(F.col("text")).alias("size"), *own), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(set_targets(weigh_sources(sources, weights), share, limit), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = targets.select(F.col("source").alias("of"), "source_size", "target", ratio.alias("ratio"))
    met = sized.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    whole = F.floor(F.col("ratio") + EDGE)
    chance = F.greatest(F.col("ratio") - whole, F.lit(0.0))
    none = chance <= EDGE
    sure = met.where(none | (F.col("size") == 0))
    drawn = draw_extra(met.where(~none & (F.col("size") > 0)).withColumn("chance", chance), seed, key)
    numbers = drawn.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    every = sure.withColumn("extra", F.lit(0).cast("long")).unionByName(numbers)
    copies = F.when(F.col("size") > 0, whole + F.col("extra")).otherwise(F.lit(0)).cast("long")
    return every.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * copies).alias("taken"), *own
    )
