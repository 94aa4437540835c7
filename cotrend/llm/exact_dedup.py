"""Exact dedup of batches against immutable snapshots, screened by static binary-fuse filters.

A snapshot holds one row per different text: its digest, the smallest doc_id and the number of rows. It is dealt by digest into buckets; each bucket has a binary-fuse filter of its digests, built
once, as the bucket never changes (9 bits a text, about 0.4 % false positives, no false negatives).

A batch is grouped by digest first, so a text that half of the batch repeats is one row per task from there on. The
different digests meet the filter of their bucket: what it does not hold is new. Positives join the exact buckets, where
their bytes are compared. Copies inside the batch are grouped on their own, by digest and bytes.

Only texts of digests with a second row move for byte checks; of those with one row no text is shuffled twice. Two texts
with one digest (none is known for SHA-256) stay apart: a class is a digest and its bytes.

Cases: null and empty texts are equal, and equal to nothing else; texts that differ only in their white-space runs are
equal; rows that repeat a doc_id count as rows of their group; of equal texts the smallest doc_id stays, and of several
rows with it all of them are marked as kept; an empty batch or snapshot gives an empty result or screens nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import SPACE, screen_bits, ship_package, stored

TEXTS_PER_BUCKET = 1 << 18


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit keys mixed with a seed."""
    x = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class FuseFilter:
    """Static binary-fuse filter with 8-bit fingerprints.

    A key has one place in each of three neighbouring segments; the exclusive or of what lies there is its fingerprint.
    """

    def __init__(self, seed: int, segment: int, cells: np.ndarray):
        self.seed, self.segment, self.cells = seed, segment, cells

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(keys, seed)
        starts = np.uint64(cells // segment - 2)
        first = ((h >> np.uint64(40)) * starts) >> np.uint64(24)
        mask = np.uint64(segment - 1)
        out = np.empty((3, len(keys)), np.int64)
        for k, shift in enumerate((0, 13, 27)):
            out[k] = ((first + np.uint64(k)) * np.uint64(segment) + ((h >> np.uint64(shift)) & mask)).astype(np.int64)
        return out, (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peel places that one key alone holds, in rounds, then fill them in reverse; a new seed if some keys remain."""
        keys = np.unique(keys)
        segment = 1 << max(2, int(np.log(max(len(keys), 1)) / np.log(3.33) + 2.25))
        ratio = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(len(keys), 2)))
        segments = max(3, int(np.ceil(len(keys) * ratio / segment)) + 2)
        for seed in range(1, 200):
            cells = np.zeros(segments * segment, np.uint8)
            at, prints = cls.places(keys, seed, segment, len(cells))
            load = np.bincount(at.ravel(), minlength=len(cells))
            sums = np.zeros(len(cells), np.int64)
            for row in at:
                np.add.at(sums, row, np.arange(len(keys)))
            rounds, left = [], len(keys)
            while left:
                alone = np.flatnonzero(load == 1)
                if not len(alone):
                    break
                owner, pick = np.unique(sums[alone], return_index=True)
                rounds.append((owner, alone[pick]))
                for row in at[:, owner]:
                    np.subtract.at(load, row, 1)
                    np.subtract.at(sums, row, owner)
                left -= len(owner)
            if left:
                segments += 1 + segments // 50
                continue
            for owner, place in reversed(rounds):
                cells[place] = 0
                value = prints[owner]
                for row in at[:, owner]:
                    value = value ^ cells[row]
                cells[place] = value
            return cls(seed, segment, cells)
        raise RuntimeError("no seed peels the keys")

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at, prints = self.places(keys, self.seed, self.segment, len(self.cells))
        return (self.cells[at[0]] ^ self.cells[at[1]] ^ self.cells[at[2]]) == prints


def keys_of(digests: pd.Series) -> np.ndarray:
    """The first 8 bytes of each digest."""
    return np.frombuffer(b"".join(d[:8] for d in digests), np.uint64)


def bucket_of(digests: Column, buckets: int) -> Column:
    """Bucket by the last bytes, which the filters do not use."""
    return F.pmod(F.conv(F.hex(F.substring(digests, 25, 7)), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def build_filters(snapshot: DataFrame) -> DataFrame:
    """``bucket``, ``seed``, ``segment``, ``cells``: one filter for each bucket of the snapshot."""
    ship_package(snapshot.sparkSession)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        built = FuseFilter.build(keys_of(group["digest"]))
        return pd.DataFrame(
            {"bucket": group["bucket"].iloc[:1], "seed": built.seed, "segment": built.segment, "cells": built.cells.tobytes()}
        )

    return snapshot.select("bucket", "digest").groupBy("bucket").applyInPandas(
        build, "bucket int, seed int, segment int, cells binary"
    )


def screen(digests: DataFrame, filters: DataFrame, parts: int = 1) -> DataFrame:
    """The rows of ``digests`` (``bucket``, ``digest``) that the filter of their bucket may hold.

    The buckets follow the snapshot, the batch may be far larger: its rows of a bucket are dealt into ``parts`` tasks, each
    with a copy of the bucket's filter.
    """

    def test(group: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(group) or not len(found):
            return group.iloc[:0]
        row = found.iloc[0]
        built = FuseFilter(int(row["seed"]), int(row["segment"]), np.frombuffer(row["cells"], np.uint8))
        return group[built.holds(keys_of(group["digest"]))]

    dealt = digests.select("bucket", "digest", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int").alias("part"))
    copies = filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pair = dealt.groupBy("bucket", "part").cogroup(copies.groupBy("bucket", "part"))
    return pair.applyInPandas(test, "bucket int, digest binary, part int").drop("part")


def screen_parts(n_digests: int, buckets: int) -> int:
    """Parts of each bucket, so that a task takes as many digests of the batch as a bucket holds of the snapshot."""
    return max(1, -(-n_digests // (TEXTS_PER_BUCKET * max(1, buckets))))


def grouped(rows: DataFrame) -> DataFrame:
    """Rows with a digest, grouped: ``digest``, ``first_id``, ``n_rows``. Copies meet before the shuffle."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_rows"))


def byte_classes(docs: DataFrame, digests: DataFrame, digest_of) -> DataFrame:
    """``digest``, ``bytes`` of the texts that have one of ``digests``, each different text once.

    Texts are grouped by their bytes on the map side: copies of one text leave a task as one row. A bit set of fixed size
    keeps the texts of other digests from moving.
    """
    rows = docs.select(digest_of(F.col("text")).alias("digest"), F.col("text").alias("bytes"))
    keys = digests.select(F.xxhash64("digest"))
    few = screen_bits(rows, F.xxhash64("digest"), keys).groupBy("digest", "bytes").count().drop("count")
    return few.join(digests.select("digest"), "digest", "left_semi")


def take_snapshot(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different digests of ``doc_id``, ``digest`` rows in buckets, written once, and their filters."""
    groups = stored(grouped(rows), "snapshot")
    buckets = max(1, -(-groups.count() // TEXTS_PER_BUCKET))
    dealt = groups.withColumn("bucket", bucket_of(F.col("digest"), buckets))
    return dealt, stored(build_filters(dealt), "filters")


def find_copies(docs: DataFrame, incoming: Column, digest_of: Callable[[Column], Column] = digest) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``digest``, ``keep_id``, ``group_size``.

    ``incoming`` tells the rows of the new batch; the others are the snapshot, which is taken here.
    """
    clean = docs.select("doc_id", normalised(F.col("text")).alias("text"), F.coalesce(incoming, F.lit(True)).alias("new"))
    rows = stored(clean.select("doc_id", "new", digest_of(F.col("text")).alias("digest")), "digests")
    snapshot, filters = take_snapshot(rows.where(~F.col("new")))
    buckets = filters.count()
    batch = grouped(rows.where("new")).withColumn("bucket", bucket_of(F.col("digest"), max(1, buckets)))
    batch = stored(batch, "batch")
    # nothing can be in an empty snapshot
    found = screen(batch, filters, screen_parts(batch.count(), buckets)) if buckets else batch.limit(0)
    positive = found.select("digest")
    met = batch.join(positive, "digest", "left_semi").unionByName(snapshot).groupBy("digest").agg(
        F.min("first_id").alias("first_id"), F.sum("n_rows").alias("n_rows")
    )  # what the filter does not hold is not met: it is new, and grouped on its own
    fresh = batch.join(positive, "digest", "left_anti").select("digest", "first_id", "n_rows")
    several = stored(met.unionByName(fresh).where(F.col("n_rows") > 1), "several")
    collided = stored(
        byte_classes(clean, several, digest_of).groupBy("digest").count().where(F.col("count") > 1).select("digest"),
        "collided",
    )
    classes = several.select("digest", F.col("first_id").alias("keep_id"), F.col("n_rows").alias("group_size"))
    single = rows.select("doc_id", "digest").join(classes, "digest", "left").select(
        "doc_id",
        "digest",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
    )
    if collided.isEmpty():  # bytes agree in every class
        return single
    apart = clean.select("doc_id", digest_of(F.col("text")).alias("digest"), "text").join(
        collided, "digest", "left_semi"
    )
    by_bytes = apart.groupBy("digest", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    own = apart.join(by_bytes, ["digest", "text"]).select("doc_id", "digest", "keep_id", "group_size")
    return single.join(collided, "digest", "left_anti").select(own.columns).unionByName(own)
