"""N-gram Jaccard join with count-vector R-trees.

A document's set holds its distinct shingles of words, as 64-bit hashes. Equal sets are merged first, so copies cost one row.
Two different sets meet when they share a hash among the smallest few of both (a prefix long enough that no pair at the
threshold can miss it). Hashes that many documents have come last in that order, for everyone alike, so a line that half
of the corpus repeats brings nobody together.

Every set also has a count vector: its hashes dealt into groups, and the number in each. The sum of the smaller
coordinates of two vectors bounds their overlap from above. Pairs of small buckets are tested by that bound one by one; the
members of a large bucket are dealt into tiles, and in a tile an R-tree over the count vectors finds the pairs that the
bound lets through. Those are verified on the whole sets. The bound never rules out a pair that links.

Large buckets are searched twice. First each tile names a spanning forest of its surviving pairs, the surest first; when
these are verified, most members of a group of near copies are connected. Then every surviving pair that still lies in
two components is verified. Pairs inside a component need no test, as only reachability is asked for. No step lists all
pairs of a group, and no link between two components is missed.

Size: the order of frequent hashes is a bit set of fixed size (2 MiB); any bit set gives the same result, and as what counts
as frequent grows with the mean, it never fills up. Texts are read three times
(frequent hashes, features, sets of surviving pairs) instead of storing their sets.

Cases: null, empty and white-space texts have an empty set and are linked with nothing; a text with fewer words than a
shingle has one shingle, the whole sequence; repeated rows are copies of each other; rows of one doc_id with different
texts are sets of their own; a link needs ``100 * overlap >= percent * union`` in whole numbers; a null doc_id is a row like
others, but no smallest doc_id; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import flag_bits, in_parts, map_batches, screen_bits, ship_package, stored
from cotrend.llm.components import components

BYTES_AT_ONCE = 1 << 21
HASHES_PER_SLICE = 1 << 20
#: A hash is frequent if so many documents, and ``OVER_MEAN`` times the mean of all places, have it near their smallest ones.
FREQUENT = 16
OVER_MEAN = 4
FREQUENT_BITS = 24
SLICE_BITS = 4
#: Buckets up to this size are listed as pairs.
SMALL_BUCKET = 16
TILE = 1024
LEAF = 32
LEAST_GROUPS = 64
MOST_GROUPS = 1 << 15

#: A-Z to a-z and white space to a space.
PLAIN = bytes(32 if b in b" \t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
WORD_FACTOR = np.uint64(0x589965CC75374CC3)
SHORT_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base ** 2 ... modulo 2 ** 64; kept per worker at the usual size."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, BYTES_AT_ONCE + 1), base, np.uint64)]))
        if n <= BYTES_AT_ONCE + 1:
            _powers[base] = have
    return have[:n]


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text."""
    raw = [t.encode("utf-8", "replace").translate(PLAIN) for t in texts]
    buffer = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    edges = np.diff(np.concatenate([[0], (buffer != 32).view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(buffer.astype(np.uint64) * powers(BASE, len(buffer)), out=sums[1:])
    word = (sums[ends] - sums[starts]) * powers(INVERSE, len(buffer))[starts] + (ends - starts).astype(np.uint64) * WORD_FACTOR
    word = mixed(word)
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64) * WORD_FACTOR) | np.uint64(1)
    whole = max(0, len(word) - words + 1)
    shingles = np.zeros(whole, np.uint64)
    for k in range(words):
        shingles += word[k : k + whole] * factors[k]
    shingles = mixed(shingles)
    places = np.searchsorted(starts, np.cumsum([0] + [len(r) + 1 for r in raw]))
    out = []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(shingles[a : b - words + 1]))
        elif b > a:
            short = (word[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * SHORT_FACTOR
            out.append(mixed(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sets_in_parts(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The same for any number of texts, a bounded number of bytes at once (or one text)."""
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + 4 * len(texts[end]) <= BYTES_AT_ONCE):
            size += 4 * len(texts[end])
            end += 1
        yield from shingle_sets(texts[start:end], words)
        start = end


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def needed(n_a, n_b, percent: int):
    """The least overlap of a link between sets of these sizes."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def frequent_hashes(docs: DataFrame, words: int, percent: int) -> np.ndarray:
    """A bit set of the places of hashes that many documents have near their smallest ones."""
    slices = 1 << SLICE_BITS
    in_slice = FREQUENT_BITS - SLICE_BITS

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            places, counts = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(places, np.arange(1, slices + 1) << in_slice)
            for number, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                packed = [places[a:b].astype(np.uint32).tobytes(), np.minimum(counts[a:b], 255).astype(np.uint8).tobytes()]
                columns = [pa.array([number], pa.int32())] + [pa.array([x], pa.binary()) for x in packed]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "places", "counts"])

        for part in (p for batch in batches for p in in_parts(batch)):
            for own in sets_in_parts([t or "" for t in part.column("text").to_pylist()], words):
                few = own[: prefix_length(len(own), percent) + len(own) // 20]
                held.append(few >> np.uint64(64 - FREQUENT_BITS))
                size += len(few)
                if size >= HASHES_PER_SLICE:
                    yield from sent()
                    held, size = [], 0
        if size:
            yield from sent()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes that share a place are frequent together, which only changes the order."""
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, places, counts in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                total = totals.setdefault(number, np.zeros(1 << in_slice, np.uint32))
                own = np.frombuffer(places, np.uint32).astype(np.int64) - (number << in_slice)
                total[own] += np.frombuffer(counts, np.uint8)  # places of one message differ
        for number, total in totals.items():
            often = total >= FREQUENT + OVER_MEAN * total.mean()
            bits = np.packbits(often, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([bits])], ["slice", "bits"])

    ship_package(docs.sparkSession)
    sent = docs.select("text").mapInArrow(collect, "slice int, places binary, counts binary")
    counted = sent.repartition(slices, "slice").mapInArrow(count, "slice int, bits binary")
    bits = np.zeros((slices, 1 << (in_slice - 3)), np.uint8)
    for row in counted.collect():  # a bit set of fixed size in all
        bits[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def group_counts(own: np.ndarray) -> bytes:
    """The count vector, packed; about one or two groups per hash, always a power of two.

    The first byte tells the width: 0 for two counts in a byte, 1 for one in a byte, 4 for four bytes each.
    """
    groups = min(MOST_GROUPS, max(LEAST_GROUPS, 1 << len(own).bit_length()))
    counts = np.bincount((own & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    most = counts.max()
    if most < 16:
        return b"\0" + (counts[0::2] | counts[1::2] << 4).astype(np.uint8).tobytes()
    kind = np.uint8 if most < 256 else np.int32
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def counts_of(packed: bytes) -> np.ndarray:
    """The vector that ``group_counts`` packed."""
    if packed[0] == 4:
        return np.frombuffer(packed, np.int32, offset=1)
    raw = np.frombuffer(packed, np.uint8, offset=1)
    return raw if packed[0] == 1 else np.column_stack([raw & 15, raw >> 4]).ravel()


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Count vectors (rows) with fewer groups: places that agree in their low bits are added."""
    return counts.reshape(*counts.shape[:-1], -1, groups).sum(axis=-2, dtype=np.int32)


def features(docs: DataFrame, words: int, percent: int, bits: np.ndarray, key: str | None = None) -> DataFrame:
    """``row``, ``doc_id``, ``n``, ``digest``, ``light`` and ``heavy`` hashes of the prefix, ``counts``; ``key`` as ``of_row``."""
    own_key = ["of_row"] if key else []
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, digests, light, heavy, counts = [], [], [], [], []
        for own in sets_in_parts([t or "" for t in batch.column("text").to_pylist()], words):
            place = own >> np.uint64(64 - FREQUENT_BITS)
            often = (shared.value[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            n = prefix_length(len(own), percent) if len(own) else 0
            first = own[~often][:n]
            sizes.append(len(own))
            digests.append(xxhash.xxh3_128_digest(own.tobytes()))
            light.append(first.tobytes())
            heavy.append(own[often][: n - len(first)].view(np.int64))
            counts.append(group_counts(own))
        columns = [pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(light, pa.binary())]
        columns += [pa.array(heavy, pa.list_(pa.int64())), pa.array(counts, pa.binary())]
        columns += [batch.column(k) for k in own_key]
        names = ["doc_id", "n", "digest", "light", "heavy", "counts", *own_key]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    rows = map_batches(
        docs.select(F.col("doc_id").cast("long"), "text", *[F.col(key).alias(k) for k in own_key]),
        describe,
        "doc_id long, n int, digest binary, light binary, heavy array<long>, counts binary" + "".join(f", {k} binary" for k in own_key),
    )
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "features")


def deal_light(sets: DataFrame, slices: int) -> DataFrame:
    """Light hashes as packed messages: ``slice``, ``hashes``, ``nodes``, ``sizes``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.frombuffer(x, np.uint64) for x in batch.column("light").to_pylist()]
            lengths = [len(x) for x in hashes]
            flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            nodes = np.repeat(batch.column("row").to_numpy(), lengths)
            sizes = np.repeat(batch.column("n").to_numpy(), lengths)
            part = (flat % np.uint64(slices)).astype(np.int32)
            # 32 bits tell the hashes of a slice apart; the few that meet by chance are ruled out like others
            flat = (flat >> np.uint64(32)).astype(np.uint32)
            order = np.argsort(part, kind="stable")
            found, starts = np.unique(part[order], return_index=True)
            ends = np.append(starts[1:], len(order))
            packed = [[x[order[a:b]].tobytes() for a, b in zip(starts, ends)] for x in (flat, nodes, sizes)]
            columns = [pa.array(found, pa.int32())] + [pa.array(x, pa.binary()) for x in packed]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "hashes", "nodes", "sizes"])

    ship_package(sets.sparkSession)
    dealt = sets.select("row", "n", "light").mapInArrow(deal, "slice int, hashes binary, nodes binary, sizes binary")
    return dealt.repartition(slices, "slice").sortWithinPartitions("slice")


def meet_light(dealt: DataFrame, percent: int) -> DataFrame:
    """Buckets of light hashes: pairs (``hash`` null, ``a``, ``b``) of small ones, members (``hash``, ``a``) of others."""

    def buckets(number: int, hashes: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((nodes, hashes))
        hashes, nodes, sizes = hashes[order], nodes[order], sizes[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        members = np.diff(np.append(starts, len(hashes)))
        pairs = []
        for gap in range(1, SMALL_BUCKET):  # each member with the one that comes gap places later
            wide = (members > gap) & (members <= SMALL_BUCKET)
            last = np.repeat(starts[wide] + members[wide], members[wide] - gap)
            first = last - gap - 1 - within(members[wide] - gap)
            second = first + gap
            small, large = np.minimum(sizes[first], sizes[second]), np.maximum(sizes[first], sizes[second])
            fits = 100 * small >= percent * large
            pairs.append(np.column_stack([nodes[first[fits]], nodes[second[fits]]]))
        both = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        big = np.repeat(members > SMALL_BUCKET, members)
        none = pa.nulls(len(both), pa.int64())
        for key, a, b in (
            (none, both[:, 0], pa.array(both[:, 1])),
            (pa.array((hashes[big].astype(np.int64) << 24) + number), nodes[big], pa.nulls(int(big.sum()), pa.int64())),
        ):
            if len(a):
                yield pa.RecordBatch.from_arrays([key, pa.array(a), b], ["hash", "a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for number, *packed in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if number != now and held:
                    yield from buckets(now, *joined(held))
                    held = []
                now = number
                held.append(packed)
        if held:
            yield from buckets(now, *joined(held))

    def joined(held: list[list[bytes]]) -> list[np.ndarray]:
        kinds = (np.uint32, np.int64, np.int32)
        return [np.frombuffer(b"".join(x[i] for x in held), kind) for i, kind in enumerate(kinds)]

    return dealt.mapInArrow(meet, "hash long, a long, b long")


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def surviving_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose count vectors allow the needed overlap."""
    ends = pairs.select(F.xxhash64("a").alias("key")).union(pairs.select(F.xxhash64("b")))
    of = screen_bits(sets.select("row", "n", "counts"), F.xxhash64("row"), ends)
    met = pairs.join(of.toDF("a", "n_a", "counts_a"), "a").join(of.toDF("b", "n_b", "counts_b"), "b")

    def bound(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(batch.num_rows, bool)
        columns = [batch.column(n).to_pylist() for n in ("n_a", "n_b", "counts_a", "counts_b")]
        for i, (n_a, n_b, raw_a, raw_b) in enumerate(zip(*columns)):
            x, y = counts_of(raw_a), counts_of(raw_b)
            groups = min(len(x), len(y))
            keep[i] = np.minimum(folded(x, groups), folded(y, groups)).sum() >= needed(n_a, n_b, percent)
        yield batch.select(["a", "b"]).filter(pa.array(keep))

    return map_batches(met.select("a", "b", "n_a", "n_b", "counts_a", "counts_b"), bound, "a long, b long")


def packed_leaves(points: np.ndarray) -> list[np.ndarray]:
    """Leaves of an R-tree: points halved again and again along the coordinate (of 64) that varies most."""
    some = np.unique(np.linspace(0, points.shape[1] - 1, 64).astype(int))
    todo, leaves = [np.arange(len(points))], []
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            leaves.append(own)
            continue
        axis = some[int(np.argmax(points[np.ix_(own, some)].var(axis=0)))]
        order = own[np.argsort(points[own, axis], kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return leaves


def tile_survivors(n: np.ndarray, points: np.ndarray, side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of places (first < second) that size and bound let through, and the bound's surplus.

    ``side`` is the block of each member; pairs are taken across the two blocks of a tile, or within its only one.
    """
    leaves = packed_leaves(points)
    most = np.stack([points[leaf].max(axis=0) for leaf in leaves])
    least_n = np.array([n[leaf].min() for leaf in leaves])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    two_blocks = side.min() != side.max()
    for k, leaf in enumerate(leaves):
        # no pair below two nodes can overlap by more than the sum of the smaller of their largest coordinates
        can = np.minimum(most[k], most[k:]).sum(axis=1, dtype=np.int64) >= needed(least_n[k], least_n[k:], percent)
        for other in (leaves[k + j] for j in np.flatnonzero(can)):
            low = np.stack([np.minimum(p, points[other]).sum(axis=1, dtype=np.int64) for p in points[leaf]])
            surplus = low / np.maximum(needed(n[leaf][:, None], n[other][None, :], percent), 1)
            small = np.minimum(n[leaf][:, None], n[other][None, :])
            large = np.maximum(n[leaf][:, None], n[other][None, :])
            good = (surplus >= 1) & (100 * small >= percent * large)
            if two_blocks:
                good &= side[leaf][:, None] != side[other][None, :]
            if other is leaf:
                good &= np.triu(np.ones(good.shape, bool), 1)
            a, b = np.nonzero(good)
            out.append((leaf[a], other[b], surplus[a, b]))
    a, b, surplus = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 3
    return np.minimum(a, b), np.maximum(a, b), surplus


def search_by_size(
    n: np.ndarray, packed: list[bytes], side: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tile_survivors`` band by band: sizes of a band and the next, so that all vectors have about as many groups.

    Sets that link differ in size by ``100 / percent`` at most, which is the width of a band.
    """
    band = np.floor(np.log(n) / np.log(max(100 / percent, 1.01) * 1.0001)).astype(int)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for number in np.unique(band):
        own = np.flatnonzero((band == number) | (band == number + 1))
        if len(own) < 2:
            continue
        counts = [counts_of(packed[i]) for i in own]
        groups = min(map(len, counts))
        points = np.zeros((len(own), groups), np.uint8)
        for k, vector in enumerate(counts):
            vector = folded(vector, groups)
            if vector.max() > 255 and points.dtype == np.uint8:
                points = points.astype(np.int32)
            points[k] = vector
        a, b, surplus = tile_survivors(n[own], points, side[own], percent)
        here = (band[own[a]] == number) | (band[own[b]] == number)
        found.append((own[a[here]], own[b[here]], surplus[here]))
    a, b, surplus = (np.concatenate(x) for x in zip(*found))
    return np.minimum(a, b), np.maximum(a, b), surplus


def forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Places of a spanning forest, heaviest pairs first."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    chosen = []
    for i in np.argsort(-weight, kind="stable").tolist():
        x, y = root(int(a[i])), root(int(b[i]))
        if x != y:
            parent[x] = y
            chosen.append(i)
            if len(chosen) == n - 1:
                break
    return np.array(chosen, np.int64)


def merge_buckets(members: DataFrame) -> DataFrame:
    """Buckets (``hash``, ``row``) with one smallest member as one bucket, under that member.

    Near copies meet in many buckets of nearly the same members; merged, each of them is listed once.
    """
    members = stored(members, "members")
    sizes = members.groupBy("hash").agg(F.min("row").alias("least"), F.count("*").alias("members"))
    least = stored(sizes.where(F.col("members") > 1).select("hash", "least"), "buckets")
    return members.join(least, "hash").select(F.col("least").alias("hash"), "row").distinct()


def tiles_of(members: DataFrame) -> DataFrame:
    """``hash``, ``low``, ``high``, ``row``, ``block``: each member of a bucket in every tile of its block.

    A bucket of at most ``TILE`` members is one tile; a larger one is cut into blocks, and each two blocks are a tile.
    """
    sizes = members.groupBy("hash").agg(F.count("*").alias("members")).where(F.col("members") > 1)
    blocks = F.ceil(F.col("members") / TILE).cast("int")
    dealt = members.join(sizes, "hash").select(
        "hash", "row", blocks.alias("blocks"), F.pmod(F.xxhash64("row"), blocks).cast("int").alias("block")
    )
    other = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return other.select("hash", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "row", "block")


def tile_pairs(tiles: DataFrame, sets: DataFrame, percent: int, labels: DataFrame | None = None) -> DataFrame:
    """Pairs (``a``, ``b``) of each tile: a forest of the survivors, or with ``labels`` all survivors between labels.

    ``more`` tells tiles whose forest leaves survivors out; only those need a second search.
    """
    of = screen_bits(sets.select("row", "n", "counts"), F.xxhash64("row"), tiles.select(F.xxhash64("row").alias("key")))
    met = tiles.join(of, "row")
    if labels is None:
        met = met.withColumn("label", F.lit(0).cast("long"))
    else:
        met = met.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    ship_package(tiles.sparkSession)
    between = labels is not None

    def find(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row", kind="stable")
        rows, label = group["row"].to_numpy(), group["label"].to_numpy()
        a = b = keep = np.zeros(0, np.int64)
        if not between or label.min() != label.max():
            sizes, blocks = group["n"].to_numpy(np.int64), group["block"].to_numpy()
            a, b, surplus = search_by_size(sizes, group["counts"].tolist(), blocks, percent)
            keep = np.flatnonzero(label[a] != label[b]) if between else forest(a, b, surplus, len(rows))
        key = {name: group[name].iloc[0] for name in ("hash", "low", "high")}
        return pd.DataFrame({"a": rows[a[keep]], "b": rows[b[keep]], "more": len(keep) < len(a), **key})

    schema = "a long, b long, more boolean, hash long, low int, high int"
    return met.groupBy("hash", "low", "high").applyInPandas(find, schema)


def verify(pairs: DataFrame, docs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that link, by their whole sets."""
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    asked = stored(ends.join(sets.select("row", "doc_id", "digest"), "row"), "asked")
    # a null doc_id is looked up like any other: by a key that is never null
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)))
    few = screen_bits(docs.select("doc_id", "text"), key, asked.select(key.alias("key")))

    def hash_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = list(sets_in_parts([t or "" for t in batch.column("text").to_pylist()], words))
        digests = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in own], pa.binary())
        hashes = pa.array([x.tobytes() for x in own], pa.binary())
        yield pa.RecordBatch.from_arrays([digests, hashes], ["digest", "hashes"])

    # asked digests are of different sets, so each finds its hashes by digest, whichever copy they come from
    hashed = map_batches(few.select("text"), hash_texts, "digest binary, hashes binary").dropDuplicates(["digest"])
    # both joins read the one shuffle of the sets by digest
    of = asked.select("row", "digest")
    ends = pairs.join(of.toDF("a", "digest_a"), "a").join(of.toDF("b", "digest_b"), "b")
    met = ends.join(hashed.toDF("digest_a", "left"), "digest_a").join(hashed.toDF("digest_b", "right"), "digest_b")

    def overlap(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(map_batches(met.select("a", "b", "left", "right"), overlap, "a long, b long"), "links")


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80, key: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id it reaches by links).

    With ``key``, a binary column of ``docs``, it comes along as ``of_row``, and ``component`` numbers the components, null for
    texts without words: these tell rows apart where a doc_id is null or repeated.
    """
    bits = frequent_hashes(docs, words, percent)
    every = features(docs, words, percent, bits, key)
    sizes = every.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("first"), F.count("*").alias("rows")
    )
    classes = stored(sizes, "classes")
    # only sets that may have copies meet their class; the others stay where they are
    copied = classes.where("rows > 1")
    flagged = flag_bits(every.where("n > 0"), F.xxhash64("digest"), copied.select(F.xxhash64("digest").alias("key")), "copied")
    single = flagged.where("not copied")
    chosen = flagged.where("copied").join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    sets = single.unionByName(stored(chosen.select(single.columns), "chosen")).drop("copied", "of_row")
    total = sets.agg(F.sum(F.octet_length("light"))).first()[0] or 0
    slices = max(1, -(-total // (8 * HASHES_PER_SLICE)))
    light = stored(meet_light(deal_light(sets, slices), percent), "light")
    heavy = sets.select(F.explode("heavy").alias("hash"), "row")
    members = light.where("b is null").select("hash", F.col("a").alias("row")).unionByName(heavy)
    tiles = stored(tiles_of(merge_buckets(members)), "tiles")
    small = surviving_pairs(stored(light.where("b is not null").select("a", "b").distinct(), "small"), sets, percent)
    found = stored(tile_pairs(tiles, sets, percent), "forests")
    links = verify(small.union(found.select("a", "b")).distinct(), docs, sets, words, percent)
    labels = components(links)
    again = tiles.join(found.where("more").select("hash", "low", "high").distinct(), ["hash", "low", "high"], "left_semi")
    rest = tile_pairs(again, sets, percent, labels).select("a", "b").distinct()
    labels = components(links.union(verify(rest, docs, sets, words, percent)))
    placed = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    groups = stored(placed.join(firsts, "label").select("digest", "component_id", F.col("label").alias("component")), "groups")
    return every.join(groups, "digest", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        *(["of_row", "component"] if key else []),
    )
