"""Hard negatives for every anchor and positive, from zone maps over blocks in Hilbert order.

Components become whole numbers (``floor(scale * x)``), so a score, the inner product with the anchor, is exact. Candidates are
ordered by label and, within a label, along a Hilbert curve through all dimensions (two bits each, of the vector scaled to
unit variance), and written as Parquet blocks of up to ``BLOCK`` rows. The zone map of a block holds its labels' range and the
least and largest value of every dimension. Interval arithmetic on a zone map gives a lower and an upper bound of the score of
any row in the block, so a search for the first ``k`` rows in a window of scores reads only blocks whose bounds meet the window:

1. every window reads the one block that promises most; the ``k``-th score found there becomes the window's new lower end;
2. every window reads all blocks whose bounds still meet it, and the best of all blocks are merged.

Positives are such a search with an open window and the anchor's label; each positive then gives a window of its own for the
negatives, between two percentages of its score, among the other labels. Bounds rule out only blocks that cannot matter, so
the result is that of a full scan, whatever the data; how much is read depends on how well the blocks cluster.

Anchors are packed into tiles of up to ``TILE`` rows, zone maps into rows of up to ``ZONES`` blocks. Tiles meet zone maps by an
equi-join on slots (every anchor has to look at every zone map), and meet the chosen blocks by equi-joins on tile and block.
A task holds one tile and one block at a time; a window keeps ``k`` rows per block, cut to ``k`` before they are shuffled.

Cases: rows with a null id, label or vector, or with a null or non-finite component take no part; vectors of different length
do not meet; an empty vector meets other empty ones with score 0; components beyond 2^62 are held there, and scores beyond a
long at its ends; rows that repeat an id count each on its own, also as anchors, and never meet rows of their own id; ties go
to the smaller id; fewer rows than asked are all returned; an anchor without positives, or a positive without negatives, has no
row; an empty table gives none; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotrend.llm.common import ship_package, stored

#: Rows of a block of candidates, anchors of a tile, zone maps of a row.
BLOCK, TILE, ZONES = 256, 256, 256
#: Bits of a dimension on the Hilbert curve, and the quartiles of a normal distribution that cut its cells.
BITS, CUTS = 2, (-0.6745, 0.0, 0.6745)
LARGEST = float(2**62)
#: Sums of whole numbers below this are exact in double precision.
EXACT = float(2**52)
LEAST, MOST = -(2**63) + 1, 2**63 - 1

VECTORS = "id long, label long, n int, asks boolean, key binary, codes array<double>"
PACKED = (
    "n int, m int, label_lo long, label_hi long, lo array<double>, hi array<double>, ids array<long>, labels array<long>, "
    "codes array<double>"
)
ZONE_ROWS = "n int, blocks array<long>, label_lo array<long>, label_hi array<long>, lo array<double>, hi array<double>"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of whole numbers below ``2 ** bits``, as rows of bytes in order of the curve."""
    x = cells.T.astype(np.int64)
    n = len(x)
    if not n:
        return np.zeros((len(cells), 0), np.uint8)
    for level in range(bits - 1, 0, -1):  # undo the turns of the finer levels
        below = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(turned, below, swap)
            x[i] ^= swap
    for i in range(1, n):  # the Gray code across dimensions
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[n - 1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    planes = [((x >> level) & 1).T for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def _cells(codes: np.ndarray) -> np.ndarray:
    length = np.sqrt((codes**2).sum(axis=1, keepdims=True))
    even = codes * np.sqrt(codes.shape[1]) / np.where(length > 0, length, 1.0)
    return np.searchsorted(CUTS, even.ravel(), side="right").reshape(codes.shape)


def _runs(values: np.ndarray) -> Iterator[slice]:
    """Runs of equal values."""
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return (slice(a, b) for a, b in zip(cuts, cuts[1:]) if b > a)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists without nulls, and the places where the lists begin and the last one ends."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def _list_column(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def coded(vectors: DataFrame, id_col: str, label: Column, vector_col: str, is_anchor: Column, scale: int) -> DataFrame:
    """The rows that take part, with whole components and their place on the curve; ``is_anchor`` is on the column ``id``."""
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    rows = rows.select("id", "label", F.size("vector").alias("n"), F.coalesce(is_anchor, F.lit(False)).alias("asks"), "vector")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            values, offsets = _lists(batch.column("vector"))
            for run in _runs(n):
                length, m = int(n[run.start]), run.stop - run.start
                with np.errstate(over="ignore"):
                    whole = np.floor(scale * values[offsets[run.start] : offsets[run.stop]].reshape(m, length))
                whole = np.clip(whole, -LARGEST, LARGEST)
                keys = hilbert_keys(_cells(whole), BITS)
                own = [batch.column(c).slice(run.start, m) for c in ("id", "label", "n", "asks")]
                own += [pa.array([k.tobytes() for k in keys], pa.binary()), _list_column(list(whole), pa.float64())]
                yield pa.RecordBatch.from_arrays(own, ["id", "label", "n", "asks", "key", "codes"])

    return rows.mapInArrow(code, VECTORS)


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows of one length in order of (label, curve, id), packed by up to ``size``, with the zone map of each pack."""
    order = ["n", "label", "key", "id", "row"]
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        length, count = -1, 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            if not count or (count < size and not last):
                return
            ids, labels, codes = (np.concatenate(part) for part in zip(*held))
            stop = count if last else count - count % size
            for start in range(0, stop, size):
                part = slice(start, min(start + size, stop))
                own = codes[part]
                columns = [
                    pa.array([length], pa.int32()), pa.array([len(own)], pa.int32()),
                    pa.array([labels[part].min()]), pa.array([labels[part].max()]),
                    _list_column([own.min(axis=0)], pa.float64()), _list_column([own.max(axis=0)], pa.float64()),
                    _list_column([ids[part]], pa.int64()), _list_column([labels[part]], pa.int64()),
                    _list_column([own.ravel()], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PACKED.split(", ")])
            held, count = [(ids[stop:], labels[stop:], codes[stop:])], count - stop

        for batch in batches:
            n = batch.column("n").to_numpy()
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            values, offsets = _lists(batch.column("codes"))
            for run in _runs(n):
                if n[run.start] != length:
                    yield from emit(last=True)
                    held, count, length = [], 0, int(n[run.start])
                m = run.stop - run.start
                held.append((ids[run], labels[run], values[offsets[run.start] : offsets[run.stop]].reshape(m, length)))
                count += m
                yield from emit(last=False)
        yield from emit(last=True)

    packs = ordered.select("n", "id", "label", "codes").mapInArrow(pack, PACKED)
    return stored(packs.select(F.monotonically_increasing_id().alias(name), "*"), name)


def zone_maps(blocks: DataFrame) -> DataFrame:
    """Zone maps of consecutive blocks of one length, packed by up to ``ZONES``; the blocks' rows are not read."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            low, at = _lists(batch.column("lo"))
            high, _ = _lists(batch.column("hi"))
            for run in _runs(n):
                for start in range(run.start, run.stop, ZONES):
                    part = slice(start, min(start + ZONES, run.stop))
                    whole = [_list_column([batch.column(c).to_numpy()[part]], pa.int64()) for c in ("block", "label_lo", "label_hi")]
                    bounds = [_list_column([x[at[part.start] : at[part.stop]]], pa.float64()) for x in (low, high)]
                    columns = [pa.array([n[start]], pa.int32()), *whole, *bounds]
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in ZONE_ROWS.split(", ")])

    rows = blocks.select("block", "n", "label_lo", "label_hi", "lo", "hi").mapInArrow(pack, ZONE_ROWS)
    return stored(rows, "zones")


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector inside each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    size = np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = np.where(size < EXACT, 0.0, size * 2.0**-40)
    return least - slack, most + slack


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond a long are held at its ends."""
    size = float((np.abs(anchors).max(initial=0.0) * np.abs(rows).max(initial=0.0)) * anchors.shape[1])
    if size < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    exact = anchors.astype(np.int64).astype(object) @ rows.astype(np.int64).astype(object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


class Asked:
    """One tile's anchors and windows, from a row of Arrow columns."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        cell = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
        self.tile, n = batch.column("tile")[i].as_py(), batch.column("n")[i].as_py()
        self.ids, self.labels = cell("ids"), cell("labels")
        self.codes = cell("codes").reshape(len(self.ids), n)
        self.w, self.at, self.low, self.high = (cell(c) for c in ("w", "at", "low", "high"))


def choose(asked: DataFrame, zones: DataFrame, same: bool, best_only: bool) -> DataFrame:
    """Blocks that windows must read: ``tile``, ``block``, ``ws``; with ``best_only`` the most promising one of each window."""
    slots = max(1, zones.count())
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    maps = zones.withColumnsRenamed({"n": "zn", "label_lo": "zl", "label_hi": "zh", "lo": "zlo", "hi": "zhi"})
    maps = maps.withColumn("slot", F.pmod(F.xxhash64("blocks"), F.lit(slots)).cast("int"))
    pairs = asked.select("*", every).join(maps, "slot").where(F.col("n") == F.col("zn"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = Asked(batch, i)
                cell = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                blocks, first, last = cell("blocks"), cell("zl"), cell("zh")
                shape = (len(blocks), own.codes.shape[1])
                least, most = score_bounds(own.codes, cell("zlo").reshape(shape), cell("zhi").reshape(shape))
                least, most = least[own.at], most[own.at]
                label = own.labels[own.at][:, None]
                fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
                fits &= (most >= own.low[:, None].astype(float)) & (least <= own.high[:, None].astype(float))
                if best_only:
                    middle = (least + most) / 2
                    to_end = -np.abs(middle - own.high[:, None])
                    good = np.where(fits, np.where((own.high == MOST)[:, None], most, to_end), -np.inf)
                    pick = good.argmax(axis=1)
                    has = np.flatnonzero(fits.any(axis=1))
                    columns = [pa.array(blocks[pick[has]]), pa.array(own.w[has]), pa.array(good[has, pick[has]])]
                    names = ["block", "w", "good"]
                else:
                    has = np.flatnonzero(fits.any(axis=0))
                    columns = [pa.array(blocks[has]), _list_column([own.w[fits[:, c]] for c in has], pa.int64())]
                    names = ["block", "ws"]
                tile = pa.array(np.full(len(has), own.tile, np.int64))
                yield pa.RecordBatch.from_arrays([tile, *columns], ["tile", *names])

    if not best_only:
        return pairs.mapInArrow(meet, "tile long, block long, ws array<long>")
    found = pairs.mapInArrow(meet, "tile long, block long, w long, good double")
    best = found.groupBy("tile", "w").agg(F.max_by("block", F.struct("good", "block")).alias("block"))
    return best.groupBy("tile", "block").agg(F.collect_list("w").alias("ws"))


def read(needs: DataFrame, asked: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows of each block for each window that reads it: ``tile``, ``w``, ``id``, ``score``."""
    rows = blocks.select("block", *[F.col(c).alias(f"c_{c}") for c in ("ids", "labels", "codes")])
    met = needs.join(asked, "tile").join(rows, "block")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = Asked(batch, i)
                cell = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                ids, labels = cell("c_ids"), cell("c_labels")
                order = np.argsort(ids, kind="stable")  # the first of equal scores has the smaller id
                ids, labels = ids[order], labels[order]
                codes = cell("c_codes").reshape(len(ids), own.codes.shape[1])[order]
                ws = np.searchsorted(own.w, cell("ws"))
                at, place = np.unique(own.at[ws], return_inverse=True)
                scores = products(own.codes[at], codes)[place]
                equal = own.labels[own.at[ws]][:, None] == labels
                good = (equal if same else ~equal) & (own.ids[own.at[ws]][:, None] != ids)
                good &= (scores >= own.low[ws][:, None]) & (scores <= own.high[ws][:, None])
                scores[~good] = LEAST - 1
                line = np.arange(len(ws))
                for _ in range(min(k, len(ids))):
                    top = scores.argmax(axis=1)
                    value = scores[line, top]
                    has = np.flatnonzero(value >= LEAST)
                    tile = pa.array(np.full(len(has), own.tile, np.int64))
                    columns = [tile, pa.array(own.w[ws[has]]), pa.array(ids[top[has]]), pa.array(value[has])]
                    yield pa.RecordBatch.from_arrays(columns, ["tile", "w", "id", "score"])
                    scores[line, top] = LEAST - 1

    return met.mapInArrow(scan, "tile long, w long, id long, score long")


def search(windows: DataFrame, tiles: DataFrame, blocks: DataFrame, zones: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows inside each window: ``tile``, ``w``, ``rank``, ``id``, ``score``.

    ``windows`` has ``tile``, ``w``, the anchor's place ``at`` in its tile, and the ends ``low`` and ``high`` of the scores.
    """

    def ask(rows: DataFrame, name: str) -> DataFrame:
        of_tile = rows.groupBy("tile").agg(F.array_sort(F.collect_list(F.struct("w", "at", "low", "high"))).alias("windows"))
        lists = [F.col(f"windows.{c}").alias(c) for c in ("w", "at", "low", "high")]
        return stored(tiles.join(of_tile, "tile").select("tile", "n", "ids", "labels", "codes", *lists), name)

    asked = ask(windows, "asked")
    seeds = read(choose(asked, zones, same, best_only=True), asked, blocks, same, k)
    least = seeds.groupBy("tile", "w").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    narrowed = windows.join(least.drop("n"), ["tile", "w"], "left").withColumn("low", F.greatest("low", "least")).drop("least")
    asked = ask(narrowed, "narrowed")
    found = read(choose(asked, zones, same, best_only=False), asked, blocks, same, k)
    order = Window.partitionBy("tile", "w").orderBy(F.desc("score"), F.asc("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("tile", "w", "rank", "id", "score")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``is_anchor`` is a condition on the column ``id``, ``label`` an expression on the columns of ``vectors``. Negatives score
    between the two percentages of their positive's score, ends included.
    """
    ship_package(vectors.sparkSession)
    rows = stored(coded(vectors, id_col, label, vector_col, is_anchor, scale), "coded")
    blocks = packed(rows, BLOCK, "block")
    tiles = packed(rows.where("asks"), TILE, "tile")
    zones = zone_maps(blocks)
    anchors = tiles.select("tile", F.posexplode("ids").alias("at", "anchor_id"))
    ends = [F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")]
    open_windows = anchors.select("tile", F.col("at").cast("long").alias("w"), F.col("at").cast("long").alias("at"), *ends)
    positives = search(open_windows, tiles, blocks, zones, True, n_positives)
    part = lambda share: F.col("score").cast("decimal(20,0)") * F.lit(share).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    windows = positives.select(
        "tile",
        (F.col("w") * n_positives + F.col("rank") - 1).alias("w"),
        F.col("w").alias("at"),
        F.ceil(part(percent[0])).cast("long").alias("low"),
        F.floor(part(percent[1])).cast("long").alias("high"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    windows = stored(windows.where(F.col("low") <= F.col("high")), "windows")
    negatives = search(windows.select("tile", "w", "at", "low", "high"), tiles, blocks, zones, False, n_negatives)
    named = windows.select("tile", "w", "at", "positive_id", "positive_score").join(anchors, ["tile", "at"])
    found = negatives.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(named, ["tile", "w"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
