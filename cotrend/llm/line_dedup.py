"""Line dedup with two Bloom filters.

1. Filters. Each task hashes the distinct line keys of its documents. One Bloom filter per slice of the hash space takes
   every hash once seen; a hash that it already holds goes to a second filter, of hashes twice seen. A hash is 8 bytes per
   different line and task: the lines themselves do not move.
2. Suspects. The twice-seen filters go to all tasks; only lines whose hash they hold are sent on, as exact keys. False
   positives of the filters cost traffic here and nothing else; false negatives do not exist.
3. Confirmation. Documents are counted per exact key, and the first occurrence of each key is found.
4. Dropping. Documents meet the list of their dropped keys and lose those lines.

Size: a filter pair has about ``BITS_PER_LINE`` bits per line up to ``max_filter_bits`` over all slices, which bounds what is
broadcast (16 MiB by default). Past that size filters get fuller and more lines are suspected, with the same result.

Cases: a null text is an empty text, which has one empty line; empty keys are never dropped; rows that repeat a doc_id are
one document for counting and each lose their lines; every row without a doc_id is a document of its own, after all others;
the key is the line without white space at both ends and with A-Z lower-cased; of equal first places the smaller doc_id,
then the earlier line, is first; very long texts are read whole; columns that are not named are not looked at; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import SPACE_BYTES, in_parts, map_batches, row_keys, ship_package, stored

BITS_PER_LINE = 16
PROBES = 3
LINES_PER_SLICE = 1 << 19
#: Hashes a task gathers before it sends them on.
HASHES_AT_ONCE = 1 << 20


def keys_of(text: str) -> list[bytes]:
    """The key of each line, in order."""
    return [line.strip(SPACE_BYTES) for line in text.encode("utf-8", "replace").lower().split(b"\n")]


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class Bloom:
    """A set of 64-bit hashes that may claim too much, never too little."""

    def __init__(self, log_bits: int, words: np.ndarray | None = None):
        self.log_bits = log_bits
        self.bytes = np.zeros(1 << (log_bits - 3), np.uint8) if words is None else words

    def places(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(PROBES):
            mixed = (hashes ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
            bit = mixed >> np.uint64(64 - self.log_bits)
            yield (bit >> np.uint64(3)).astype(np.int64), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for place, mask in self.places(hashes):
            out &= (self.bytes[place] & mask) != 0
        return out

    def add(self, hashes: np.ndarray) -> None:
        for place, mask in self.places(hashes):
            np.bitwise_or.at(self.bytes, place, mask)


def slice_of(hashes: np.ndarray, slices: int) -> np.ndarray:
    return (hashes % np.uint64(slices)).astype(np.int64)


def twice_seen(docs: DataFrame, slices: int, log_bits: int) -> list[Bloom]:
    """The filters of hashes that two documents or more may hold, one per slice."""

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            distinct, counts = np.unique(np.concatenate(held), return_counts=True)
            part = slice_of(distinct, slices)
            order = np.argsort(part, kind="stable")
            distinct, counts, part = distinct[order], counts[order], part[order]
            found, starts = np.unique(part, return_index=True)
            ends = np.append(starts[1:], len(part))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.int32()),
                    pa.array([distinct[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([distinct[a:b][counts[a:b] > 1].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["slice", "once", "twice"],
            )

        for text in (t for batch in batches for part in in_parts(batch) for t in part.column("text").to_pylist()):
            own = set(keys_of(text))
            own.discard(b"")
            held.append(hashes_of(list(own)))
            size += len(own)
            if size >= HASHES_AT_ONCE:
                yield from sent()
                held, size = [], 0
        if size:
            yield from sent()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come slice by slice; one pair of filters is held at a time."""
        now, once, twice = None, Bloom(log_bits), Bloom(log_bits)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([twice.bytes.tobytes()], pa.binary())], ["slice", "bits"]
            )

        for batch in batches:
            for number, seen, again in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if number != now:
                    if now is not None:
                        yield done()
                    now, once, twice = number, Bloom(log_bits), Bloom(log_bits)
                hashes = np.frombuffer(seen, np.uint64)
                twice.add(hashes[once.holds(hashes)])
                twice.add(np.frombuffer(again, np.uint64))
                once.add(hashes)
        if now is not None:
            yield done()

    ship_package(docs.sparkSession)
    hashed = docs.select("text").mapInArrow(hash_lines, "slice int, once binary, twice binary")
    by_slice = hashed.repartition(slices, "slice").sortWithinPartitions("slice")
    filters = [Bloom(log_bits, np.zeros(0, np.uint8)) for _ in range(slices)]
    for row in by_slice.mapInArrow(fill, "slice int, bits binary").collect():  # max_filter_bits at most
        filters[row["slice"]] = Bloom(log_bits, np.frombuffer(row["bits"], np.uint8))
    return filters


def find_repeats(rows: DataFrame, min_docs: int, max_filter_bits: int = 1 << 27) -> DataFrame:
    """``_file``, ``_at``, ``key`` of every row and line key that at least ``min_docs`` documents hold, with its first occurrence.

    ``rows`` has ``doc_id``, ``text`` without nulls, and the keys of rows ``_file`` and ``_at``. ``first`` is the document
    (its doc_id, and the keys of the row where that is null) and the line where the key comes first. ``min_docs`` is 2 or more.
    """
    if min_docs < 2:
        raise ValueError("a repeated line is in two documents at least")
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = rows.agg(F.sum(breaks + 1)).first()[0] or 0
    slices = int(max(1, min(-(-lines // LINES_PER_SLICE), max_filter_bits // (BITS_PER_LINE * LINES_PER_SLICE))))
    log_bits = int(BITS_PER_LINE * LINES_PER_SLICE).bit_length() - 1
    if lines < LINES_PER_SLICE:
        log_bits = max(10, int(BITS_PER_LINE * lines).bit_length())
    shared = rows.sparkSession.sparkContext.broadcast(twice_seen(rows, slices, log_bits))

    def suspect(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        of_row, keys, places = [], [], []
        found: list[dict[bytes, int]] = []
        for text in batch.column("text").to_pylist():
            first: dict[bytes, int] = {}
            for place, key in enumerate(keys_of(text)):
                if key and key not in first:
                    first[key] = place
            found.append(first)
        every = [k for first in found for k in first]
        hashes = hashes_of(every)
        part = slice_of(hashes, slices)
        hit = np.zeros(len(every), bool)
        for number in np.unique(part):
            own = part == number
            if len(shared.value[number].bytes):
                hit[own] = shared.value[number].holds(hashes[own])
        hits = iter(hit.tolist())
        for number, first in enumerate(found):
            for key, place in first.items():
                if next(hits):
                    of_row.append(number)
                    keys.append(key)
                    places.append(place)
        own = [batch.column(c).take(pa.array(of_row, pa.int64())) for c in ("doc_id", "_file", "_at")]
        columns = [*own, pa.array(keys, pa.binary()), pa.array(places, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_file", "_at", "key", "line"])

    held = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "_file", "_at", "text")
    lines_at = map_batches(held, suspect, "doc_id long, _file long, _at long, key binary, line int")
    suspects = stored(lines_at, "line-suspects")
    # a document counts once per key: the map side sends one row per key and document, rows of one doc_id are merged here
    none = F.col("doc_id").isNull()
    document = F.struct(none.alias("none"), "doc_id", *[F.when(none, F.col(c)).alias(c) for c in ("_file", "_at")])
    per_doc = suspects.groupBy("key", document.alias("document")).agg(F.min("line").alias("line"))
    confirmed = (
        per_doc.groupBy("key")
        .agg(F.count("*").alias("n_docs"), F.min(F.struct("document", "line")).alias("first"))
        .where(F.col("n_docs") >= min_docs)
        .select("key", "first")
    )
    # written, so that both sides of the join come straight from a shuffle, which can split a key of very many rows
    confirmed = stored(confirmed, "repeated-lines")
    return suspects.select(document.alias("document"), "_file", "_at", "key").join(confirmed, "key")


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, keep_first: bool = False, *more: str) -> DataFrame:
    """``doc_id``, ``text`` without repeated lines, ``n_lines``, ``n_dropped`` and the columns named in ``more``.

    ``keep_first`` keeps the line where a key comes first of all; otherwise all lines of a repeated key go.
    """
    rows = row_keys(docs, "doc_id", "text", *more)
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    repeats = find_repeats(rows, min_docs)
    here = F.col("first.document").eqNullSafe(F.col("document"))
    first_line = F.when(F.lit(keep_first) & here, F.col("first.line")).otherwise(-1)
    # a row has a drop for each of its own lines at most
    drops = repeats.groupBy("_file", "_at").agg(F.collect_set(F.struct("key", first_line.alias("stays"))).alias("drops"))
    met = rows.join(drops, ["_file", "_at"], "left").drop("_file", "_at")

    def apply(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept_texts, sizes, dropped = [], [], []
        for text, drops in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist()):
            lines = text.split("\n")
            sizes.append(len(lines))
            if drops:
                gone = {d["key"]: d["stays"] for d in drops}
                places = enumerate(zip(lines, keys_of(text)))
                lines = [line for i, (line, key) in places if gone.get(key, i) == i]
                text = "\n".join(lines)
            kept_texts.append(text)
            dropped.append(sizes[-1] - len(lines))
        columns = {n: batch.column(n) for n in batch.schema.names if n not in ("text", "drops")}
        columns |= {
            "text": pa.array(kept_texts, pa.string()),
            "n_lines": pa.array(sizes, pa.int64()),
            "n_dropped": pa.array(dropped, pa.int64()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema if f.name not in ("text", "drops"))
    return map_batches(met, apply, f"{fields}, text string, n_lines long, n_dropped long")
