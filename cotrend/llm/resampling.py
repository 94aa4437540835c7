"""Importance resampling towards a target distribution, by bit-sliced aggregation.

Texts are counted as hashed features: every word and every run of two words falls into one of 10000 buckets. A bucket's gain is
the whole-numbered log ratio of its smoothed share in the target texts and in all documents; a document's weight is the
floored mean of the gains of its features. The counts of a document are held as bit planes: plane ``k`` has one bit for every
bucket, bit ``k`` of that bucket's count. The gains are held likewise, as planes of the magnitudes of the positive and of the
negative ones. The sum of count times gain is then the sum of ``2 ** (k + j)`` times the number of bits that plane ``k`` of the
counts and plane ``j`` of the gains have in common, with the sign of the gains: whole numbers only, so weights are exact.

Two passes read the texts: one adds up counts per bucket (at most 10000 rows a task are shuffled, and the driver gets 10000
sums), the other weighs every document; texts never move. The draw sorts narrow rows by ranges of (score, doc_id, row) and
numbers each range on its own, so neither one score nor one doc_id can fill a task. What is held per task is bounded by parts
of texts (``PART_BYTES``), never by a whole batch.

Cases: a null text counts as empty; an empty text, or one without a word, has no features and weight 0, and is never drawn
if ``least_words`` is over 0; texts of any length are read whole, in parts that are cut between words; a null doc_id is hashed
as the empty text and comes after all others; rows that repeat a doc_id are scored, counted and ranked each on its own, ties to
the smaller doc_id, and rows equal in score and doc_id take their ranks in any order; an empty table gives no rows, an empty
target leaves a flat share; other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import map_batches, ship_package, stored

BUCKETS = 10_000
WORDS_OF_PLANE = -(-BUCKETS // 64)
#: Bytes of text whose features are held at once.
PART_BYTES = 4 << 20
#: Words up to so many bytes are hashed side by side, longer ones on their own.
SIDE_BY_SIDE = 48

# Fixed value: the reversed polynomial of crc32.
POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


TABLE = _crc_table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words once A-Z are lower-cased: digits, a-z and all bytes of characters beyond ASCII.
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def _feed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The crc32 states after the bytes of each word, from the states before them."""
    order = np.argsort(-lengths, kind="stable")
    state, starts, lengths = state[order], starts[order], lengths[order]
    long = int(np.searchsorted(-lengths, -SIDE_BY_SIDE, side="left"))  # so many words are longer
    for i in range(long):
        word = data[starts[i] : starts[i] + lengths[i]].tobytes()
        state[i] = zlib.crc32(word, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    state_, starts, lengths = state[long:], starts[long:], lengths[long:]
    for j in range(int(lengths[0]) if len(lengths) else 0):
        k = int(np.searchsorted(-lengths, -j, side="left"))  # those with more than j bytes
        own = state_[:k]
        state_[:k] = TABLE[(own ^ data[starts[:k] + j]) & 255] ^ (own >> 8)
    out = np.empty_like(state)
    out[order] = state
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and the text and bucket of every feature; text ``i`` is ``data[offsets[i]:offsets[i + 1]]`` in UTF-8.

    The buckets of the words come first, in the order of the texts, then those of the runs of two.
    """
    data = LOWER[data]
    inside = IN_WORD[data]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    texts = np.searchsorted(offsets, starts, side="right") - 1
    words = np.bincount(texts, minlength=len(offsets) - 1)
    one = _feed(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, lengths)
    first = np.flatnonzero(texts[1:] == texts[:-1])
    spaced = TABLE[(one[first] ^ np.uint32(32)) & 255] ^ (one[first] >> 8)
    two = _feed(spaced, data, starts[first + 1], lengths[first + 1])
    buckets = (np.concatenate([one, two]) ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % BUCKETS
    return words, np.concatenate([texts, texts[first]]), buckets


def _parts(text: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Parts of a long text, cut between words; with the last word so far before each (then true) to pair with its first."""
    start, last = 0, text[:0]
    while start < len(text):
        stop = start + PART_BYTES
        while stop < len(text) and IN_WORD[LOWER[text[stop]]]:
            ahead = IN_WORD[LOWER[text[stop : stop + PART_BYTES]]]
            stop += len(ahead) if ahead.all() else int(np.argmin(ahead))
        part = text[start:stop]
        yield (np.concatenate([last, np.full(1, 32, np.uint8), part]), True) if len(last) else (part, False)
        inside = IN_WORD[LOWER[part]]
        if inside.any():
            end = len(inside) - int(np.argmax(inside[::-1]))
            outside = np.flatnonzero(~inside[:end])
            last = part[int(outside[-1]) + 1 if len(outside) else 0 : end]
        start = stop


def text_buffers(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without nulls, and the places where they begin and the last one ends."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def counts_of_texts(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each bounded run of texts: their places, words, and (text, bucket, count) of their features, sorted."""
    data, offsets = text_buffers(batch)
    first = 0
    while first < len(batch):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PART_BYTES, side="right")) - 1)
        if offsets[last] - offsets[first] <= PART_BYTES:
            own = offsets[first : last + 1]
            words, texts, buckets = features(data[own[0] : own[-1]], own - own[0])
            key = np.sort(texts * BUCKETS + buckets)
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            counts = np.diff(np.concatenate([new, [len(key)]]))
            texts, buckets = np.divmod(key[new], BUCKETS)
        else:  # one long text
            words, total = np.zeros(1, np.int64), np.zeros(BUCKETS, np.int64)
            for part, again in _parts(data[offsets[first] : offsets[last]]):
                own_words, _, buckets = features(part, np.array([0, len(part)]))
                words += own_words - again
                total += np.bincount(buckets[again:], minlength=BUCKETS)
            buckets = np.flatnonzero(total)
            texts, counts = np.zeros(len(buckets), np.int64), total[buckets]
        yield slice(first, last), words, texts, buckets, counts
        first = last


def bit_planes(texts: np.ndarray, buckets: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The planes of whole numbers of 0 or more, given by ascending (text, bucket).

    For each bit that any value has: the bit, the texts with such a value, and their planes as rows of 64-bit words.
    """
    for k in range(int(values.max()).bit_length() if len(values) else 0):
        has = np.flatnonzero((values >> k) & 1)
        if not len(has):
            continue
        own, rows = np.unique(texts[has], return_inverse=True)
        word = rows * WORDS_OF_PLANE + (buckets[has] >> 6)
        bit = np.uint64(1) << (buckets[has] & 63).astype(np.uint64)
        new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        planes = np.zeros(len(own) * WORDS_OF_PLANE, np.uint64)
        planes[word[new]] = np.bitwise_or.reduceat(bit, new)
        yield k, own, planes.reshape(len(own), WORDS_OF_PLANE)


def signed_planes(gains: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(bit, sign, plane) of the magnitudes of the positive and of the negative gains."""
    places = np.arange(BUCKETS)
    return [
        (j, sign, plane[0])
        for sign in (1, -1)
        for j, _, plane in bit_planes(np.zeros(BUCKETS, np.int64), places, np.maximum(sign * gains, 0))
    ]


def gain_sums(n: int, texts: np.ndarray, buckets: np.ndarray, counts: np.ndarray, gains: list) -> np.ndarray:
    """Sum of count times gain of ``n`` texts, from the bits that their planes share with those of the gains."""
    total = np.zeros(n, np.int64)
    for k, own, planes in bit_planes(texts, buckets, counts):
        for j, sign, plane in gains:
            shared = np.bitwise_count(planes & plane).sum(axis=1, dtype=np.int64)
            total[own] += sign * (shared << (k + j))
    return total


def bucket_counts(docs: DataFrame) -> DataFrame:
    """``bucket``, ``n``: the features of all texts."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, buckets, counts in counts_of_texts(batch):
                total += np.bincount(buckets, counts, BUCKETS).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    found = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(count, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket: ``floor(1000 * ln((t + 1) * (S + 10000) / ((s + 1) * (T + 10000))))`` in doubles."""
    sums = np.zeros((2, BUCKETS), np.int64)
    both = bucket_counts(docs).select("bucket", "n", F.lit(0).alias("of"))
    both = both.unionByName(bucket_counts(target).select("bucket", "n", F.lit(1).alias("of")))
    for row in both.collect():  # at most 10000 buckets of either
        sums[row["of"], row["bucket"]] = row["n"]
    all_s, all_t = (float(x) + BUCKETS for x in sums.sum(axis=1))
    ratio = lambda s, t: (t + 1.0) * all_s / ((s + 1.0) * all_t)
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in sums.T.tolist()], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` of every document."""
    planes = signed_planes(gains)

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for run, words, texts, buckets, counts in counts_of_texts(batch):
            n = run.stop - run.start
            features_ = np.bincount(texts, counts, n).astype(np.int64)
            weight = gain_sums(n, texts, buckets, counts, planes) // np.maximum(features_, 1)
            ids = batch.column(batch.schema.get_field_index("doc_id")).slice(run.start, n)
            columns = [ids, pa.array(words.astype(np.int64)), pa.array(features_), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    schema = "doc_id long, n_words long, n_features long, weight long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return map_batches(rows, measure, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """A whole-numbered Gumbel draw that depends on the seed and the doc_id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(-1000 * F.log(-F.log((number + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the ``percent`` highest scores of the documents with enough words."""
    rows = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    asks = rows.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    dealt = asks.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id holds the range in its upper and the place within it in its lower 33 bits
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "ordered")
    range_of = F.shiftright("at", 33)
    sizes = sorted(dealt.groupBy(range_of.alias("range")).agg(F.count("*").alias("n")).collect())  # one row a range
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    drawn = percent * total // 100
    before = scored.sparkSession.createDataFrame(starts, "range long, before long")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = dealt.withColumn("range", range_of).join(F.broadcast(before), "range")
    ranked = ranked.select(*scored.columns, F.when(place <= drawn, place).alias("rank"))
    rest = rows.where(~F.coalesce(F.col("n_words") >= least_words, F.lit(False)))
    return ranked.unionByName(rest.select(*scored.columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank`` of every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``, ``target`` has ``text``.
    """
    weighed = weigh(docs, bucket_gains(docs, target))
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(scored, percent, least_words)
