"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased, everything but letters becomes a space, and each run of 2, 3 and 4 bytes is hashed to a row of an
embedding table. The mean of these rows goes through a linear softmax. Embeddings and softmax are trained by
stochastic gradient descent in numpy on a bounded sample; a part of the sample is kept back to fit the temperature
of the softmax and the score below which a prediction is marked as rejected.

Since both layers are linear, a row of the table and the softmax collapse into one score per language, and a text is
scored by summing those: no embedding is formed at prediction time.

Bounds: ``sample_rows`` training rows in all, shared evenly by all languages, but ``least_rows`` for each; a table with so many
languages that this would pass ``most_rows`` is an error, none is left out in silence. Only counts per hashed run reach the
driver, at most ``row_entries`` a row (of a training text with more different runs the most frequent count), so 20 MB to 80 MB
for ``sample_rows`` and 400 MB at ``most_rows``. Every text is scored whole; with many languages it is scored through its
embedding, so a text needs ``DIMENSION`` numbers a byte at most.

Cases: a null text, or one without a letter, gets ``und`` with score 0 and is marked as rejected, and so does every
text when there is nothing to learn from (an empty table, for one); null languages teach nothing; a language learned from one row is a language;
ties go to the language that is first in code-point order; rows that agree in doc_id and language teach once (by the first
text in order), rows without a doc_id too; very long texts take part whole; columns beside ``doc_id``, ``text`` and ``lang`` are
left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotrend.llm.common import map_batches

NO_LANGUAGE = "und"
SIZES = (2, 3, 4)
TABLE_BITS = 15
DIMENSION = 16
#: Lower-case ASCII letters and all bytes beyond ASCII stay, others become a space.
LETTER_BYTES = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
GAP = b" " * max(SIZES)
CHARS_AT_ONCE = 4_000_000


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # one row per hashed run, one column per language, divided by the temperature
    bias: np.ndarray
    weights: np.ndarray | None  # with more languages than dimensions, ``scores`` are embeddings and meet these weights
    reject_below: float


def hashed_runs(buffer: np.ndarray, size: int) -> np.ndarray:
    """Table rows of all runs of ``size`` bytes, one per starting place."""
    out = np.full(len(buffer) - size + 1, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(size):
        out ^= buffer[k : len(buffer) - size + 1 + k]
        out *= np.uint32(0x01000193)
    out ^= out >> np.uint32(15)
    return out & np.uint32((1 << TABLE_BITS) - 1)


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as letters in one buffer with gaps between, and the first byte of each, one more at the end."""
    raw = [t.lower().encode("utf-8", "replace").translate(LETTER_BYTES) for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + len(GAP) for r in raw], out=starts[1:])
    return np.frombuffer(GAP.join(raw) + 2 * GAP, np.uint8), starts


def run_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    buffer, starts = joined([text])
    rows = np.concatenate([hashed_runs(buffer, s)[: starts[1]] for s in SIZES])
    return np.unique(rows, return_counts=True)


def most_frequent(rows: np.ndarray, counts: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``entries`` most frequent runs, ties to the smaller hash, in order of their hashes."""
    if len(rows) <= entries:
        return rows, counts
    best = np.sort(np.argsort(-counts, kind="stable")[:entries])
    return rows[best], counts[best]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, sample_rows: int, least_rows: int, most_rows: int, seed: int) -> DataFrame:
    """Different ``doc_id``, ``lang``: of each language the first rows by a hashed place, an even share for all.

    Only rows that can be learned from are counted and drawn, so no language of the table is left out.
    """
    place = F.xxhash64(F.col("doc_id"), F.lit(seed))
    known = docs.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select("doc_id", "lang", place.alias("place"))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    found = sizes.limit(most_rows // least_rows + 1).collect()  # one row per language
    if len(found) * least_rows > most_rows:
        raise ValueError(f"there are more than {most_rows // least_rows} languages to learn; raise most_rows")
    if not found:
        return known.select("doc_id", "lang").limit(0)
    share = max(least_rows, sample_rows // len(found))
    # a few times the share pass by chance, the first place of a language always does; ranks then cut what is too much
    cut = [(r.lang, min(1.0, (4 * share + 20) / r.n), r.first) for r in found]
    cuts = F.broadcast(docs.sparkSession.createDataFrame(cut, "lang string, fraction double, first long"))
    chance = F.col("place") / F.lit(2.0**64) + F.lit(0.5)
    low = known.join(cuts, "lang").where((chance < F.col("fraction")) | (F.col("place") == F.col("first")))
    drawn = low.select("doc_id", "lang", "place").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))
    return drawn.withColumn("rank", rank).where(F.col("rank") <= share).select("doc_id", "lang")


def fit(
    docs: DataFrame,
    sample_rows: int = 2400,
    least_rows: int = 6,
    most_rows: int = 12_000,
    row_entries: int = 4096,
    epochs: int = 8,
    seed: int = 11,
) -> Model | None:
    """Train on ``doc_id``, ``text``, ``lang``; None when no row can be learned from."""
    chosen = training_rows(docs.select("doc_id", "text", "lang"), sample_rows, least_rows, most_rows, seed)
    pairs = chosen.select(F.col("doc_id").alias("of_doc"), F.col("lang").alias("of_lang"))
    usable = docs.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("lang") == F.col("of_lang"))
    met = usable.join(F.broadcast(pairs), same)  # at most sample_rows, or most_rows with very many languages
    # a doc_id may have any number of rows; one text for each pair keeps what reaches the driver bounded
    rows = met.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [most_frequent(*run_counts(t), row_entries) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array([x for x, _ in found], pa.list_(pa.int32())),
                pa.array([y for _, y in found], pa.list_(pa.int32())),
            ],
            ["doc_id", "lang", "rows", "counts"],
        )

    counted = map_batches(
        rows.select(F.col("doc_id").cast("long"), "text", "lang"),
        count,
        "doc_id long, lang string, rows array<int>, counts array<int>",
    )
    sample = counted.toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    if not sample.num_rows:
        return None
    names = sample["lang"].to_pylist()
    languages = sorted(set(names), key=lambda x: x.encode())
    target = np.array([languages.index(x) for x in names])
    order = np.random.default_rng(seed).permutation(len(target))
    inputs = []
    for rows, counts in zip(sample["rows"], sample["counts"]):
        n = counts.values.to_numpy()
        inputs.append((rows.values.to_numpy(), (n / n.sum()).astype(np.float32)))
    kept_back = order[::6] if len(order) >= 60 else order
    learned = np.setdiff1d(order, kept_back) if len(order) >= 60 else order
    table, weights, bias = descend(inputs, target, learned, len(languages), epochs, seed)
    logits = np.stack([inputs[i][1] @ table[inputs[i][0]] for i in kept_back]) @ weights + bias
    temperature, reject = calibrate(logits, target[kept_back])
    weights, bias = (weights / temperature).astype(np.float32), bias / temperature
    if len(languages) > DIMENSION:
        return Model(languages, table, bias, weights, reject)
    return Model(languages, table @ weights, bias, None, reject)


def descend(inputs, target, learned, n_languages: int, epochs: int, seed: int, rate: float = 1.0, batch: int = 16):
    """Plain stochastic gradient descent with a linearly falling rate."""
    random = np.random.default_rng(seed)
    table = random.uniform(-1, 1, (1 << TABLE_BITS, DIMENSION)).astype(np.float32) / DIMENSION
    weights = np.zeros((DIMENSION, n_languages), np.float32)
    bias = np.zeros(n_languages, np.float32)
    steps = max(1, epochs * -(-len(learned) // batch))
    step = 0
    for _ in range(epochs):
        shuffled = random.permutation(learned)
        for start in range(0, len(shuffled), batch):
            some = shuffled[start : start + batch]
            lr = rate * (1 - step / steps)
            hidden = np.stack([inputs[i][1] @ table[inputs[i][0]] for i in some])
            grad = softmax(hidden @ weights + bias)
            grad[np.arange(len(some)), target[some]] -= 1
            back = grad @ weights.T
            weights -= lr * hidden.T @ grad
            bias -= lr * grad.sum(0) / batch
            for i, b in zip(some, back):
                table[inputs[i][0]] -= (lr * 20) * inputs[i][1][:, None] * b
            step += 1
    return table, weights, bias


def softmax(logits: np.ndarray) -> np.ndarray:
    out = np.exp(logits - logits.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def calibrate(logits: np.ndarray, target: np.ndarray, wanted: float = 0.99) -> tuple[float, float]:
    """The temperature of least log loss (scores are never sharpened), and the lowest score from which the share of right answers is as wanted."""
    rows = np.arange(len(target))
    loss = lambda t: -np.log(softmax(logits / t)[rows, target] + 1e-12).mean()
    temperature = min(np.geomspace(1, 20, 41), key=loss)
    sure = softmax(logits / temperature)
    order = np.argsort(-sure.max(1), kind="stable")
    right = (sure.argmax(1) == target)[order].cumsum() / (rows + 1)
    enough = np.flatnonzero(right >= wanted)
    return float(temperature), float(sure.max(1)[order][enough[-1]]) if len(enough) else 1.0


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``rejected`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: list[str]) -> np.ndarray:
        m = shared.value
        buffer, starts = joined(texts)
        total = np.zeros((len(texts), m.scores.shape[1]))
        for size in SIZES:
            rows = m.scores[hashed_runs(buffer, size)[: starts[-1]]]
            total += np.add.reduceat(rows, starts[:-1], axis=0)
        mean = total / (len(SIZES) * np.diff(starts))[:, None]
        return softmax((mean if m.weights is None else mean @ m.weights) + m.bias)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = shared.value
        texts = batch.column("text").to_pylist()
        lettered = batch.column("lettered").to_pylist()
        names, best = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
        todo = [i for i, x in enumerate(lettered) if x] if m else []
        start, most = 0, CHARS_AT_ONCE // (1 if not m or m.weights is None else 4)
        while start < len(todo):
            end, chars = start, 0
            while end < len(todo) and (end == start or chars + len(texts[todo[end]]) <= most):
                chars += len(texts[todo[end]])
                end += 1
            sure = score([texts[i] for i in todo[start:end]])
            for i, k, s in zip(todo[start:end], sure.argmax(1), sure.max(1)):
                names[i], best[i] = m.languages[k], s
            start = end
        rejected = best < m.reject_below if m else np.ones(len(texts), bool)
        rejected |= ~np.array(lettered, bool)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(best), pa.array(rejected)],
            ["doc_id", "lang_pred", "score", "rejected"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text", has_letter(F.col("text")).alias("lettered"))
    return map_batches(rows, run, "doc_id long, lang_pred string, score double, rejected boolean")
