"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.session import scratch_path

#: White space of the text contracts, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null counts as empty) and the columns named in ``more``."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def crc_remainder(key: Column, divisor: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % F.lit(divisor)


#: Where the paths of scratch tables are noted, if anybody wants to delete them later.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


@contextmanager
def noted_scratch() -> Iterator[list[str]]:
    """The paths of the scratch tables that are written inside the block."""
    paths: list[str] = []
    token = _noted.set(paths)
    try:
        yield paths
    finally:
        _noted.reset(token)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more, in whatever file system they are."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def row_keys(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` with two whole numbers, ``_file`` and ``_at``, that tell rows apart and are the same at every read.

    A Parquet table that is read as it is has them already: a hash of the file's name and the row's place in the file. Any
    other frame is written once, as what computes it may deal its rows otherwise the next time.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = stored(docs.select(*columns), "numbered")
    return docs.select(*columns, F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared scratch folder and read again.

    The lineage is cut there: what follows survives lost executors without recomputing ``df``.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    noted = _noted.get()
    if noted is not None:
        noted.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def flag_bits(rows: DataFrame, key: Column, keys: DataFrame, name: str, log_bits: int = 22) -> DataFrame:
    """``rows`` with a boolean column ``name``: whether the 64-bit hash ``key`` may be in the only column of ``keys``.

    Never false for a key that is there; true for a few that are not. The keys become a bit set of fixed size,
    ``2 ** log_bits`` bits in at most ``2 ** (log_bits - 6)`` rows of 16 bytes. That bound holds for any number of keys, so
    these rows are broadcast; with very many keys all flags are true.
    """
    place = lambda c: F.shiftrightunsigned(c, 64 - log_bits)
    of_key = place(F.col(keys.columns[0]))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (of_key % 64).cast("int"))
    words = keys.groupBy(F.shiftright(of_key, 6).alias("_word")).agg(F.bit_or(one).alias("_mask"))
    held = rows.withColumn("_place", place(key))
    met = held.join(F.broadcast(words), F.shiftright("_place", 6) == F.col("_word"), "left")
    bit = F.call_function("getbit", F.col("_mask"), (F.col("_place") % 64).cast("int"))
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(bit == 1, F.lit(False)).alias(name))


def screen_bits(rows: DataFrame, key: Column, keys: DataFrame, log_bits: int = 22) -> DataFrame:
    """The rows whose key may be in ``keys``: no right row is lost, a few wrong ones stay."""
    return flag_bits(rows, key, keys, "_may", log_bits).where("_may").drop("_may")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the executors' Python, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``function`` on parts of the Arrow batches, of bounded rows and bytes, so that what is made of them stays small."""

    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch):
                yield from function(part)

    return df.mapInArrow(run, schema)


ROWS_AT_ONCE = 1000
BYTES_AT_ONCE = 8 << 20


def in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows = max(1, min(ROWS_AT_ONCE, batch.num_rows * BYTES_AT_ONCE // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
