"""Readers of stored increments.

A store of counts has three folders under its root. ``runs`` holds the counts of each run of a batch, ``tiers`` holds sums over
batches, and ``published`` holds a log: one small entry per publication, written after the files it names. Readers go by the
log alone, so a run that is still being written, or that died, is never seen.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.functions.keys import pair_key
from cotrend.sources.files import matches

COUNTS = "item_a string, item_b string, datetime string, lib_counts bigint"
SCHEMA = f"{COUNTS}, batch_id string, library string"
REPORT = "batch_id string, reason string, n bigint"
LOG = "batch_id string, run string, tier string, merged array<struct<batch_id string, run string>>, entry string"

# The signs that Spark's partition folders hold in percent form, and its name for NULL.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Run(NamedTuple):
    """One published run of a batch."""

    batch_id: str
    run: str


def batch_folder(batch_id: str) -> str:
    """Name of a batch's folder as Spark writes partition folders, so that reading gives the id back."""
    if not batch_id or batch_id == NULL_FOLDER or "\0" in batch_id:
        raise ValueError(f"not a batch id: {batch_id!r}")
    return "batch_id=" + "".join(f"%{ord(sign):02X}" if sign in ESCAPED else sign for sign in batch_id)


def run_folder(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/runs/run={run}"


def tier_folder(root: str, tier: str) -> str:
    return f"{root.rstrip('/')}/tiers/{tier}"


def log_folder(root: str) -> str:
    return f"{root.rstrip('/')}/published"


def report_folder(root: str, run: str) -> str:
    """The drop report of a run; it lies beside the run's batch and is deleted with it."""
    return f"{run_folder(root, run)}/report"


def work_folder(root: str) -> str:
    """A new folder for what one run writes and reads again."""
    return f"{root.rstrip('/')}/work/{uuid.uuid4().hex}"


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    """The publications of a store, ordered by the text ``entry``; None where nothing was ever published."""
    try:
        return spark.read.schema(LOG).json(log_folder(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def published_runs(log: DataFrame) -> list[Run]:
    """The run that counts for each batch: the last one published. Batches that were cleared have none."""
    latest = log.where(F.col("batch_id").isNotNull()).groupBy("batch_id").agg(F.max_by("run", "entry").alias("run"))
    return sorted(Run(*row) for row in latest.where(F.col("run").isNotNull()).collect())  # one row per batch


def read_runs(spark: SparkSession, root: str, runs: list[Run]) -> DataFrame:
    """Counts of the given runs with their ``batch_id``."""
    schema = f"{COUNTS}, run string, batch_id string"
    columns = ["item_a", "item_b", "datetime", "lib_counts", "batch_id"]
    if not runs:
        return spark.createDataFrame([], schema).select(columns)
    paths = [f"{run_folder(root, run)}/{batch_folder(batch_id)}" for batch_id, run in runs]
    return spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/runs").parquet(*paths).select(columns)


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """What became of the files of each published batch: ``batch_id``, ``reason``, ``n``.

    Batches that were written without a report have no rows.
    """
    log = read_log(spark, root)
    runs = [] if log is None else published_runs(log)
    empty = spark.createDataFrame([], REPORT)
    if not runs:
        return empty
    rows = spark.read.schema("reason string, n bigint, run string").option("basePath", f"{root.rstrip('/')}/runs")
    present = {path.rsplit("/", 2)[-2] for path in matches(spark, f"{root.rstrip('/')}/runs/run=*/report")}
    paths = [report_folder(root, run) for _, run in runs if f"run={run}" in present]
    if not paths:
        return empty
    batches = spark.createDataFrame(runs, "batch_id string, run string")
    return rows.json(paths).join(batches, "run").select("batch_id", "reason", "n")


def _keyed(rows: DataFrame, *more: str) -> DataFrame:
    key = pair_key(rows["item_a"], rows["item_b"]).alias("library")
    return rows.select(key, "item_a", "item_b", "datetime", "lib_counts", *more)


def read_increments(spark: SparkSession, root: str) -> DataFrame:
    """All published increments under ``root``; one month of a key may have a row per batch.

    Also reads a table with a folder per key, which has no log. The schema is given, so a key such as ``123`` stays text, a
    store of empty batches reads as an empty table, and so does a root that nothing was written to yet.
    """
    log = read_log(spark, root)
    if log is not None:
        return _keyed(read_runs(spark, root, published_runs(log)), "batch_id")
    try:
        rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], SCHEMA)
    return _keyed(rows, "batch_id")


def read_counts(spark: SparkSession, root: str, runs: list[Run] | None = None) -> DataFrame:
    """All published increments, or those of the given runs, added up: one row per key and month.

    Starts from the last compaction, if there is one. Batches it does not hold are added; of a batch that ran again since,
    the run that it holds is taken off again, so every batch counts once. Filters on the items reach all scans.
    """
    log = read_log(spark, root)
    last = [] if log is None else log.where(F.col("tier").isNotNull()).orderBy(F.desc("entry")).limit(1).collect()
    if not last:
        rows = read_increments(spark, root) if runs is None else read_runs(spark, root, runs)
        return _keyed(_summed(rows))
    held, now = {Run(*pair) for pair in last[0].merged}, set(published_runs(log) if runs is None else runs)
    tier = spark.read.schema(COUNTS).parquet(tier_folder(root, last[0].tier))
    if held == now:
        return _keyed(tier)
    less = read_runs(spark, root, sorted(held - now)).withColumn("lib_counts", -F.col("lib_counts"))
    rows = tier.unionByName(read_runs(spark, root, sorted(now - held)).drop("batch_id")).unionByName(less.drop("batch_id"))
    return _keyed(_summed(rows).where(F.col("lib_counts") != 0))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item_a", "item_b", "datetime").agg(F.sum("lib_counts").alias("lib_counts"))
