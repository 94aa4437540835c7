"""Count tables as files.

A count table has one row per key and month, so no key is large, whatever the input looked like.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.sources.files import matches
from cotrend.sources.increments import (
    LOG,
    batch_folder,
    log_folder,
    published_runs,
    read_counts,
    read_log,
    report_folder,
    run_folder,
    tier_folder,
)

#: The key is ``item_a`` and ``item_b``; ``library`` is its text, which two keys can share.
STORED = ("item_a", "item_b", "datetime", "lib_counts")


def append_by_key(counts: DataFrame, path: str) -> None:
    """Append to a table with one folder per key text. A second run of the same batch counts twice.

    For small catalogues: the number of folders grows with the square of the tools. One folder
    gets one file per append. Opening folders is the work here, not the rows, so the tasks are as many as the session's
    shuffle partitions: left to itself, adaptive execution gathers the few rows in one task that opens every folder.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_key = counts.select("library", *STORED).repartition(tasks, "library")
    by_key.write.partitionBy("library").mode("append").parquet(path)


def _new_run(spark: SparkSession, root: str) -> str:
    """Name of a new run. A root of batches without a log is refused, as its batches would vanish from sight."""
    if read_log(spark, root) is None and matches(spark, f"{root.rstrip('/')}/batch_id=*"):
        raise ValueError(f"{root} has batches without a log of publications; write them to a new root")
    return uuid.uuid4().hex


def _publish(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Add one entry to the log. It is a single file that appears by a rename, so readers see all of it or nothing.

    Entries are ordered by number. Two writers at once may take the same number; for different batches that makes no
    difference, and of two runs of one batch the last in order of the entries' names counts.
    """
    log = read_log(spark, root)
    last = "" if log is None else log.agg(F.max("entry")).first()[0] or ""
    number = int(last.split("-")[0] or 0) + 1
    entry = spark.createDataFrame(rows, LOG.rsplit(", ", 1)[0]).coalesce(1)
    entry.write.json(f"{log_folder(root)}/entry={number:012d}-{uuid.uuid4().hex}")


def _curve() -> Column:
    """Sort key that takes letters of both items in turn, so that rows close in it are close in either item."""
    return F.arrays_zip(F.split("item_a", ""), F.split(F.coalesce("item_b", F.lit("")), ""))


def _sorted_rows(counts: DataFrame, *first: str) -> DataFrame:
    """Few files for any number of pairs, whose parts hold few first and few second items.

    Single tools come first, then pairs along an interleaved key: a filter on either item skips files, row groups and pages by
    their smallest and largest names, which a sort by ``item_a`` would only do for the first one.
    """
    order = [*first, F.col("item_b").isNotNull(), _curve()]
    dealt = counts.select(*first, *STORED).repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order, "item_a", "item_b", "datetime")


def write_increment(counts: DataFrame, root: str, batch_id: str, report: DataFrame | None = None) -> None:
    """Write the counts of one batch; a second run of the batch takes the place of the first.

    Every run has a folder of its own and is published when it is complete. Until then, and if it fails, readers see
    the run before it. An empty run replaces too, so keys that a second run no longer has do not stay behind.
    ``report`` (``reason``, ``n``; a few rows) is published with the counts.
    """
    run = _new_run(counts.sparkSession, root)
    _sorted_rows(counts).write.parquet(f"{run_folder(root, run)}/{batch_folder(batch_id)}")
    if report is not None:
        report.select("reason", "n").coalesce(1).write.json(report_folder(root, run))
    _publish(counts.sparkSession, root, [(batch_id, run, None, None)])


def write_increments(counts: DataFrame, root: str, batches: list[str] | None = None) -> None:
    """Write the counts of several batches, told apart by ``batch_id``, with one job, and publish them together.

    Batches that occur in ``counts`` are replaced as a whole, others stay. ``batches`` names the batches that ran: one that
    has no row is cleared, and a row of any other is an error. So is a row whose id is null or empty. After an error
    nothing is published.
    """
    for batch_id in batches or []:
        batch_folder(batch_id)
    spark = counts.sparkSession
    run = _new_run(spark, root)
    _sorted_rows(counts, "batch_id").write.partitionBy("batch_id").parquet(run_folder(root, run))
    written = spark.read.schema("datetime string, batch_id string").parquet(run_folder(root, run))
    found = {row.batch_id for row in written.select("batch_id").distinct().collect()}  # one row per batch
    if None in found:
        raise ValueError("counts have rows without a batch id; nothing was published")
    if batches is not None and found - set(batches):
        raise ValueError(f"counts have rows of other batches, such as {min(found - set(batches))!r}; nothing was published")
    runs = [(batch_id, run if batch_id in found else None, None, None) for batch_id in sorted(found | set(batches or []))]
    if runs:
        _publish(spark, root, runs)


def compact_increments(spark: SparkSession, root: str) -> None:
    """Add up all published batches once; ``read_counts`` starts from these sums from then on.

    The sums are published with the list of runs they hold. Batches written while this runs are not in the list, and are
    added by readers. The runs stay, for views by batch and for batches that run again.
    """
    log = read_log(spark, root)
    if log is None:
        return
    tier, runs = uuid.uuid4().hex, published_runs(log)
    _sorted_rows(read_counts(spark, root, runs)).write.parquet(tier_folder(root, tier))
    _publish(spark, root, [(None, None, tier, [tuple(run) for run in runs])])


def remove_unpublished(spark: SparkSession, root: str) -> list[str]:
    """Delete folders of runs and sums that no reader needs any more; returns their names.

    Only while nothing writes to the store: a run that is not published yet looks like one that died.
    """
    log = read_log(spark, root)
    if log is None:
        return []
    last = log.where(F.col("tier").isNotNull()).orderBy(F.desc("entry")).limit(1).collect()
    needed = {f"run={run}" for _, run in published_runs(log)}
    needed |= {f"run={pair.run}" for row in last for pair in row.merged} | {row.tier for row in last}
    removed = []
    for pattern in ("runs/run=*", "tiers/*", "work/*"):
        for found in matches(spark, f"{root.rstrip('/')}/{pattern}"):
            name = found.rsplit("/", 1)[-1]
            if name not in needed:
                delete_folder(spark, found)
                removed.append(name)
    return sorted(removed)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
