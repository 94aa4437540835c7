"""One batch: notebook files to stored monthly counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.functions.keys import entity_id_from_path
from cotrend.operators.catalogue import catalogue_span
from cotrend.operators.counts import (
    find_baskets,
    judge_files,
    report_of_judged,
    usage_of_baskets,
    usage_of_equal_baskets,
)
from cotrend.operators.extract import extract_imports
from cotrend.operators.relation import date_entities, relation_of_files
from cotrend.sinks.increments import delete_folder, write_increment
from cotrend.sources.catalogue_file import load_catalogue
from cotrend.sources.files import list_files, read_relation, read_repo_metadata, refuse_hidden, scan_lines
from cotrend.sources.increments import published_runs, read_increments, read_log, work_folder
from cotrend.sources.metadata import read_metadata
from cotrend.sources.packed import pack_lines, pack_names, read_ledger, read_packed
from cotrend.sources.records import read_records


def notebook_usage(
    lines: DataFrame, relation: DataFrame, metadata: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """Monthly counts of tools and pairs.

    ``lines`` is path, line; ``relation`` nb_id, repo_id; ``metadata`` repo_id, updated_at. Baskets
    are formed per file and meet the relation afterwards, so two files of one id count twice, as
    does a file listed twice in the relation.
    """
    span = catalogue_span(catalogue)
    names = extract_imports(lines, distinct=False)
    found = find_baskets(names, catalogue, span, by="path")
    found = found.select(entity_id_from_path(F.col("path")).alias("nb_id"), "basket")
    dated = date_entities(relation, metadata)
    return usage_of_baskets(found, dated, catalogue, span, by="nb_id")


def notebook_drop_report(
    lines: DataFrame, relation: DataFrame, metadata: DataFrame, catalogue: DataFrame
) -> DataFrame:
    """What became of the files of ``notebook_usage``: ``reason``, ``n``.

    Reasons are ``no relation row``, ``no date``, ``no catalogued item`` and ``counted``, in this
    order; every file with a line is in one of them, once for each of its relation rows.
    """
    paths = lines.select("path").distinct()
    return report_of_judged(_judged(lines, paths, relation, metadata, catalogue, catalogue_span(catalogue)))


def _judged(
    lines: DataFrame, paths: DataFrame, relation: DataFrame, metadata: DataFrame, catalogue: DataFrame, span: int
) -> DataFrame:
    found = find_baskets(extract_imports(lines, distinct=False), catalogue, span, by="path")
    return judge_files(paths, found, date_entities(relation, metadata, keep_undated=True))


def count_batch(
    lines: DataFrame,
    paths: DataFrame,
    relation: DataFrame,
    metadata: DataFrame,
    catalogue: DataFrame,
    root: str,
    batch_id: str,
) -> None:
    """Store the counts of ``notebook_usage`` and the figures of ``notebook_drop_report`` from one scan of the lines.

    ``paths`` has the ``path`` of every file that has a line, which a listing knows without opening files. Equal baskets are
    written once under ``root``; counts and report are read from there, and are published together. (Accumulators, as in
    ``observe``, could count rows twice when tasks of a lost executor run again.)
    """
    spark, span = lines.sparkSession, catalogue_span(catalogue)
    path = work_folder(root)
    try:
        _judged(lines, paths, relation, metadata, catalogue, span).write.parquet(path)
        judged = spark.read.parquet(path)
        equal = judged.where(F.col("reason") == "counted").drop("reason")
        counts = usage_of_equal_baskets(equal, catalogue, span)
        write_increment(counts, root, batch_id, report=report_of_judged(judged))
    finally:
        delete_folder(spark, path)


def _tables(
    spark: SparkSession, relation_path: str, metadata_path: str, catalogue_path: str, multiline: bool, stored: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    relation = read_records(spark, relation_path) if multiline else read_relation(spark, relation_path, multiline=False)
    metadata = read_metadata(spark, metadata_path) if stored else read_repo_metadata(spark, metadata_path)
    return relation, metadata, load_catalogue(spark, catalogue_path)


def run_batch(
    spark: SparkSession,
    folders: list[str],
    relation_path: str,
    metadata_path: str,
    catalogue_path: str,
    root: str,
    batch_id: str,
    multiline: bool = True,
    stored_metadata: bool = False,
) -> DataFrame:
    """Process the notebook folders of a batch and store the counts; returns the stored counts.

    What became of the batch's files is stored beside them, see ``read_report``.

    The relation is read by many tasks, however large one file is; ``multiline=False`` saves a shuffle where no field holds a
    line break. ``stored_metadata`` says that ``metadata_path`` was written by ``write_metadata``: then the dates of the
    batch's own repositories are looked up, not those of all.
    """
    refuse_hidden(spark, folders)
    relation, metadata, catalogue = _tables(spark, relation_path, metadata_path, catalogue_path, multiline, stored_metadata)
    listed = list_files(spark, folders)
    if stored_metadata:
        relation = relation_of_files(relation, listed)
    count_batch(scan_lines(spark, folders), listed, relation, metadata, catalogue, root, batch_id)
    stored = read_increments(spark, root)
    return stored.where(F.col("batch_id") == batch_id)


def run_batches(
    spark: SparkSession,
    folders: list[str],
    relation_path: str,
    metadata_path: str,
    catalogue_path: str,
    root: str,
    multiline: bool = True,
) -> DataFrame:
    """One increment per folder, with the folder's name as id; returns the stored counts of all of them.

    The driver lists one folder at a time, so the number of files is bounded by the largest folder.
    If a run stops, run it again: finished folders are replaced by the same counts.
    """
    ids = [folder.rstrip("/").rsplit("/", 1)[-1] for folder in folders]
    if len(set(ids)) < len(ids):
        raise ValueError("two folders have one name, so one batch would replace the other")
    for folder, batch_id in zip(folders, ids):
        run_batch(spark, [folder], relation_path, metadata_path, catalogue_path, root, batch_id, multiline)
    return read_increments(spark, root).where(F.col("batch_id").isin(ids))


def run_new_files(
    spark: SparkSession,
    folders: list[str],
    relation_path: str,
    metadata_path: str,
    catalogue_path: str,
    root: str,
    store: str,
    multiline: bool = True,
) -> DataFrame:
    """Count the files that were added to the folders since the last call; returns the counts this call stored.

    The new files are packed into ``store`` and become one batch, named by their pack. Packs whose counts were not published,
    because a run died in between, are counted too, so calling again is always safe and no file counts twice.
    """
    pack_lines(spark, folders, store)
    log = read_log(spark, root)
    counted = set() if log is None else {run.batch_id for run in published_runs(log)}
    waiting = [pack for pack in pack_names(spark, store) if pack not in counted]
    if waiting:
        tables = _tables(spark, relation_path, metadata_path, catalogue_path, multiline)
        for pack in waiting:
            paths = read_ledger(spark, store).where(F.col("pack") == pack)
            count_batch(read_packed(spark, store, [pack]), paths, *tables, root, pack)
    return read_increments(spark, root).where(F.col("batch_id").isin(waiting))
