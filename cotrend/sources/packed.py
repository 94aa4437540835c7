"""Lines of many small files, packed once into few Parquet files, with a ledger of the files they came from.

``lines`` holds a folder per pack, ``ledger`` one row per file: its path, length, time of change and pack. The ledger is written
after the lines, and readers go by it, so a pack that died is neither read nor missed: its files are packed by the next run.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.sources.files import LINE_COLUMNS, read_present, refuse_hidden, scan_lines

FILES = "path string, length bigint, modified timestamp"
LEDGER = f"{FILES}, pack string"


def list_versions(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Visible, non-empty files directly in the folders: ``path``, ``length``, ``modified``. No file is opened."""

    def read(paths: list[str]) -> DataFrame:
        rows = spark.read.format("binaryFile").load(paths)
        return rows.select("path", "length", F.col("modificationTime").alias("modified"))

    return read_present(spark, folders, read, FILES)


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """``path``, ``length``, ``modified``, ``pack`` of every packed file."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{store.rstrip('/')}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def new_files(spark: SparkSession, folders: list[str], store: str) -> DataFrame:
    """Files of the folders that are not in the ledger in this version."""
    listed, ledger = list_versions(spark, folders), read_ledger(spark, store)
    return listed.join(ledger, ["path", "length", "modified"], "left_anti")


def pack_names(spark: SparkSession, store: str) -> list[str]:
    """The packs of the ledger, oldest first."""
    return sorted(row.pack for row in read_ledger(spark, store).select("pack").distinct().collect())


def pack_lines(spark: SparkSession, folders: list[str], store: str) -> str | None:
    """Pack the lines of the files that are new since the last call; returns the name of the pack, None if none is new.

    Only new files are opened. Their names pass through the driver, as the names of all files do when Spark lists a folder.
    A packed file that has changed is an error: its lines are stored and may have been counted.
    """
    refuse_hidden(spark, folders)
    fresh = new_files(spark, folders, store).collect()  # names only
    if not fresh:
        return None
    rows = spark.createDataFrame(fresh, FILES)
    changed = rows.join(read_ledger(spark, store).select("path"), "path", "left_semi").limit(1).collect()
    if changed:
        raise ValueError(f"a packed file has changed: {changed[0].path}")
    last = (pack_names(spark, store) or ["0-"])[-1]
    pack = f"{int(last.split('-')[0]) + 1:06d}-{uuid.uuid4().hex}"
    plain = [re.sub(r"([\\*?\[\]{}])", r"\\\1", row.path) for row in fresh]  # no name is a pattern
    scan_lines(spark, plain).write.parquet(f"{store.rstrip('/')}/lines/pack={pack}")
    rows.withColumn("pack", F.lit(pack)).coalesce(1).write.mode("append").parquet(f"{store.rstrip('/')}/ledger")
    return pack


def read_packed(spark: SparkSession, store: str, packs: list[str] | None = None) -> DataFrame:
    """``path``, ``line``, ``pack`` of the lines of some packs, or of all in the ledger."""
    packs = pack_names(spark, store) if packs is None else packs
    schema = f"{LINE_COLUMNS}, pack string"
    if not packs:
        return spark.createDataFrame([], schema)
    root = f"{store.rstrip('/')}/lines"
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/pack={pack}" for pack in packs])
