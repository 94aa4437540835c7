"""Readers of notebook folders, the relation file and repository metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Repository <id> is described by repo_<id>.json (a file, or a folder of one part).
METADATA_NAME = r"repo_([^/]*?)\.json"

FILE_COLUMNS = "path string, length bigint"
LINE_COLUMNS = "path string, line string"


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of a file system that match a pattern."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def read_present(
    spark: SparkSession, folders: list[str], read: Callable[[list[str]], DataFrame], columns: str
) -> DataFrame:
    """One scan of the folders that exist; a folder given twice is an error, as its rows would count twice."""
    if len({folder.rstrip("/") for folder in folders}) < len(folders):
        raise ValueError("a folder is given more than once")
    try:
        return read(folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    present = [folder for folder in folders if matches(spark, folder)]
    return read(present) if present else spark.createDataFrame([], columns)


def refuse_hidden(spark: SparkSession, folders: list[str]) -> None:
    """An error if a notebook is hidden from Spark's readers: its name starts with ``_`` or ``.``."""
    hidden = [path for folder in folders for path in matches(spark, f"{folder.rstrip('/')}/[._]*.ipynb")]
    if hidden:
        raise ValueError(f"{len(hidden)} notebooks have hidden names, the first is {hidden[0]}")


def list_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Visible, non-empty files directly in the folders: ``path``, ``length``. A missing folder has none.

    Only these two columns are read, so no file is opened. Spark leaves out empty files, which have
    no line to scan, and files whose name starts with ``_`` or ``.``; ``refuse_hidden`` finds
    notebooks among the latter.
    """

    def read(paths: list[str]) -> DataFrame:
        return spark.read.format("binaryFile").load(paths).select("path", "length")

    return read_present(spark, folders, read, FILE_COLUMNS)


def urls_to_frame(spark: SparkSession, urls: list[str]) -> DataFrame:
    """A given list of files as ``s3_url``; a folder is better read with ``list_files``."""
    return spark.createDataFrame([(url,) for url in urls], "s3_url string")


def scan_lines(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Text lines of all files directly in the folders: ``path``, ``line``.

    Lines end at ``\\n`` alone; a lone ``\\r`` stays inside its line.
    """

    def read(paths: list[str]) -> DataFrame:
        rows = spark.read.text(paths, lineSep="\n")
        return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))

    return read_present(spark, folders, read, LINE_COLUMNS)


def read_relation(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV with a header, all columns text, a double quote escaped by a double quote.

    Multi-line files are read whole by one task each; ``read_records`` reads a large one by many.
    ``multiline=False`` does so too where no field holds a line break.
    """
    return spark.read.csv(path, header=True, multiLine=multiline, escape='"')


def read_repo_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``repo_id`` from the file name and ``updated_at`` from the JSON object; other keys are skipped."""
    rows = spark.read.schema("updated_at string").json(path, multiLine=True)
    repo_id = F.regexp_extract(F.col("_metadata.file_path"), METADATA_NAME, 1)
    return rows.select(repo_id.alias("repo_id"), "updated_at")


def preview(df: DataFrame, by: str | Column, n: int = 10) -> DataFrame:
    """The first ``n`` rows in a given order."""
    return df.orderBy(by).limit(n)
