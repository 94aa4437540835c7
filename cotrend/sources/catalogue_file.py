"""Catalogue file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.operators.catalogue import catalogue_span


def load_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Read the CSV columns ``Libraries`` and ``Category`` and number the rows in file order.

    A multi-line CSV file is never split, so within the one file the generated id counts rows.
    """
    rows = spark.read.csv(path, header=True, multiLine=True)
    files = rows.inputFiles()
    if len(files) != 1:
        raise ValueError(f"a catalogue is one file, found {len(files)} in {path}")
    named = rows.where(F.col("Libraries").isNotNull())
    catalogue = named.select(
        "Libraries", "Category", F.monotonically_increasing_id().cast("int").alias("pos")
    )
    catalogue_span(catalogue)
    return catalogue
