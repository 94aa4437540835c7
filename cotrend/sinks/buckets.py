"""Append counts to a table in buckets of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cotrend.sinks.increments import STORED
from cotrend.sources.buckets import bucket_number, bucket_table

#: Buckets of a new table. Keys and months, not the input, set the size of a count table.
BUCKETS = 32


def append_buckets(counts: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """Append to the table under ``root``; a table that exists keeps its number of buckets.

    Rows are dealt as the buckets are, so every task writes the one file of its bucket. A second run of the same batch counts
    twice, as in any append.
    """
    spark = counts.sparkSession
    buckets = bucket_number(spark, root) or buckets
    name = bucket_table(spark, root, buckets)
    counts.select("library", *STORED).repartition(buckets, "library").write.insertInto(name)
