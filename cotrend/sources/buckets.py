"""Count tables dealt into a fixed number of buckets by the text of their key.

One folder per key costs a file per key and batch; buckets cost one file per bucket and batch, whatever the number of keys. A read
of one key opens one bucket, and two such tables with as many buckets meet without a shuffle.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from cotrend.sources.files import matches
from cotrend.sources.increments import COUNTS

COLUMNS = f"library string, {COUNTS}"


def bucket_number(spark: SparkSession, root: str) -> int | None:
    """The number of buckets that a table has; None where nothing was written yet. Its folder's name says it."""
    found = matches(spark, f"{root.rstrip('/')}/of-*")
    return int(re.search(r"/of-(\d+)$", found[0])[1]) if found else None


def bucket_table(spark: SparkSession, root: str, buckets: int) -> str:
    """Name of the session's table over the folder. The files belong to the folder and outlive the session."""
    path = f"{root.rstrip('/')}/of-{buckets}"
    name = f"buckets_{hashlib.md5(path.encode()).hexdigest()}"
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet "
        f"CLUSTERED BY (library) SORTED BY (library, datetime) INTO {buckets} BUCKETS LOCATION '{quoted}'"
    )
    return name


def read_buckets(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the table; one that nothing was written to is empty."""
    buckets = bucket_number(spark, root)
    if buckets is None:
        return spark.createDataFrame([], COLUMNS)
    name = bucket_table(spark, root, buckets)
    spark.catalog.refreshTable(name)  # other sessions may have appended
    return spark.table(name)
