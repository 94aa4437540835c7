"""Repository dates kept by buckets of the repository id.

Repository files are read once, by ``write_metadata``. A batch that meets the store by bucket and id reads the buckets of its own
repositories: where the batch's side is small enough to broadcast, Spark takes the buckets from it and leaves out all
others (dynamic partition pruning); a larger batch meets most buckets anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name of the bucket column. The number of buckets is fixed, so that what one version wrote any other finds.
BUCKET = "repo_bucket"
BUCKETS = 256

COLUMNS = "repo_id string, updated_at string"


def metadata_bucket(repo_id: Column) -> Column:
    return F.pmod(F.xxhash64(repo_id), F.lit(BUCKETS)).cast("int")


def write_metadata(metadata: DataFrame, path: str, mode: str = "error") -> None:
    """Store ``repo_id``, ``updated_at`` with a folder per bucket; ``mode`` "append" adds repositories that are new.

    Rows without an id meet no entity and are left out; a repeated id repeats its entities, as in the files it comes from.
    """
    rows = metadata.select("repo_id", "updated_at", metadata_bucket(F.col("repo_id")).alias(BUCKET))
    dealt = rows.where(F.col("repo_id").isNotNull()).repartition(BUCKET).sortWithinPartitions(BUCKET, "repo_id")
    dealt.write.partitionBy(BUCKET).mode(mode).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``repo_id``, ``updated_at`` and the bucket; ``date_entities`` meets it by both."""
    return spark.read.schema(f"{COLUMNS}, {BUCKET} int").parquet(path)
