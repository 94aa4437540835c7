"""From files to repositories to months.

Neither join is hinted. A side under the session's broadcast threshold is broadcast; otherwise the
adaptive sort-merge join splits partitions that one repository or one id makes large, which it can
do because both sides come straight from a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.functions.keys import entity_id_from_path
from cotrend.functions.months import with_month
from cotrend.sources.metadata import BUCKET, metadata_bucket


def join_relation(urls: DataFrame, relation: DataFrame) -> DataFrame:
    """Files with their repository: ``nb_id``, ``s3_url``, ``repo_id``.

    Files without a relation row vanish; a repeated relation row repeats its file.
    """
    files = urls.withColumn("nb_id", entity_id_from_path(F.col("s3_url")))
    return files.join(relation.select("nb_id", "repo_id"), "nb_id").select("nb_id", "s3_url", "repo_id")


def date_entities(
    relation: DataFrame, metadata: DataFrame, by: str = "nb_id", keep_undated: bool = False
) -> DataFrame:
    """Relation rows with the month of their repository's ``updated_at``.

    Rows without a usable date are dropped, or kept with a NULL month for a drop report. Metadata from ``read_metadata`` is met
    by bucket too, so that buckets without a repository of the relation need not be read.
    """
    keys = ["repo_id"]
    if BUCKET in metadata.columns:
        relation, keys = relation.withColumn(BUCKET, metadata_bucket(F.col("repo_id"))), [BUCKET, "repo_id"]
    dates = with_month(metadata, "updated_at").select(*keys, "month")
    if keep_undated:
        return relation.join(dates, keys, "left").select(by, "repo_id", "month")
    dates = dates.where(F.col("month").isNotNull())
    return relation.join(dates, keys).select(by, "repo_id", "month")


def relation_of_files(relation: DataFrame, files: DataFrame) -> DataFrame:
    """The relation rows of a batch: those whose id is that of a file in ``path``."""
    ids = files.where(F.col("length") > 0).select(entity_id_from_path(F.col("path")).alias("nb_id"))
    return relation.join(ids, "nb_id", "left_semi")
