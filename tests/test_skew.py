"""Plans and results when one key holds a third of all rows."""

import datetime
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from cotrend import date_entities, join_relation, keep_catalogued, monthly_usage, notebook_usage

from .conftest import final_plan, plan, rows

ROWS = 60_000


@contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# At these sizes the defaults (256 MB) never call a partition skewed.
SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


def hot(spark, name, size):
    """``name`` with a third of the rows on one value."""
    return spark.range(0, ROWS, 1, 8).withColumn(
        name, F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % size).cast("string")
    )


def test_hot_repository_is_split(spark):
    with settings(spark, **SMALL):
        relation = hot(spark, "repo_id", 5000).select(F.col("id").cast("string").alias("nb_id"), "repo_id")
        metadata = spark.range(5000).select(
            F.col("id").cast("string").alias("repo_id"), F.lit("2017-06-30T23:59:59Z").alias("updated_at")
        )
        dated = date_entities(relation, metadata)
        assert "skew=true" in final_plan(dated)
        assert dated.count() == ROWS


def test_hot_notebook_id_is_split(spark):
    with settings(spark, **SMALL):
        urls = spark.range(5000).select(F.concat(F.lit("s3a://b/f/nb_"), "id", F.lit(".ipynb")).alias("s3_url"))
        relation = hot(spark, "nb_id", 5000).select("nb_id", F.col("id").cast("string").alias("repo_id"))
        joined = join_relation(urls, relation)
        assert "skew=true" in final_plan(joined)
        assert joined.count() == ROWS


def test_hot_item_is_split_when_the_catalogue_is_too_large_to_broadcast(spark):
    with settings(spark, **SMALL):
        items = hot(spark, "item", 5000).select("id", "item")
        catalogue = spark.range(5000).select(F.col("id").cast("string").alias("Libraries"))
        kept = keep_catalogued(items, catalogue)
        text = final_plan(kept)
        assert "skew=true" in text and "BroadcastHashJoin" not in text
        assert kept.count() == ROWS


def test_hot_entity_is_combined_before_the_shuffle(spark, tools):
    """Both sides of the entity join are aggregated on the map side first."""
    names = [row.Libraries for row in tools.collect()]
    item = F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 15 + 1).cast("int"))
    items = hot(spark, "entity", 9000).select("entity", item.alias("item"))
    month = F.lit(datetime.date(2017, 6, 1)).alias("month")
    entities = hot(spark, "entity", 9000).select("entity", month)
    counts = monthly_usage(items, entities, tools)
    text = plan(counts)
    assert "partial_bit_or" in text and "partial_count(1)" in text
    got = {row.library: row.lib_counts for row in counts.collect()}
    # the hot entity uses five tools of every third place, and every one of its rows counts
    assert got["numpy"] >= ROWS // 3
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert rows(monthly_usage(items, entities, tools)) == rows(counts)


def test_hot_file_name_is_split(spark, tools):
    """A third of all files share one name, and so one id."""
    with settings(spark, **SMALL):
        files = hot(spark, "nb_id", 5000)
        path = F.concat(F.lit("s3a://b/"), "id", F.lit("/nb_"), "nb_id", F.lit(".ipynb"))
        lines = files.select(path.alias("path"), F.lit('"import numpy\\n",').alias("line"))
        relation = spark.range(5000).select(F.col("id").cast("string").alias("nb_id"), F.lit("r").alias("repo_id"))
        metadata = spark.createDataFrame([("r", "2017-06-30T23:59:59Z")], "repo_id string, updated_at string")
        counts = notebook_usage(lines, relation, metadata, tools)
        assert "skew=true" in final_plan(counts)
        assert rows(counts) == [("numpy", "numpy", None, "2017-06", ROWS)]


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_scan_reads_two_columns(spark, broadcast):
    from cotrend.plans.queries import QUERIES

    with settings(spark, spark__sql__autoBroadcastJoinThreshold=broadcast):
        text = plan(QUERIES["monthly_usage"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text
    assert "PushedFilters: [IsNotNull(l_suppkey), IsNotNull(l_orderkey)]" in text
