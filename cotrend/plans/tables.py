"""The driver's tables seen as notebooks, tools, repositories and dates.

An order stands for a notebook, the nation of a line's supplier for a tool, a region for a category,
a customer for a repository, the order date for the date of an update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FOLDER = "s3a://bucket/notebooks_6/"
ISO_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables; its schema is read from the file footers once, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def notebook_path(key: Column) -> Column:
    return F.concat(F.lit(f"{FOLDER}nb_"), key.cast("string"), F.lit(".ipynb"))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_OUT)


def _lines_with_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    placed = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return placed.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, item"""
    rows = _lines_with_tool(spark, sf_dir)
    return rows.select(F.col("l_orderkey").alias("entity"), F.col("n_name").alias("item"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 nations in five regions."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    rows = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        F.col("n_name").alias("Libraries"),
        F.col("r_name").alias("Category"),
        F.col("n_nationkey").alias("pos"),
    )


def supplier_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue that grows with the data: suppliers by nation."""
    suppliers = table(spark, sf_dir, "supplier").select("s_name", "s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("s_name").alias("Libraries"),
        F.col("n_name").alias("Category"),
        F.col("s_suppkey").cast("int").alias("pos"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, month, and the status used to split batches; the key of orders is unique."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("entity"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        F.col("o_orderstatus").alias("status"),
    )


def partly_dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an ISO text; those of status P have a text of another form."""
    orders = table(spark, sf_dir, "orders")
    bad = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(F.col("o_orderstatus") == "P", bad).otherwise(iso_text(F.col("o_orderdate")))
    return orders.select(F.col("o_orderkey").alias("entity"), text.alias("updated_at"))


def notebook_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source line per lineitem, in the three statement forms: path, line."""
    rows = _lines_with_tool(spark, sf_dir)
    name, flag = F.col("n_name"), F.col("l_returnflag")
    statement = (
        F.when(flag == "A", F.concat(F.lit("import "), name, F.lit(" as x")))
        .when(flag == "R", F.concat(F.lit("from "), name, F.lit(".sub import y")))
        .otherwise(F.concat(F.lit("import os, "), name, F.lit(".core")))
    )
    line = F.concat(F.lit('    "'), statement, F.lit('\\n",'))
    return rows.select(notebook_path(F.col("l_orderkey")).alias("path"), line.alias("line"))


def order_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nb_id, repo_id: orders and their customers."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("nb_id"),
        F.col("o_custkey").cast("string").alias("repo_id"),
    )


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """repo_id, document: one JSON object per customer, dated by the last order."""
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    document = F.to_json(F.struct(iso_text(F.col("last")).alias("updated_at"), F.lit(False).alias("fork")))
    return last.select(F.col("o_custkey").cast("string").alias("repo_id"), document.alias("document"))
