"""Records of large CSV files whose fields hold line breaks, read by many tasks.

A line break ends a record where the number of double quotes before it is even. That number is a sum over all that stands before
in the file, so it is found in two steps, as a prefix sum over blocks: every block of a file, as Spark splits it, counts its
own quotes, a small table adds these up per file, and lines are then judged with the sum of the blocks before their own.
Lines that are records by themselves stay as they are; only the lines of broken records meet to be joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: How fields are read from a record, as ``read_relation`` reads them.
OPTIONS = {"escape": '"'}


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their ``file``, the ``block`` (offset) of the file that they begin in, and their ``place`` in reading order."""
    rows = spark.read.text(path, lineSep="\n")
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def number_records(lines: DataFrame) -> DataFrame:
    """``file``, ``record`` (from 0 in each file), ``place``, ``line`` and whether the record is ``whole`` in this line.

    One shuffle by block, which is as large as Spark's splits, whatever the files' sizes; the sums per block are one small
    row each.
    """
    odd = F.pmod(_quotes(F.col("line")), F.lit(2)).cast("int")
    in_block = Window.partitionBy("file", "block").orderBy("place")
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.withColumn("odd", odd).withColumn("open", F.pmod(before, F.lit(2)).cast("int"))
    # lines that begin a record, were the block to begin outside or inside of quotes
    begins = lambda inside: F.sum((F.col("open") == inside).cast("long"))
    marked = marked.withColumn("begun_0", begins(0).over(in_block)).withColumn("begun_1", begins(1).over(in_block))

    # the shuffle by block above serves this sum as well
    sums = marked.groupBy("file", "block").agg(
        F.pmod(F.sum("odd"), F.lit(2)).alias("odd"), F.max("begun_0").alias("n_0"), F.max("begun_1").alias("n_1")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("odd").over(earlier), F.lit(0)), F.lit(2)).cast("int")
    starts = sums.withColumn("inside", inside)
    begun = F.when(F.col("inside") == 0, F.col("n_0")).otherwise(F.col("n_1"))
    starts = starts.withColumn("n", begun)
    starts = starts.select("file", "block", "inside", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))

    met = marked.join(starts, ["file", "block"])
    own = F.when(F.col("inside") == 0, F.col("begun_0")).otherwise(F.col("begun_1"))
    closed = (F.col("open") == F.col("inside")) & (F.col("odd") == 0)
    return met.select("file", (F.col("earlier") + own - 1).alias("record"), "place", "line", closed.alias("whole"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The rows of CSV files with a header, all columns text, a double quote escaped by a double quote.

    As ``read_relation`` with ``multiline=True``, for files whose quotes stand in quoted fields only and come in pairs, but no
    file is read by one task alone. A record may run over any number of lines and blocks; it is put together in one task.
    Every file begins with its header, on one line, and all have the same columns. Blank lines are skipped, and ``\\r`` before a
    line break that ends a record belongs to the break.
    """
    names = spark.read.csv(path, header=True, **OPTIONS).columns
    numbered = number_records(file_lines(spark, path)).where(F.col("record") > 0)
    whole = numbered.where("whole").select("line")
    parts = numbered.where(~F.col("whole")).groupBy("file", "record")
    pieces = F.array_sort(F.collect_list(F.struct("place", "line")))
    broken = parts.agg(pieces.alias("pieces")).select(F.array_join(F.col("pieces.line"), "\n").alias("line"))
    records = whole.unionByName(broken).select(F.regexp_replace("line", "\r$", "").alias("line"))
    schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in names)
    row = F.from_csv("line", schema, OPTIONS)
    return records.where(F.trim("line") != "").select(row.alias("row")).select("row.*")
