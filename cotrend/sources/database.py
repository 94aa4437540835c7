"""Stored tables in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted(name: str) -> str:
    """A name as a quoted SQL identifier, whatever it holds."""
    return '"' + name.replace('"', '""') + '"'


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], **options: str
) -> DataFrame:
    """A whole table; pass the reader's partition options to read a large one with many tasks."""
    return spark.read.options(**options).jdbc(url, table, properties=properties)


def table_exists(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> bool:
    """Whether the database's metadata lists a table (or view) of exactly this name."""
    jvm = spark.sparkContext._jvm
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    login = jvm.java.util.Properties()
    for name, value in properties.items():
        login.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        metadata = connection.getMetaData()
        sign = metadata.getSearchStringEscape()
        pattern = "".join(sign + c if c in "_%" or c == sign else c for c in table)
        found = metadata.getTables(None, None, pattern, None)
        while found.next():
            if found.getString("TABLE_NAME") == table:
                return True
        return False
    finally:
        connection.close()


def read_trend(spark: SparkSession, url: str, key: str, properties: dict[str, str]) -> DataFrame:
    """Users per month from the table of one key, summed inside the database.

    A key that was never stored has no table, and an empty series.
    """
    if not table_exists(spark, url, key, properties):
        return spark.createDataFrame([], "datetime string, users bigint")
    month, count = quoted("datetime"), quoted("lib_counts")
    query = (
        f"SELECT {month}, SUM(CAST({count} AS bigint)) AS {quoted('users')} "
        f"FROM {quoted(key)} GROUP BY {month}"
    )
    reader = spark.read.format("jdbc").options(url=url, query=query, **properties)
    return reader.load().orderBy("datetime")
