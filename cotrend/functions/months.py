"""Month of a timestamp.

Inside the jobs a month is the DATE of its first day: four bytes to group, sort and shuffle by.
It becomes the text ``YYYY-MM`` on the few rows of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: the only accepted text form, e.g. 2017-06-30T23:59:59Z (one-digit fields pass too).
ISO_TEXT = "yyyy-M-d'T'H:m:s'Z'"


def json_text(document: Column, key: str) -> Column:
    """Top-level value of a JSON object; an absent key and a JSON null both give NULL.

    The key is taken as it is, whatever signs it holds: it is a field name, not a path.
    """
    return F.from_json(document, StructType([StructField(key, StringType())])).getField(key)


def month_of(text: Column) -> Column:
    """First day of the month of an ISO text; NULL when the text is not of that form."""
    return F.trunc(F.try_to_timestamp(text, F.lit(ISO_TEXT)).cast("date"), "month")


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def with_month(df: DataFrame, ts_col: str) -> DataFrame:
    """Add ``month`` from an ISO text, a date or a timestamp column; NULL when unusable."""
    if isinstance(df.schema[ts_col].dataType, StringType):
        month = month_of(F.col(ts_col))
    else:
        month = F.trunc(F.col(ts_col).cast("date"), "month")
    return df.withColumn("month", month)
