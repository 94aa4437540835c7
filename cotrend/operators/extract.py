"""Imported names per text file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.functions.lines import may_import, names_in_words, words


def extract_imports(lines: DataFrame, by: str = "path", distinct: bool = True) -> DataFrame:
    """Names imported in ``line``: ``by``, ``item``.

    ``distinct=False`` leaves repeated names in and saves a shuffle, for callers that go on to
    form baskets, where repeats vanish anyway.
    """
    statements = lines.where(may_import(F.col("line"))).select(by, words(F.col("line")).alias("words"))
    names = statements.select(by, F.explode(names_in_words(F.col("words"))).alias("item"))
    return names.distinct() if distinct else names
