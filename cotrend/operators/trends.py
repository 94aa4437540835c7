"""Monthly series from stored counts.

A key is its two items (the second is NULL for a single tool), never the joined text, which two keys
can share. Filters on the items reach the scan of a stored table: batches are sorted along both items, so
files, row groups and pages without a wanted item in either place are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotrend.functions.keys import series_label
from cotrend.operators.catalogue import (
    DEFAULT_CATEGORY,
    DEFAULT_PARTNER,
    DEFAULT_TOOL,
    first_k_of_category,
)
from cotrend.operators.counts import count_number


def of_key(item: str, other: str | None = None) -> Column:
    """Rows of one tool, or of an unordered pair of tools."""
    if other is None:
        return (F.col("item_a") == item) & F.col("item_b").isNull()
    first, second = sorted((item, other), key=lambda name: name.encode())
    return (F.col("item_a") == first) & (F.col("item_b") == second)


def trend(counts: DataFrame, item: str, other: str | None = None) -> DataFrame:
    """Users of one item, or of a pair, per month; increments of a month are added up."""
    rows = counts.where(of_key(item, other))
    return rows.groupBy("datetime").agg(F.sum(count_number()).alias("users")).orderBy("datetime")


def _series(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy("series", "pos", "datetime").agg(F.sum(count_number()).alias("users"))
    return summed.orderBy("pos", "datetime").select("series", "datetime", "users")


def trend_by_category(
    counts: DataFrame, catalogue: DataFrame, category: str = DEFAULT_CATEGORY, k: int | None = None
) -> DataFrame:
    """Series of the tools of a category, or of its first ``k``; a tool never used has no rows."""
    tool = F.col("Libraries")
    chosen = first_k_of_category(catalogue, category, k)
    singles = counts.where(F.col("item_b").isNull())
    return _series(singles.join(chosen.select(tool.alias("item_a"), tool.alias("series"), "pos"), "item_a"))


def trend_pairs_by_category(
    counts: DataFrame,
    catalogue: DataFrame,
    item: str = DEFAULT_TOOL,
    category: str = DEFAULT_PARTNER,
    k: int | None = None,
) -> DataFrame:
    """Series of ``item`` together with each tool of another category, or its first ``k``."""
    tool, main = F.col("Libraries"), F.lit(item)
    chosen = first_k_of_category(catalogue, category, k).select(
        F.least(main, tool).alias("item_a"),
        F.greatest(main, tool).alias("item_b"),
        series_label(main, tool).alias("series"),
        "pos",
    )
    with_item = counts.where((F.col("item_a") == item) | (F.col("item_b") == item))
    return _series(with_item.join(chosen, ["item_a", "item_b"]))
