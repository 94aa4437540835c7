"""Monthly counts of items and pairs.

A count is the number of entity rows that use the item, dated by the month of the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cotrend.functions.keys import entity_id_from_path, pair_key
from cotrend.functions.months import month_text
from cotrend.operators.baskets import (
    basket_masks,
    basket_places,
    keep_catalogued,
    mask_rows,
    place_rows,
)
from cotrend.operators.catalogue import MASK_BITS, catalogue_span


def drop_undated(entities: DataFrame) -> DataFrame:
    return entities.where(F.col("month").isNotNull())


def count_monthly(rows: DataFrame, keys: tuple[str, ...] = ("library", "datetime")) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("lib_counts"))


def merge_rows(entities: DataFrame, by: str, *more: str) -> DataFrame:
    """One row per entity, month and the columns in ``more`` with its number of rows ``n``.

    Joined as they are, the rows of an entity listed very often would all meet in one task.
    """
    return entities.groupBy(by, "month", *more).agg(F.count("*").alias("n"))


def find_baskets(items: DataFrame, catalogue: DataFrame, span: int, by: str) -> DataFrame:
    """Baskets as masks where the catalogue fits one, as lists of places where it does not."""
    find = basket_masks if span <= MASK_BITS else basket_places
    return find(items, catalogue, by)


def usage_of_baskets(
    found: DataFrame,
    entities: DataFrame,
    catalogue: DataFrame,
    span: int,
    by: str = "entity",
    one_row_per_entity: bool = False,
    singles: bool = True,
    pairs: bool = True,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """Counts per item or pair, month and the entity columns in ``more``, from baskets and dated entities.

    ``span`` comes from ``catalogue_span`` and ``found`` from ``find_baskets``.
    Equal baskets of one month are counted first, so pairs are formed once per different basket
    and not once per entity.
    """
    dated = drop_undated(entities)
    if one_row_per_entity:
        dated = dated.select(by, "month", *more, F.lit(1).alias("n"))
    else:
        dated = merge_rows(dated, by, *more)
    equal = dated.join(found, by).groupBy("basket", "month", *more).agg(F.sum("n").alias("n"))
    return usage_of_equal_baskets(equal, catalogue, span, singles, pairs, more)


def usage_of_equal_baskets(
    equal: DataFrame,
    catalogue: DataFrame,
    span: int,
    singles: bool = True,
    pairs: bool = True,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """``usage_of_baskets`` from baskets with their month and number of rows ``n``."""
    keep = ["month", "n", *more]
    listed = isinstance(equal.schema["basket"].dataType, ArrayType)
    if listed:
        rows = place_rows(equal, keep, singles, pairs)
    else:
        rows = mask_rows(equal, keep, span, singles, pairs)
    counts = rows.groupBy("a", "b", "month", *more).agg(F.sum("n").alias("lib_counts"))
    names = catalogue.select("pos", "Libraries")
    if not listed:  # at most MASK_BITS rows
        names = F.broadcast(names)
    return _named(counts, names, pairs, more)


def _named(counts: DataFrame, names: DataFrame, pairs: bool, more: tuple[str, ...]) -> DataFrame:
    """Names in place of the places ``a`` and ``b``, the smaller name first."""
    one = names.select(F.col("pos").alias("a"), F.col("Libraries").alias("name_a"))
    named = counts.join(one, "a")
    if pairs:
        other = names.select(F.col("pos").alias("b"), F.col("Libraries").alias("name_b"))
        named = named.join(other, "b")
        item_a = F.least("name_a", "name_b")
        item_b = F.when(F.col("a") != F.col("b"), F.greatest("name_a", "name_b"))
    else:
        item_a, item_b = F.col("name_a"), F.lit(None).cast("string")
    named = named.select(
        item_a.alias("item_a"),
        item_b.alias("item_b"),
        month_text(F.col("month")).alias("datetime"),
        "lib_counts",
        *more,
    )
    key = pair_key(F.col("item_a"), F.col("item_b")).alias("library")
    return named.select(key, "item_a", "item_b", "datetime", "lib_counts", *more)


def monthly_usage(
    items: DataFrame,
    entities: DataFrame,
    catalogue: DataFrame,
    by: str = "entity",
    one_row_per_entity: bool = False,
    singles: bool = True,
    pairs: bool = True,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """How many entity rows use each catalogued item, and each pair of them, per month.

    ``items`` has ``by`` and ``item``, ``entities`` has ``by`` and ``month``. An entity listed
    twice counts twice. ``one_row_per_entity`` says that ``by`` is a key of ``entities`` and saves
    the shuffle that merges equal rows; the result does not depend on it. Columns of the entities
    in ``more``, such as a batch, are counted apart: one pass over the items serves them all.
    """
    span = catalogue_span(catalogue)
    found = find_baskets(items, catalogue, span, by)
    return usage_of_baskets(
        found,
        entities,
        catalogue,
        span,
        by,
        one_row_per_entity=one_row_per_entity,
        singles=singles,
        pairs=pairs,
        more=more,
    )


def counts_as_text(counts: DataFrame) -> DataFrame:
    """The stored form of a count table: text only."""
    return counts.withColumn("lib_counts", F.col("lib_counts").cast("string"))


def count_number(column: str = "lib_counts") -> Column:
    """A stored count as a number, whether it was stored as text or not."""
    return F.col(column).cast("bigint")


def keys_present(counts: DataFrame) -> DataFrame:
    """Items and pairs that have any count, with their months and total.

    Grouped by both items: a tool ``a_b`` and the pair of ``a`` and ``b`` stay apart.
    """
    return counts.groupBy("library", "item_a", "item_b").agg(
        F.count_distinct("datetime").alias("months"), F.sum(count_number()).alias("total")
    )


def drop_report(
    items: DataFrame, entities: DataFrame, catalogue: DataFrame, by: str = "entity"
) -> DataFrame:
    """Entity rows that count and that do not: ``reason``, ``n``."""
    merged = merge_rows(entities, by)
    with_item = keep_catalogued(items, catalogue).select(by).distinct()
    reason = (
        F.when(F.col("month").isNull(), "no date")
        .when(F.col("has_item").isNull(), "no catalogued item")
        .otherwise("counted")
    )
    marked = merged.join(with_item.withColumn("has_item", F.lit(True)), by, "left")
    return marked.groupBy(reason.alias("reason")).agg(F.sum("n").alias("n"))


def judge_files(paths: DataFrame, found: DataFrame, dated: DataFrame) -> DataFrame:
    """Rows of files by what becomes of them: ``reason``, ``basket``, ``month``, ``n``.

    ``paths`` has the ``path`` of every file, ``found`` the ``path`` and ``basket`` of each file with a catalogued item, and
    ``dated`` the relation rows with their months (``date_entities`` with ``keep_undated``). A file without a relation row is
    one row, a file listed twice is two. Only rows that count have a basket and a month. Equal rows are counted, so the result
    is small: the counts and the drop report both come from it.
    """
    met = paths.select("path", entity_id_from_path(F.col("path")).alias("nb_id")).join(found, "path", "left")
    files = met.groupBy("nb_id", "basket").agg(F.count("*").alias("files"))
    listed = merge_rows(dated, "nb_id")
    reason = (
        F.when(F.col("n").isNull(), "no relation row")
        .when(F.col("month").isNull(), "no date")
        .when(F.col("basket").isNull(), "no catalogued item")
        .otherwise("counted")
    )
    rows = (F.col("files") * F.coalesce("n", F.lit(1))).alias("n")
    judged = files.join(listed, "nb_id", "left").select(reason.alias("reason"), "basket", "month", rows)
    counted = F.col("reason") == "counted"
    basket, month = (F.when(counted, F.col(name)).alias(name) for name in ("basket", "month"))
    return judged.groupBy("reason", basket, month).agg(F.sum("n").alias("n"))


def report_of_judged(judged: DataFrame) -> DataFrame:
    """What became of the files: ``reason``, ``n``."""
    return judged.groupBy("reason").agg(F.sum("n").alias("n"))
