"""Baskets: the distinct catalogued items of one entity, and their unordered pairs.

The catalogue filter always comes first, so a basket, and with it the pairs of one entity, is
bounded by the catalogue and not by how much an entity holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.functions.keys import pair_key


def keep_catalogued(items: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rows whose ``item`` is in the catalogue.

    Spark broadcasts the catalogue when its size is under the session's threshold; beyond it, the
    adaptive sort-merge join splits the partitions of frequent items.
    """
    names = catalogue.select(F.col("Libraries").alias("item"))
    return items.join(names, "item", "left_semi").select(items.columns)


def distinct_items(items: DataFrame, by: str = "entity") -> DataFrame:
    return items.select(by, "item").distinct()


def baskets(items: DataFrame, catalogue: DataFrame, by: str = "entity") -> DataFrame:
    """Sorted distinct catalogued items per entity: ``by``, ``items``."""
    kept = keep_catalogued(items, catalogue)
    return kept.groupBy(by).agg(F.array_sort(F.collect_set("item")).alias("items"))


def _expand(found: DataFrame, by: str, first_partner: int) -> DataFrame:
    one = found.select(by, "items", F.posexplode("items").alias("at", "item_a"))
    from_there = F.slice("items", F.col("at") + 1 + first_partner, F.size("items"))
    return one.select(by, "item_a", F.explode(from_there).alias("item_b"))


def pairs_by_array(found: DataFrame, by: str = "entity") -> DataFrame:
    """Unordered pairs of each basket, the smaller name first."""
    pairs = _expand(found, by, first_partner=1)
    return pairs.withColumn("library", pair_key(F.col("item_a"), F.col("item_b")))


def with_pairs(found: DataFrame, by: str = "entity") -> DataFrame:
    """Items and pairs of each basket; ``item_b`` is NULL on the rows of single items."""
    # Starting at the item itself gives each item once as its own partner: the single-item row.
    rows = _expand(found, by, first_partner=0)
    partner = F.when(F.col("item_a") != F.col("item_b"), F.col("item_b"))
    rows = rows.select(by, "item_a", partner.alias("item_b"))
    return rows.withColumn("library", pair_key(F.col("item_a"), F.col("item_b")))


def pairs_by_join(items: DataFrame, catalogue: DataFrame, by: str = "entity") -> DataFrame:
    """The pairs of ``pairs_by_array`` as a self-join; an entity has at most one row per tool."""
    kept = distinct_items(keep_catalogued(items, catalogue), by)
    one = kept.select(by, F.col("item").alias("item_a"))
    other = kept.select(by, F.col("item").alias("item_b"))
    pairs = one.join(other, by).where(F.col("item_a") < F.col("item_b"))
    return pairs.withColumn("library", pair_key(F.col("item_a"), F.col("item_b")))


def basket_masks(items: DataFrame, catalogue: DataFrame, by: str = "entity") -> DataFrame:
    """Baskets as one bigint per entity, bit ``pos`` set for the tool at that place.

    For catalogues of at most ``MASK_BITS`` places (so as many rows). The bit-or combines on the map side, so an
    entity with very many rows reaches the shuffle as one row per task.
    """
    places = F.broadcast(catalogue.select(F.col("Libraries").alias("item"), "pos"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("pos"))
    return items.join(places, "item").groupBy(by).agg(F.bit_or(bit).alias("basket"))


def basket_places(items: DataFrame, catalogue: DataFrame, by: str = "entity") -> DataFrame:
    """Baskets as the sorted places of their tools, for a catalogue of any size."""
    places = catalogue.select(F.col("Libraries").alias("item"), "pos")
    kept = items.join(places, "item")
    return kept.groupBy(by).agg(F.array_sort(F.collect_set("pos")).alias("basket"))


def _has_bit(place: str):
    shifted = F.call_function("shiftright", F.col("basket"), F.col(place))
    return shifted.bitwiseAND(F.lit(1).cast("bigint")) == 1


def mask_rows(found: DataFrame, keep: list[str], span: int, singles: bool, pairs: bool) -> DataFrame:
    """Rows (``a``, ``b``) of places for each mask, ``a <= b``; ``a = b`` stands for one item."""
    all_places = F.array(*[F.lit(place) for place in range(span)])
    rows = found.select(*keep, "basket", F.explode(all_places).alias("a")).where(_has_bit("a"))
    if not pairs:
        return rows.select(*keep, "a", F.col("a").alias("b"))
    last = F.lit(span - 1)
    if singles:
        partners = F.sequence("a", last)
    else:  # sequence() counts down from a start after its end
        partners = F.when(F.col("a") < last, F.sequence(F.col("a") + 1, last))
    rows = rows.select(*keep, "basket", "a", F.explode(partners).alias("b"))
    return rows.where(_has_bit("b")).select(*keep, "a", "b")


def place_rows(found: DataFrame, keep: list[str], singles: bool, pairs: bool) -> DataFrame:
    """``mask_rows`` for baskets made by ``basket_places``."""
    rows = found.select(*keep, "basket", F.posexplode("basket").alias("at", "a"))
    if not pairs:
        return rows.select(*keep, "a", F.col("a").alias("b"))
    from_there = F.slice("basket", F.col("at") + (1 if singles else 2), F.size("basket"))
    return rows.select(*keep, "a", F.explode(from_there).alias("b"))
