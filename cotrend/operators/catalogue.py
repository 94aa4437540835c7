"""Catalogue of items: ``Libraries``, ``Category`` and ``pos`` (place in the file, from 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cotrend.functions.keys import pair_key

# The shipped catalogue, in order.
DEFAULT_TOOLS = {
    "Visualization": ("matplotlib", "seaborn", "plotly"),
    "Data Wrangling": ("numpy", "scipy", "pandas"),
    "Machine Learning": ("sklearn", "eli5", "xgboost"),
    "Deep Learning": ("keras", "tensorflow", "theano"),
    "Natural Language Processing": ("nltk", "gensim", "spacy"),
}

# What is shown before anything is chosen.
DEFAULT_CATEGORY = "Visualization"
DEFAULT_TOOL = "matplotlib"
DEFAULT_PARTNER = "Data Wrangling"

# Places 0..63 fit the bits of one bigint. Such a catalogue has at most 64 rows, which is what
# makes its broadcasts safe.
MASK_BITS = 64

SCHEMA = "Libraries string, Category string, pos int"


def default_catalogue(spark: SparkSession) -> DataFrame:
    rows = [(tool, category) for category, tools in DEFAULT_TOOLS.items() for tool in tools]
    return spark.createDataFrame([(*row, pos) for pos, row in enumerate(rows)], SCHEMA)


def catalogue_span(catalogue: DataFrame) -> int:
    """One more than the last ``pos``; raises when a name or a place is missing or occurs twice.

    One aggregation for a catalogue of any size. A name listed twice would count its users twice.
    """
    totals = catalogue.agg(
        F.count("*").alias("tools"),
        F.count_distinct("Libraries").alias("names"),
        F.count_distinct("pos").alias("places"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
    ).first()
    if not totals.tools:
        return 0
    # a NULL is no distinct value, so a missing name or place shows as one value too few
    if not totals.tools == totals.names == totals.places or totals.first < 0:
        raise ValueError("each catalogue row needs its own name and its own place from 0 on")
    return totals.last + 1


def tools_of_category(catalogue: DataFrame, category: str) -> DataFrame:
    """Tools of one category with their places, in catalogue order."""
    chosen = catalogue.where(F.col("Category") == category)
    return chosen.select("Libraries", "pos").orderBy("pos")


def _in_order(catalogue: DataFrame, column: str) -> DataFrame:
    return catalogue.groupBy(column).agg(F.min("pos").alias("pos")).orderBy("pos")


def distinct_categories(catalogue: DataFrame) -> DataFrame:
    """Categories in the order of their first tool."""
    return _in_order(catalogue, "Category")


def distinct_tools(catalogue: DataFrame) -> DataFrame:
    """Tool names in order, each once."""
    return _in_order(catalogue, "Libraries")


def first_k_per_category(catalogue: DataFrame, k: int = 3) -> DataFrame:
    """The first ``k`` tools of every category; all of them where there are fewer."""
    in_category = Window.partitionBy("Category").orderBy("pos")
    return catalogue.withColumn("rank", F.row_number().over(in_category)).where(F.col("rank") <= k)


def first_k_of_category(catalogue: DataFrame, category: str, k: int | None = None) -> DataFrame:
    """The tools of one category in catalogue order; only the first ``k`` where ``k`` is given."""
    tools = tools_of_category(catalogue, category)
    return tools if k is None else tools.limit(k)


def partner_categories(catalogue: DataFrame, item: str) -> DataFrame:
    """Categories other than that of ``item``, in order, the first marked as the default.

    No rows for an unknown item.
    """
    own = catalogue.where(F.col("Libraries") == item).orderBy("pos").limit(1).select("Category")
    others = catalogue.where(F.col("Category") != own.scalar())
    first = others.agg(F.min("pos").alias("pos"))
    marked = (F.col("pos") == first.scalar()).alias("is_default")
    return distinct_categories(others).select("Category", "pos", marked).orderBy("pos")


def default_partner_category(catalogue: DataFrame, item: str) -> DataFrame:
    return partner_categories(catalogue, item).select("Category", "pos").orderBy("pos").limit(1)


def key_universe(catalogue: DataFrame) -> DataFrame:
    """Every tool and every unordered pair of tools, used or not.

    Each tool lists the ranks before its own and meets their tools by an equi-join. Ranks are dense,
    whatever the places are, so a list is as long as the catalogue at most.
    """
    rank = (F.row_number().over(Window.orderBy("pos")) - 1).alias("rank")  # n rows for n * (n + 1) / 2 keys
    tools = catalogue.select(F.col("Libraries").alias("one"), rank)
    singles = tools.select(
        F.col("one").alias("item_a"), F.lit(None).cast("string").alias("item_b")
    )
    earlier = tools.where(F.col("rank") > 0).select(
        "one", F.explode(F.sequence(F.lit(0), F.col("rank") - 1)).alias("rank")
    )
    others = tools.select(F.col("one").alias("other"), "rank")
    pairs = earlier.join(others, "rank").select(
        F.least("one", "other").alias("item_a"), F.greatest("one", "other").alias("item_b")
    )
    key = pair_key(F.col("item_a"), F.col("item_b")).alias("library")
    return singles.unionByName(pairs).select(key, "item_a", "item_b")
