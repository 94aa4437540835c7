"""Count tables in a database. URL, driver and login always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotrend.operators.counts import counts_as_text
from cotrend.sources.database import quoted

# Months are YYYY-MM; counts are stored as text. Databases group and cast these types, which many
# of them do not for the unbounded text type that Spark would create.
COLUMN_TYPES = "datetime VARCHAR(7), lib_counts VARCHAR(20)"


def append_table(rows: DataFrame, url: str, table: str, properties: dict[str, str], **options: str) -> None:
    """Append rows to a table, made on the first write."""
    rows.write.options(**options).jdbc(url, table, mode="append", properties=properties)


def append_table_per_key(
    counts: DataFrame, url: str, properties: dict[str, str], max_keys: int = 10_000
) -> list[str]:
    """Append ``datetime, lib_counts`` to one table per key present; returns the keys written.

    For small catalogues: each key is one write that filters stored counts (``read_increments``).
    With more than ``max_keys`` keys nothing is written and an error is raised; ``append_table``
    with the key columns takes any number. So are two keys of one name, such as a tool ``a_b`` and
    the pair of ``a`` and ``b``. A key has a row per month and batch, so one task writes it.
    """
    found = counts.select("library", "item_a", "item_b").distinct().limit(max_keys + 1).collect()
    if len(found) > max_keys:
        raise ValueError(f"more than {max_keys} keys: use append_table with the key columns")
    keys = [row.library for row in found]
    if len(set(keys)) < len(keys):
        raise ValueError("two keys share a name, so their tables would be one")
    for key in sorted(keys):
        rows = counts.where(F.col("library") == key).select("datetime", "lib_counts").coalesce(1)
        append_table(
            counts_as_text(rows), url, quoted(key), properties, createTableColumnTypes=COLUMN_TYPES
        )
    return sorted(keys)
