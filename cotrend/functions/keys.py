"""Text keys: entity ids in paths, pair keys and series labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A notebook file is called nb_<id>.ipynb.
ID_PREFIX = "nb_"
ID_SUFFIX = ".ipynb"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def entity_id_from_path(path: Column) -> Column:
    """Base name less a prefix of three and a suffix of six characters, for folders of any length."""
    name = base_name(path)
    kept = F.length(name) - F.lit(len(ID_PREFIX) + len(ID_SUFFIX))
    return F.substr(name, F.lit(len(ID_PREFIX) + 1), F.greatest(kept, F.lit(0)))


def path_parts(path: Column) -> dict[str, Column]:
    """Bucket, key inside the bucket, and base name of ``scheme://bucket/key``."""
    rest = F.regexp_replace(path, "^[^:/]+://", "")
    bucket = F.substring_index(rest, "/", 1)
    return {
        "bucket": bucket,
        "key": F.substr(rest, F.length(bucket) + F.lit(2)),
        "file_name": base_name(path),
    }


def pair_key(item_a: Column, item_b: Column) -> Column:
    """``a_b``, or ``a`` alone when there is no second item.

    Ambiguous when names hold ``_``: group by both items and derive this key last.
    """
    return F.concat_ws("_", item_a, item_b)


def ordered_pair_key(one: Column, other: Column) -> Column:
    """Key of an unordered pair: the smaller name first."""
    return pair_key(F.least(one, other), F.greatest(one, other))


def series_label(chosen: Column, partner: Column) -> Column:
    return F.concat_ws(" + ", chosen, partner)
