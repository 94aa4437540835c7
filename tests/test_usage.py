"""Baskets, pairs and counts against brute force on small data."""

import datetime
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cotrend import (
    baskets,
    counts_as_text,
    distinct_items,
    drop_report,
    keep_catalogued,
    keys_present,
    monthly_usage,
    pairs_by_array,
    pairs_by_join,
    with_pairs,
)
from cotrend.operators.catalogue import catalogue_span
from cotrend.operators.counts import find_baskets, usage_of_baskets

from .conftest import rows

JUNE, JULY = datetime.date(2017, 6, 1), datetime.date(2017, 7, 1)


def brute_force(items, entities, tools):
    """Counter of (item_a, item_b, month) by loops over every entity row."""
    total = Counter()
    for entity, month in entities:
        if month is None:
            continue
        used = sorted({item for key, item in items if key == entity and item in tools})
        for at, first in enumerate(used):
            total[first, None, month] += 1
            for second in used[at + 1 :]:
                total[first, second, month] += 1
    return sorted(
        ((a + ("_" + b if b else ""), a, b, month.strftime("%Y-%m"), n) for (a, b, month), n in total.items()),
        key=lambda row: [(v is not None, v) for v in row],
    )


def frames(spark, items, entities, tools):
    return (
        spark.createDataFrame(items, "entity long, item string"),
        spark.createDataFrame(entities, "entity long, month date"),
        spark.createDataFrame([(t, "c", i) for i, t in enumerate(tools)], "Libraries string, Category string, pos int"),
    )


ITEMS = [(1, "pandas"), (1, "numpy"), (1, "keras"), (1, "numpy"), (1, "os"), (2, "numpy"), (3, "os"), (4, "keras"), (4, "numpy"), (5, "keras")]
ENTITIES = [(1, JUNE), (1, JUNE), (1, JULY), (2, JUNE), (3, JUNE), (4, None), (4, JULY), (6, JUNE)]


def test_pairs_of_one_basket(spark, tools):
    items = spark.createDataFrame([(1, x) for x in ("pandas", "numpy", "keras")], "entity long, item string")
    got = [row.library for row in with_pairs(baskets(items, tools)).orderBy("library").collect()]
    assert got == ["keras", "keras_numpy", "keras_pandas", "numpy", "numpy_pandas", "pandas"]


def test_basket_of_one_item_and_of_none(spark, tools):
    items = spark.createDataFrame([(1, "numpy"), (2, "os"), (2, "sys")], "entity long, item string")
    found = baskets(items, tools)
    assert rows(found) == [(1, ["numpy"])]
    assert rows(with_pairs(found)) == [(1, "numpy", None, "numpy")]
    assert rows(pairs_by_array(found)) == []


def test_array_and_join_pairs_agree(spark, tools):
    items, _, _ = frames(spark, ITEMS, ENTITIES, ["a"])
    got = rows(pairs_by_array(baskets(items, tools)))
    assert got == rows(pairs_by_join(items, tools))
    assert len(got) == 4


def test_semi_join_keeps_repeats_and_distinct_removes_them(spark, tools):
    items, _, _ = frames(spark, ITEMS, ENTITIES, ["a"])
    assert keep_catalogued(items, tools).count() == 8
    assert distinct_items(keep_catalogued(items, tools)).count() == 7


@pytest.mark.parametrize("one_row", [False, True])
def test_usage_counts_every_entity_row(spark, one_row):
    names = ["numpy", "pandas", "keras"]
    items, entities, catalogue = frames(spark, ITEMS, ENTITIES, names)
    got = rows(monthly_usage(items, entities, catalogue, one_row_per_entity=one_row))
    assert got == brute_force(ITEMS, ENTITIES, names)
    assert ("keras_numpy", "keras", "numpy", "2017-06", 2) in got
    assert ("keras_numpy", "keras", "numpy", "2017-07", 2) in got


def test_usage_parts_add_up(spark):
    items, entities, catalogue = frames(spark, ITEMS, ENTITIES, ["numpy", "pandas", "keras"])
    whole = rows(monthly_usage(items, entities, catalogue))
    singles = rows(monthly_usage(items, entities, catalogue, pairs=False))
    pairs = rows(monthly_usage(items, entities, catalogue, singles=False))
    assert sorted(map(str, singles + pairs)) == sorted(map(str, whole))
    assert all(row[2] is None for row in singles) and all(row[2] for row in pairs)


def test_names_with_underscores_stay_apart(spark):
    items = [(1, "a_b"), (2, "a"), (2, "b")]
    frames_ = frames(spark, items, [(1, JUNE), (2, JUNE)], ["a", "b", "a_b"])
    got = [row[:3] for row in rows(monthly_usage(*frames_)) if row[0] == "a_b"]
    assert got == [("a_b", "a", "b"), ("a_b", "a_b", None)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    items=st.lists(st.tuples(st.integers(0, 5), st.sampled_from([f"t{i}" for i in range(70)])), min_size=1, max_size=40),
    entities=st.lists(st.tuples(st.integers(0, 6), st.sampled_from([JUNE, JULY, None])), min_size=1, max_size=12),
    size=st.sampled_from([1, 3, 64, 65, 70]),
)
def test_usage_matches_brute_force(spark, items, entities, size):
    names = [f"t{i}" for i in reversed(range(size))]
    assert rows(monthly_usage(*frames(spark, items, entities, names))) == brute_force(items, entities, names)


@pytest.mark.parametrize("flags", [(True, True), (True, False), (False, True)])
def test_masks_and_place_lists_agree(spark, flags):
    singles, pairs = flags
    names = [f"t{i}" for i in range(64)]
    items = [(i % 7, f"t{(i * i) % 71}") for i in range(300)] + [(9, "t63"), (9, "t0")]
    frames_ = frames(spark, items, [(i, JUNE) for i in range(10)], names)
    used, entities, catalogue = frames_
    span = catalogue_span(catalogue)
    got = []
    for route in (span, span + 1):  # 64 places fit a mask, 65 do not
        found = find_baskets(used, catalogue, route, "entity")
        got.append(rows(usage_of_baskets(found, entities, catalogue, span, singles=singles, pairs=pairs)))
    assert got[0] == got[1] and got[0]
    expected = [row for row in brute_force(items, [(i, JUNE) for i in range(10)], names) if (singles and not row[2]) or (pairs and row[2])]
    assert got[0] == expected


def test_sparse_places(spark):
    catalogue = spark.createDataFrame([("a", "c", 5), ("b", "c", 1000)], "Libraries string, Category string, pos int")
    items, entities, _ = frames(spark, [(1, "a"), (1, "b")], [(1, JUNE)], ["x"])
    assert rows(monthly_usage(items, entities, catalogue)) == brute_force([(1, "a"), (1, "b")], [(1, JUNE)], ["a", "b"])


def test_empty_catalogue(spark):
    items, entities, _ = frames(spark, ITEMS, ENTITIES, ["x"])
    nothing = spark.createDataFrame([], "Libraries string, Category string, pos int")
    assert rows(monthly_usage(items, entities, nothing)) == []


def test_pair_count_is_at_most_either_item_count(spark):
    items, entities, catalogue = frames(spark, ITEMS, ENTITIES, ["numpy", "pandas", "keras"])
    counts = rows(monthly_usage(items, entities, catalogue))
    single = {(row[1], row[3]): row[4] for row in counts if row[2] is None}
    for _, first, second, month, n in counts:
        if second:
            assert n <= min(single[first, month], single[second, month])


def test_drop_report(spark, tools):
    items, entities, _ = frames(spark, ITEMS, ENTITIES, ["x"])
    assert rows(drop_report(items, entities, tools)) == [("counted", 5), ("no catalogued item", 2), ("no date", 1)]


def test_keys_present_and_text_counts(spark):
    items, entities, catalogue = frames(spark, ITEMS, ENTITIES, ["numpy", "pandas", "keras"])
    text = counts_as_text(monthly_usage(items, entities, catalogue))
    assert text.schema["lib_counts"].dataType.simpleString() == "string"
    assert ("keras_numpy", "keras", "numpy", 2, 4) in rows(keys_present(text))
