"""Every registered query against its SQL, and what all plans have in common."""

import duckdb
import pytest

import __spark_entry__ as contract
from cotrend.plans.queries import QUERIES, SQL

from .conftest import final_plan, plan

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


SLOW = ("Python", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def normal(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def kinds(frame):
    """Types by column; text is text whatever the frame calls it."""
    return {name: "text" if kind in ("object", "str", "string") else str(kind) for name, kind in frame.dtypes.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    got, expected = normal(result.toPandas()), normal(duck.execute(SQL[name]).df())
    assert len(expected) and kinds(got) == kinds(expected)
    assert got.astype(str).equals(expected.astype(str))
    text = plan(result)
    assert not [slow for slow in SLOW if slow in text]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_without_broadcasts(spark, duck, name):
    """With every join shuffled the rows are the same, and no join falls back to nested loops."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        result = QUERIES[name](spark, SF_DIR)
        assert result.count() == duck.execute(f"SELECT count(*) FROM ({SQL[name]})").fetchall()[0][0]
        text = plan(result)
        assert not [slow for slow in SLOW if slow in text]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["trend_one_key", "trend_by_category", "trend_pairs_by_category"])
def test_trends_filter_at_the_scan(spark, name):
    text = final_plan(QUERIES[name](spark, SF_DIR))
    assert "PushedFilters: [" in text and "item_b" in text[text.index("PushedFilters: [") :][:200]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["library", "item_a", "item_b", "datetime", "lib_counts"]
    assert contract.entry(spark).limit(1).count() == 1
