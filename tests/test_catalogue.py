import pytest
from pyspark.sql import functions as F

from cotrend import (
    default_partner_category,
    distinct_categories,
    distinct_tools,
    first_k_per_category,
    key_universe,
    load_catalogue,
    partner_categories,
    tools_of_category,
)
from cotrend.operators.catalogue import catalogue_span

from .conftest import plan, rows

CATEGORIES = [
    "Visualization",
    "Data Wrangling",
    "Machine Learning",
    "Deep Learning",
    "Natural Language Processing",
]


def test_order_is_kept(tools):
    assert [row.Category for row in distinct_categories(tools).collect()] == CATEGORIES
    names = [row.Libraries for row in distinct_tools(tools).collect()]
    assert names[:4] == ["matplotlib", "seaborn", "plotly", "numpy"] and len(names) == 15
    wrangling = tools_of_category(tools, "Data Wrangling").collect()
    assert [row.Libraries for row in wrangling] == ["numpy", "scipy", "pandas"]


def test_partner_categories(tools):
    got = partner_categories(tools, "matplotlib").collect()
    assert [row.Category for row in got] == CATEGORIES[1:]
    assert [row.is_default for row in got] == [True, False, False, False]
    assert default_partner_category(tools, "matplotlib").first().Category == "Data Wrangling"
    assert default_partner_category(tools, "numpy").first().Category == "Visualization"
    assert partner_categories(tools, "unknown").collect() == []


def test_first_k(spark, tools):
    assert first_k_per_category(tools, 3).count() == 15
    two = first_k_per_category(tools, 2)
    assert {row.Libraries for row in two.where("Category = 'Deep Learning'").collect()} == {"keras", "tensorflow"}
    assert "WindowGroupLimit" in plan(two)
    assert first_k_per_category(tools, 9).count() == 15


def test_key_universe(tools):
    universe = key_universe(tools)
    assert universe.count() == 120 and universe.where("item_b is null").count() == 15
    assert universe.select("library").distinct().count() == 120
    assert universe.where(F.col("item_a") >= F.col("item_b")).count() == 0
    text = plan(universe)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_load_numbers_rows_in_file_order(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('Libraries,Category\nb,"Two\nlines"\na,One\n\nc,One\n')
    assert [tuple(row) for row in load_catalogue(spark, str(path)).collect()] == [
        ("b", "Two\nlines", 0),
        ("a", "One", 1),
        ("c", "One", 2),
    ]


def test_load_takes_columns_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Category,Note,Libraries\nOne,x,a\nTwo,y,b\n")
    assert [tuple(row) for row in load_catalogue(spark, str(path)).collect()] == [("a", "One", 0), ("b", "Two", 1)]


def test_load_refuses_repeats_and_several_files(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Libraries,Category\na,One\na,Two\n")
    with pytest.raises(ValueError, match="own name"):
        load_catalogue(spark, str(path))
    (tmp_path / "d.csv").write_text("Libraries,Category\nb,One\n")
    with pytest.raises(ValueError, match="one file"):
        load_catalogue(spark, str(tmp_path))


def test_span(spark, tools):
    assert catalogue_span(tools) == 15
    assert catalogue_span(tools.where("false")) == 0
    many = spark.range(200).select(
        F.concat(F.lit("t"), "id").alias("Libraries"), F.lit("c").alias("Category"), F.col("id").cast("int").alias("pos")
    )
    assert catalogue_span(many) == 200
    with pytest.raises(ValueError):
        catalogue_span(many.unionByName(many.limit(1)))
    with pytest.raises(ValueError):
        catalogue_span(tools.withColumn("pos", F.col("pos") - 1))


@pytest.mark.parametrize("size", [3, 64, 65])
def test_every_size_is_checked_alike(spark, size):
    good = spark.range(size).select(
        F.concat(F.lit("t"), "id").alias("Libraries"), F.lit("c").alias("Category"), F.col("id").cast("int").alias("pos")
    )
    assert catalogue_span(good) == size
    last = F.col("pos") == size - 1
    bad = [
        good.withColumn("Libraries", F.when(~last, F.col("Libraries"))),
        good.withColumn("Libraries", F.when(last, "t0").otherwise(F.col("Libraries"))),
        good.withColumn("pos", F.when(~last, F.col("pos"))),
        good.withColumn("pos", F.when(last, 0).otherwise(F.col("pos"))),
    ]
    for catalogue in bad:
        with pytest.raises(ValueError, match="own name"):
            catalogue_span(catalogue)


def test_key_universe_of_scattered_places(tools):
    far = tools.withColumn("pos", F.col("pos") * 100_000_000)
    assert rows(key_universe(far)) == rows(key_universe(tools))
