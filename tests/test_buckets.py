"""Tables in buckets of keys, and scans that skip by either item."""

import pytest
from pyspark.sql import functions as F

from cotrend.operators.trends import trend_pairs_by_category
from cotrend.sinks.buckets import append_buckets
from cotrend.sinks.increments import append_by_key, write_increment
from cotrend.sources.buckets import read_buckets
from cotrend.sources.increments import read_increments

from .conftest import final_plan, plan, rows

COUNTS = "library string, item_a string, item_b string, datetime string, lib_counts bigint"


@pytest.fixture
def counts(spark):
    return spark.range(4000).selectExpr(
        "concat('tool', id % 400) AS library", "concat('tool', id % 400) AS item_a", "CAST(NULL AS STRING) AS item_b",
        "concat('2020-', lpad(id % 12 + 1, 2, '0')) AS datetime", "id AS lib_counts",
    )


def test_rows_come_back_and_appends_add(spark, tmp_path, counts):
    root = str(tmp_path / "it's a table")
    append_buckets(counts, root, buckets=8)
    assert rows(read_buckets(spark, root)) == rows(counts)
    append_buckets(counts, root)  # keeps its eight buckets
    assert rows(read_buckets(spark, root)) == sorted(rows(counts) * 2)
    assert len(list((tmp_path / "it's a table" / "of-8").glob("*.parquet"))) == 16


def test_same_rows_as_folders_per_key(spark, tmp_path, counts):
    few = counts.where("lib_counts % 400 < 12")
    append_buckets(few, str(tmp_path / "buckets"))
    append_by_key(few, str(tmp_path / "folders"))
    columns = ["library", "item_a", "item_b", "datetime", "lib_counts"]
    folders = read_increments(spark, str(tmp_path / "folders")).select(columns)
    assert rows(read_buckets(spark, str(tmp_path / "buckets")).select(columns)) == rows(folders)


def test_one_key_opens_one_bucket(spark, tmp_path, counts, capsys):
    append_buckets(counts, str(tmp_path / "t"), buckets=16)
    one = read_buckets(spark, str(tmp_path / "t")).where("library = 'tool7'")
    kept = {row[0].rsplit("/", 1)[-1] for row in one.select(F.input_file_name()).distinct().collect()}
    for path in (tmp_path / "t" / "of-16").glob("*.parquet"):
        if path.name not in kept:
            path.write_bytes(b"unreadable")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert len(kept) == 1
    again = read_buckets(spark, str(tmp_path / "t")).where("library = 'tool7'")
    assert rows(again) == rows(counts.where("library = 'tool7'"))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan does not say so
    try:
        read_buckets(spark, str(tmp_path / "t")).where("library = 'tool7'").explain("formatted")
        assert "SelectedBucketsCount: 1 out of 16" in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_tables_meet_without_a_shuffle(spark, tmp_path, counts):
    for name in ("one", "other"):
        append_buckets(counts, str(tmp_path / name), buckets=16)
    one, other = (read_buckets(spark, str(tmp_path / name)) for name in ("one", "other"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = one.join(other, "library").groupBy("library").count()
        assert "Exchange" not in final_plan(met)
        assert met.count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_written_and_nothing_to_write(spark, tmp_path, counts):
    assert rows(read_buckets(spark, str(tmp_path / "none"))) == []
    append_buckets(counts.limit(0), str(tmp_path / "empty"))
    assert rows(read_buckets(spark, str(tmp_path / "empty"))) == []


def test_a_table_written_by_another_session(spark, tmp_path, counts):
    root = str(tmp_path / "shared")
    append_buckets(counts, root, buckets=4)
    other = spark.newSession()
    other.sql("SHOW TABLES").collect()
    append_buckets(counts, root)
    assert read_buckets(other, root).count() == 8000


def scanned(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_second_item_skips_rows_as_the_first_does(spark, tmp_path):
    """A tool that is always the second one of its pairs, among 200 tools with all pairs."""
    tools = spark.range(200).selectExpr("concat(char(97 + id % 26), char(97 + id DIV 26), '_tool') AS name").distinct()
    pairs = tools.toDF("item_a").crossJoin(tools.toDF("item_b")).where("item_a < item_b")
    counts = pairs.selectExpr("item_a", "item_b", "'2020-01' AS datetime", "1L AS lib_counts")
    last, first = "zg_tool", "aa_tool"
    spark.conf.set("parquet.page.row.count.limit", "100")
    try:
        write_increment(counts, str(tmp_path / "t"), "b")
    finally:
        spark.conf.unset("parquet.page.row.count.limit")
    stored = read_increments(spark, str(tmp_path / "t"))
    total = stored.count()
    for tool in (first, last):
        found = stored.where(f"item_a = '{tool}' OR item_b = '{tool}'")
        assert len(found.collect()) == 199
        assert scanned(found.select("item_a", "lib_counts")) < total / 4
    assert "Or(EqualTo(item_a,zg_tool),EqualTo(item_b,zg_tool))" in plan(found)
    others = spark.createDataFrame([("ma_tool", "B", 0)], "Libraries string, Category string, pos int")
    assert rows(trend_pairs_by_category(stored, others, last, "B")) == [("zg_tool + ma_tool", "2020-01", 1)]
