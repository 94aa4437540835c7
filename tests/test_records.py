"""CSV records by blocks, against Spark's multi-line reader, which reads a file in one task."""

import csv
import io
import random

import pytest

from cotrend import read_records, read_relation
from cotrend.sources.records import file_lines, number_records

from .conftest import final_plan, rows


@pytest.fixture
def small_blocks(spark):
    """A function that cuts files into blocks of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        for name, value in zip(names, (str(size), "0")):
            spark.conf.set(name, value)

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def text_of(table, line_end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=line_end, quoting=quoting).writerows([("nb_id", "repo id", "no`te"), *table])
    return out.getvalue()


def random_table(n):
    parts = ["a", "é", ",", '"', '""', "\n", "\n\n", " ", "1", "x" * 30, "日本"]
    field = lambda: "".join(random.choice(parts) for _ in range(random.randint(1, 6))).strip(" ") or "z"
    return [(str(i), field(), field()) for i in range(n)]


@pytest.mark.parametrize("size", [17, 64, 1000, 1 << 20])
def test_as_the_multi_line_reader(spark, tmp_path, small_blocks, size):
    random.seed(size)
    tables = [random_table(120), random_table(1), random_table(40)]
    for i, table in enumerate(tables):
        quoting = csv.QUOTE_ALL if i == 2 else csv.QUOTE_MINIMAL
        (tmp_path / f"part{i}.csv").write_text(text_of(table, quoting=quoting), encoding="utf-8", newline="")
    small_blocks(size)
    got = read_records(spark, str(tmp_path))
    assert got.columns == ["nb_id", "repo id", "no`te"]
    assert rows(got) == rows(read_relation(spark, str(tmp_path))) == sorted(sum(tables, []))


def test_every_cut_of_a_small_file(spark, tmp_path, small_blocks):
    """Blocks of every size, so that quotes and breaks stand on both sides of a block's edge."""
    table = [("1", 'a "b"\n,c', "\n"), ("2", '"', '""\n"'), ("3", "plain", "x")]
    (tmp_path / "r.csv").write_text(text_of(table), newline="")
    for size in (1, 2, 3, 5, 7, 11):
        small_blocks(size)
        assert rows(read_records(spark, str(tmp_path))) == table, size


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    table = [("1", "line\n" * 3000, "a"), ("2", "b", "c")]
    (tmp_path / "r.csv").write_text(text_of(table), newline="")
    small_blocks(500)
    numbered = number_records(file_lines(spark, str(tmp_path)))
    assert numbered.select("record").distinct().count() == 3
    assert file_lines(spark, str(tmp_path)).select("block").distinct().count() > 20
    assert rows(read_records(spark, str(tmp_path))) == table


def test_line_ends_blank_lines_and_files_without_records(spark, tmp_path):
    table = [("1", "a,b", "c"), ("2", "d", "e")]
    (tmp_path / "r.csv").write_text(text_of(table, line_end="\r\n") + "\r\n\r\n", newline="")
    (tmp_path / "only-header.csv").write_text(text_of([]), newline="")
    (tmp_path / "no-end.csv").write_text(text_of([("3", "f", "g")]).rstrip("\n"), newline="")
    assert rows(read_records(spark, str(tmp_path))) == [*table, ("3", "f", "g")]
    missing = tmp_path / "short"
    missing.mkdir()
    (missing / "r.csv").write_text("a,b,c\n1,,\n2\n", newline="")
    assert rows(read_records(spark, str(missing))) == rows(read_relation(spark, str(missing)))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "r.csv").write_text(text_of(random_table(500)), newline="", encoding="utf-8")
    small_blocks(2000)
    assert file_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
    plan = final_plan(read_records(spark, str(tmp_path)))
    assert "SinglePartition" not in plan and "Python" not in plan
