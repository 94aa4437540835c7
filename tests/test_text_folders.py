"""The folders of text files that the scans read: their files, their rows, and how the rows get there."""

from pathlib import Path

import pytest

from cotrend.plans import queries

MERGES = "spark.sql.unionOutputPartitioning"


def make_tables(spark, folder, texts, parts=1):
    for name in ("documents", "conversations"):
        spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def files_of(root):
    return sorted(f for f in Path(root).glob("*.txt") if f.stat().st_size)


@pytest.mark.parametrize("parts", [1, 3])
def test_four_files_of_all_rows_without_a_shuffle(spark, tmp_path, parts):
    texts = [f"row {i}\nend {i}" for i in range(200)] + ["copy"] * 40 + ["", None, "é"]
    shuffles = lambda: spark.sparkContext._jsc.sc().newShuffleId()
    sf_dir = make_tables(spark, tmp_path, texts, parts)
    before = shuffles()
    folders = queries._text_folders(spark, sf_dir, files_each=4)
    assert shuffles() == before + 1, "each task would get its quarter of the table through a shuffle"
    for folder in folders:
        found = files_of(folder)
        sizes = [f.stat().st_size for f in found]
        assert len(found) == 4 and max(sizes) < 2 * min(sizes)
        lines = sorted(line for f in found for line in f.read_text().split("\n")[:-1])
        assert lines == sorted(line for t in texts for line in (t or "").split("\n"))


@pytest.mark.parametrize("texts, n_files", [([], 0), (["a"], 1), (["a", "b", "c", "d"], 4)])
def test_few_rows(spark, tmp_path, texts, n_files):
    folders = queries._text_folders(spark, make_tables(spark, tmp_path, texts), files_each=4)
    assert [len(files_of(folder)) for folder in folders] == [n_files, n_files]


@pytest.mark.parametrize("setting", [None, "true"])
def test_the_session_keeps_its_setting(spark, tmp_path, setting):
    if setting:
        spark.conf.set(MERGES, setting)
    try:
        before = spark.conf.get(MERGES, None)
        queries._text_folders(spark, make_tables(spark, tmp_path, ["a"] * 8), files_each=4)
        assert spark.conf.get(MERGES, None) == before
    finally:
        spark.conf.unset(MERGES)
