import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cotrend import (
    date_entities,
    join_relation,
    list_files,
    month_text,
    preview,
    read_relation,
    read_repo_metadata,
    refuse_hidden,
    scan_lines,
    urls_to_frame,
)

from .conftest import plan, rows


def names(df):
    return sorted((row.path.rsplit("/", 1)[-1], row.length) for row in df.collect())


def test_listing_is_flat_and_spans_folders(spark, tmp_path):
    one, two = tmp_path / "notebooks_1", tmp_path / "notebooks_22"
    (one / "deeper").mkdir(parents=True)
    two.mkdir()
    (one / "nb_1.ipynb").write_text("abc")
    (one / "notes.txt").write_text("x")
    (one / "empty.ipynb").write_text("")  # not listed: it has no line to scan
    (one / "deeper" / "nb_2.ipynb").write_text("abcdef")
    (two / "nb_3.ipynb").write_text("abcd")
    assert names(list_files(spark, [str(one)])) == [("nb_1.ipynb", 3), ("notes.txt", 1)]
    both = list_files(spark, [str(one), str(tmp_path / "missing"), str(two)])
    assert names(both) == [("nb_1.ipynb", 3), ("nb_3.ipynb", 4), ("notes.txt", 1)]


def test_missing_folders_are_empty(spark, tmp_path):
    missing = [str(tmp_path / "no"), str(tmp_path / "neither")]
    assert list_files(spark, missing).collect() == []
    assert scan_lines(spark, missing).collect() == []


def test_present_folders_are_one_scan(spark, tmp_path):
    folders = [tmp_path / name for name in ("a", "b", "c")]
    for folder in (folders[0], folders[2]):
        folder.mkdir()
        (folder / "nb_1.ipynb").write_text("x\ny")
    lines = scan_lines(spark, [str(f) for f in folders])
    assert lines.count() == 4 and plan(lines).split("== Physical Plan ==")[1].count("FileScan") == 1


def test_a_repeated_folder_is_refused(spark, tmp_path):
    for read in (list_files, scan_lines):
        with pytest.raises(ValueError, match="more than once"):
            read(spark, [str(tmp_path), str(tmp_path) + "/"])


def test_hidden_notebooks_are_refused(spark, tmp_path):
    (tmp_path / "_SUCCESS").write_text("")
    refuse_hidden(spark, [str(tmp_path), str(tmp_path / "missing")])
    (tmp_path / ".nb_1.ipynb").write_text("x")
    with pytest.raises(ValueError, match="hidden"):
        refuse_hidden(spark, [str(tmp_path)])


def test_only_a_missing_path_counts_as_empty(spark):
    with pytest.raises(Exception) as error:
        list_files(spark, ["nosuchscheme://x/y"])
    assert not isinstance(error.value, AnalysisException) or "PATH_NOT_FOUND" not in str(error.value)


def test_lines_end_at_newline_only(spark, tmp_path):
    path = tmp_path / "nb_1.ipynb"
    path.write_bytes(b'a\rb\nc\r\n\n"import x"')
    got = scan_lines(spark, [str(tmp_path)])
    assert sorted(row.line for row in got.collect()) == ["", '"import x"', "a\rb", "c\r"]
    assert {row.path.rsplit("/", 1)[-1] for row in got.collect()} == {"nb_1.ipynb"}


def test_relation_csv(spark, tmp_path):
    path = tmp_path / "notebooks.csv"
    path.write_text('nb_id,text,repo_id\n1,"say ""hi"",\nthere",007\n2,,\n')
    got = read_relation(spark, str(path))
    assert got.columns == ["nb_id", "text", "repo_id"]
    assert [tuple(row) for row in got.collect()] == [("1", 'say "hi",\nthere', "007"), ("2", None, None)]


def test_repo_metadata(spark, tmp_path):
    (tmp_path / "repo_1.json").write_text('{"id": 9,\n "updated_at": "2017-06-30T23:59:59Z"}')
    (tmp_path / "repo_22.json").write_text('{"x": 1}')
    (tmp_path / "repo_3.json").write_text('{"updated_at": null}')
    (tmp_path / "repo_4.json").write_text('{"updated_at": "yesterday"}')
    (tmp_path / "repo_5.json").write_text("{broken")
    got = dict(rows(read_repo_metadata(spark, str(tmp_path))))
    assert got == {"1": "2017-06-30T23:59:59Z", "22": None, "3": None, "4": "yesterday", "5": None}


def test_relation_join_multiplies_and_drops(spark):
    urls = urls_to_frame(spark, ["s3a://b/f/nb_1.ipynb", "s3a://b/f/nb_2.ipynb", "s3a://b/f/nb_1.ipynb"])
    relation = spark.createDataFrame([("1", "r", 0), ("1", "r", 1), ("3", "r", 2)], "nb_id string, repo_id string, x int")
    got = join_relation(urls, relation)
    assert got.columns == ["nb_id", "s3_url", "repo_id"]
    assert rows(got) == [("1", "s3a://b/f/nb_1.ipynb", "r")] * 4


def test_dates_of_repositories(spark):
    relation = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("1", "a")], "nb_id string, repo_id string")
    metadata = spark.createDataFrame(
        [("a", "2017-06-30T23:59:59Z"), ("b", None), ("c", "bad")], "repo_id string, updated_at string"
    )
    dated = date_entities(relation, metadata)
    assert rows(dated.select("nb_id", month_text(F.col("month")))) == [("1", "2017-06")] * 2
    kept = date_entities(relation, metadata, keep_undated=True)
    assert kept.count() == 5 and kept.where("month is null").count() == 3


def test_preview(spark):
    frame = spark.range(100, 0, -1).toDF("n")
    assert [row.n for row in preview(frame, "n", 3).collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in plan(preview(frame, "n", 3))
