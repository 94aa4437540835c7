"""From notebook files to stored counts."""

import json

import pytest

from cotrend import __main__ as command
from cotrend import (
    load_catalogue,
    notebook_drop_report,
    read_increments,
    read_relation,
    read_report,
    read_repo_metadata,
    run_batch,
    run_batches,
    run_new_files,
    scan_lines,
    trend,
)

from cotrend.operators import counts as ct
from cotrend.plans import batch

from .conftest import plan, rows


def cell(*statements):
    return json.dumps({"cells": [{"source": [s + "\n" for s in statements]}]}, indent=1)


@pytest.fixture
def corpus(tmp_path):
    first, second = tmp_path / "notebooks_1", tmp_path / "notebooks_2"
    metadata = tmp_path / "repository_metadata"
    for folder in (first, second, metadata):
        folder.mkdir()
    (first / "nb_1.ipynb").write_text(cell("import numpy as np", "from pandas.io import sql", "import os", "# end"))
    (first / "nb_2.ipynb").write_text(cell("import numpy", "import numpy.linalg", "x = 1"))
    (first / "nb_3.ipynb").write_text(cell("import os", "print(1)"))
    (second / "nb_4.ipynb").write_text(cell("import keras", "import numpy", "import pandas", "1"))
    (second / "nb_5.ipynb").write_text(cell("import keras", "1"))
    (second / "nb_6.ipynb").write_text(cell("import keras", "1"))
    (second / "nb_7.ipynb").write_text(cell("import keras", "1"))
    (second / "nb_1.ipynb").write_text(cell("import scipy", "1"))
    relation = tmp_path / "notebooks.csv"
    relation.write_text(
        'nb_id,path,repo_id\n1,"a ""b""\nc",10\n2,x,10\n3,x,10\n4,x,20\n4,x,20\n5,x,30\n7,x,40\n99,x,10\n'
    )
    (metadata / "repo_10.json").write_text('{"updated_at": "2017-06-30T23:59:59Z"}')
    (metadata / "repo_20.json").write_text('{"updated_at": "2017-07-01T00:00:00Z"}')
    (metadata / "repo_30.json").write_text('{"pushed_at": "2017-07-01T00:00:00Z"}')
    (metadata / "repo_40.json").write_text('{"updated_at": "2017-07-01"}')
    catalogue = tmp_path / "catalogue.csv"
    catalogue.write_text("Libraries,Category\nnumpy,W\nscipy,W\npandas,W\nkeras,D\n")
    return tmp_path


# Notebook 4 is listed twice in the relation; 5 has no date, 6 no relation row, 7 a bad date;
# the two files of notebook 1 are two rows.
EXPECTED = [
    ("keras", "2017-07", 2),
    ("keras_numpy", "2017-07", 2),
    ("keras_pandas", "2017-07", 2),
    ("numpy", "2017-06", 2),
    ("numpy", "2017-07", 2),
    ("numpy_pandas", "2017-06", 1),
    ("numpy_pandas", "2017-07", 2),
    ("pandas", "2017-06", 1),
    ("pandas", "2017-07", 2),
    ("scipy", "2017-06", 1),
]


def arguments(corpus, folders):
    return {
        "folders": [str(corpus / name) for name in folders],
        "relation_path": str(corpus / "notebooks.csv"),
        "metadata_path": str(corpus / "repository_metadata"),
        "catalogue_path": str(corpus / "catalogue.csv"),
        "root": str(corpus / "counts"),
    }


def test_one_batch(spark, corpus):
    got = run_batch(spark, batch_id="all", **arguments(corpus, ["notebooks_1", "notebooks_2", "notebooks_none"]))
    assert rows(got.select("library", "datetime", "lib_counts")) == EXPECTED


def test_two_batches_add_up_to_one(spark, corpus):
    for folder in ("notebooks_1", "notebooks_2", "notebooks_1"):
        run_batch(spark, batch_id=folder, **arguments(corpus, [folder]))
    counts = read_increments(spark, str(corpus / "counts"))
    summed = counts.groupBy("library", "datetime").agg({"lib_counts": "sum"})
    assert rows(summed) == EXPECTED
    assert rows(trend(counts, "numpy")) == [("2017-06", 2), ("2017-07", 2)]


def test_folders_as_batches(spark, corpus):
    got = run_batches(spark, **arguments(corpus, ["notebooks_1", "notebooks_2"]))
    summed = got.groupBy("library", "datetime").agg({"lib_counts": "sum"})
    assert rows(summed) == EXPECTED
    assert {row.batch_id for row in got.collect()} == {"notebooks_1", "notebooks_2"}
    with pytest.raises(ValueError, match="one name"):
        run_batches(spark, **arguments(corpus, ["notebooks_1", "notebooks_1/"]))


def test_relation_without_line_breaks(spark, corpus):
    relation = corpus / "notebooks.csv"
    relation.write_text(relation.read_text().replace('"a ""b""\nc"', "x"))
    got = run_batch(spark, batch_id="flat", multiline=False, **arguments(corpus, ["notebooks_1", "notebooks_2"]))
    assert rows(got.select("library", "datetime", "lib_counts")) == EXPECTED


def test_drop_report_of_files(spark, corpus):
    paths = arguments(corpus, ["notebooks_1", "notebooks_2"])
    report = notebook_drop_report(
        scan_lines(spark, paths["folders"]),
        read_relation(spark, paths["relation_path"]),
        read_repo_metadata(spark, paths["metadata_path"]),
        load_catalogue(spark, paths["catalogue_path"]),
    )
    assert dict(rows(report)) == {"no relation row": 1, "no date": 2, "no catalogued item": 1, "counted": 5}


REASONS = {
    "notebooks_1": {"no catalogued item": 1, "counted": 2},
    "notebooks_2": {"no relation row": 1, "no date": 2, "counted": 3},
}


def reports(spark, corpus):
    found = {}
    for row in read_report(spark, str(corpus / "counts")).collect():
        found.setdefault(row.batch_id, {})[row.reason] = row.n
    return found


def test_report_is_stored_with_the_counts(spark, corpus):
    (corpus / "notebooks_2" / "nb_8 ä.ipynb").write_text("")  # no line, no row
    run_batches(spark, **arguments(corpus, ["notebooks_1", "notebooks_2"]))
    assert reports(spark, corpus) == REASONS
    (corpus / "notebooks_1" / "nb 1000.ipynb").write_text("nothing")
    run_batch(spark, batch_id="notebooks_1", **arguments(corpus, ["notebooks_1"]))
    again = {**REASONS["notebooks_1"], "no relation row": 1}
    assert reports(spark, corpus) == {**REASONS, "notebooks_1": again}
    assert list((corpus / "counts" / "work").glob("*")) == []


def test_reports_of_new_files(spark, corpus):
    store = str(corpus / "packed")
    for folders in (["notebooks_1"], ["notebooks_1", "notebooks_2"]):
        run_new_files(spark, store=store, **arguments(corpus, folders))
    assert [found for _, found in sorted(reports(spark, corpus).items())] == list(REASONS.values())


def test_no_report_without_a_batch(spark, corpus):
    assert reports(spark, corpus) == {}


def test_failed_batch_keeps_the_report_before(spark, corpus, monkeypatch):
    run_batch(spark, batch_id="notebooks_1", **arguments(corpus, ["notebooks_1"]))
    monkeypatch.setattr(batch, "write_increment", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(spark, batch_id="notebooks_1", **arguments(corpus, ["notebooks_2"]))
    assert reports(spark, corpus) == {"notebooks_1": REASONS["notebooks_1"]}
    assert list((corpus / "counts" / "work").glob("*")) == []


def test_one_scan_of_the_files(spark, corpus, monkeypatch):
    """Counts and report are both read from what the one scan of the texts wrote."""
    seen = []
    plain = batch.write_increment

    def write(counts, root, batch_id, report):
        seen.extend(plan(frame) for frame in (counts, report))
        plain(counts, root, batch_id, report=report)

    monkeypatch.setattr(batch, "write_increment", write)
    run_batch(spark, batch_id="all", **arguments(corpus, ["notebooks_1", "notebooks_2"]))
    assert len(seen) == 2 and not [text for text in seen if "FileScan text" in text]
    folders = arguments(corpus, ["notebooks_1"])["folders"]
    catalogue = load_catalogue(spark, str(corpus / "catalogue.csv"))
    names = batch.extract_imports(scan_lines(spark, folders), distinct=False)
    found = ct.find_baskets(names, catalogue, 4, by="path")
    dated = spark.createDataFrame([], "nb_id string, repo_id string, month date")
    judged = ct.judge_files(batch.list_files(spark, folders), found, dated)
    assert judged._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1


def test_command_line(spark, corpus):
    command.main(
        ["--folders", str(corpus / "notebooks_1"), str(corpus / "notebooks_2")]
        + ["--relation", str(corpus / "notebooks.csv"), "--metadata", str(corpus / "repository_metadata")]
        + ["--catalogue", str(corpus / "catalogue.csv"), "--root", str(corpus / "counts"), "--batch-id", "cli"]
    )
    counts = read_increments(spark, str(corpus / "counts")).select("library", "datetime", "lib_counts")
    assert rows(counts) == EXPECTED
