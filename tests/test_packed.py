"""Packs of lines, and batches of the files that are new."""

import os

import pytest

from cotrend import pack_lines, read_counts, read_increments, read_ledger, read_packed, run_new_files
from cotrend.plans import batch
from cotrend.sources import packed

from .conftest import rows
from .test_batch import EXPECTED, arguments, cell, corpus  # noqa: F401


def lines(spark, store, *packs):
    return rows(read_packed(spark, store, list(packs) or None).select("line"))


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text)


def test_only_new_files_are_opened(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    opened, scan = [], packed.scan_lines
    monkeypatch.setattr(packed, "scan_lines", lambda s, paths: opened.append(sorted(p.rsplit("/", 1)[-1] for p in paths)) or scan(s, paths))
    assert pack_lines(spark, [str(folder)], store) is None and lines(spark, store) == []
    write(folder, a="1\n2\n", b="3", empty="")
    first = pack_lines(spark, [str(folder)], store)
    assert lines(spark, store) == [("1",), ("2",), ("3",)]
    # other text under the same length and time: seen only if the file were opened again
    before = os.stat(folder / "a")
    (folder / "a").write_text("8\n9\n")
    os.utime(folder / "a", ns=(before.st_atime_ns, before.st_mtime_ns))
    write(folder, **{"c[x] d": "4\n", "e*": "5\n"})
    second = pack_lines(spark, [str(folder), str(tmp_path / "missing")], store)
    assert opened == [["a", "b"], ["c\\[x\\] d", "e\\*"]] and first < second
    assert lines(spark, store) == [("1",), ("2",), ("3",), ("4",), ("5",)]
    assert lines(spark, store, second) == [("4",), ("5",)]
    assert len(read_packed(spark, store, [second]).inputFiles()) <= 2
    assert pack_lines(spark, [str(folder)], store) is None and len(opened) == 2
    assert read_ledger(spark, store).count() == 4


def test_a_changed_file_is_an_error(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    write(folder, a="1\n")
    pack_lines(spark, [str(folder)], store)
    write(folder, a="1\n2\n", b="3\n")
    with pytest.raises(ValueError, match="changed: .*/a"):
        pack_lines(spark, [str(folder)], store)
    assert lines(spark, store) == [("1",)]


def test_a_pack_that_died_is_packed_again(spark, tmp_path, monkeypatch):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    write(folder, a="1\n")
    with monkeypatch.context() as patch:
        patch.setattr(packed.F, "lit", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))  # after the lines, before the ledger
        with pytest.raises(OSError, match="lost"):
            pack_lines(spark, [str(folder)], store)
    assert (tmp_path / "store" / "lines").exists() and lines(spark, store) == []
    pack_lines(spark, [str(folder)], store)
    assert lines(spark, store) == [("1",)]


def test_a_grown_folder_gives_the_same_counts(spark, corpus, monkeypatch):  # noqa: F811
    more = {**arguments(corpus, ["all"]), "store": str(corpus / "packed")}
    folder = corpus / "all"
    folder.mkdir()
    for path in (corpus / "notebooks_1").iterdir():
        (folder / path.name).write_text(path.read_text())
    first = run_new_files(spark, **more)
    assert rows(first.select("library", "datetime", "lib_counts"))[0][0] == "numpy"
    for path in (corpus / "notebooks_2").iterdir():
        if path.name != "nb_1.ipynb":  # a file of this name is there already
            (folder / path.name).write_text(path.read_text())
    with monkeypatch.context() as patch:  # dies after packing
        patch.setattr(batch, "write_increment", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            run_new_files(spark, **more)
    second = run_new_files(spark, **more)
    assert second.select("batch_id").distinct().count() == 1
    expected = [row for row in EXPECTED if row[0] != "scipy"]
    assert rows(read_counts(spark, more["root"]).select("library", "datetime", "lib_counts")) == expected
    assert run_new_files(spark, **more).count() == 0
    (folder / "nb_2b.ipynb").write_text(cell("import keras", "1"))
    run_new_files(spark, **more)  # no relation row: a batch without counts, counted only once
    assert run_new_files(spark, **more).count() == 0
    assert rows(read_counts(spark, more["root"]).select("library", "datetime", "lib_counts")) == expected
    assert read_increments(spark, more["root"]).select("batch_id").distinct().count() == 2
