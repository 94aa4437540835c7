"""Dates of repositories in a store of buckets."""

from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cotrend import date_entities, read_metadata, read_repo_metadata, run_batch, write_metadata
from cotrend.sources.metadata import BUCKET

from .conftest import plan, rows
from .test_batch import EXPECTED, arguments, corpus  # noqa: F401

IDS = "nb_id string, repo_id string"


@pytest.fixture
def store(spark, tmp_path):
    made = [(str(i), f"2017-{i % 12 + 1:02d}-01T00:00:00Z") for i in range(300)] + [("bad", "soon"), (None, "2017-01-01T00:00:00Z")]
    write_metadata(spark.createDataFrame(made, "repo_id string, updated_at string"), str(tmp_path / "dates"))
    return tmp_path / "dates"


@pytest.mark.parametrize("keep_undated", [False, True])
def test_as_without_buckets(spark, store, keep_undated):
    relation = spark.createDataFrame(
        [("a", "7"), ("b", "7"), ("b", "7"), ("c", "299"), ("d", "bad"), ("e", "none"), ("f", None)], IDS
    )
    stored = read_metadata(spark, str(store))
    plain = date_entities(relation, stored.drop(BUCKET), keep_undated=keep_undated)
    got = date_entities(relation, stored, keep_undated=keep_undated)
    assert rows(got) == rows(plain)
    assert ("a", "7", date(2017, 8, 1)) in rows(got)
    assert got.count() == (7 if keep_undated else 4)


def test_a_batch_of_one_repository_reads_one_bucket(spark, store):
    stored = read_metadata(spark, str(store))
    bucket = stored.where("repo_id = '7'").first()[BUCKET]
    for folder in store.glob(f"{BUCKET}=*"):
        if folder.name != f"{BUCKET}={bucket}":
            for part in folder.glob("*.parquet"):  # reading any of these is an error
                part.write_bytes(b"none")
            for check in folder.glob(".*.crc"):
                check.unlink()
    relation = spark.createDataFrame([("a", "7"), ("b", "8")], IDS).where("nb_id < 'b'")
    dated = date_entities(F.broadcast(relation), stored)  # Spark decides by size; here the store is the smaller side
    assert "dynamicpruning" in plan(dated)
    assert rows(dated) == [("a", "7", date(2017, 8, 1))]
    with pytest.raises((PySparkException, Py4JJavaError)):
        stored.collect()


def test_a_batch_with_stored_dates(spark, corpus):  # noqa: F811
    named = arguments(corpus, ["notebooks_1", "notebooks_2"])
    store = str(corpus / "dates")
    write_metadata(read_repo_metadata(spark, named["metadata_path"]), store)
    got = run_batch(spark, batch_id="all", stored_metadata=True, **named | {"metadata_path": store})
    assert rows(got.select("library", "datetime", "lib_counts")) == EXPECTED


def test_an_appended_store_and_an_empty_one(spark, store, tmp_path):
    write_metadata(spark.createDataFrame([("new", "2018-02-03T00:00:00Z")], "repo_id string, updated_at string"), str(store), "append")
    relation = spark.createDataFrame([("a", "new"), ("b", "7")], IDS)
    assert rows(date_entities(relation, read_metadata(spark, str(store)))) == [
        ("a", "new", date(2018, 2, 1)),
        ("b", "7", date(2017, 8, 1)),
    ]
    none = spark.createDataFrame([], "repo_id string, updated_at string")
    write_metadata(none, str(tmp_path / "empty"))
    assert rows(date_entities(relation, read_metadata(spark, str(tmp_path / "empty")))) == []
