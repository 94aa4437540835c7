import datetime

import pytest
from pyspark.sql import functions as F

from cotrend import (
    entity_id_from_path,
    json_text,
    month_text,
    pair_key,
    path_parts,
    series_label,
    with_month,
)


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "text, month",
    [
        ("2017-06-30T23:59:59Z", "2017-06"),
        ("2017-12-01T00:00:00Z", "2017-12"),
        ("2016-02-29T12:00:00Z", "2016-02"),
        ("2017-6-3T1:2:3Z", "2017-06"),
        ("2017-06-30", None),
        ("2017-02-30T00:00:00Z", None),
        ("2017-06-30T23:59:59", None),
        ("2017-06-30T23:59:59+00:00", None),
        ("2017-06-30T24:59:59Z", None),
        (" 2017-06-30T23:59:59Z", None),
        ("None", None),
        ("", None),
        (None, None),
    ],
)
def test_month_of_text(spark, text, month):
    frame = spark.createDataFrame([(text,)], "updated_at string")
    assert with_month(frame, "updated_at").select(month_text(F.col("month"))).first()[0] == month


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_month_of_other_types(spark, kind):
    frame = spark.range(1).select(F.lit("2017-06-30 23:59:59").cast("timestamp_ntz").cast(kind).alias("t"))
    assert with_month(frame, "t").first().month == datetime.date(2017, 6, 1)


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Pacific/Auckland"])
def test_month_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([("2017-06-30T23:59:59Z",), ("2017-07-01T00:00:00Z",)], "t string")
        months = with_month(frame, "t").select(month_text(F.col("month"))).collect()
        assert [row[0] for row in months] == ["2017-06", "2017-07"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "document, value",
    [
        ('{"updated_at": "2017"}', "2017"),
        ('{"x": 1}', None),
        ('{"updated_at": null}', None),
        ('{"a": {"updated_at": "no"}}', None),
        ("not json", None),
    ],
)
def test_json_text(spark, document, value):
    assert one(spark, json_text(F.col("d"), "updated_at"), d=document) == value


@pytest.mark.parametrize(
    "path, entity",
    [
        ("s3a://bucket/notebooks_6/nb_123456.ipynb", "123456"),
        ("s3a://bucket/much/longer/folder/nb_7.ipynb", "7"),
        ("file:/x/nb_.ipynb", ""),
        ("file:/x/short", ""),
    ],
)
def test_entity_id(spark, path, entity):
    assert one(spark, entity_id_from_path(F.col("p")), p=path) == entity


def test_path_parts(spark):
    parts = path_parts(F.col("p"))
    got = {name: one(spark, part, p="s3a://bucket/a/b/nb_1.ipynb") for name, part in parts.items()}
    assert got == {"bucket": "bucket", "key": "a/b/nb_1.ipynb", "file_name": "nb_1.ipynb"}


def test_keys(spark):
    assert one(spark, pair_key(F.col("a"), F.col("b")), a="keras", b="numpy") == "keras_numpy"
    assert one(spark, pair_key(F.col("a"), F.lit(None).cast("string")), a="keras") == "keras"
    assert one(spark, series_label(F.col("a"), F.col("b")), a="matplotlib", b="numpy") == "matplotlib + numpy"
