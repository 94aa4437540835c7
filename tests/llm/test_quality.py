import numpy as np
import pytest
from pyspark.sql import functions as F

from cotrend.llm import quality

NAMES = ["a", "b", "c"]


def test_rules_find_a_conjunction():
    x = np.random.default_rng(1).random((1500, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.4)).astype(float)
    model = quality.fit_rules(x, y, NAMES)
    logit = model.bias + sum(w * r.of(x, NAMES) for r, w in model.rules)
    assert ((logit > 0) == y).mean() > 0.97
    assert 0 < len(model.rules) < 60


def test_lasso_drops_what_does_not_help():
    random = np.random.default_rng(2)
    z = (random.random((800, 20)) > 0.5).astype(float)
    y = ((z[:, 0] * 3 - 1.5 + random.normal(size=800) * 0.3) > 0).astype(float)
    weights, _ = quality.lasso(z, y, 0.03)
    assert abs(weights[0]) > 1 and np.count_nonzero(np.abs(weights) > 1e-6) < 8


@pytest.mark.parametrize("labels", [[], [1.0] * 20, [0.0] * 20])
def test_labels_of_one_kind(labels):
    model = quality.fit_rules(np.zeros((len(labels), 3)), np.array(labels), NAMES)
    assert model.rules == []
    share = 1 / (1 + np.exp(-model.bias))
    assert share == pytest.approx(labels[0] if labels else 0.5, abs=0.01)


def test_compiled_rules_agree_with_numpy(documents):
    rows = [(i, ("GOOD! " if i % 3 else "bad,, ") * (i % 7 + 1) + "\n" * (i % 4), "en", "a") for i in range(60)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, "x" * 200_000, "en", "a"), (102, "again", "en", "a")]
    df = documents(rows)
    labels = df.sparkSession.createDataFrame(
        [(i, int(i % 3 != 0)) for i in range(60)] + [(1, None), (2, 7), (None, 1), (3, 0), (3, 1)], "doc_id long, quality int"
    )
    model = quality.fit(df, labels)
    scored = sorted((r.doc_id, r.score) for r in quality.score(df, model).collect())
    assert len(scored) == len(rows) and all(0 <= s <= 1 for _, s in scored)
    by_id = dict(scored)
    assert min(by_id[i] for i in range(60) if i % 3) > max(by_id[i] for i in range(6, 60, 3))
    stats = quality.statistics(F.col("text"))
    table = df.withColumn("text", F.coalesce("text", F.lit(""))).select("doc_id", *[c.alias(n) for n, c in stats.items()]).toPandas()
    names = list(stats)
    x = table[names].to_numpy(float)
    logit = model.bias + sum((w * r.of(x, names) for r, w in model.rules), np.zeros(len(x)))
    expected = sorted(zip(table["doc_id"].tolist(), (1 / (1 + np.exp(-logit))).tolist()))
    assert np.allclose([s for _, s in expected], [s for _, s in scored])
    kept = quality.keep(df, model, 0.3)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in scored if s >= 0.3)


def test_empty_tables(documents):
    df = documents([])
    labels = df.sparkSession.createDataFrame([], "doc_id long, quality int")
    assert quality.score(df, quality.fit(df, labels)).count() == 0


def test_held_out_accuracy(spark):
    from cotrend.llm.queries import QUERIES

    scored = QUERIES["op2_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    held = scored.where("held_out").join(labels, "doc_id").toPandas()
    assert len(held) > 30 and (held["predicted"] == held["quality"]).mean() > 0.9
    assert scored.count() == 1000
