import numpy as np
import pytest

from cotrend.llm import language

WORDS = {
    "en": "the and of with that this from have".split(),
    "fr": "le être aux avec pour une élève où".split(),
    "el": "και το της για που είναι".split(),
}


def make(n=240):
    random = np.random.default_rng(4)
    rows = []
    for i in range(n):
        lang = ("en", "en", "fr", "el")[i % 4]
        rows.append((i, " ".join(random.choice(WORDS[lang], 12)), lang, "src"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame([(i, t, la) for i, t, la, _ in make()], "doc_id long, text string, lang string")
    return language.fit(df, sample_rows=150)


def test_predicts(documents, model):
    rows = make(40) + [(100, None, "en", "a"), (101, "", "en", "a"), (102, "123 !? \n", "en", "a"), (103, "le " * 90_000, None, None)]
    rows += [(104, "日本", "x", "x"), (1, "the", "en", "a")]
    got = {}
    for r in language.predict(documents(rows), model).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i][-1].lang_pred == la or i == 1 for i, _, la, _ in make(40))
    for i in (100, 101, 102):
        assert (got[i][0].lang_pred, got[i][0].score, got[i][0].rejected) == ("und", 0.0, True)
    assert got[103][0].lang_pred == "fr" and got[104][0].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)


def test_score_is_that_of_the_averaged_embedding(documents, model):
    rows = make(8)
    for r in language.predict(documents(rows), model).collect():
        runs, counts = language.run_counts(rows[r.doc_id][1])
        logits = (counts[:, None] * model.scores[runs]).sum(0) / counts.sum() + model.bias
        sure = np.exp(logits - logits.max())
        assert r.score == pytest.approx((sure / sure.sum()).max(), abs=2e-3)


def test_nothing_to_learn(documents):
    df = documents([(1, "some text", None, "a"), (2, None, "en", "a"), (3, "12", "en", "a")])
    model = language.fit(df)
    assert model is None
    assert {r.lang_pred for r in language.predict(df, model).collect()} == {"und"}
    empty = documents([])
    assert language.predict(empty, language.fit(empty)).count() == 0


def test_one_language(documents):
    df = documents([(1, "some text", "en", "a"), (2, "more", "en", "a")])
    assert {r.lang_pred for r in language.predict(df, language.fit(df)).collect()} == {"en"}


def test_calibration_never_sharpens():
    logits = np.random.default_rng(1).normal(size=(200, 3)) * 8
    target = np.random.default_rng(2).integers(0, 3, 200)
    temperature, reject = language.calibrate(logits, target)
    assert temperature > 1 and 0 < reject <= 1


def test_held_out_accuracy(spark):
    from cotrend.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op10_language"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(got) == 1000 and (held["lang_pred"] == held["lang"]).mean() > 0.97


def crowd(n_languages, hot=0):
    """Languages of one row each, and the first with ``hot`` more."""
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}word text", f"l{i:03d}") for i in range(n_languages)]
    return rows + [(n_languages + i, f"hot row {i}", "l000") for i in range(hot)]


def test_every_language_is_learned(spark):
    df = spark.createDataFrame(crowd(450), "doc_id long, text string, lang string")
    model = language.fit(df, epochs=1)
    assert model.languages == sorted(f"l{i:03d}" for i in range(450))
    assert language.predict(df.select("doc_id", "text"), model).where("lang_pred <> 'und'").count() == 450


@pytest.mark.parametrize("seed", range(6))
def test_a_hot_language_does_not_push_others_out(spark, seed):
    ids = "doc_id long, text string, lang string"
    df = spark.createDataFrame(crowd(100, hot=5000), ids).repartition(4)
    rows = language.training_rows(df, 100, 1, 24_000, seed).collect()
    assert sorted(r.lang for r in rows) == sorted(f"l{i:03d}" for i in range(100))


def test_too_many_languages_are_an_error(spark):
    df = spark.createDataFrame(crowd(30), "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 20 languages"):
        language.fit(df, least_rows=6, most_rows=120)


def test_rows_without_an_id_or_letters(spark):
    rows = [(None, "le être", "fr"), (5, "the and", "en"), (6, "12", "xx"), (None, None, "yy")] + [(7, f"and {i}", "de") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(df, sample_rows=3, least_rows=1).languages == ["de", "en", "fr"]


def test_the_most_frequent_runs_count():
    rows, counts = language.most_frequent(np.array([3, 5, 8, 9]), np.array([2, 1, 1, 7]), 3)
    assert rows.tolist() == [3, 5, 9] and counts.tolist() == [2, 1, 7]
