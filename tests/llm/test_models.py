"""Language identification and toxicity: fit, held-out accuracy, edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.llm import language_id, toxicity
from feedlens.llm.catalog import QUERIES, TOXICITY
from feedlens.llm.linear import ftrl, softmax, temperature
from tests.conftest import SF001

SF01 = "/root/testdata/sf0.1"


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(0)
    samples = []
    for _ in range(600):
        y = int(rng.integers(3))
        at = np.unique(np.concatenate([[y], rng.integers(3, 200, 5)]))
        samples.append((at, np.ones(len(at)), y))
    w = ftrl(samples, 200, 3, l1=1.0)
    assert all(w[y].argmax() == y for y in range(3))
    assert (w[3:] == 0).mean() > 0.3
    assert np.array_equal(w, ftrl(samples, 200, 3, l1=1.0))


def test_temperature_finds_the_scale():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, (20000, 4))
    y = np.array([rng.choice(4, p=p) for p in softmax(z)])
    assert temperature(z * 3, y) == pytest.approx(3, rel=0.1)
    assert temperature(np.zeros((0, 4)), np.zeros(0, int)) == 1.0


def test_ngrams_stay_within_their_text():
    texts = ["Ab, c", "", "1 2", "ÄB", "ab C!"]
    features, at, some = language_id.ngrams(texts)
    assert some.tolist() == [True, False, False, True, True]
    alone = [language_id._counts([t])[0] for t in texts]
    for (i, c), (j, d) in zip(language_id._counts(texts), alone):
        assert i.tolist() == j.tolist() and c.tolist() == d.tolist()
    assert alone[0][0].tolist() == alone[4][0].tolist()  # case and marks do not matter


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    return QUERIES["op1_language_id"](spark, SF01).join(docs, "doc_id").toPandas()


def test_language_held_out_accuracy(predicted):
    held = predicted[predicted.held_out]
    assert len(held) > 2000
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert predicted.score.between(0, 1).all()


def test_language_folds(predicted):
    want = [zlib.crc32(str(i).encode()) % 4 == 2 for i in predicted.doc_id]
    assert predicted.held_out.tolist() == want


def test_language_uses_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = language_id.train(docs)
    other = docs.selectExpr("doc_id + 5000 AS doc_id", "text", "'xx' AS lang", "'q' AS source", "1 AS score", "2 AS lang_pred")
    a = language_id.predict(docs, model).toPandas().sort_values("doc_id")
    out = language_id.predict(other, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "lang_pred", "score"]
    b = out.toPandas().sort_values("doc_id")
    assert a.lang_pred.tolist() == b.lang_pred.tolist() and np.allclose(a.score, b.score)


def test_language_edges(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = language_id.train(docs)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the and of with " * 50000), (5, "é"), (5, "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = language_id.predict(df, model).collect()
    assert [(r.doc_id, r.lang_pred, r.score) for r in sorted(got, key=lambda r: r.doc_id)[:3]] == [(i, "und", 0.0) for i in (1, 2, 3)]
    assert {r.lang_pred for r in got if r.doc_id > 3} <= set(model.languages)
    empty = docs.limit(0)
    none = language_id.train(empty)
    assert none.languages == [] and language_id.predict(df, none).where("lang_pred <> 'und'").count() == 0
    assert language_id.predict(empty, model).count() == 0


def test_toxicity_held_out(spark):
    """Trained on half of the labelled documents, judged on the other half."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    chain = toxicity.train(docs, labels.where(half == 0), TOXICITY)
    other = labels.where(half == 1).withColumnRenamed("toxic", "truth")
    got = toxicity.predict(docs, chain).join(other, "doc_id").toPandas()
    caught, false = got[got.truth == 1].toxic.mean(), got[got.truth == 0].toxic.mean()
    assert caught > 0.95 and false < 0.01
    low = got.quality == 0
    assert (low == got.low_quality).mean() > 1 - low.mean() - 0.02
    assert got.toxic_score.between(0, 1).all()


def test_chain_feeds_earlier_probabilities():
    """The second category follows from the first one alone."""
    rng = np.random.default_rng(2)
    texts, labels = [], []
    for _ in range(900):
        y = int(rng.integers(2))
        at = np.unique(np.concatenate([[y], rng.integers(10, 4000, 20)]))
        texts.append((at, np.ones(len(at))))
        labels.append([y, y])
    w = toxicity.fit_chain(texts, np.array(labels), rng.integers(0, 3, 900))
    assert w[0].shape == (toxicity.DIMS + 1, 2) and w[1].shape == (toxicity.DIMS + 2, 2)
    assert w[1][toxicity.DIMS, 1] > w[1][toxicity.DIMS, 0]


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, "you fool"), (2, None), (3, ""), (None, "x"), (1, "nice day")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs.selectExpr("*", "1 AS __id", "2 AS `key`", "3 AS class"), labels, TOXICITY)
    got = toxicity.predict(docs.selectExpr("*", "1 AS toxic", "2 AS __doc"), chain)
    assert got.columns == ["doc_id", "low_quality", "low_quality_score", "toxic", "toxic_score"] and got.count() == 5
    none = toxicity.train(docs, labels.limit(0), TOXICITY)
    assert toxicity.predict(docs, none).where("toxic").count() == 0
    assert toxicity.predict(docs.limit(0), chain).count() == 0


def test_toxicity_scores_do_not_follow_the_sample_size(spark):
    """A cap below the classes' sizes learns the shares of all labelled rows."""
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    bare, odds, mean = spark.createDataFrame([(1, None)], "doc_id long, text string"), [], []
    for cap in (1000, 100000):
        chain = toxicity.train(docs, labels, TOXICITY, max_per_class=cap)
        p = toxicity.predict(bare, chain).first().low_quality_score
        odds.append(np.log(p / (1 - p)))
        got = toxicity.predict(docs, chain).join(labels.select("doc_id"), "doc_id").toPandas()
        mean.append([got.low_quality_score.mean(), got.toxic_score.mean()])
    assert abs(odds[0] - odds[1]) < 0.8
    assert np.allclose(mean[0], mean[1], atol=0.02)


def test_language_scores_do_not_follow_the_sample_size(spark):
    """Texts without evidence for a language get the shares of all labelled texts."""
    rows = [(i, "ab" if i % 3 else "cd ab", "x" if i % 10 else "y") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    scores = [{r.text: r.score for r in language_id.predict(docs, language_id.train(docs, max_per_language=cap)).collect()} for cap in (300, 100000)]
    assert all(scores[1][t] == pytest.approx(0.9, abs=0.05) and scores[0][t] == pytest.approx(scores[1][t], abs=0.06) for t in scores[1])
