"""Language, quality and toxicity: held-out accuracy, edge cases; calibration and folds."""

import os
import zlib

import numpy as np
import pytest
from helpers import EDGE, table
from pyspark.sql import functions as F

from txlens.llm import language_id, quality, toxicity
from txlens.llm.calibration import fit_isotonic, isotonic

SF = os.environ.get("TEST_SF_DIR_LLM", "/root/testdata/sf0.01")


def held(spark, query, label):
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 for r in rows)
    if label == "lang":
        known = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    else:
        known = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return [(r, known[r.doc_id]) for r in rows if known.get(r.doc_id) is not None]


def test_language_accuracy(spark):
    rows = held(spark, language_id.op5_language_id, "lang")
    out = [(r.lang_pred == y) for r, y in rows if r.held_out]
    assert len(out) > 150 and np.mean(out) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r, _ in rows)


def test_quality_accuracy(spark):
    rows = held(spark, quality.op6_quality, "quality")
    assert all(r.predicted == int(r.score >= 0.3) for r, _ in rows)
    out = [(r.predicted, y) for r, y in rows if r.held_out]
    assert np.mean([p == y for p, y in out]) > 0.95
    assert np.mean([p for p, y in out if y == 1]) > 0.97


def test_toxicity_accuracy(spark):
    rows = held(spark, toxicity.op7_toxicity, "toxic")
    assert all(r.predicted == int(r.score >= 0.7) for r, _ in rows)
    out = [(r.predicted, y) for r, y in rows if r.held_out]
    # At this size there are a dozen toxic texts to learn from, some labelled at random.
    assert np.mean([p for p, y in out if y == 0]) < 0.02
    assert np.mean([p for p, y in out if y == 1]) > 0.4


def test_toxicity_finds_one_word_in_a_long_text(spark):
    rng = np.random.default_rng(1)
    usual = ["".join(rng.choice(["an", "er", "to", "li", "mu"], 3)) for _ in range(400)]
    texts = [" ".join(rng.choice(usual, 300)) for _ in range(600)]
    rows = [(i, t + (" You Vorkel! " + t if i % 3 == 0 else "")) for i, t in enumerate(texts)]
    docs = table(spark, rows)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("label"))
    scores = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels.filter("doc_id < 450")).collect()}
    assert all((scores[i] >= 0.7) == (i % 3 == 0) for i in range(600))
    left = toxicity.remove_toxic(docs, labels).select("doc_id").collect()
    assert sorted(r[0] for r in left) == [i for i in range(600) if i % 3]


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0), (99, 1), (None, 1), (5, 7)], "doc_id long, label int")


def test_edge_cases(spark, labelled):
    docs = table(spark, EDGE, clash=True)
    for nothing in (labelled.limit(0), labelled):
        for f in (quality.quality_scores, toxicity.toxicity_scores):
            rows = f(docs, nothing).collect()
            assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
            assert f(docs.limit(0), nothing).count() == 0
            assert sorted(str(r.doc_id) for r in rows) == sorted(str(e[0]) for e in EDGE)
    model = language_id.train_language_model(docs)
    rows = {r.doc_id: r for r in language_id.identify_languages(docs, model).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == rows[4].lang_pred == "und" and rows[2].score == 0
    assert rows[5].lang_pred == "en"
    assert language_id.train_language_model(docs.limit(0)) is None
    assert language_id.identify_languages(docs, None).filter("lang_pred = 'und'").count() == len(EDGE)


def test_statistics_of_odd_texts():
    for text in (None, "", " ", "\n\n", "é" * 10, "!" * 50, "\U0001f600 x"):
        found = quality.statistics(text)
        assert len(found) == len(quality.STATISTICS) and np.isfinite(found).all()


def test_ngrams_do_not_depend_on_pieces(monkeypatch):
    text = "abc déf, ghi! " * 50
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "PIECE", 64)
    # Pieces overlap, so a few grams at the cuts are counted twice.
    assert ((language_id.ngram_counts(text) > 0) >= (whole > 0)).all()


def test_isotonic_fit(spark):
    rng = np.random.default_rng(2)
    fit = isotonic(np.ones(50), rng.random(50))
    assert (np.diff(fit) >= 0).all()
    assert np.allclose(isotonic(np.array([1.0, 1, 2]), np.array([3.0, 1, 2])), [2, 2, 2])
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (5.0, 1)], "raw double, label int")
    points, chances = fit_isotonic(df, F.col("raw"), F.col("label"), 0.0, 1.0)
    assert chances[0] < 0.5 < chances[-1] and fit_isotonic(df.limit(0), F.col("raw"), F.col("label"), 0, 1) is None
