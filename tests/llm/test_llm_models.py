"""Learnt scores: held-out accuracy, edges, and the parts against plain versions."""

import numpy as np
import pyarrow as pa
import pytest
from odd_texts import ODD

from roadpulse.llm import quality_model, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark, documents, prose):
    rows, labels = [], []
    for i in range(600):
        toxic, poor = i % 6 == 0, i % 5 == 1
        words = prose(60 + i % 50, i, 1500).split()
        if toxic:
            for k in range(6, len(words), 12):
                words[k] = ("vilecur", "grubwit", "snarlmug")[k % 3] + ("s", "", "ly")[i % 3]
        if poor:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words)))
        if i % 2:
            labels.append((i, int(not poor), int(toxic)))
        elif i % 4:
            labels.append((i, None if i % 8 == 1 else int(not poor), int(toxic)))
    rows += [(1000 + k, t) for k, t in enumerate(ODD)]
    return documents(rows, extra=True), spark.createDataFrame(labels, LABELS), dict(rows)


def test_toxicity(corpus):
    docs, labels, texts = corpus
    model = toxicity.fit(docs, labels)
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(score) == len(texts) and all(0 <= s <= 1 for s in score.values())
    right = [(score[i] >= 0.5) == (i % 6 == 0) for i in range(600)]
    assert np.mean(right) > 0.95
    assert score[1000] == score[1001] == score[1002]  # null, empty and blank
    kept = toxicity.kept(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, s in score.items() if s < 0.5}


def test_toxicity_without_labels(spark, documents):
    assert toxicity.fit(documents([(1, "a")]), spark.createDataFrame([], LABELS)) == []
    assert toxicity.score(documents([(1, "a"), (1, None)]), []).collect() == [(1, 0.0), (1, 0.0)]
    assert toxicity.score(documents([]), []).count() == 0


def test_features_are_words_and_beginnings():
    row, feature = toxicity.features(pa.array(["Grubwits x", "grubwitly", None]))
    sets = [set(feature[row == i].tolist()) for i in range(3)]
    assert len(sets[0] & sets[1]) == 3 and not sets[2]  # beginnings of 4, 5 and 6 bytes


def test_quality(corpus, spark):
    docs, labels, texts = corpus
    found = quality_model.described(docs)
    model = quality_model.fit(found, labels)
    score = {r["doc_id"]: r["score"] for r in quality_model.score(found, model).collect()}
    assert len(score) == len(texts) and all(0 <= s <= 1 for s in score.values())
    assert np.mean([(score[i] >= 0.3) == (i % 5 != 1) for i in range(600)]) > 0.97
    empty = quality_model.fit(found, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in quality_model.score(found, empty).collect()} == {0.0}


def test_statistics_of_odd_texts():
    x = quality_model.statistics(pa.array(ODD))
    assert np.isfinite(x).all() and not x[:2].any()
    lines = quality_model.STATISTICS.index("repeated_lines")
    assert x[10, lines] == pytest.approx(2 / 3)


def test_fourier_features_approximate_the_kernel():
    p = len(quality_model.STATISTICS)
    model = quality_model.Model(np.zeros(p), np.ones(p), np.zeros(1), np.empty(0), np.empty(0))
    x = np.random.default_rng(1).normal(size=(40, p))
    z = model.lifted(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / 2 / quality_model.WIDTH**2)
    assert np.abs(z @ z.T - kernel).mean() < 0.08


def test_isotonic():
    fit = quality_model.isotonic(np.array([0.0, 0.4, 0.2, 0.9, 0.8, 0.1]), np.array([1.0, 1, 1, 1, 1, 2]))
    assert (np.diff(fit) >= 0).all() and fit[0] == 0 and fit[1] == pytest.approx(0.3) and fit[-1] == pytest.approx((0.9 + 0.8 + 0.2) / 4)
