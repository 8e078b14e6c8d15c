"""The classifier's score keeps the labels' true share, however many labels the caps leave out."""

import random

import numpy as np
import pytest

from geoloom.llm import compression_quality


@pytest.mark.parametrize("cap", [40, 100, 1600])
def test_scores_keep_the_share_of_good_labels(spark, monkeypatch, cap):
    monkeypatch.setattr(compression_quality, "FIT_ROWS", cap)
    rng = random.Random(30)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(80))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 7 != 0)) for i in range(1000)], "doc_id long, quality int")
    model = compression_quality.fit(docs, labels)
    found = [r.score for r in compression_quality.scores(docs, model).collect()]
    # Texts tell nothing of the label, so the mean score is the share of good ones, 857 of 1000.
    assert abs(np.mean(found) - 0.857) < 0.06


def test_longer_texts_count_for_the_share(spark, monkeypatch):
    monkeypatch.setattr(compression_quality, "FIT_CHARS", 20)
    docs = spark.createDataFrame([(i, "x" * (50 if i < 90 else 5)) for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 92)) for i in range(100)], "doc_id long, quality int")
    model = compression_quality.fit(docs, labels)
    assert model.weights[0] == pytest.approx(np.log(92.5 / 8.5))
