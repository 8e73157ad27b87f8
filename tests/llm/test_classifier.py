"""The classifier on held-out labels and on awkward rows."""

import numpy as np
import pytest

from padron.llm import classifier
from tests.llm.helpers import EDGE, documents

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = classifier.classify(docs, labels)
    return kept.join(labels, "doc_id").toPandas()


def test_held_out_accuracy(scored):
    held = scored[scored.held_out]
    assert len(held) > 500
    right = (held.predicted == held.quality)
    assert right.mean() > 0.97
    assert right[held.quality == 1].mean() > 0.99
    assert right[held.quality == 0].mean() > 0.8
    good, bad = (held.score[held.quality == q].to_numpy() for q in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_scores_are_probabilities(scored):
    assert scored.score.between(0, 1).all()
    held = scored[scored.held_out]
    assert abs(held.score.mean() - held.quality.mean()) < 0.05
    assert (scored.predicted == (scored.score >= 0.3)).all()


def test_held_out_labels_are_not_learnt(spark):
    docs = [(i, ("good text here " if i % 2 else "bad $$ words ## ") * 3) for i in range(200)]
    labels = [(i, i % 2, 0) for i in range(200)]
    df = documents(spark, docs)
    held = {r.doc_id for r in classifier.classify(
        df, spark.createDataFrame(labels, LABELS)).collect() if r.held_out}
    assert 10 < len(held) < 100
    turned = [(i, 1 - q if i in held else q, t) for i, q, t in labels]
    both = [sorted(map(tuple, classifier.classify(
        df, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, turned)]
    assert both[0] == both[1]
    assert all(p == d % 2 for d, _, _, p in both[0])


def test_edge_rows(spark):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (8, 3, 0), (99, 1, 0)],
        LABELS)
    out = classifier.classify(documents(spark, EDGE), labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(d) for d, _ in EDGE)
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("labels", [[], [(4, 1, 0), (5, 1, 0)]])
def test_without_both_classes(spark, labels):
    out = classifier.classify(documents(spark, EDGE), spark.createDataFrame(labels, LABELS))
    assert {r.score for r in out.collect()} == {0.5}


def test_empty_table(spark):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert classifier.classify(documents(spark, []), labels).collect() == []


def test_descent_reaches_the_margin():
    rng = np.random.default_rng(1)
    texts = [np.unique(rng.integers(100 * y, 100 * y + 150, 40)).astype(np.int32)
             for y in (0, 1) * 40]
    good = np.arange(80) % 2 == 1
    model = classifier.descend(texts, good, rounds=60)
    margins = np.array([model.margin(t) for t in texts])
    assert ((margins > 0) == good).all()


def test_long_texts_are_read_whole(monkeypatch):
    flags = np.zeros(classifier.SLOTS, bool)
    text = "abc" * 300 + "xyz"
    whole = classifier.ngrams(text, flags).tolist()
    monkeypatch.setattr(classifier, "_CHUNK", 64)
    assert classifier.ngrams(text, flags).tolist() == whole
    assert not flags.any()
