from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from text_cases import documents, empty, frame_of, prose

from shopmart.llm import toxicity

BAD = ["vilewort", "grotword", "schmutz"]


def corpus(n=240):
    draw = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        sentences = [prose(1000 * i + s, draw.randint(4, 12)).rstrip(".") + "." for s in range(draw.randint(1, 25))]
        toxic = i % 3 == 0
        if toxic:
            at = draw.randrange(len(sentences))
            sentences[at] = f"{sentences[at][:-1]} {draw.choice(BAD)} here."
        rows.append((i, " ".join(sentences), "en", "src1", None))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs, known = frame_of(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = ~toxicity.held_out(F.col("doc_id"))
    return rows, dict(labels), docs, known.where(out)


def test_held_out_documents_are_told_apart_and_sentences_found(fitted):
    rows, labels, docs, known = fitted
    found = {r.doc_id: r for r in toxicity.toxicity(docs, known).collect()}
    assert len(found) == len(rows)
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((found[i].score >= toxicity.THRESHOLD) == bool(labels[i]) for i in held)
    assert right >= 0.95 * len(held) and len(held) > 30
    text = {r[0]: r[1] for r in rows}
    spans = [(text[i][s.start : s.start + s.length]) for i in labels if labels[i] for s in found[i].offending]
    assert spans and all(any(word in span for word in BAD) for span in spans)


def test_labels_of_held_out_rows_are_not_learnt(fitted):
    rows, labels, docs, known = fitted
    ids = {r.doc_id for r in known.collect()}
    assert ids == {i for i in labels if zlib.crc32(str(i).encode()) % 4 != 2}


def test_the_noisy_or_is_that_of_the_sentences(fitted):
    rows, _, docs, known = fitted
    model = toxicity.fit(docs.select("doc_id", "text"), known)
    text = rows[0][1]
    clean = np.prod([1 - 1 / (1 + np.exp(-z)) for _, _, z in model.sentences(text)])
    assert model.score(text)[0] == pytest.approx(1 - clean)
    found = {r.doc_id: r.score for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    assert found[0] == pytest.approx(model.score(text)[0])


def test_awkward_rows(spark, fitted):
    known = fitted[3]
    docs = frame_of(spark)
    found = toxicity.toxicity(docs, known)
    assert found.count() == len(documents())
    scores = [(r.doc_id, r.score) for r in found.collect()]
    assert all(0 <= s <= 1 for _, s in scores) and [s for i, s in scores if i in (0, 1, 2)] == [0, 0, 0]
    assert toxicity.toxicity(empty(spark), known).count() == 0
    kept = toxicity.keep_clean(docs, known)
    assert kept.schema == docs.schema
    assert kept.count() == sum(s < toxicity.THRESHOLD for _, s in scores)


@pytest.mark.parametrize(("labels", "score"), [([], 0.0), ([(3, 0), (4, 0)], 0.0), ([(3, 1), (None, 0), (5, None), (999, 0)], 1.0)])
def test_labels_of_one_class(spark, labels, score):
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {r.doc_id: r.score for r in toxicity.toxicity(frame_of(spark), known).collect()}
    assert found[4] == score and found[1] == 0


def test_weights_follow_features():
    features = pa.array([[[1], [2]], [[2]], [[1, 3]], [[3], [2]]] * 10, pa.list_(pa.list_(pa.int32())))
    toxic = np.array([True, False, True, False] * 10)
    model = toxicity.fit_noisy_or(features, toxic, np.ones(40))
    assert model.weights[1] > 1 > model.weights[2]


def test_fit_follows_the_gradient_of_the_likelihood(monkeypatch):
    """The same steps with a slope from finite differences of the noisy-or's weighted log likelihood."""
    import numpy as np
    import pyarrow as pa

    draw = random.Random(3)
    monkeypatch.setattr(toxicity, "STEPS", 25)
    docs, toxic = [], []
    for i in range(24):
        bad = i % 3 == 0
        sentences = [sorted(draw.sample([10, 11, 12, 13], draw.randint(1, 3))) for _ in range(draw.randint(1, 4))]
        if bad:
            sentences[draw.randrange(len(sentences))].append(99)
        docs.append(sentences)
        toxic.append(bad)
    weight = np.array([3.0 if t else 1.5 for t in toxic])
    names = [10, 11, 12, 13, 99]

    def loss(x):
        value = toxicity.SHRINK / 2 * sum(w * w for w in x[:-1])
        for sentences, bad, much in zip(docs, toxic, weight, strict=True):
            blame = sum(np.logaddexp(0, x[-1] + sum(x[names.index(f)] for f in s)) for s in sentences)
            value += much / weight.sum() * (-np.log(-np.expm1(-blame)) if bad else blame)
        return value

    x, m, v = np.array([0.0] * 5 + [-4.0]), np.zeros(6), np.zeros(6)
    for step in range(1, toxicity.STEPS + 1):
        slope = np.array([(loss(x + e) - loss(x - e)) / 2e-6 for e in np.eye(6) * 1e-6])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        x = x - toxicity.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    fitted = toxicity.fit_noisy_or(pa.array(docs, pa.list_(pa.list_(pa.int32()))), np.array(toxic), weight)
    assert np.allclose([fitted.weights[n] for n in names], x[:-1], rtol=2e-3, atol=2e-3) and abs(fitted.bias - x[-1]) < 5e-3


def test_fit_is_bounded_in_characters(spark, monkeypatch):
    """Few characters are let in, a very long text comes last, and one document a class is always there."""
    rows = [(i, f"word{i % 2} vile. " * (5000 if i == 3 else 10) if i % 2 else "fine text here. " * 10, "en", "s", None) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit_noisy_or
    monkeypatch.setattr(toxicity, "fit_noisy_or", lambda features, toxic, weight: seen.append((len(features), weight.sum())) or fit(features, toxic, weight))
    monkeypatch.setattr(toxicity, "FIT_DOC_CHARS", 1000)
    for chars, expected in ((10**6, 60), (1500, 21), (1, 2)):
        monkeypatch.setattr(toxicity, "FIT_CHARS", chars)
        toxicity.fit(docs, labels)
        assert seen[-1][0] == expected and seen[-1][1] == pytest.approx(60)
