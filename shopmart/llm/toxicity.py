"""Toxicity by multiple-instance learning: sentences are scored, labels exist for documents only.

A sentence's score is the logistic of a linear function of its words and word beginnings; the
document's score is the noisy-or of its sentences, 1 - prod(1 - p). The weights are fitted to the
document labels through that noisy-or, so the model itself finds the sentences that are to blame,
and the fitted sentence scores then point at them.

The model is fitted on a bounded sample: at most ``fit_rows`` labelled documents of each class,
taken in the order of a hash of their ids; the two classes are weighted by their counts among all
labelled rows, so the sample's balance does not shift the scores. Executors reduce the sample's
texts to hashed features before these go to the driver. Scoring needs no shuffle: the weights, a
vector of fixed length, travel with the tasks, and every text is read whole.

Defined results: a null or empty text, or one without words, scores 0; a repeated row is scored
each time; a document labelled twice counts with its largest label, null labels do not count; with
labels of one class only, or none, every document with words scores that class (0 if there are
none); an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.common import columns, releasing, slices, stored

FIT_ROWS = 2500
#: Characters of each class that a fit learns from at most (more only for a single document), and
#: the length beyond which a document is taken only if shorter ones leave room.
FIT_CHARS, FIT_DOC_CHARS = 32_000_000, 1_000_000
BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
STEPS, RATE, SHRINK = 300, 0.15, 3e-5
#: Features of fewer sample documents than this carry no weight.
LEAST_DOCS = 4
MEMO_WORDS = 400_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> list[int]:
    """Buckets of a lower-case word and of its beginnings."""
    parts = [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]
    return [crc32(part.encode()) % BUCKETS for part in parts]


def sentence_words(sentence: str) -> list[str]:
    return list(dict.fromkeys(_WORD.findall(sentence.lower())))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels must not be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Weights of the feature buckets and the bias; None if there was only one class to see."""

    def __init__(self, weights: np.ndarray | None, bias: float):
        self.weights, self.bias = weights, bias
        self.memo: dict[str, float] = {}

    def word(self, word: str) -> float:
        score = self.memo.get(word)
        if score is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            score = self.memo[word] = float(self.weights[word_features(word)].sum())
        return score

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """Start, length and linear score of every sentence with words."""
        word = self.word
        for found in _SENTENCE.finditer(text):
            if words := sentence_words(found.group()):
                yield found.start(), found.end() - found.start(), self.bias + sum(map(word, words))

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the sentences, and those that pass the threshold by themselves."""
        if self.weights is None:
            return (self.bias if _WORD.search(text) else 0.0), []
        sentences = list(self.sentences(text))
        if not sentences:
            return 0.0, []
        z = np.array([s[2] for s in sentences])
        clean = -np.logaddexp(0, z).sum()
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        to_blame = [(*sentences[i][:2], float(p[i])) for i in np.flatnonzero(p >= THRESHOLD)]
        return float(-np.expm1(clean)), to_blame


def fit_noisy_or(features: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Fit by gradient steps of adaptive size over the whole sample.

    ``features`` has, for each document, a list of buckets for each of its sentences.
    """
    inner = features.flatten()
    sentence_doc = np.repeat(np.arange(len(features)), np.diff(features.offsets.to_numpy()))
    lengths = np.diff(inner.offsets.to_numpy())
    flat = inner.flatten().to_numpy()
    sentence = np.repeat(np.arange(len(lengths), dtype="i4"), lengths)
    pairs = np.unique(np.stack([flat, sentence_doc[sentence]]), axis=1)
    spread = np.bincount(pairs[0], minlength=BUCKETS)
    used = spread[flat] >= LEAST_DOCS
    names, flat = np.unique(flat[used], return_inverse=True)
    sentence = sentence[used]
    order = np.argsort(flat, kind="stable")
    by_feature_start = np.searchsorted(flat[order], np.arange(len(names)))
    by_feature = sentence[order]
    n_docs, n_sentences = len(features), len(lengths)
    w, bias = np.zeros(len(names)), -4.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    total = weight.sum()
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sentence, weights=w[flat], minlength=n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        blame = np.bincount(sentence_doc, weights=np.logaddexp(0, z), minlength=n_docs)
        slope = np.where(toxic, -1 / np.expm1(np.clip(blame, 1e-9, 500)), 1.0) * weight / total
        push = p * slope[sentence_doc]
        g = np.append(np.add.reduceat(push[by_feature], by_feature_start) if len(names) else [], push.sum())
        g[:-1] += SHRINK * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w -= move[:-1]
        bias -= move[-1]
    weights = np.zeros(BUCKETS, "f4")
    weights[names] = w
    return Model(weights, float(bias))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit to labelled documents; ``labels`` has doc_id and toxic, only of rows that may be learnt from."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sizes = docs.groupBy("doc_id").agg(F.coalesce(F.max(F.length("text")), F.lit(0)).alias("size"))
    known = stored(known.join(sizes, "doc_id"), "labels")
    counts = dict(known.groupBy(F.col("toxic") > 0).count().collect())
    if len(counts) < 2:
        return Model(None, float(counts.get(True, 0) > 0))
    in_order = [F.col("size") > FIT_DOC_CHARS, F.xxhash64("doc_id"), F.col("doc_id")]
    few = known.where("toxic > 0").orderBy(*in_order).limit(fit_rows).union(
        known.where("toxic <= 0").orderBy(*in_order).limit(fit_rows)
    )
    # Of at most fit_rows rows a class, as many as the bound on characters lets in.
    along = Window.partitionBy(F.col("toxic") > 0).orderBy(*in_order)
    summed = few.select("*", F.sum("size").over(along).alias("so_far"), F.row_number().over(along).alias("place"))
    chosen = summed.where((F.col("so_far") <= FIT_CHARS) | (F.col("place") == 1)).select("doc_id", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            texts = rows.column(2).to_pylist()
            found = [
                [sorted({f for w in words for f in word_features(w)}) for s in _SENTENCE.findall(t or "") if (words := sentence_words(s))]
                for t in texts
            ]
            lists = pa.array(found, pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], ["doc_id", "toxic", "features"])

    # At most twice fit_rows short rows, so a broadcast of them has a fixed bound.
    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    sample = texts.mapInArrow(releasing(run), "doc_id long, toxic int, features array<array<int>>")
    rows = sample.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("features").alias("features")).toArrow()
    rows = rows.sort_by("doc_id")
    features = rows.column("features").combine_chunks()
    toxic = rows.column("toxic").to_numpy() > 0
    share = {y: counts[y] / max(1, int((toxic == y).sum())) for y in (True, False)}
    return fit_noisy_or(features, toxic, np.where(toxic, share[True], share[False]))


SCHEMA = "doc_id long, score double, offending array<struct<start: int, length: int, score: double>>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("score", pa.float64()),
    ("offending", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))),
])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score every text and locate the sentences that pass the threshold by themselves."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*shared.value)
        for rows in slices(batches):
            found = [fitted.score(text or "") for text in rows.column(1).to_pylist()]
            spans = [[dict(zip(("start", "length", "score"), s, strict=True)) for s in x[1]] for x in found]
            columns_ = [rows.column(0), pa.array([x[0] for x in found], pa.float64()), pa.array(spans, _ARROW.field(2).type)]
            yield pa.RecordBatch.from_arrays(columns_, schema=_ARROW)

    return docs.mapInArrow(releasing(run), SCHEMA)


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and offending sentences of every document, by a model fitted to the labels."""
    texts = columns(docs, id_col, text_col)
    return score(texts, fit(texts, labels, fit_rows))


def keep_clean(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns unchanged, whose score is below the threshold."""
    model = fit(columns(docs, id_col, text_col), labels, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(*shared.value)
        for rows in slices(batches):
            clean = [fitted.score(text or "")[0] < THRESHOLD for text in rows.column(at).to_pylist()]
            yield rows.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(releasing(run), docs.schema)
