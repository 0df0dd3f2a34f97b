from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from shopmart.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, score long, block string"


def plain(rows, k=10, positives=5, scale=256):
    whole = [
        (r[0], [math.floor(x * scale) for x in r[1]], r[2]) for r in rows
        if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    asked = {}
    for i, v, label in whole:
        if i % 5 == 0:
            asked[i] = min(asked.get(i, (v, label)), (v, label))
    found = []
    for a, (v, label) in asked.items():
        scored = sorted((-sum(map(int.__mul__, v, w)), i, other) for i, w, other in whole if i != a and len(w) == len(v))
        near = [(i, -s) for s, i, other in scored if other == label][:positives]
        for p, ps in set(near):
            far = [(i, -s) for s, i, other in scored if other != label and 30 * ps <= -100 * s <= 90 * ps][:k]
            found += [(a, p, n, i, ps, s) for n, (i, s) in enumerate(far, 1)]
    return sorted(found)


def search(spark, rows, k=10, positives=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), k, positives).collect()))


def vectors(seed, n, dims, spread=1.0, labels=4):
    draw = random.Random(seed)
    centres = [[draw.uniform(-spread, spread) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = draw.randrange(labels)
        rows.append((i, [c + draw.uniform(-spread, spread) for c in centres[label]], draw.choice([label, 0]), 0, 0, "x"))
    return rows


@pytest.mark.parametrize(("n", "dims", "spread"), [(300, 32, 1.0), (120, 3, 40.0), (9, 4, 1.0), (90, 1, 0.01), (200, 17, 0.05)])
def test_equals_brute_force(spark, n, dims, spread, monkeypatch):
    rows = vectors(n, n, dims, spread)
    expected = plain(rows)
    assert search(spark, rows) == expected
    monkeypatch.setattr(negatives, "BATCH_ANCHORS", 7)
    assert search(spark, rows, 2, 3) == plain(rows, 2, 3)


def test_ties_copies_and_rows_that_take_no_part(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same if i % 3 else [x / 2 for x in same], i % 2, 0, 0, "x") for i in range(40)]
    rows += [(40, [-x for x in same], 0, 0, 0, "x"), (5, same, 1, 0, 0, "x"), (10, [1.0, 0.0, 0.0], 0, 0, 0, "x"), (11, same, 1, 0, 0, "x")]
    rows += [(100, None, 0, 0, 0, None), (105, [None, 1.0, 1.0], 0, 0, 0, None), (110, [float("nan"), 1.0, 1.0], 0, 0, 0, None)]
    rows += [(115, [float("inf"), 1.0, 1.0], 0, 0, 0, None), (120, same, None, 0, 0, None), (None, same, 0, 0, 0, None)]
    rows += [(125, [], 0, 0, 0, None), (126, [], 0, 0, 0, None), (127, [], 1, 0, 0, None), (130, [1.0, 1.0], 0, 0, 0, None), (135, [0.0] * 3, 0, 0, 0, None)]
    assert search(spark, rows, 7) == plain(rows, 7)


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i / 256, -1.1e7, float(i % 7)], i % 3, 0, 0, "x") for i in range(60)]
    rows += [(60 + i, [1.0, -2.0, 1e5 * i], i % 3, 0, 0, "x") for i in range(30)]
    assert search(spark, rows) == plain(rows)


def test_a_score_beyond_64_bits_is_an_error(spark):
    rows = [(5, [1e9], 0, 0, 0, "x"), (6, [1e9], 0, 0, 0, "x")]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        search(spark, rows)


def test_empty_table(spark):
    assert search(spark, []) == []


def test_copies_of_anchors_are_never_broadcast(spark, tmp_path):
    """Spark takes the copies to be as few as the anchors; on small stored tables it would broadcast them."""
    df = spark.createDataFrame(vectors(1, 50, 4), SCHEMA).selectExpr("vec_id AS id", "CAST(label AS LONG) AS label", "embedding AS v")
    negatives.build_index(df).write.parquet(str(tmp_path / "index"))
    wanted = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    negatives.batches_of(df.withColumn("wanted", wanted), 5).write.parquet(str(tmp_path / "batches"))
    index, batches = (spark.read.parquet(str(tmp_path / name)) for name in ("index", "batches"))
    met = negatives._met(index, batches, 3)
    assert "SortMergeJoin" in plan_of(met) and "Broadcast" not in plan_of(met)
    assert met.count() == index.count() * batches.count()


def test_copies_of_anchors_grow_no_further_than_their_bound(spark, monkeypatch):
    index = spark.createDataFrame([(bytes(8 * n),) for n in (2048, 2048, 904)], "ids binary")
    assert negatives.salts_of(index) == 64 and negatives.salts_of(index.limit(0)) == 64
    monkeypatch.setattr(negatives, "SALT_ROWS", 50)
    assert negatives.salts_of(index) == 100
    monkeypatch.setattr(negatives, "SALT_ROWS", 1)
    assert negatives.salts_of(index) == 512
    rows = vectors(3, 80, 4)
    assert search(spark, rows) == plain(rows)


def test_bounds_hold_the_scores_and_narrow():
    draw = np.random.default_rng(4)
    vectors = np.floor(draw.normal(size=(200, 40)) * 300 + np.repeat(draw.normal(size=4) * 500, 10))
    block = negatives.Block(np.arange(200), np.zeros(200, "i8"), vectors, *negatives.summaries(vectors))
    width = []
    for level in range(len(negatives.LEVELS)):
        for one in range(0, 200, 20):
            least, most = block.bounds(level, np.arange(200), block, one)
            exact = np.array(block.scores(np.arange(200), block, one))
            assert (least <= exact).all() and (exact <= most).all()
            assert exact.max() <= block.reach(block)[one]
            width.append((level, float((most - least).mean())))
    means = [np.mean([w for n, w in width if n == level]) for level in range(3)]
    assert means[0] > means[1] > means[2]


def test_exact_scores_are_taken_of_few_rows(monkeypatch):
    """Refining drops most rows of a label before any exact score."""
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(20, 32)) * 200
    vectors = np.floor(centres[np.arange(2000) % 20] + draw.normal(size=(2000, 32)) * 20)
    block = negatives.Block(np.arange(2000), np.zeros(2000, "i8"), vectors, *negatives.summaries(vectors))
    scored = []
    exact = negatives.Block.scores
    monkeypatch.setattr(negatives.Block, "scores", lambda self, rows, *rest: scored.append(len(rows)) or exact(self, rows, *rest))
    assert len(list(negatives.search_positives(block, block, 5))) == 10000
    assert sum(scored) < 0.5 * 2000 * 2000


def test_segments_are_never_empty():
    for dims in (1, 2, 5, 16, 17, 64):
        for n in negatives.LEVELS:
            ends = negatives.segment_ends(dims, n)
            assert ends[0] == 0 and ends[-1] == dims and (np.diff(ends) > 0).all()
