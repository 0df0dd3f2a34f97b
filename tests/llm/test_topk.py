from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmart.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score long, id string"


def plain(rows, k=10, scale=1024):
    whole = []
    for vec_id, v, *_ in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((vec_id, [math.floor(float(np.float32(x)) * scale) for x in v]))
    asked = {}
    for vec_id, v in whole:
        if vec_id % 5 == 0:
            asked[vec_id] = min(asked.get(vec_id, v), v)
    found = []
    for q, v in asked.items():
        scored = sorted((-sum(map(int.__mul__, v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        found += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def search(spark, rows, k=10):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, topk.search(df, F.col("vec_id") % 5 == 0, k).collect()))


def vectors(seed, n, dims, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.uniform(-spread, spread) for _ in range(dims)], 0, 0, "x") for i in range(n)]


@pytest.mark.parametrize(("n", "dims", "spread"), [(300, 16, 1.0), (70, 3, 40.0), (9, 4, 1.0), (130, 1, 0.001)])
def test_equals_brute_force(spark, n, dims, spread):
    rows = vectors(n, n, dims, spread)
    assert search(spark, rows) == plain(rows)


def test_ties_copies_and_rows_that_take_no_part(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same, 0, 0, "x") for i in range(40)] + [(40, [-x for x in same], 0, 0, "x")]
    rows += [(5, same, 0, 0, "x"), (10, [1.0, 0.0, 0.0], 0, 0, "x")]
    rows += [(100, None, 0, 0, None), (105, [None, 1.0, 1.0], 0, 0, None), (110, [float("nan"), 1.0, 1.0], 0, 0, None)]
    rows += [(115, [float("inf"), 1.0, 1.0], 0, 0, None), (120, [1e6, 1.0, 1.0], 0, 0, None), (None, same, 0, 0, None)]
    rows += [(125, [], 0, 0, None), (126, [], 0, 0, None), (130, [1.0, 1.0], 0, 0, None), (135, [0.0] * 3, 0, 0, None)]
    assert search(spark, rows, 7) == plain(rows, 7)


@pytest.mark.parametrize("size", [1e5, 5e5, 9e5])
def test_large_components_are_queries_and_answers(spark, size):
    """Some rows beyond 2^26, some queries too; 1e5 in rows 1 and 100 once went missing."""
    rows = vectors(3, 60, 4)
    rows += [(100 + i, [size * (1 + i % 3), -0.5, float(i), -size / 2], 0, 0, "x") for i in range(12)]
    rows += [(1, [size, 0.25, 0.0, 1.0], 0, 0, "x"), (100, [size, 0.5, 0.0, 0.0], 0, 0, "x")]
    found = search(spark, rows)
    assert found == plain(rows) and {100, 105, 110} <= {r[0] for r in found} and 1 in {r[2] for r in found}


def test_sums_beyond_64_bits_are_exact_and_answers_that_do_not_fit_are_errors(spark):
    # Components near 2^70 that cancel out leave small scores.
    rows = [(i, [2.0**60, -(2.0**60), i / 2], 0, 0, "x") for i in range(9)] + [(10 + i, [1.0, 1.0, float(i)], 0, 0, "x") for i in (0, 5)]
    near = [r for r in rows if r[0] >= 10] + [(21, [2.0**60, 2.0**60 * -1, 3.0], 0, 0, "x")]
    assert search(spark, near) == plain(near)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        search(spark, rows)


def test_empty_table(spark):
    assert search(spark, []) == []


def test_slices_hold_the_values():
    values = np.array([[5, -3], [0, -3], [17, 4]])
    least, digits, slices = topk.bit_slices(values)
    assert least.tolist() == [0, -3] and digits.tolist() == [5, 3]
    bits = np.unpackbits(slices.view("u1"), axis=1, bitorder="little")[:, :3]
    assert (sum(bits[i].astype(int) << i for i in range(5)) == values[:, 0]).all()


def test_sum_of_bitmaps():
    draw = np.random.default_rng(3)
    total, expected = topk.Sum(), np.zeros(64, object)
    for _ in range(200):
        bitmap, weight = draw.integers(0, 2**64, (1, 1), "u8"), int(draw.integers(0, 6))
        total.add(bitmap, weight)
        expected += np.unpackbits(bitmap.view("u1"), bitorder="little").astype(object) << weight
    found = sum(np.unpackbits(d.view("u1"), bitorder="little").astype(object) << i for i, d in enumerate(total.slices()))
    assert (found == expected).all()
