"""Exact quantiles against sorted lists, on friendly and hostile distributions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from shopmart.operators import profile, quantiles
from shopmart.operators.quantiles import exact_quantiles


def spans(df):
    return {
        c: tuple(df.selectExpr(f"count({c})", f"min({c})", f"max({c})").first()) for c in df.columns
    }


PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
RNG = random.Random(11)
CASES = {
    "uniform": [RNG.uniform(-5, 5) for _ in range(900)],
    "one value": [3.5] * 50,
    "single row": [1.25],
    "hot value": [7.0] * 500 + [float(i) for i in range(400)],
    "far outlier": [RNG.random() for _ in range(500)] + [1e300, -1e300],
    "full range": [-1.7e308, 1.7e308, 0.0, 1.0, 5e-324],
    "neighbours": [1.0, float(np.nextafter(1.0, 2.0))] * 20,
    "minus infinity": [-math.inf, 1.0, 2.0, 3.0],
    "both infinities": [math.inf] * 3 + [-math.inf] * 200 + [float(i) for i in range(300)],
    "infinities alone": [math.inf, -math.inf],
    "log-normal": [RNG.lognormvariate(0, 9) for _ in range(600)],
    "exponents": [10.0 ** RNG.randrange(-9, 9) for _ in range(600)],
}


def plain(values):
    """Linear interpolation, without arithmetic between equal or exactly hit values."""
    ordered, found = sorted(values), []
    for p in PROBABILITIES:
        place = (len(ordered) - 1) * p
        low, high, part = ordered[math.floor(place)], ordered[math.ceil(place)], place - math.floor(place)
        found.append(low if low == high or not part else low + (high - low) * part)
    return found


@pytest.mark.parametrize("case", CASES)
def test_quantiles(frame, case):
    values = CASES[case]
    df = frame([(v, float(i)) for i, v in enumerate([*values, None])], "v DOUBLE, w DOUBLE")
    found = exact_quantiles(df, spans(df), PROBABILITIES)
    if case not in ("full range", "infinities alone"):  # interpolation overflows there in both
        assert np.allclose(found["v"], plain(values), rtol=1e-12, atol=0, equal_nan=True)
    assert found["v"][0] == min(values) and found["v"][-1] == max(values)
    assert np.allclose(found["w"], np.quantile(range(len(values) + 1), PROBABILITIES))


def test_column_without_values(frame):
    df = frame([(None,)], "v DOUBLE")
    assert exact_quantiles(df, spans(df), (0.5,)) == {"v": [None]}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("reach", [0.0, 0.0005, 0.2])
def test_brackets_change_nothing(frame, case, reach, monkeypatch):
    """Brackets that are narrow, wide, or miss their rank: counts tell, and the whole table is searched."""
    monkeypatch.setattr(quantiles, "REACH", reach)
    values = CASES[case]
    df = frame([(v, float(i % 7)) for i, v in enumerate([*values, None])], "v DOUBLE, `w w` DOUBLE").repartition(3)
    found = df.selectExpr(*[f"{quantiles.bracket_sketch(f'`{c}`', PROBABILITIES)} AS `{c}`" for c in df.columns]).first()
    brackets = {c: list(zip(found[c][::2], found[c][1::2], strict=True)) for c in df.columns}
    brackets["v"][2] = (min(values), min(values))
    measured = {c: tuple(df.selectExpr(f"count(`{c}`)", f"min(`{c}`)", f"max(`{c}`)").first()) for c in df.columns}
    assert str(exact_quantiles(df, measured, PROBABILITIES, brackets)) == str(exact_quantiles(df, measured, PROBABILITIES))


def test_a_stored_table_is_read_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200_000, numPartitions=4).selectExpr("id % 1000 / 7 AS a", "pow(id, 1.5) AS b", "if(id % 3 = 0, 5D, id) AS c").write.parquet(path)
    reads, whole = [], quantiles._count_slices
    quantiles._count_slices, before = (lambda df, intervals, long: reads.append(long) or whole(df, intervals, long)), whole
    try:
        found = {r["column_name"]: (r["p25"], r["p50"], r["p75"]) for r in profile.numeric_summary(spark.read.parquet(path)).collect()}
    finally:
        quantiles._count_slices = before
    assert reads and all(reads)  # only rows between brackets are searched
    ids = np.arange(200_000)
    columns = {"a": ids % 1000 / 7, "b": ids.astype(float) ** 1.5, "c": np.where(ids % 3 == 0, 5.0, ids)}
    for name, values in columns.items():
        assert np.allclose(found[name], np.quantile(values, (0.25, 0.5, 0.75)), rtol=1e-12)
