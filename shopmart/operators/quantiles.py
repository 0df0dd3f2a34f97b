"""Exact quantiles of whole tables with bounded state.

A single sorted window or a collected histogram of all values would end in one task. Here
every wanted rank starts with the interval from minimum to maximum; each pass counts rows in
equal slices of the interval, keeps the slice that holds the rank, and narrows to the values
in it, until one value is left. A pass returns at most one row per slice and rank, whatever
the size or the distribution of the table.

Passes over the whole table are spared by brackets: a sketch, made in the scan that counts the
columns, names two values around each quantile. One scan then counts the rows below, at and between
the brackets' ends and sets aside those strictly between, a small share of the table, among which
the search goes on. The counts are exact, so a sketch that missed a rank is noticed, and that
rank is searched in the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from shopmart.functions.scalars import column_name
from shopmart.session import scratch_dir

SLICES = 1024
#: How finely the sketch knows ranks, and how far on either side of a quantile its bracket reaches.
SKETCH_ACCURACY = 10_000
REACH = 0.0005


@dataclass
class _Search:
    """One wanted rank: the interval that holds it and the rank within that interval."""

    column: str
    rank: int
    low: float
    high: float

    @property
    def interval(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high


def _long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.unpivot([], [F.col(column_name(c)) for c in columns], "name", "v")


def _count_slices(df: DataFrame, intervals: Sequence[tuple[str, float, float]], long: bool) -> dict[int, list]:
    """Per interval: its non-empty slices in order, as (rows, smallest, largest value)."""
    values = df if long else _long_form(df, list(dict.fromkeys(column for column, _, _ in intervals)))
    bounds = df.sparkSession.createDataFrame(
        [(i, *interval) for i, interval in enumerate(intervals)], "i INT, name STRING, low DOUBLE, high DOUBLE"
    )
    # Halves, so that the width of an interval over the full range stays finite. It is zero
    # only between two neighbouring denormal numbers.
    share = "(v / 2 - low / 2) / (high / 2 - low / 2)"
    place = f"if(high / 2 > low / 2, CAST(least({share} * {SLICES}, {SLICES - 1}) AS INT), if(v > low, 1, 0))"
    counted = (
        values.join(F.broadcast(bounds), "name")  # a handful of rows per column
        .where("v >= low AND v <= high")
        .selectExpr("i", "v", f"{place} AS s")
        .groupBy("i", "s")
        .agg(F.count("v").alias("rows"), F.min("v").alias("smallest"), F.max("v").alias("largest"))
    )
    slices: dict[int, list] = {i: [] for i in range(len(intervals))}
    for row in sorted(counted.collect(), key=lambda r: (r["i"], r["s"])):
        slices[row["i"]].append((row["rows"], row["smallest"], row["largest"]))
    return slices


def order_statistics(df: DataFrame, wanted: Sequence[tuple[str, int, float, float]], long: bool = False) -> list[float]:
    """Values at the wanted ranks: (column, rank from 0, minimum and maximum of the column).

    A ``long`` table has the columns' values as (name, v).
    """
    searches = [_Search(*w) for w in wanted]
    before = None
    while open_intervals := list(dict.fromkeys(s.interval for s in searches if s.low < s.high)):
        if open_intervals == before:
            raise RuntimeError(f"no interval narrowed: {open_intervals}")
        before = open_intervals
        found = dict(zip(open_intervals, _count_slices(df, open_intervals, long).values()))
        for search in searches:
            for rows, smallest, largest in found.get(search.interval, ()):
                if search.rank < rows:
                    search.low, search.high = smallest, largest
                    break
                search.rank -= rows
    return [s.low for s in searches]


def _infinite_ends(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, int, float, float]]:
    """Rows at minus and plus infinity, and the finite span, of columns that have such rows."""
    if not columns:
        return {}
    finite = "if(abs({0}) < double('Infinity'), {0}, NULL)"
    row = df.selectExpr(*[
        f"named_struct('below', count_if({c} = double('-Infinity')), 'above', count_if({c} = double('Infinity')),"
        f" 'low', min({finite.format(c)}), 'high', max({finite.format(c)})) AS {c}"
        for c in map(column_name, columns)
    ]).first()
    return {c: tuple(row[c]) for c in columns}


def bracket_sketch(column: str, probabilities: Sequence[float]) -> str:
    """Aggregate: two values around each quantile of a column, as one array."""
    shares = [min(1.0, max(0.0, p + side * REACH)) for p in probabilities for side in (-1, 1)]
    return f"approx_percentile({column}, array({', '.join(f'{x}D' for x in shares)}), {SKETCH_ACCURACY})"


def _in_brackets(
    df: DataFrame, wanted: Sequence[tuple[str, int, float, float]], brackets: dict[str, Sequence[tuple[float, float]]]
) -> list[float | None]:
    """Values at the wanted ranks that lie in a bracket of their column; null for the others."""
    ends = [(c, low, high) for c, pairs in brackets.items() for low, high in dict.fromkeys(pairs) if math.isfinite(low) and math.isfinite(high)]
    if not ends:
        return [None] * len(wanted)
    number = lambda x: f"double('{x!r}')"
    counts, kept = [], []
    for i, (column, low, high) in enumerate(ends):
        c = column_name(column)
        inside = f"{c} > {number(low)} AND {c} < {number(high)}"
        counts += [f"count_if({c} < {number(low)}) AS below{i}", f"count_if({c} = {number(low)}) AS at{i}", f"count_if({inside}) AS inside{i}", f"count_if({c} = {number(high)}) AS top{i}"]
        kept.append(f"if({inside}, named_struct('name', '{i}', 'v', {c}), NULL)")
    counted = Observation()
    path = scratch_dir(df.sparkSession, "brackets")
    observed = df.observe(counted, *map(F.expr, counts))
    observed.selectExpr(f"inline(array_compact(array({', '.join(kept)})))").write.parquet(path)
    inner = df.sparkSession.read.schema("name STRING, v DOUBLE").parquet(path)
    found, rows = counted.get, [None] * len(wanted)
    searched: list[tuple[int, tuple[str, int, float, float]]] = []
    for n, (column, rank, *_) in enumerate(wanted):
        for i, (own, low, high) in enumerate(ends):
            place = rank - found[f"below{i}"]
            if own != column or place < 0 or rows[n] is not None:
                continue
            if place < found[f"at{i}"]:
                rows[n] = low
            elif place < found[f"at{i}"] + found[f"inside{i}"]:
                searched.append((n, (str(i), place - found[f"at{i}"], low, high)))
                break
            elif low < high and place < found[f"at{i}"] + found[f"inside{i}"] + found[f"top{i}"]:
                rows[n] = high
    values = order_statistics(inner, [w for _, w in searched], long=True) if searched else []
    for (n, _), value in zip(searched, values, strict=True):
        rows[n] = value
    return rows


def exact_quantiles(
    df: DataFrame,
    spans: dict[str, tuple[int, float, float]],
    probabilities: Sequence[float],
    brackets: dict[str, Sequence[tuple[float, float]]] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles of double columns, linearly interpolated; null for a column without values.

    ``spans`` gives count, minimum and maximum of each column, ``brackets`` two values around each
    quantile of a column, where a sketch has found some. Infinite values take the ranks
    at either end and only the finite ones between them are searched.
    """
    ends = _infinite_ends(df, [c for c, (n, *span) in spans.items() if n and any(map(math.isinf, span))])
    wanted, places = [], []
    for column, (count, low, high) in spans.items():
        below, above, low, high = ends.get(column, (0, 0, low, high))
        for p in probabilities if count else ():
            place = (count - 1) * p
            places.append((column, place - math.floor(place)))
            for rank in (math.floor(place), math.ceil(place)):
                if rank < below or rank >= count - above:
                    end = -math.inf if rank < below else math.inf
                    wanted.append((column, 0, end, end))
                else:
                    wanted.append((column, rank - below, low, high))
    finite = {c: pairs for c, pairs in (brackets or {}).items() if c not in ends}
    values = _in_brackets(df, wanted, finite)
    left = [n for n, value in enumerate(values) if value is None]
    for n, value in zip(left, order_statistics(df, [wanted[n] for n in left]), strict=True):
        values[n] = value
    quantiles: dict[str, list[float | None]] = {c: [] for c in spans}
    for (column, part), below, above in zip(places, values[::2], values[1::2]):
        quantiles[column].append(below if below == above or not part else below + (above - below) * part)
    return {c: found or [None] * len(probabilities) for c, found in quantiles.items()}
