"""Table profiles: one aggregate pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from shopmart.functions.scalars import column_name, is_missing, lenient_number, text_literal
from shopmart.operators.quantiles import bracket_sketch, exact_quantiles
from shopmart.session import scratch_scope


def aggregate(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    """Global aggregate from SQL expressions: always one row, also for an empty table."""
    return df.selectExpr(*expressions)


def null_counts(df: DataFrame) -> list[str]:
    """Aggregates ``nulls_<column>`` for every column (NaN counts as null)."""
    return [
        f"count_if({is_missing(column_name(name), dtype)}) AS {column_name(f'nulls_{name}')}" for name, dtype in df.dtypes
    ]


def profile_of_counts(
    counts: DataFrame, dataset: str, columns: Sequence[str], ingested_at: datetime | None = None
) -> DataFrame:
    """The profile from one row of counts: ``rows`` and ``nulls_<column>``."""
    shares = ", ".join(
        f"{text_literal(name)}, coalesce(round(try_divide({column_name(f'nulls_{name}')} * 10000, rows)) / 100, 0D)"
        for name in columns
    )
    stamp = f"TIMESTAMP '{ingested_at}'" if ingested_at else "current_timestamp()"
    return counts.selectExpr(
        f"{text_literal(dataset)} AS dataset",
        "rows",
        f"{len(columns)}L AS columns",
        f"map({shares}) AS null_pct_per_column",
        f"{stamp} AS ingested_at",
    )


def table_profile(df: DataFrame, dataset: str, ingested_at: datetime | None = None) -> DataFrame:
    """One row: row and column count, null percent per column (2 decimals) as a map, run time."""
    return profile_of_counts(aggregate(df, ["count(1) AS rows", *null_counts(df)]), dataset, df.columns, ingested_at)


def null_profile(df: DataFrame, dataset: str) -> DataFrame:
    """Long form of the null percentages, worst column first."""
    return (
        table_profile(df, dataset)
        .selectExpr("dataset", "explode(null_pct_per_column) AS (column_name, null_pct)")
        .orderBy(F.desc("null_pct"), "column_name")
    )


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """Row and column count of several tables."""
    return reduce(DataFrame.unionByName, [
        aggregate(df, [f"{text_literal(name)} AS dataset", "count(1) AS rows", f"{len(df.columns)}L AS columns"])
        for name, df in tables.items()
    ])


def _counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(f"{column_name(column)} IS NOT NULL").groupBy(column_name(column)).count()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null left out, in value order."""
    return _counts(df, column).orderBy(column_name(column))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their percent of the whole, most frequent first."""
    counts = _counts(df, column)
    # A scalar subquery over the same aggregate: no window that gathers all values in one task.
    total = counts.agg(F.sum("count")).scalar()
    share = F.round(F.col("count") * 1000 / total) / 10
    return counts.withColumn("share_pct", share).orderBy(F.desc("count"), column_name(column))


QUARTILES = (0.25, 0.5, 0.75)


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of every numeric column.

    Quartiles are exact, interpolated between neighbours. Reads ``df`` twice: pass a stored table.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    numbers = df.selectExpr(*[f"{lenient_number(column_name(name))} AS {column_name(name)}" for name in columns])
    measures = ", ".join(
        f"named_struct('column_name', {text_literal(name)}, 'count', count({c}), 'mean', avg({c}),"
        f" 'std', stddev_samp({c}), 'min', min({c}), 'max', max({c}), 'around', {bracket_sketch(c, QUARTILES)})"
        for name, c in zip(columns, map(column_name, columns), strict=True)
    )
    # One row per column comes to the driver, which steers the search for the quartiles.
    moments = aggregate(numbers, [f"array({measures}) AS m"]).selectExpr("inline(m)").collect()
    spans = {m["column_name"]: (m["count"], m["min"], m["max"]) for m in moments}
    brackets = {m["column_name"]: list(zip(m["around"][::2], m["around"][1::2], strict=True)) for m in moments if m["around"]}
    with scratch_scope(df.sparkSession):
        quartiles = exact_quantiles(numbers, spans, QUARTILES, brackets)
    return df.sparkSession.createDataFrame(
        [
            (m["column_name"], m["count"], m["mean"], m["std"], m["min"], *quartiles[m["column_name"]], m["max"])
            for m in moments
        ],
        "column_name STRING, count BIGINT, mean DOUBLE, std DOUBLE, min DOUBLE, p25 DOUBLE, p50 DOUBLE, p75 DOUBLE,"
        " max DOUBLE",
    )
