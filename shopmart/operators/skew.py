"""Joins that stay balanced when one key holds much of a table.

Adaptive execution splits skewed partitions of a plain sort-merge join, but not the right
side of a left join, not a join inside a chain on one key, and not a window. The joins here
cover the first two cases, ``shopmart.operators.scan`` the third. They take the hot keys as a
list that ``find_hot_keys`` measures once on a stored table; with an empty list they give the
plain join. The list steers only the layout: results are the same whichever keys it names.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 64
HOT_SHARE = 0.01
#: Rows sampled to steer the layout; results never depend on the sample.
SAMPLE_ROWS = 1_000_000


def find_hot_keys(
    df: DataFrame,
    key: str,
    share: float = HOT_SHARE,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 42,
) -> list[Any]:
    """Keys (values of a SQL expression) that hold at least ``share`` of the rows, null included.

    Only the share counts, never the size of the table. Row counts of Parquet tables come from
    file footers; tables of more than ``sample_rows`` rows are sampled on the key column alone.
    No more than 1/share keys can have that share, so the list that is fetched is short.
    """
    rows = df.count()
    fraction = min(1.0, sample_rows / max(rows, 1))
    keys = df.selectExpr(f"{key} AS k")
    if fraction < 1.0:
        keys = keys.sample(fraction, seed)
    busy = (
        keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= max(2.0, share * rows * fraction))
        .orderBy(F.desc("n"), "k")
    )
    return [row["k"] for row in busy.collect()]


def is_hot(column: Column, hot: Sequence[Any]) -> Column:
    known = [value for value in hot if value is not None]
    test = F.coalesce(column.isin(known), F.lit(False)) if known else F.lit(False)
    return (test | column.isNull()) if None in hot else test


def _spread(df: DataFrame, hot_test: Column, salts: int) -> DataFrame:
    """Give rows of a hot key one of many salts, chosen by the row's own content."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    return df.withColumn("_salt", F.when(hot_test, salt).otherwise(F.lit(0)))


def _copy(df: DataFrame, hot_test: Column, salts: int) -> DataFrame:
    """Repeat rows of a hot key once per salt."""
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    return df.withColumn("_salt", F.explode(F.when(hot_test, all_salts).otherwise(F.array(F.lit(0)))))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    hot: Sequence[Any] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows to a table with few rows per key ("left" or "inner").

    Hot keys of ``rows`` are salted and their few lookup rows copied. No broadcast is
    forced: Catalyst and AQE broadcast ``lookup`` when its size is below the threshold.
    """
    if not hot:
        return rows.join(lookup, key, how)
    left = _spread(rows, is_hot(F.col(key), hot), salts)
    right = _copy(lookup, is_hot(F.col(key), [v for v in hot if v is not None]), salts)
    return left.join(right, [key, "_salt"], how).drop("_salt")


def detail_join(
    parents: DataFrame,
    details: DataFrame,
    key: str,
    hot: Sequence[Any] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Left join of parents to many detail rows, hot keys being on the detail side.

    A hot parent is copied once per salt; copies that met no detail row are dropped. A hot
    parent without any detail row (the list may be out of date) is added back once.
    """
    hot = [value for value in hot if value is not None]
    if not hot:
        return parents.join(details, key, "left")
    test = is_hot(F.col(key), hot)
    left = _copy(parents, test, salts)
    right = _spread(details, test, salts).withColumn("_met", F.lit(True))
    joined = left.join(right, [key, "_salt"], "left").where(~test | F.col("_met")).drop("_salt", "_met")
    met_keys = details.where(test).select(key).distinct()
    bare = parents.where(test).join(met_keys, key, "left_anti")
    return joined.unionByName(bare, allowMissingColumns=True)
