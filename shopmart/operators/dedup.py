"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key, null counting as a key of its own.

    A distributed table has no row order, so "first" follows ``order_by`` (a load time or
    sequence column, if there is one) and then all other columns: a rerun on any cluster
    layout keeps the same row. The rank filter lets Catalyst cut every key to one row
    before the shuffle (``WindowGroupLimit``), so a key with very many copies stays cheap.
    """
    order = [*order_by, *[name for name in df.columns if name not in keys]] or list(keys)
    rank = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) AS _row"
    return df.selectExpr("*", rank).where("_row = 1").drop("_row")

