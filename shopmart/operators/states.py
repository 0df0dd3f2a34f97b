"""Distinct counts that can be merged: exact bitmaps over dense keys.

The state of a cell (a period and a group) is the set of its members' dense numbers, as bitmaps of
32,768 numbers each. Sets of several cells are united by or-ing their bitmaps, so a month, a
quarter and a year are counted from the stored states, without the rows they were made of, and a
new day adds its own states only. A bitmap takes 4 KB however few members it has: choose a grain at
which cells hold more than a few, or leave the rare ones to compression in the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def distinct_states(rows: DataFrame, cell: Sequence[str], key: str) -> DataFrame:
    """The cell's columns, bucket and members: one bitmap for each cell and range of keys. Keys are positive."""
    numbers = rows.where(f"{key} > 0").select(
        *cell, F.bitmap_bucket_number(F.col(key)).alias("bucket"), F.bitmap_bit_position(F.col(key)).alias("_bit")
    )
    # Members are made distinct and brought together as plain numbers: bitmaps that each task begins for
    # itself would be 4 KB for about every row, once a table has more cells and ranges than a task has rows.
    together = numbers.distinct().repartition(*cell, "bucket")
    return together.groupBy(*cell, "bucket").agg(F.bitmap_construct_agg("_bit").alias("members"))


def merged(states: DataFrame, cell: Sequence[Column | str]) -> DataFrame:
    """States of coarser cells, columns or expressions over those of the finer ones."""
    return states.groupBy(*cell, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def counted(states: DataFrame, cell: Sequence[Column | str], name: str) -> DataFrame:
    """Distinct members of each cell; cells may be coarser than the states."""
    united = merged(states, cell)
    left = [c for c in united.columns if c not in ("bucket", "members")]
    return united.groupBy(*left).agg(F.sum(F.bitmap_count("members")).cast("long").alias(name))
