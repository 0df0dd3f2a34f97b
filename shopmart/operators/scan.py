"""Running totals per key as a segmented prefix scan.

A window over a key is one task's work however many rows the key has. Here the rows are first cut
into segments: ranges of (key, order) of about equal size, whatever the keys. A key with few rows
lies inside one segment, a key with very many spans several, and several large keys do no more harm
than one. Each segment is scanned by itself. What a segment passes on is one summary row of the
key at its end: its total, its rows and its last amount there. The summaries of a key, in the order
of the segments, give the carry into each of them, and the carry is added to the rows that need it.

Which rows fall into which segment decides the layout only. Sums are of whole cents, so the result
does not depend on where a key is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shopmart.session import scratch_dir

#: A segment's rows, about. A table of no more rows is one segment and scanned by a plain window.
SEGMENT_ROWS = 2_000_000


def segment_count(rows: int, segment_rows: int = SEGMENT_ROWS) -> int:
    return max(1, -(-rows // segment_rows))


def with_segments(df: DataFrame, key: str, order: Sequence[str], segments: int) -> DataFrame:
    """The rows with the number of their range in a column ``_segment``, from a stored table.

    Ranges come from a sample that is drawn anew at each run of a plan; storing the number makes all
    uses, and reruns of lost tasks, see the same ranges.
    """
    path = scratch_dir(df.sparkSession, "segments")
    ranged = df.repartitionByRange(segments, key, *order).withColumn("_segment", F.spark_partition_id())
    ranged.write.parquet(path)
    return df.sparkSession.read.schema(ranged.schema).parquet(path)


def _window_columns(window, amount: str) -> dict:
    return {
        "_run": F.sum("_cents").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_rank": F.rank().over(window),
        "_prev": F.lag(amount, 1).over(window),
    }


def running(df: DataFrame, key: str, order: Sequence[str], amount: str, segments: int = 1) -> DataFrame:
    """Add running total (whole cents), rank and previous amount per key, in sort order.

    ``order`` must be unique within a key. An amount that no cents can hold counts as missing.
    """
    columns = df.columns
    in_cents = F.expr(f"try_cast(round({amount} * 100) AS BIGINT)")
    if segments == 1:
        found = df.withColumn("_cents", in_cents).withColumns(_window_columns(Window.partitionBy(key).orderBy(*order), amount))
        return found.select(*columns, "_run", "_rank", "_prev")
    rows = with_segments(df, key, order, segments).withColumn("_cents", in_cents)
    carried = carries(rows, key, order, amount)
    inside = Window.partitionBy("_segment", key).orderBy(*order)
    local = rows.withColumns({**_window_columns(inside, amount), "_first": F.row_number().over(inside) == 1})
    # Two rows a segment at most: the bound of this side is the number of segments.
    match = local[key].eqNullSafe(carried["_key"]) & (F.col("_segment") == F.col("_into"))
    joined = local.join(F.broadcast(carried), match, "left")
    before = F.col("_into").isNotNull()
    return joined.select(
        *columns,
        F.when(before & F.col("_sum_before").isNotNull(), F.col("_sum_before") + F.coalesce("_run", F.lit(0))).otherwise(F.col("_run")).alias("_run"),
        (F.col("_rank") + F.coalesce("_rows_before", F.lit(0))).cast("int").alias("_rank"),
        F.when(F.col("_first") & before, F.col("_last_before")).otherwise(F.col("_prev")).alias("_prev"),
    )


def carries(rows: DataFrame, key: str, order: Sequence[str], amount: str) -> DataFrame:
    """For a key that began in an earlier segment: its total, rows and last amount before each later one.

    One summary row for each segment and key is aggregated where the rows lie. Only a segment's least
    and greatest key can go on in another segment, so a key of a single segment drops out.
    """
    summaries = rows.groupBy(F.col(key).alias("_key"), "_segment").agg(
        F.sum("_cents").alias("sum"),
        F.count(F.lit(1)).alias("rows"),
        F.max(F.struct(F.struct(*order).alias("point"), F.col(amount).alias("amount")))["amount"].alias("last"),
    )
    by_segment = Window.partitionBy("_key").orderBy("_segment")
    earlier = by_segment.rowsBetween(Window.unboundedPreceding, -1)
    return summaries.select(
        "_key",
        F.col("_segment").alias("_into"),
        F.sum("sum").over(earlier).alias("_sum_before"),
        F.sum("rows").over(earlier).alias("_rows_before"),
        F.lag("last", 1).over(by_segment).alias("_last_before"),
    ).where("_rows_before IS NOT NULL")
