"""CSV files with line breaks in quoted fields, read by many tasks each.

A line break ends a record only outside quotes, and whether a place is outside depends on all
quotes before it, which is why Spark reads such a file in one task. Here a file is read as lines, in
Spark's own ranges of bytes. For each range one summary row tells whether its quotes are even or odd;
a prefix over the ranges tells whether a range begins inside quotes, and a running count inside
the range tells it of each line. A line that begins outside quotes begins a record, and most records are
such a line alone. The lines of the others are put together, across the ends of ranges where needed,
and each record is parsed by itself.

A range's lines are sorted by one task; nothing larger than a range or a record is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shopmart.functions.scalars import column_name


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines by file, block (where their range begins) and place; odd: whether the line flips the quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    # Both uses below read this one shuffle.
    return lines.withColumn("odd", quotes % 2).repartition("file", "block")


def _ranges(lines: DataFrame) -> DataFrame:
    """For each range: whether it begins and ends inside quotes, and the range whose last record goes on into it."""
    counted = lines.groupBy("file", "block").agg(
        F.sum("odd").alias("flips"), (F.sum("odd") - F.max_by("odd", "place")).alias("flips_before_last")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = counted.withColumn("inside", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    # A range inside quotes has the start of a record if some line before its last one ends them.
    begins = inside.withColumn("owner", F.when((F.col("inside") == 0) | (F.col("flips_before_last") > 0), F.col("block")))
    return begins.select(
        "file", "block", "inside", ((F.col("inside") + F.col("flips")) % 2).alias("open"),
        F.last("owner", ignorenulls=True).over(earlier).alias("owner"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_first): the text of every record, and whether it is its file's first."""
    lines = _lines(spark, path)
    # One row a range of a file.
    placed = lines.join(_ranges(lines), ["file", "block"], "left")
    before = Window.partitionBy("file", "block").orderBy("place")
    flips = F.coalesce(F.sum("odd").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = F.coalesce("inside", F.raise_error(F.lit("a file was cut differently while it was read")).cast("long"))
    rows = placed.select("*", ((known + flips) % 2 == 0).alias("begins"), F.row_number().over(before).alias("line"))
    start = F.when(F.col("begins"), F.col("place"))
    whole = Window.partitionBy("file", "block")
    rows = rows.select(
        "*", F.last(start, ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, 0)).alias("start"),
        F.max(start).over(whole).alias("last_start"), ((F.col("block") == 0) & (F.col("line") == 1)).alias("is_first"),
    )
    alone = F.col("begins") & (F.col("odd") == 0)
    # The record that a range ends in goes by that range, whichever ranges its lines are in; others by their start.
    tail = F.when(F.col("start").isNull(), F.col("owner")).when((F.col("start") == F.col("last_start")) & (F.col("open") == 1), F.col("block"))
    parts = rows.where(~alone).select("file", "block", "place", "value", "is_first", tail.alias("tail"), F.when(tail.isNull(), F.col("start")).alias("start"))
    joined = parts.groupBy("file", "tail", "start").agg(
        F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("lines"), F.bool_or("is_first").alias("is_first")
    )
    together = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return rows.where(alone).select(F.col("value").alias("record"), "is_first").union(joined.select(together, "is_first"))


def read(spark: SparkSession, path: str, names: Sequence[str], options: dict[str, object]) -> DataFrame:
    """All columns as text, under the header's names; a file with another header is an error."""
    found = records(spark, path).where(F.length("record") > 0)
    fields = F.from_csv("record", _ddl(names), {k: str(v) for k, v in options.items()})
    parsed = found.select(fields.alias("fields"), "is_first")
    header = F.struct(*[F.lit(name).alias(f"c{i}") for i, name in enumerate(names)])
    own = F.struct(*[F.col("fields")[name].alias(f"c{i}") for i, name in enumerate(names)])
    other = F.raise_error(F.lit(f"a file below {path} has another header than {list(names)}")).cast("boolean")
    rows = parsed.where(F.when(~F.col("is_first"), F.lit(True)).when(own.eqNullSafe(header), F.lit(False)).otherwise(other))
    return rows.select(*[F.col("fields")[name].alias(name) for name in names])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"{column_name(name)} STRING" for name in names)
