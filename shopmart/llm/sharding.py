"""Proportional stratified interleaving of documents into shards, in DataFrame operations only.

Rows are put in a seeded random order within their source; a row's fractional rank is its place in
that order over the size of its source. Sorted by fractional rank, any run of rows holds every
source in proportion, so cutting the sorted rows into equal runs gives shards that all match the
mixture, with row counts at most one apart.

Neither order is made in one task. Random keys are cut into ranges of about ``RANGE_ROWS`` rows,
rows are numbered inside a range, and the counts of earlier ranges are added on. A source with a
third of all rows has its third of the ranges. Texts are read once, for their size and checksum;
all that is shuffled is a few numbers a row.

Rows that are equal in id, size, checksum and source, such as copies without ids, are counted before
they are shuffled and made again as numbered copies, ``COPIES_TOGETHER`` in a step, so a third of
all rows being equal makes neither a hot key nor one long task. A copy's random key comes from its
number too; so equal rows spread over the ranges, and the result depends on the rows alone.

Defined results: a null text has size 8 and the checksum of the empty text; rows without a source
are a source of their own; equal rows are numbered in either order, which gives the same result; an
empty table gives no rows; other columns are not read, so they may have any name. Sources are taken
to be far fewer than rows: rows that are alone in their source all have the rank 1/2 and share a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.common import stored

SHARDS = 24
SEED = 20240
RANGE_ROWS = 1024
#: Ranges whose counts are summed in one task before the sums are summed.
RANGES_TOGETHER = 4096
#: Copies of a row that one step makes; more of them are made by several tasks.
COPIES_TOGETHER = 1024


def range_starts(counts: DataFrame, by: list[str]) -> DataFrame:
    """For each range (``by``, bin, n) the rows in earlier ranges, as ``before``.

    Sums run within blocks of ranges first and then over the blocks, so no task sees all ranges.
    """
    blocks = counts.withColumn("block", F.floor(F.col("bin") / RANGES_TOGETHER))
    earlier = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*by, "block").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy(*by, "block").agg(F.sum("n").alias("block_n"))
    totals = totals.withColumn("start", F.coalesce(F.sum("block_n").over(earlier), F.lit(0))).drop("block_n")
    within = blocks.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    found = join_same(within, totals, [*by, "block"])
    return found.select(*by, "bin", (F.col("start") + F.col("inner")).alias("before"))


def join_same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which nulls equal each other, keeping the left columns of that name."""
    renamed = right.withColumnsRenamed({key: f"{key}_right" for key in keys})
    same = [left[key].eqNullSafe(renamed[f"{key}_right"]) for key in keys]
    return left.join(renamed, same).drop(*[f"{key}_right" for key in keys])


def numbered(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Number rows from 0 within ``by``, in the order of their range (bin) and then of ``order``."""
    starts = range_starts(rows.groupBy(*by, "bin").agg(F.count("*").alias("n")), by)
    in_range = F.row_number().over(Window.partitionBy(*by, "bin").orderBy(*order)) - 1
    return join_same(rows.withColumn("in_range", in_range), starts, [*by, "bin"]).withColumn(
        "place", F.col("in_range") + F.col("before")
    ).drop("in_range", "before", "bin")


def bins(rows: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / RANGE_ROWS))


def numbered_copies(groups: DataFrame) -> DataFrame:
    """A row for each of the ``copies`` of a row, with its number from 0 as ``copy``."""
    few = groups.where(F.col("copies") <= COPIES_TOGETHER).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_TOGETHER).cast("long")))
    steps = groups.where(F.col("copies") > COPIES_TOGETHER).withColumn("first", first).repartition("doc_id", "size", "text_crc32", "source", "first")
    last = F.least(F.col("first") + COPIES_TOGETHER, F.col("copies")) - 1
    many = steps.withColumn("copy", F.explode(F.sequence(F.col("first"), last))).drop("first")
    return few.unionByName(many).drop("copies")


def assign(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    groups = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "rows")
    sizes = groups.groupBy("source").agg(F.sum("copies").alias("source_n"))
    # 63 bits; its upper 32 pick the range, so ranges follow the order of the whole key.
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32", "source", "copy"), 1)
    drawn = join_same(numbered_copies(groups).withColumn("drawn", key), sizes, ["source"]).drop("copy").withColumn(
        "bin", F.shiftright(F.shiftright("drawn", 31) * bins(F.col("source_n")), 32)
    )
    ties = ["doc_id", "size", "text_crc32"]
    ranked = numbered(drawn, ["source"], ["drawn", *ties])
    fraction = (F.col("place") + 0.5) / F.col("source_n")
    n = groups.agg(F.sum("copies")).first()[0] or 0
    total = F.lit(n).cast("long")
    spread = stored(ranked.select(
        "doc_id", "source", "size", "text_crc32", fraction.alias("fraction"),
        F.floor(fraction * bins(total)).alias("bin"),
    ), "ranked")
    placed = numbered(spread, [], ["fraction", "source", *ties])
    shard = F.expr(f"CAST(place * {shards} DIV greatest(1, {n}) AS INT)")
    first = F.ceil(total * F.col("shard") / shards).cast("long")
    return placed.withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("place") - first).alias("slot")
    )
