"""Surrogate keys that stay: a stored map from natural keys to dense numbers.

The map is a Parquet table of (natural_key, surrogate_key). A run gives numbers to new members only,
on from the greatest known one, in the order of their natural keys; numbers are gapless, start at
1 (0 is the unknown member) and never change, so they neither collide nor depend on a hash.

New members are sorted into ranges, each row noting its range and its place there. The ranges'
counts, one row each, give every range its offset; a number is offset plus place. So members are
shuffled once, no task sees all of them, and the numbers do not depend on where ranges are cut.
Numbers appear with the commit of one append: a run that is ended early leaves the map as it was, and
one that is repeated finds its members known. One job at a time may extend a map.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType

from shopmart.session import scratch_dir, scratch_scope

#: Rows of a range that Spark's running row id can number.
_PLACES = (1 << 33) - 1


def map_schema(natural: DataType) -> StructType:
    return StructType([StructField("natural_key", natural), StructField("surrogate_key", LongType())])


def read_map(spark: SparkSession, path: str, natural: DataType) -> DataFrame:
    """The map as it is, or an empty one where none has been written."""
    schema = map_schema(natural)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def numbered(members: DataFrame, first: int) -> DataFrame:
    """Distinct members (natural_key) with numbers from ``first`` on, in their own order."""
    spark = members.sparkSession
    path = scratch_dir(spark, "members")
    placed = members.repartitionByRange("natural_key").sortWithinPartitions("natural_key").select(
        "natural_key",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)).alias("place"),
    )
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row a range.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(offsets), "part").select(
        "natural_key", (F.col("place") + F.col("before") + first).alias("surrogate_key")
    )


def extend(members: DataFrame, natural: str, path: str) -> DataFrame:
    """Number the members that the map at ``path`` does not know, append them, return the whole map."""
    spark, kind = members.sparkSession, members.schema[natural].dataType
    known = read_map(spark, path, kind)
    found = members.select(F.col(natural).alias("natural_key")).where("natural_key IS NOT NULL").distinct()
    new = found.join(known, "natural_key", "left_anti")
    greatest = known.agg(F.coalesce(F.max("surrogate_key"), F.lit(0))).first()[0]
    with scratch_scope(spark):
        numbered(new, greatest + 1).write.mode("append").parquet(path)
    return read_map(spark, path, kind)


def with_key(df: DataFrame, natural: str, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with its members' numbers in a column ``name``; null for a member the map lacks."""
    return df.join(keys.select(F.col("natural_key").alias(natural), F.col("surrogate_key").alias(name)), natural, "left")
