"""CSV, Parquet and JSON readers and writers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shopmart.functions.scalars import lenient_timestamp
from shopmart.schemas import PARTITION_DATES, RAW
from shopmart.sources import split_csv

# Name parts that mark a date column when a table is not in PARTITION_DATES.
DATE_WORDS = ("date", "created", "paid")

#: Rows of a written CSV file at most.
CSV_ROWS = 1_000_000

T = TypeVar("T")


def each(spark: SparkSession, items: Iterable[T], job: Callable[[T], None], at_once: int = 4) -> None:
    """Run independent write jobs side by side, so a small table does not idle the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheritable_thread_target(spark)(job), items))


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whichever store that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job made; one that is not there is no fault."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def replace(spark: SparkSession, made: str, path: str) -> None:
    """Put a folder that a job has just written in the place of another."""
    folder, system = _folder(spark, made)
    target, _ = _folder(spark, path)
    system.delete(target, True)
    system.mkdirs(target.getParent())
    if not system.rename(folder, target):
        raise OSError(f"could not move {made} to {path}")


def _bytes(text: str) -> int:
    """A size setting as a number: 134217728b, 128m, 1g."""
    digits = text.rstrip("bBkKmMgG")
    unit = text[len(digits) :].lower().rstrip("b")
    return int(digits) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]


def _largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file at a path, from one listing."""
    folder, system = _folder(spark, path)
    sizes = [status.getLen() for status in system.globStatus(folder.suffix("/*")) or [] if status.isFile()]
    return max(sizes, default=0) or system.getContentSummary(folder).getLength()


def read_csv(spark: SparkSession, path: str, table: str, dates: Sequence[str] = (), split: bool | None = None) -> DataFrame:
    """Scan a CSV table with header. Values that do not fit the column's type become null.

    Columns are read as text by header name, then cast leniently, so one bad value costs
    neither the job nor its row. ``dates`` names text columns to parse as timestamps.
    Quoted fields may hold line breaks. A file that is no larger than Spark's ranges is read by one
    task; if there is a larger one, files are read in ranges (see ``split_csv``). ``split`` says
    which way instead. An empty quoted field is empty text, an empty bare one is null.
    """
    if split is None:
        split = _largest_file(spark, path) > _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    as_text = StructType([StructField(name, StringType()) for name in header])
    options = {"header": True, "escape": '"', "multiLine": True, "enforceSchema": False, "lineSep": "\n"}
    # Any null mark but the empty text lets the parser tell an empty quoted field from a bare one.
    options |= {"nullValue": "\u0000", "emptyValue": ""}
    if split:
        parsing = {name: options[name] for name in ("escape", "lineSep", "nullValue", "emptyValue")}
        raw = split_csv.read(spark, path, header, parsing)
    else:
        raw = spark.read.schema(as_text).options(**options).csv(path)
    types = {field.name: field.dataType.simpleString() for field in RAW[table].fields}
    casts = {name: f"try_cast(`{name}` AS {types[name]})" if name in types else f"`{name}`" for name in header}
    casts |= {name: lenient_timestamp(f"`{name}`") for name in dates}
    return raw.selectExpr(*[f"{cast} AS `{name}`" for name, cast in casts.items()])


def write_csv(df: DataFrame, path: str, rows_per_file: int = CSV_ROWS) -> None:
    """Write CSV that ``read_csv`` gives back as it was: line breaks, edge spaces and empty text stay.

    Files end after ``rows_per_file`` rows, so none grows with the table.
    """
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""', "nullValue": ""}
    df.write.mode("overwrite").options(header=True, escape='"', lineSep="\n", maxRecordsPerFile=rows_per_file, **keep).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Scan Parquet with a fixed schema, or the footers' own; partition columns come back."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    only_touched_partitions: bool = False,
) -> None:
    """Overwrite a Parquet table, partitioned Hive style.

    The rebalance hint gathers each partition value into few files and lets AQE split large
    values over many tasks, so a month that holds most rows is not one task or one file.
    ``only_touched_partitions`` leaves partitions without new rows in place.
    """
    out = df
    if partition_by:
        out = df.hint("rebalance", *[F.col(c) for c in partition_by])
        if sort_by:
            out = out.sortWithinPartitions(*partition_by, *sort_by)
    elif sort_by:
        out = out.sortWithinPartitions(*sort_by)
    mode = "dynamic" if only_touched_partitions and partition_by else "static"
    # Hashed keys are hex digits, which only an entropy coder makes smaller.
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def date_column(df: DataFrame, table: str | None = None) -> str | None:
    """The column that dates a table: its declared one, else the first whose name says so."""
    if table in PARTITION_DATES:
        return PARTITION_DATES[table]
    return next((c for c in df.columns if any(word in c for word in DATE_WORDS)), None)


def with_year_month(df: DataFrame, column: str) -> DataFrame:
    moment = lenient_timestamp(column)
    return df.selectExpr("*", f"year({moment}) AS year", f"month({moment}) AS month")


def write_dated(df: DataFrame, parquet_path: str, table: str) -> None:
    """Write a raw table as Parquet, by year and month where it has a date."""
    column = date_column(df, table)
    if column is None:
        write_parquet(df, parquet_path)
    else:
        write_parquet(with_year_month(df, column), parquet_path, ("year", "month"))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, table: str, split: bool | None = None) -> None:
    """Convert a raw CSV table to Parquet."""
    write_dated(read_csv(spark, csv_path, table, split=split), parquet_path, table)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a quality report back; the result rows are in its ``checks`` array."""
    return spark.read.option("multiLine", True).json(path)
