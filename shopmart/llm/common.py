"""Helpers shared by the text operators: table access, shared scratch tables, small utilities."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.session import scratch_dir

#: Rows taken from an Arrow batch at a time, so that Python objects of few texts live at once.
SLICE_ROWS = 256
#: Long texts are worked on in pieces of about this many characters, cut at white space.
PIECE_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back, which also cuts its lineage."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once for each application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name, root = os.path.basename(package), os.path.dirname(package)
        if os.path.isdir(package):
            target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix=f"{name}-")), name)
            context.addPyFile(shutil.make_archive(target, "zip", root, name))
        _shipped.add(context.applicationId)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Give the pages that this process has freed back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Run) -> Run:
    """The same task function; at its end the worker, which stays for later tasks, keeps no freed pages."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def pieces(text: str) -> Iterator[str]:
    """Cut a long text behind white space; joined, the pieces are the text."""
    start, n = 0, len(text)
    while n - start > PIECE_CHARS:
        end = start + PIECE_CHARS
        while end < n and text[end - 1] not in " \t\n\v\f\r":
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text alone, under fixed names, ready for tasks of this package."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
