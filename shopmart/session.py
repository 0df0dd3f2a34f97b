"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import SparkSession

from shopmart.sources import tables

# Adaptive execution sizes shuffles, switches join strategies on measured sizes and
# splits skewed join partitions; all of it is per session, so a cluster may override it.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.showConsoleProgress": "false",
    # The padded hash keys of pseudonyms are binary literals of 64 bytes; plans show them masked.
    "spark.sql.redaction.string.regex": "(?i)(0x|X')[0-9a-f]{128}",
    # Recording the Python line of every column call costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "shopmart", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session. Keyword names use ``__`` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_CONF, **{name.replace("__", "."): value for name, value in conf.items()}}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="shopmart-")


#: Scratch folders made in the innermost open scope of this thread.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """Return a fresh folder path for intermediate tables and stream checkpoints.

    It lies below ``spark.checkpoint.dir``, which a cluster points at storage that every
    executor can reach. Only a local session without that setting gets a temporary folder; executors
    of a local cluster are processes of their own and need the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _local_scratch()
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, when the block ends, the scratch folders that this thread made in it.

    Frames that read them must have been written or collected by then. Also a block that fails frees
    its folders; those of a driver that dies are left to the lifetime of the shared folder.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            tables.remove(spark, path)


#: Spark then removes the shuffle files of an execution when it ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let every write and count of the block free its shuffle files; the session's own setting comes back.

    A frame that is collected twice in the block shuffles twice.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
