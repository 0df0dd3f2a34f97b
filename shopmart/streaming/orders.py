"""Order-event feed: JSON events from files or Kafka into JSON files, exactly once."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shopmart.functions.scalars import lenient_timestamp
from shopmart.schemas import ORDER_EVENT
from shopmart.streaming.lines import read_lines

DRAIN = {"availableNow": True}
LIVE = {"processingTime": "0 seconds"}
VALID, REJECTED = "valid", "rejected"
_CORRUPT = "_unparsed"
_LANDED = StructType([*ORDER_EVENT.fields]).add("raw", "string").add("outcome", "string")


def read_files(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Stream of text lines from files that arrive in a folder, in a ``value`` column."""
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def kafka_source_options(
    servers: str, topic: str, group: str | None = None, max_per_batch: int | None = None
) -> dict[str, str]:
    """Options to read a topic from its start; afterwards the checkpoint holds the offsets."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "3"}


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Stream of a topic's values as text. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load().select(F.col("value").cast("string"))


def encode(events: DataFrame) -> DataFrame:
    """Events as JSON text in a ``value`` column."""
    return events.select(F.to_json(F.struct(*events.columns)).alias("value"))


def publish(events: DataFrame, options: Mapping[str, str]) -> None:
    """Write events to a topic, acknowledged by all in-sync replicas."""
    encode(events).write.format("kafka").options(**options).save()


def decode(lines: DataFrame) -> DataFrame:
    """Parse ``value`` into event columns. ``outcome`` tells valid events from lines that are
    not JSON, lack an order id or have a field that does not parse. Rejected lines keep their
    text in ``raw``, and so do valid events with fields that the schema does not know."""
    schema = StructType([*ORDER_EVENT.fields]).add(_CORRUPT, "string")
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.select("value", F.from_json("value", schema, options).alias("event"))
    valid = f"coalesce(event.order_id IS NOT NULL AND event.{_CORRUPT} IS NULL, false)"
    known = ", ".join(f"'{name}'" for name in ORDER_EVENT.fieldNames())
    unknown = f"coalesce(size(array_except(json_object_keys(value), array({known}))) > 0, true)"
    return parsed.selectExpr(
        *[f"if({valid}, event.{name}, NULL) AS {name}" for name in ORDER_EVENT.fieldNames()],
        f"if({valid} AND NOT {unknown}, NULL, value) AS raw",
        f"if({valid}, '{VALID}', '{REJECTED}') AS outcome",
    )


def deduplicated(lines: DataFrame, within: str) -> DataFrame:
    """Valid events of a stream of JSON lines, each order id once, however often it is delivered.

    Repeats are dropped if their event time is within ``within`` of the first one's; so long, and no
    longer, is an id kept in the state. An event that comes later than that behind the newest one is
    late and dropped too. Events without a readable time cannot be held to this and are left out
    here; ``decode`` lands them.
    """
    events = decode(lines).where(f"outcome = '{VALID}'").withColumn("_at", F.expr(lenient_timestamp("event_time")))
    unique = events.where("_at IS NOT NULL").withWatermark("_at", within).dropDuplicatesWithinWatermark(["order_id"])
    return unique.drop("_at")


def start(
    lines: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = DRAIN, within: str | None = None
) -> StreamingQuery:
    """Land a stream of JSON lines below ``path``, split by outcome; stops when drained unless ``trigger`` says else.

    One sink takes both outcomes, so the source is read once. Offsets in the checkpoint and
    the sink's commit log make a restart neither lose nor repeat an event. A producer that sends
    twice needs ``within`` (see ``deduplicated``); then valid events alone are landed.
    """
    events = decode(lines) if within is None else deduplicated(lines, within)
    return (
        events.writeStream.format("json").option("ignoreNullFields", False).partitionBy("outcome")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def run_first(spark: SparkSession, folder: str, path: str, checkpoint: str, events: int, per_batch: int | None = None) -> None:
    """Land the next ``events`` lines of a folder, exactly, or as many as there are, and stop."""
    lines = read_lines(spark, folder, min(per_batch or events, events), events)
    query = start(lines, path, checkpoint, LIVE)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_until_idle(query: StreamingQuery, idle_seconds: float = 5.0, poll_seconds: float = 0.2) -> int:
    """Watch a live query until no event has come for a while, stop it between batches, return its events.

    What the query reports of each batch tells when it last had input; a batch that is under way
    counts as input.
    """
    last_input, seen, events = time.monotonic(), -1, 0
    while query.isActive:
        for progress in query.recentProgress:
            if progress["batchId"] > seen and progress["numInputRows"]:
                seen, last_input = progress["batchId"], time.monotonic()
                events += progress["numInputRows"]
        status = query.status
        if status["isDataAvailable"] and status["isTriggerActive"]:
            last_input = time.monotonic()
        if time.monotonic() - last_input >= idle_seconds:
            query.stop()
        time.sleep(poll_seconds)
    if query.exception() is not None:
        raise query.exception()
    return events


def run(lines: DataFrame, path: str, checkpoint: str) -> None:
    start(lines, path, checkpoint).awaitTermination()


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed valid events."""
    return _read(spark, path, VALID).select(*ORDER_EVENT.fieldNames())


def read_unknown_fields(spark: SparkSession, path: str) -> DataFrame:
    """Order id and whole text of landed valid events that have fields beyond the schema."""
    return _read(spark, path, VALID).where("raw IS NOT NULL").select("order_id", "raw")


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines as they arrived."""
    return _read(spark, path, REJECTED).select("raw")


def _read(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    return spark.read.schema(_LANDED).json(path).where(F.col("outcome") == outcome)
