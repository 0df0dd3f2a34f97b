"""Order-event stream: restarts, malformed lines, bounded batches."""

from __future__ import annotations

import json

import pytest

from conftest import SMALL, rows
from shopmart.schemas import ORDER_EVENT
from shopmart.sources import retail
from shopmart.streaming import orders as feed


def event(order_id, **extra):
    body = {"order_id": order_id, "customer_id": 1, "product_id": 2, "quantity": 3, "unit_price": 9.5,
            "channel": "web", "event_time": "2024-01-01T00:00:00"}
    return json.dumps(body | extra)


def ingest(spark, folder, path, per_batch=None):
    feed.run(feed.read_files(spark, folder, per_batch), f"{path}/out", f"{path}/checkpoint")


def test_two_runs_over_a_growing_folder(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text(event(100_000_001) + "\n{broken\n" + event(None) + "\n")
    ingest(spark, str(source), tmp_path)
    assert [r["order_id"] for r in feed.read_landed(spark, f"{tmp_path}/out").collect()] == [100_000_001]
    assert rows(feed.read_rejected(spark, f"{tmp_path}/out")) == rows(
        spark.createDataFrame([("{broken",), (event(None),)], "raw STRING"))

    (source / "b.jsonl").write_text(event(100_000_002, quantity=5) + "\n")
    for _ in range(2):  # the second time there is nothing new
        ingest(spark, str(source), tmp_path)
    landed = feed.read_landed(spark, f"{tmp_path}/out")
    assert landed.schema.simpleString() == ORDER_EVENT.simpleString()
    assert {r["order_id"]: r["quantity"] for r in landed.collect()} == {100_000_001: 3, 100_000_002: 5}
    assert landed.count() == 2


def test_batches_are_bounded(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(5):
        (source / f"{i}.jsonl").write_text(event(100_000_000 + i) + "\n")
    query = feed.start(feed.read_files(spark, str(source), 2), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 1]
    assert feed.read_landed(spark, f"{tmp_path}/out").count() == 5


def test_stream_equals_batch(spark, tmp_path):
    stream = spark.readStream.schema(retail.SCHEMAS["events"]).parquet(f"{SMALL}/event[s].parquet")
    feed.run(retail.order_events(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    batch = feed.decode(retail.order_events(retail.read(spark, SMALL, "events")))
    valid = batch.where("outcome = 'valid'").select(*ORDER_EVENT.fieldNames())
    assert rows(feed.read_landed(spark, f"{tmp_path}/out")) == rows(valid)
    assert feed.read_rejected(spark, f"{tmp_path}/out").count() == batch.where("outcome = 'rejected'").count() > 0


def test_encode_is_the_inverse_of_decode(spark):
    events = spark.createDataFrame([(100_000_001, 1, 2, 3, 9.5, "web", "2024-01-01T00:00:00")], ORDER_EVENT)
    assert rows(feed.decode(feed.encode(events)).where("raw IS NULL").select(*events.columns)) == rows(events)


def test_kafka_options():
    source = feed.kafka_source_options("b:9092", "orders_stream", "group", 100)
    assert source["startingOffsets"] == "earliest"
    assert (source["kafka.group.id"], source["maxOffsetsPerTrigger"]) == ("group", "100")
    sink = feed.kafka_sink_options("b:9092", "orders_stream")
    assert (sink["kafka.acks"], sink["kafka.retries"]) == ("all", "3")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        feed.read_topic(spark, feed.kafka_source_options("b:9092", "t"))
