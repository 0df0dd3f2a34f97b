"""Bounded, idle-stopped and deduplicated reads of the event stream."""

from __future__ import annotations

import threading
import time

import pytest

from shopmart.streaming import lines as counted, orders as feed
from test_stream import event

NUMBER = 100_000_000


def write(folder, name, numbers, end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(event(NUMBER + n) for n in numbers) + end)


def landed(spark, path):
    return sorted(r["order_id"] - NUMBER for r in feed.read_landed(spark, f"{path}/out").collect())


def first(spark, path, n, per_batch=None):
    feed.run_first(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", n, per_batch)
    return landed(spark, path)


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_exactly_n_lines_a_run(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(counted, "BLOCK_BYTES", block)
    write(tmp_path / "in", "a", range(10))
    write(tmp_path / "in", "b", range(10, 13), end="")
    (tmp_path / "in" / "c").write_text("")
    write(tmp_path / "in", "d", range(13, 40))
    assert first(spark, tmp_path, 7, 3) == list(range(7))
    assert first(spark, tmp_path, 7) == list(range(14))
    write(tmp_path / "in", "e", range(40, 45))
    assert first(spark, tmp_path, 100, 11) == list(range(45))
    assert first(spark, tmp_path, 5) == list(range(45))  # nothing is left
    write(tmp_path / "in", "f", range(45, 50))
    assert first(spark, tmp_path, 2) == list(range(47))


def test_a_killed_run_repeats_nothing(spark, tmp_path, monkeypatch):
    write(tmp_path / "in", "a", range(40))
    calls = []

    def breaks(df, batch):
        calls.append(batch)
        if len(calls) == 3:
            raise RuntimeError("killed")
        df.select("record").write.mode("append").parquet(f"{tmp_path}/seen")

    def run():
        stream = counted.read_lines(spark, f"{tmp_path}/in", 6, 30)
        query = stream.writeStream.foreachBatch(breaks).option("checkpointLocation", f"{tmp_path}/check").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    seen = sorted(r["record"] for r in spark.read.parquet(f"{tmp_path}/seen").collect())
    assert seen == list(range(1, len(seen) + 1)) and len(seen) >= 30 and calls[2] == calls[3]


def test_bounds_are_positive(spark, tmp_path):
    with pytest.raises(ValueError):
        counted.read_lines(spark, str(tmp_path), 0)


def test_a_live_run_ends_when_idle_and_takes_late_files(spark, tmp_path):
    write(tmp_path / "in", "a", range(5))
    query = feed.start(feed.read_files(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", feed.LIVE)
    late = threading.Timer(3.0, write, (tmp_path / "in", "b", range(5, 9)))
    late.start()
    began = time.monotonic()
    assert feed.run_until_idle(query, idle_seconds=6.0) == 9
    assert time.monotonic() - began >= 8.0 and not query.isActive
    assert landed(spark, tmp_path) == list(range(9))


def test_a_failed_query_is_not_taken_for_an_idle_one(spark, tmp_path):
    write(tmp_path / "in", "a", range(5))

    def breaks(df, batch):
        raise RuntimeError("broken sink")

    stream = feed.read_files(spark, f"{tmp_path}/in").writeStream.foreachBatch(breaks)
    query = stream.option("checkpointLocation", f"{tmp_path}/check").start()
    with pytest.raises(Exception, match="broken sink"):
        feed.run_until_idle(query, idle_seconds=60.0)


def timed(n, minute):
    return event(NUMBER + n, event_time=f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00")


def deliver(spark, path, name, events, extra=()):
    (path / "in").mkdir(exist_ok=True)
    (path / "in" / name).write_text("\n".join([*(timed(n, m) for n, m in events), *extra]) + "\n")
    query = feed.start(feed.read_files(spark, f"{path}/in"), f"{path}/out", f"{path}/checkpoint", within="30 minutes")
    query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    return states[-1] if states else None


def test_repeats_are_dropped_and_state_is_bounded(spark, tmp_path):
    assert deliver(spark, tmp_path, "a", [(1, 0), (1, 0), (2, 5), (1, 9)], ["{broken", event(None)]) == 2
    assert landed(spark, tmp_path) == [1, 2]
    deliver(spark, tmp_path, "b", [(2, 6), (3, 8), (3, 8), (1, 0)])
    assert landed(spark, tmp_path) == [1, 2, 3]
    # Two hours on, the first ids leave the state; it holds what is within the watermark alone.
    for i in range(6):
        left = deliver(spark, tmp_path, f"c{i}", [(10 + i, 120 + 60 * i)])
    assert landed(spark, tmp_path) == [1, 2, 3, *range(10, 16)]
    assert left <= 2
