from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from text_cases import documents, empty, frame_of

from shopmart.llm import sharding


def check(rows, shards):
    n = Counter(r.shard for r in rows)
    sizes = [n.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sources = Counter(r.source for r in rows)
    for source, total in sources.items():
        shares = Counter(r.shard for r in rows if r.source == source)
        for s in range(shards):
            assert abs(shares.get(s, 0) - total * sizes[s] / len(rows)) <= 2 + 0.02 * total


def test_awkward_rows(spark):
    rows = sharding.assign(frame_of(spark), shards=4).collect()
    check(rows, 4)
    expected = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in documents())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert sharding.assign(empty(spark)).count() == 0


@pytest.mark.parametrize("range_rows", [7, 1024])
def test_mixture_and_ranges(spark, monkeypatch, range_rows):
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(sharding, "RANGES_TOGETHER", 5)
    docs = spark.range(1200).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text", "IF(id % 3 = 0, 'big', IF(id % 50 = 1, NULL, concat('s', id % 7))) AS source")
    rows = sharding.assign(docs, shards=24).collect()
    check(rows, 24)
    again = sharding.assign(docs.repartition(5), shards=24).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    other = sharding.assign(docs, shards=24, seed=1).collect()
    assert sorted(map(tuple, rows), key=str) != sorted(map(tuple, other), key=str)


def test_many_equal_rows(spark, monkeypatch):
    """A third of the rows are copies without an id; they spread over shards like any others."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", 16)
    monkeypatch.setattr(sharding, "COPIES_TOGETHER", 50)
    docs = spark.range(900).selectExpr(
        "IF(id % 3 = 0, NULL, id) AS doc_id", "IF(id % 3 = 0, 'copy', CAST(id AS STRING)) AS text",
        "IF(id % 3 = 0 OR id % 2 = 0, 'big', 'small') AS source",
    )
    rows = sharding.assign(docs, shards=6).collect()
    check(rows, 6)
    copies = Counter(r.shard for r in rows if r.doc_id is None)
    assert sum(copies.values()) == 300 and all(30 <= copies[s] <= 70 for s in range(6))
    again = sharding.assign(docs.repartition(3), shards=6).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_copies_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_TOGETHER", 4)
    groups = spark.createDataFrame([(1, "a", 8, 0, 1), (2, None, 8, 0, 4), (None, "a", 8, 0, 11)], "doc_id long, source string, size long, text_crc32 long, copies long")
    found = Counter((r.doc_id, r["copy"]) for r in sharding.numbered_copies(groups).collect())
    assert found == Counter([(1, 0), *((2, i) for i in range(4)), *((None, i) for i in range(11))])


def test_order_is_that_of_fractional_ranks(spark, monkeypatch):
    """Within the whole order a source's k-th row lies at (k + 1/2) / size."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", 16)
    docs = spark.range(500).selectExpr("id AS doc_id", "'' AS text", "concat('s', CAST(sqrt(id) / 6 AS INT)) AS source")
    rows = sorted(sharding.assign(docs, shards=5).collect(), key=lambda r: (r.shard, r.slot))
    seen, sizes, last = Counter(), Counter(r.source for r in rows), 0.0
    for r in rows:
        fraction = (seen[r.source] + 0.5) / sizes[r.source]
        assert fraction >= last
        last = fraction
        seen[r.source] += 1
