"""Segmented running totals against plain Python, and how evenly they spread."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from conftest import plan_of, rows
from shopmart.operators import scan
from shopmart.plans import marts
from shopmart.plans.hot import HotKeys
from shopmart.schemas import CLEANED

segmented = scan.with_segments
SCHEMA = "customer_id STRING, order_id BIGINT, order_date TIMESTAMP, total_amount DOUBLE"


def spend(frame, n=400, days=9, seed=3):
    rng = random.Random(seed)
    start = datetime(2023, 1, 1)
    data = [
        (None if i % 41 == 0 else "hot" if i % 3 else f"c{rng.randrange(20)}", i,
         None if i % 50 == 0 else start + timedelta(days=rng.randrange(days)),
         None if i % 29 == 0 else float("inf") if i % 97 == 0 else rng.randrange(1, 10**6) / 100)
        for i in range(n)
    ]
    rng.shuffle(data)
    return frame(data, SCHEMA)


def plain(orders):
    by_customer = {}
    for row in orders.collect():
        by_customer.setdefault(row["customer_id"], []).append(row)
    expected = []
    for customer, items in by_customer.items():
        items.sort(key=lambda r: (r["order_date"] or datetime.min, r["order_id"]))
        total, previous = None, None
        for rank, r in enumerate(items, 1):
            amount = r["total_amount"]
            if amount is not None and amount != float("inf"):
                total = (total or 0) + round(amount * 100)
            expected.append((customer, r["order_id"], r["order_date"], amount, None if total is None else total / 100, rank, previous))
            previous = amount
    return sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("segments,days", [(1, 9), (2, 9), (7, 9), (40, 9), (8, 1), (500, 3)])
def test_running_total_against_brute_force(frame, segments, days):
    orders = spend(frame, days=days)
    assert rows(marts.customer_spend(orders, segments)) == plain(orders)


def test_one_customer_and_no_rows(frame):
    one = frame([("c", i, None, 1.0) for i in range(50)], SCHEMA)
    assert rows(marts.customer_spend(one, 6)) == plain(one)
    assert marts.customer_spend(one.limit(0), 6).count() == 0


@pytest.mark.parametrize("keys", ["id % 200", "if(id % 3 = 0, 7, id % 200)", "7"])
def test_segments_are_even_whatever_the_keys(spark, keys):
    """200 customers of half a percent each, one with a third of the rows, and one with all of them."""
    orders = spark.range(40_000).selectExpr(
        f"CAST({keys} AS STRING) AS customer_id", "id AS order_id", "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id % 300 AS INT)) AS order_date",
        "1D AS total_amount",
    )
    segmented = scan.with_segments(orders, "customer_id", ["order_date", "order_id"], 40)
    work = [r["count"] for r in segmented.groupBy("_segment", "customer_id").count().collect()]
    sizes = [r["count"] for r in segmented.groupBy("_segment").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 2 * sorted(sizes)[20] and max(work) <= max(sizes)
    carried = scan.carries(segmented.withColumn("_cents", segmented["order_id"]), "customer_id", ["order_date", "order_id"], "total_amount")
    assert carried.count() <= 40


def test_segment_numbers_are_stored(spark, frame):
    text = plan_of(scan.with_segments(spend(frame), "customer_id", ["order_date", "order_id"], 5))
    assert "parquet" in text and "Exchange" not in text


def test_segment_count():
    assert [scan.segment_count(n) for n in (0, 1, 2_000_000, 2_000_001, 10**10)] == [1, 1, 1, 2, 5000]


def test_spend_is_segmented_only_for_customers_that_outgrow_a_segment(spark, frame, tmp_path, monkeypatch):
    """No customer is hot and a hundredth of the orders fits a segment: one shuffle and no stored copy, however many orders."""
    assert [marts.spend_segments(n, HotKeys()) for n in (0, 9_000_000, 200_000_000, 200_000_001)] == [1, 1, 1, 101]
    assert [marts.spend_segments(n, HotKeys(order_customers=("hot",))) for n in (1_000_000, 9_000_000)] == [1, 5]
    cleaned = {name: frame([], schema) for name, schema in CLEANED.items()}
    cleaned["orders"] = spark.range(400).selectExpr(
        "id AS order_id", "CAST(id % 200 AS STRING) AS customer_id", "TIMESTAMP '2024-01-01' AS order_date",
        "'delivered' AS status", "CAST(id AS DOUBLE) AS total_amount", "1D AS shipping_fee", "'web' AS channel",
    )
    made = []
    monkeypatch.setattr(marts, "segment_count", lambda rows: 5)
    monkeypatch.setattr(scan, "with_segments", lambda *a: made.append(a) or segmented(*a))
    marts.write_all(cleaned, str(tmp_path))
    assert not made
    found = spark.read.parquet(f"{tmp_path}/customer_spend")
    assert rows(found) == rows(marts.customer_spend(cleaned["orders"]))
