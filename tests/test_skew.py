"""Skew-aware joins give what the plain ones give."""

from __future__ import annotations

import random

import pytest

from conftest import rows
from shopmart.operators import skew
from shopmart.plans import gold, marts
from shopmart.plans.hot import HotKeys
from shopmart.sources import retail
from shopmart.plans import silver as silver_plan
from conftest import HASH_KEY, SMALL


@pytest.fixture
def facts(frame):
    rng = random.Random(5)
    data = [(i, None if i % 10 == 0 else (7 if i % 3 == 0 else rng.randrange(40))) for i in range(600)]
    return frame(data, "id INT, k INT")


@pytest.fixture
def lookup(frame):
    return frame([(k, f"n{k}") for k in range(30)] + [(7, "again")], "k INT, name STRING")


def test_find_hot_keys(facts):
    assert set(skew.find_hot_keys(facts, "k", share=0.08)) == {7, None}
    assert skew.find_hot_keys(facts, "k", share=0.9) == []
    assert skew.find_hot_keys(facts.limit(0), "k") == []
    assert skew.find_hot_keys(facts, "k + 1", share=0.2) == [8]
    assert 7 in skew.find_hot_keys(facts, "k", share=0.2, sample_rows=300)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [[7], [7, None], [999], [3, 7, 12]])
def test_lookup_join(facts, lookup, how, hot):
    plain = facts.join(lookup, "k", how).select("id", "k", "name")
    salted = skew.lookup_join(facts, lookup, "k", how, hot, salts=5).select("id", "k", "name")
    assert rows(salted) == rows(plain)


@pytest.mark.parametrize("hot", [[7], [7, None], [35], [999], [0, 7, 35]])
def test_detail_join(facts, lookup, hot):
    parents = lookup.unionByName(lookup.limit(0)).where("name <> 'again'").selectExpr("k", "name")
    extra = parents.sparkSession.createDataFrame([(500, "no details"), (None, "null key")], "k INT, name STRING")
    parents = parents.unionByName(extra)
    plain = parents.join(facts, "k", "left").select("k", "name", "id")
    # 999 is nowhere; 500 has no detail row, like a key that went cold since it was measured.
    salted = skew.detail_join(parents, facts, "k", [*hot, 500], salts=5).select("k", "name", "id")
    assert rows(salted) == rows(plain)


def test_star_and_marts_with_hot_keys_equal_plain_ones(spark):
    raw = retail.raw_tables(spark, SMALL)
    clean = {name: silver_plan.clean(name, df, HASH_KEY) for name, df in raw.items()}
    hot = HotKeys.detect(clean["orders"], clean["order_items"], clean["payments"], share=0.009)
    hot = HotKeys(
        order_customers=hot.order_customers or (clean["orders"].first()["customer_id"],),
        item_orders=(1, 2, 3, 4_000_000), item_products=(5, 6, 7), payment_orders=(61, 122, 1),
    )
    assert rows(gold.build_star(clean, hot=hot)["fato_pedidos"]) == rows(gold.build_star(clean)["fato_pedidos"])
    plain, salted = marts.build_all(clean), marts.build_all(clean, hot)
    for name in ("orders_enriched", "items_enriched", "monthly_revenue", "customer_spend"):
        assert rows(salted[name]) == rows(plain[name]), name
