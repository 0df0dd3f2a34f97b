"""Key checks from one presence aggregate against plain Python counts."""

from __future__ import annotations

import json
import random
import re

import pytest

from conftest import SMALL, plan_of, rows
from shopmart.operators import checks, presence
from shopmart.operators.presence import Reference
from shopmart.plans import gold, quality
from shopmart.sources import retail


def plan_text(df):
    df.collect()
    return plan_of(df)


@pytest.fixture
def shop(frame):
    draw = random.Random(4)
    people = [(draw.choice([None, *range(30)]), f"c{draw.randrange(9)}") for _ in range(50)]
    orders = [(draw.choice([None, *range(60)]), draw.choice([None, *range(45)]), draw.choice(["c1", "c40", None])) for _ in range(300)]
    items = [(draw.choice([None, *range(90)]), float(draw.choice([1, 2, 2.5]))) for _ in range(700)]
    data = {"people": people, "orders": orders, "items": items}
    schemas = {"people": "id INT, code STRING", "orders": "id BIGINT, person BIGINT, code STRING", "items": "order_id INT, weight DOUBLE"}
    return {name: frame(found, schemas[name]) for name, found in data.items()}, data


REFERENCES = [
    Reference("orders", "person", "people", "id"), Reference("items", "order_id", "orders", "id"),
    Reference("orders", "code", "people", "code"), Reference("items", "weight", "people", "id"),
    Reference("orders", "person", "orders", "id"), Reference("orders", "code", "people", "id"),
]
UNIQUE = [("people", "id"), ("orders", "id"), ("people", "code")]


def test_equals_plain_counts(shop):
    tables, data = shop
    place = {("people", "id"): 0, ("people", "code"): 1, ("orders", "id"): 0, ("orders", "person"): 1, ("orders", "code"): 2,
             ("items", "order_id"): 0, ("items", "weight"): 1}
    column = lambda table, name: [row[place[table, name]] for row in data[table]]
    found = {}
    for r in checks.key_checks(tables, REFERENCES, UNIQUE).collect():
        found[r["check"], r["dataset"], r["fk_col"], r["parent"], r["pk_col"]] = r
    for r in REFERENCES:
        used, known = column(r.child, r.fk), set(column(r.parent, r.pk))
        orphans = sorted({v for v in used if v is not None and v not in known})
        out = found["referential_integrity", r.child, r.fk, r.parent, r.pk]
        assert out["error_count"] == len(orphans) + used.count(None)
        details = json.loads(out["details"])
        assert details == {"sample_orphans": orphans[:20], "null_fk_count": used.count(None)}
    for table, name in UNIQUE:
        values = column(table, name)
        assert found["duplicates", table, None, None, name]["error_count"] == len(values) - len(set(values))
    assert len(found) == len(REFERENCES) + len(UNIQUE)


def test_tables_without_rows(shop):
    tables, _ = shop
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {r["status"] for r in checks.key_checks(empty, REFERENCES, UNIQUE).collect()} == {"PASS"}


def test_orphan_keys_with_their_rows(shop):
    tables, data = shop
    known = {r[0] for r in data["orders"]}
    used = [r[0] for r in data["items"]]
    expected = sorted({(v, used.count(v)) for v in used if v is not None and v not in known})
    assert sorted(map(tuple, checks.orphan_keys(tables["items"], tables["orders"], "order_id", "id").collect())) == expected


def test_suite_reads_each_table_once_for_its_keys_and_joins_nothing(spark):
    raw = {name: df for name, df in retail.raw_tables(spark, SMALL).items() if name != "customers"}
    references = [r for r in quality.REFERENCES if "customers" not in (r.child, r.parent)]
    text = plan_text(checks.key_checks(raw, references, [(n, k) for n, k in quality.UNIQUE_KEYS.items() if n in raw]))
    final = text.split("== Initial Plan ==")[0]
    assert "Join" not in final
    # Orders serve as orders and as payments: two tables, two scans; the second use of the counts reads the first's shuffle.
    assert len(re.findall("FileScan|Scan parquet", final)) == len(references and {"products", "orders", "order_items", "payments"})
    assert "ReusedExchange" in final


def test_a_key_that_fills_a_table_is_one_row_from_each_task(spark):
    hot = spark.range(20_000, numPartitions=4).selectExpr("if(id % 3 > 0, 7L, id) AS k")
    counted = presence.KeyPresence({"t": hot}, [], [("t", "k")]).frame
    assert counted.where("key0 = 7").selectExpr("n0").collect()[0][0] == spark.range(20_000).where("id % 3 > 0 OR id = 7").count()
    assert re.search("functions=.*partial_count", plan_of(counted))


def test_key_violations_have_no_join(spark, frame):
    star = {
        "dim_clientes": frame([("a", 1), ("a", 2), ("b", 2), (None, None), (None, None)], "nk_customer_id STRING, sk_cliente BIGINT"),
        "dim_produtos": frame([(5, 5)], "nk_product_id BIGINT, sk_produto BIGINT"),
        "dim_tempo": spark.sql("SELECT DATE '2024-01-01' AS dt_data, 9L AS sk_tempo"),
        "fato_pedidos": frame([(1, 0, 9), (3, 5, None), (3, 6, 9)], "sk_cliente BIGINT, sk_produto BIGINT, sk_tempo BIGINT"),
    }
    found = gold.key_violations(star)
    assert rows(found) == sorted([
        ("dim_clientes", "nk_customer_id unique", 1, 5), ("dim_clientes", "sk_cliente unique", 1, 5),
        ("dim_produtos", "nk_product_id unique", 0, 1), ("dim_produtos", "sk_produto unique", 0, 1),
        ("dim_tempo", "dt_data unique", 0, 1), ("dim_tempo", "sk_tempo unique", 0, 1),
        ("fato_pedidos", "sk_cliente references dim_clientes", 2, 3), ("fato_pedidos", "sk_produto references dim_produtos", 1, 3),
        ("fato_pedidos", "sk_tempo references dim_tempo", 0, 3),
    ], key=lambda r: [(v is not None, str(v)) for v in r])
    assert "Join" not in plan_text(found)
