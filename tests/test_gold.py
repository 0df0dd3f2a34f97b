"""Star schema: keys, dimensions, fact."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from conftest import only, rows
from shopmart.functions.keys import wide_key
from shopmart.plans import gold
from test_keys import expected_crc, expected_hmac

ALICE, BOB = expected_hmac(1), expected_hmac(2)


@pytest.fixture
def silver(frame):
    return {
        "customers": frame(
            [(ALICE, "SP", "SP", datetime(2022, 1, 1)), (BOB, "RJ", "RJ", datetime(2022, 1, 2))],
            "customer_id STRING, city STRING, state STRING, created_at TIMESTAMP",
        ),
        "products": frame(
            [(10, "A", "c1", "s1", 100.0, 40.0, 1), (20, "B", "c2", "s2", 500.0, 200.0, 1),
             (99, "Z", "c2", "s2", 0.0, 0.0, 1), (98, "N", "c2", "s2", None, 1.0, 1)],
            "product_id BIGINT, name STRING, category STRING, subcategory STRING, price DOUBLE, cost DOUBLE, stock_qty INT",
        ),
        "orders": frame(
            [(1, ALICE, datetime(2022, 3, 15, 18), "delivered", 300.0, 10.0, "web"),
             (2, BOB, datetime(2023, 6, 20), "shipped", 500.0, 5.0, "mobile"),
             (3, expected_hmac(77), datetime(2023, 12, 1), "cancelled", 50.0, 5.0, "web"),
             (4, BOB, None, "delivered", 60.0, 5.0, "web")],
            "order_id BIGINT, customer_id STRING, order_date TIMESTAMP, status STRING, total_amount DOUBLE,"
            " shipping_fee DOUBLE, channel STRING",
        ),
        "order_items": frame(
            [(1, 1, 10, 2, 100.0, 0.0, 200.0), (2, 1, 20, 1, 100.0, 0.0, 100.0), (3, 2, 20, 1, 500.0, 0.0, 500.0),
             (4, 3, 12345, 1, 50.0, 0.0, 50.0), (5, 777, 10, 1, 1.0, 0.0, 1.0)],
            "item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, unit_price DOUBLE, discount DOUBLE,"
            " line_total DOUBLE",
        ),
        "payments": frame(
            [(1, 1, "pix", "approved", 300.0), (2, 2, "boleto", "pending", 400.0), (3, 2, "pix", "approved", 100.0)],
            "payment_id BIGINT, order_id BIGINT, method STRING, status STRING, amount DOUBLE",
        ),
    }


def test_customer_dimension(silver):
    dim = gold.build_dim_clientes(silver["customers"])
    assert dim.columns == ["sk_cliente", "nk_customer_id", "city", "state", "dt_criacao"]
    assert {r["sk_cliente"] for r in dim.collect()} == {expected_crc(ALICE), expected_crc(BOB)}
    again = gold.build_dim_clientes(silver["customers"].orderBy("city").repartition(3))
    assert rows(dim) == rows(again)


def test_product_dimension_margin(silver):
    dim = {r["nk_product_id"]: r for r in gold.build_dim_produtos(silver["products"]).collect()}
    assert {k: r["margem_pct"] for k, r in dim.items()} == {10: 60.0, 20: 60.0, 99: 0.0, 98: 0.0}
    assert dim[10]["sk_produto"] == expected_crc(10)


def test_calendar(spark):
    dim = gold.build_dim_tempo(spark, date(2022, 11, 5), date(2023, 2, 3))
    assert dim.count() == 91
    day = only(dim.where("dt_data = DATE '2023-01-01'"))
    assert day["sk_tempo"] == expected_crc("2023-01-01")
    assert (day["dia_semana"], day["nm_dia_semana"], day["fl_fimdesemana"]) == (6, "Sunday", True)
    assert (day["semana_ano"], day["trimestre"], day["nm_mes"]) == (52, 1, "January")
    assert dim.select("sk_tempo").distinct().count() == 91
    assert gold.build_dim_tempo(spark, date(2024, 2, 29), date(2024, 2, 29)).count() == 1
    with pytest.raises(ValueError):
        gold.build_dim_tempo(spark, date(2024, 1, 2), date(2024, 1, 1))


def test_calendar_spans_the_orders(silver):
    dim = gold.calendar_of(silver["orders"])
    assert dim.count() == (date(2023, 12, 1) - date(2022, 3, 15)).days + 1
    assert gold.calendar_of(silver["orders"].where("order_date IS NULL")).count() == 0


def test_fact(silver):
    star = gold.build_star(silver)
    fact = star["fato_pedidos"]
    assert tuple(fact.columns) == gold.FACT_COLUMNS
    found = fact.select("nk_order_id", "item_id", "method", "year", "month", "line_total")
    assert rows(found) == sorted([
        (1, 1, "pix", 2022, 3, 200.0), (1, 2, "pix", 2022, 3, 100.0), (2, 3, "boleto", 2023, 6, 500.0),
        (2, 3, "pix", 2023, 6, 500.0), (3, 4, None, 2023, 12, 50.0), (4, None, None, None, None, None),
    ], key=lambda r: [(v is not None, str(v)) for v in r])
    by_order = {r["nk_order_id"]: r for r in fact.collect()}
    assert by_order[1]["sk_cliente"] == expected_crc(ALICE)
    assert by_order[1]["sk_tempo"] == expected_crc("2022-03-15")
    assert (by_order[3]["sk_cliente"], by_order[3]["sk_produto"]) == (0, 0)
    assert (by_order[4]["sk_tempo"], by_order[4]["sk_produto"]) == (0, None)
    assert rows(gold.orphan_counts(fact)) == [("sk_cliente", 1, 1), ("sk_produto", 1, 1), ("sk_tempo", 1, 1)]


def test_empty_dimension_makes_every_row_an_orphan(silver, frame):
    nobody = gold.build_dim_clientes(silver["customers"].where("false"))
    fact = gold.build_fato_pedidos(
        silver["orders"], silver["order_items"], silver["payments"], nobody,
        gold.build_dim_produtos(silver["products"]), gold.calendar_of(silver["orders"]),
    )
    assert fact.where("sk_cliente <> 0").count() == 0


def test_repeated_customer_does_not_multiply_facts(silver):
    plain = gold.build_star(silver)["fato_pedidos"]
    moved = silver["customers"].unionByName(silver["customers"].selectExpr("customer_id", "'X' city", "state", "created_at"))
    assert rows(gold.build_star({**silver, "customers": moved})["fato_pedidos"]) == rows(plain)


def test_missing_fact_column_is_named(frame):
    with pytest.raises(KeyError, match="vl_frete"):
        gold.enforce_columns(frame([(1,)], "nk_order_id BIGINT"), ("nk_order_id", "vl_frete"), "fato_pedidos")


def test_collisions(silver, frame):
    dim = gold.build_dim_clientes(silver["customers"])
    assert gold.report_collisions(dim, "dim_clientes") == 0
    clash = dim.selectExpr("1L AS sk_cliente", "nk_customer_id")
    assert rows(gold.key_collisions(clash, "dim_clientes")) == [(1, 2)]
    with pytest.warns(UserWarning, match="1 surrogate key collisions"):
        gold.report_collisions(clash, "dim_clientes")
    with pytest.raises(ValueError):
        gold.report_collisions(clash, "dim_clientes", fail=True)


def test_wide_keys(silver):
    star = gold.build_star(silver, key=wide_key)
    assert star["fato_pedidos"].where("sk_tempo > 4294967295").count() > 0
    assert star["fato_pedidos"].where("sk_cliente = 0").count() == 1
