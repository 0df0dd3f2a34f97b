"""Silver cleaners on small fixtures."""

from __future__ import annotations

from datetime import datetime

import pytest

from conftest import HASH_KEY, only, rows
from shopmart.plans import silver
from test_keys import expected_hmac

CUSTOMER = (
    "customer_id BIGINT, name STRING, email STRING, phone STRING, city STRING, state STRING,"
    " birth_date STRING, created_at STRING"
)
PEOPLE = [
    (1, "Ødegård", "one@mail.test", "11", "Tromsø", "NO", "1990-01-01", "2022-01-01"),
    (2, "Quill", "two@mail.test", "12", "Porto", "PT", "1991-02-02", "2022-01-02T10:30:00"),
    (3, "Marsh", "three@mail.test", "13", "Ghent", "BE", "not a date", "2022-01-03"),
]
PRODUCT = (
    "product_id BIGINT, name STRING, category STRING, subcategory STRING, price {num}, cost {num},"
    " stock_qty INT, created_at STRING"
)
ITEM = (
    "item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, unit_price DOUBLE, discount DOUBLE,"
    " line_total DOUBLE"
)
ORDER = (
    "order_id BIGINT, customer_id BIGINT, order_date STRING, status STRING, total_amount DOUBLE,"
    " shipping_fee DOUBLE, channel STRING"
)


def test_customers_are_hashed_and_deduplicated(frame):
    out = silver.clean_customers(frame(PEOPLE * 2, CUSTOMER), HASH_KEY)
    found = {r["phone"]: r for r in out.collect()}
    assert out.count() == 3
    assert found["11"]["customer_id"] == expected_hmac(1)
    assert found["11"]["name"] == expected_hmac("Ødegård")
    assert found["11"]["city"] == "Tromsø"
    assert found["12"]["created_at"] == datetime(2022, 1, 2, 10, 30)
    assert found["13"]["birth_date"] is None


def test_customers_without_id_or_email_are_dropped(frame):
    people = [PEOPLE[0], (None, *PEOPLE[1][1:]), (*PEOPLE[2][:2], None, *PEOPLE[2][3:])]
    assert silver.clean_customers(frame(people, CUSTOMER), HASH_KEY).count() == 1


def test_pii_columns_are_a_parameter(frame):
    out = silver.clean_customers(frame(PEOPLE[:1], CUSTOMER), HASH_KEY, pii=("customer_id", "phone"))
    assert (out.first()["name"], out.first()["phone"]) == ("Ødegård", expected_hmac("11"))


def test_products(frame):
    stock = [(1, "p", "c", "s", 10.0, 4.0, n, "2022-01-01") for n in (10,)]
    raw = [*stock, (2, "p", "c", "s", -20.0, 4.0, None, "2022-01-01"), (3, "p", "c", "s", 10.0, 15.0, 5, "x")]
    out = {r["product_id"]: r for r in silver.clean_products(frame(raw, PRODUCT.format(num="DOUBLE"))).collect()}
    assert [out[i]["stock_qty"] for i in (1, 2, 3)] == [10, 0, 5]
    assert out[2]["price"] == 20.0
    assert out[3]["cost"] == 10.0
    assert out[3]["created_at"] is None


def test_product_amounts_given_as_text(frame):
    raw = [
        (1, "p", "c", "s", "12.5", "abc", 1, "2022-01-01"),
        (2, "p", "c", "s", None, "7", 1, "2022-01-01"),
        (3, "p", "c", "s", "NaN", "7", 1, "2022-01-01"),
    ]
    out = {r["product_id"]: r for r in silver.clean_products(frame(raw, PRODUCT.format(num="STRING"))).collect()}
    assert (out[1]["price"], out[1]["cost"]) == (12.5, None)
    assert (out[2]["price"], out[2]["cost"]) == (None, 7.0)
    assert (out[3]["price"], out[3]["cost"]) == (None, 7.0)


def test_keyed_dedup_keeps_one_row_and_follows_order_by(frame):
    raw = [(1, "b", "c", "s", 1.0, 1.0, 1, "2022-01-02"), (1, "a", "c", "s", 1.0, 1.0, 1, "2022-01-03")]
    df = frame(raw, PRODUCT.format(num="DOUBLE"))
    assert only(silver.clean_products(df))["name"] == "a"
    assert only(silver.clean_products(df, order_by=["created_at"]))["name"] == "b"


@pytest.mark.parametrize("given,expected", [(-7.0, 0.0), (0.125, 0.125), (33.0, 1.0), (0.999, 0.999), (-0.0, 0.0), (-1e-9, 0.0)])
def test_discount_is_clipped(frame, given, expected):
    out = only(silver.clean_order_items(frame([(1, 1, 1, 1, -5.0, given, -5.0)], ITEM)))
    assert (str(out["discount"]), out["unit_price"], out["line_total"]) == (str(expected), 5.0, 5.0)


def test_null_discount_stays_null(frame):
    assert only(silver.clean_order_items(frame([(1, 1, 1, 1, 5.0, None, 5.0)], ITEM)))["discount"] is None


def test_orders_need_a_positive_total(frame):
    raw = [
        (i, 42, "2023-01-01", "delivered", total, 1.0, "web")
        for i, total in enumerate([10.0, 0.0, -1.0, None, float("nan")])
    ]
    out = silver.clean_orders(frame(raw, ORDER), HASH_KEY)
    assert [r["order_id"] for r in out.collect()] == [0]


def test_same_id_has_same_hash_in_all_tables(frame):
    customer = silver.clean_customers(frame([(42, *PEOPLE[0][1:])], CUSTOMER), HASH_KEY).first()
    order = silver.clean_orders(frame([(1, 42, "2023-01-01", "x", 1.0, 1.0, "web")], ORDER), HASH_KEY).first()
    review = silver.clean_reviews(
        frame(
            [(1, 1, 42, 1, 9, "c", "2023")],
            "review_id BIGINT, order_id BIGINT, customer_id BIGINT, product_id BIGINT, rating INT, comment STRING,"
            " created_at STRING",
        ),
        HASH_KEY,
    ).first()
    assert customer["customer_id"] == order["customer_id"] == review["customer_id"]
    assert review["rating"] == 5


def test_payments(frame):
    schema = "payment_id BIGINT, order_id BIGINT, method STRING, status STRING, amount DOUBLE, paid_at STRING"
    raw = [(1, 1, "pix", "approved", 1.0, "2023-01-01T05:00:00"), (1, 1, "pix", "approved", 1.0, "2023-01-02"),
           (2, 1, "pix", "approved", 1.0, "?")]
    out = rows(silver.clean_payments(frame(raw, schema)).select("payment_id", "paid_at"))
    assert out == [(1, datetime(2023, 1, 1, 5)), (2, None)]


def test_unlisted_columns_survive(frame):
    raw = frame([(1, 1, 1, 1, 1.0, 0.0, 1.0, "x")], ITEM + ", note STRING")
    assert only(silver.clean_order_items(raw))["note"] == "x"


def test_coercion_losses(frame):
    df = frame([("1", "2023-01-01"), ("x", None), (None, "bad")], "a STRING, d STRING")
    assert rows(silver.coercion_losses(df, "t", numbers=["a"], dates=["d"])) == [("t", "a", 1), ("t", "d", 1)]
