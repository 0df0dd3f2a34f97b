"""Analytic questions on a small star with results worked out by hand; catalog tables."""

from __future__ import annotations

from datetime import date

import pytest

from conftest import HASH_KEY, SMALL, rows
from shopmart.plans import analytics, explore, gold, silver
from shopmart.sources import ddl, retail

AS_OF = date(2001, 8, 1)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """The star schema of the smallest tables, loaded into catalog tables in ``dw``."""
    clean = {n: silver.clean(n, df, HASH_KEY) for n, df in retail.raw_tables(spark, SMALL).items()}
    path = str(tmp_path_factory.mktemp("dw"))
    ddl.create_tables(spark, "dw", path)
    ddl.create_tables(spark, "dw", path)  # a second time changes nothing
    ddl.load_tables(gold.build_star(clean), "dw")
    return {name: spark.table(f"dw.{name}") for name in ddl.TABLES}


def test_catalog_tables_carry_types_and_comments(spark, star):
    types = dict(star["fato_pedidos"].dtypes)
    assert (types["line_total"], types["discount"], types["sk_cliente"]) == ("decimal(12,2)", "decimal(5,4)", "bigint")
    described = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE dw.dim_clientes").collect()}
    assert "HMAC" in described["nk_customer_id"]
    assert star["fato_pedidos"].where("dt_carga IS NULL").count() == 0
    before = star["fato_pedidos"].count()
    ddl.load_tables({"fato_pedidos": _copy(spark, star)}, "dw")
    assert spark.table("dw.fato_pedidos").count() == before


def _copy(spark, star):
    """Rows to reload, detached from the table they overwrite."""
    fact = star["fato_pedidos"].drop("dt_carga")
    return spark.createDataFrame(fact.collect(), fact.schema)


# Dates by key; order 4 is cancelled, order 6 has an unknown customer, order 7 no items.
DAYS = {1: date(2024, 1, 10), 2: date(2024, 1, 20), 3: date(2024, 2, 5), 4: date(2024, 3, 1), 5: date(2025, 2, 1)}
SALES = [
    (1, 1, 1, 1, "delivered", "web", "pix", 2, 10.0, 30.0), (1, 1, 2, 1, "delivered", "web", "pix", 1, 20.0, 30.0),
    (2, 2, 1, 2, "delivered", "web", "wallet", 1, 5.05, 5.05), (3, 1, 1, 3, "shipped", "mobile", "pix", 3, 15.0, 15.0),
    (4, 2, 2, 4, "cancelled", "web", "pix", 9, 99.0, 99.0), (5, 1, 2, 5, "delivered", "web", "pix", 1, 7.0, 7.0),
    (6, 0, 1, 1, "delivered", "web", "pix", 1, 1.0, 1.0), (7, 1, 0, 1, "delivered", "web", "pix", None, None, 8.0),
]


@pytest.fixture
def small(frame):
    fact = frame(
        [(*row, DAYS[row[3]].year, DAYS[row[3]].month) for row in SALES],
        "nk_order_id BIGINT, sk_cliente BIGINT, sk_produto BIGINT, sk_tempo BIGINT, ds_status STRING, ds_canal STRING,"
        " method STRING, quantity INT, line_total DOUBLE, vl_total_pedido DOUBLE, year INT, month INT",
    )
    days = frame([(k, d, d.year, d.month) for k, d in DAYS.items()], "sk_tempo BIGINT, dt_data DATE, ano INT, mes INT")
    products = frame([(1, 101, "pen", "office"), (2, 102, "mug", "home")],
                     "sk_produto BIGINT, nk_product_id BIGINT, nm_produto STRING, category STRING")
    people = frame([(1, "SP"), (2, "RJ")], "sk_cliente BIGINT, state STRING")
    return fact, days, products, people


def listed(df):
    return [tuple(row) for row in df.collect()]


@pytest.mark.parametrize("hot", [(), (1,), (0, 1, 2)])
def test_q1(small, hot):
    fact, days, products, _ = small
    assert listed(analytics.monthly_revenue(fact, days, products, hot)) == [
        (2024, 1, "home", 20.0, 1, 20.0), (2024, 1, "office", 16.05, 3, 5.35), (2025, 2, "home", 7.0, 1, 7.0),
    ]


def test_q2(small):
    fact, _, products, _ = small
    expected = [(101, "pen", "office", 7, 31.05, 1), (102, "mug", "home", 2, 27.0, 2)]
    assert listed(analytics.top_products(fact, products)) == expected
    assert listed(analytics.top_products(fact, products, keep_ties=True)) == expected
    assert listed(analytics.top_products(fact, products, k=1)) == expected[:1]


def test_q2_ties(frame):
    fact = frame([("delivered", 1, 1, 5.0), ("delivered", 2, 1, 5.0), ("delivered", 3, 1, 5.0), ("returned", 3, 1, 9.0)],
                 "ds_status STRING, sk_produto BIGINT, quantity INT, line_total DOUBLE")
    dim = frame([(i, 10 + i, "n", "c") for i in (1, 2, 3)],
                "sk_produto BIGINT, nk_product_id BIGINT, nm_produto STRING, category STRING")
    cut = analytics.top_products(fact, dim, k=2)
    assert [(r["nk_product_id"], r["ranking_receita"]) for r in cut.collect()] == [(11, 1), (12, 1)]
    assert analytics.top_products(fact, dim, k=2, keep_ties=True).count() == 3


@pytest.mark.parametrize("as_of,days,expected", [
    (date(2025, 2, 10), None, [("web", "pix", 1, 7.0, 7.0)]),
    (date(2025, 2, 10), 372, [("mobile", "pix", 1, 15.0, 15.0), ("web", "pix", 1, 7.0, 7.0)]),
    # The ticket is a mean over rows: (30 + 30 + 1 + 8 + 7) / 5.
    (date(2024, 2, 1), None,
     [("web", "pix", 4, 15.2, 38.0), ("mobile", "pix", 1, 15.0, 15.0), ("web", "wallet", 1, 5.05, 5.05)]),
])
def test_q3(small, as_of, days, expected):
    fact, calendar, *_ = small
    assert listed(analytics.ticket_by_channel(fact, calendar, as_of, days)) == expected


def test_q3_prunes_partitions(star):
    plan = analytics.ticket_by_channel(star["fato_pedidos"], star["dim_tempo"], AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year#" in plan.split("PartitionFilters: [")[1][:400]


def test_q4(small):
    fact, days, _, people = small
    assert listed(analytics.churn(fact, days, people, date(2025, 3, 1))) == [
        (2, "RJ", DAYS[2], 406, "churn"), (1, "SP", DAYS[5], 28, "ativo"),
    ]
    assert {r[4] for r in listed(analytics.churn(fact, days, people, date(2025, 3, 1), days=406))} == {"ativo"}
    assert {r[4] for r in listed(analytics.churn(fact, days, people))} == {"churn"}  # today lies far behind


@pytest.mark.parametrize("wrap,last", [(False, 13), (True, 1)])
def test_q5(small, wrap, last):
    fact, days, *_ = small
    first = date(2024, 1, 1)
    assert listed(analytics.cohorts(fact, days, wrap)) == [
        (first, first, 3, 0), (first, date(2024, 2, 1), 1, 1), (first, date(2025, 2, 1), 1, last),
    ]


def test_exploration(frame):
    orders = frame([(1, "2023-01-05", "delivered", 30.0), (2, "2023-01-09T10:00:00", "shipped", 0.1),
                    (3, "?", "delivered", 5.0)],
                   "order_id BIGINT, order_date STRING, status STRING, total_amount DOUBLE")
    items = frame([(1, 10, 10.0), (1, 10, 20.0), (2, 10, 9.0), (3, 20, 5.5)],
                  "order_id BIGINT, product_id BIGINT, line_total DOUBLE")
    products = frame([(10, "a"), (20, "b")], "product_id BIGINT, category STRING")
    assert rows(explore.monthly_orders(orders)) == [("2023-01", 2, 30.1)]
    found = explore.revenue_by_category(orders, items, products)
    assert [tuple(r) for r in found.collect()] == [("b", 5.5), ("a", 30.0)]
    sums = explore.order_total_reconciliation(orders, items)
    assert rows(sums) == [(1, 30.0, 30.0, 0.0, True), (2, 0.1, 9.0, -8.9, False), (3, 5.0, 5.5, -0.5, False)]
