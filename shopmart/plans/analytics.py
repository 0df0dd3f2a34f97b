"""Analytic questions on the star schema.

Rows whose surrogate key is the unknown member 0 match no dimension row and drop out of the
inner joins. ``as_of`` stands for the current date and defaults to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from shopmart.functions.scalars import cents, money_avg, money_sum, month_start, months_apart
from shopmart.operators.skew import lookup_join

SOLD = "ds_status NOT IN ('cancelled', 'returned')"
TOP_K = 20
CHURN_DAYS = 90


def _today(as_of: date | None) -> str:
    return f"DATE '{as_of}'" if as_of else "current_date()"


def monthly_revenue(
    fact: DataFrame, dim_tempo: DataFrame, dim_produtos: DataFrame, hot_products: Sequence[int] = ()
) -> DataFrame:
    """Q1: delivered revenue, orders and average ticket per month and category.

    ``hot_products`` are surrogate keys as ``skew.find_hot_keys(fact, "sk_produto")`` lists them.
    """
    delivered = fact.where("ds_status = 'delivered'").select("sk_tempo", "sk_produto", "nk_order_id", "line_total")
    groups = dim_produtos.selectExpr("sk_produto", "category AS categoria")
    named = lookup_join(delivered, groups, "sk_produto", "inner", hot_products)
    total, orders = f"sum({cents('line_total')})", "count(DISTINCT nk_order_id)"
    return (
        named.join(dim_tempo.select("sk_tempo", "ano", "mes"), "sk_tempo")
        .groupBy("ano", "mes", "categoria")
        .agg(
            F.expr(f"{total} / 100 AS receita"),
            F.expr(f"{orders} AS qtd_pedidos"),
            F.expr(f"round(try_divide({total}, {orders})) / 100 AS ticket_medio"),
        )
        .orderBy("ano", "mes", F.desc("receita"), "categoria")
    )


def product_revenue(fact: DataFrame, dim_produtos: DataFrame) -> DataFrame:
    """Units and revenue per product, without cancelled and returned orders.

    The fact is summed per surrogate key before it meets the dimension, so the join handles
    one row per product however often a product was sold.
    """
    sums = fact.where(SOLD).groupBy("sk_produto").agg(
        F.expr("sum(quantity) AS units"), F.expr(f"sum({cents('line_total')}) AS amount")
    )
    names = dim_produtos.selectExpr("sk_produto", "nk_product_id", "nm_produto", "category AS categoria")
    return sums.join(names, "sk_produto").groupBy("nk_product_id", "nm_produto", "categoria").agg(
        F.expr("sum(units) AS unidades_vendidas"), F.expr("sum(amount) / 100 AS receita_total")
    )


def top_products(fact: DataFrame, dim_produtos: DataFrame, k: int = TOP_K, keep_ties: bool = False) -> DataFrame:
    """Q2: best-selling products with their revenue rank.

    Exactly ``k`` rows (ties at the cut by product id), or with ``keep_ties`` all products
    of rank up to ``k``. Either way tasks pre-select before the single sorted task: a rank
    within the first k rows depends on those rows alone, and a rank filter is pushed below
    the window as a per-task limit.
    """
    revenue = product_revenue(fact, dim_produtos)
    if not keep_ties:
        revenue = revenue.orderBy(F.desc("receita_total"), "nk_product_id").limit(k)
    return (
        revenue.selectExpr("*", "rank() OVER (ORDER BY receita_total DESC) AS ranking_receita")
        .where(f"ranking_receita <= {k}")
        .orderBy("ranking_receita", "nk_product_id")
    )


def ticket_by_channel(
    fact: DataFrame, dim_tempo: DataFrame, as_of: date | None = None, days: int | None = None
) -> DataFrame:
    """Q3: average ticket per channel and payment method over the last 12 months, or ``days``.

    The average runs over item rows. The date filter on the calendar cannot prune fact
    partitions, so the same bound is put on the fact's year and month.
    """
    first = f"date_sub({_today(as_of)}, {days})" if days is not None else f"add_months({_today(as_of)}, -12)"
    recent = fact.where(f"{SOLD} AND year * 12 + month >= year({first}) * 12 + month({first})")
    return (
        recent.join(dim_tempo.where(f"dt_data >= {first}").select("sk_tempo"), "sk_tempo")
        .withColumnsRenamed({"ds_canal": "canal", "method": "metodo_pagamento"})
        .groupBy("canal", "metodo_pagamento")
        .agg(
            F.expr("count(DISTINCT nk_order_id) AS qtd_pedidos"),
            F.expr(f"{money_avg('vl_total_pedido')} AS ticket_medio"),
            F.expr(f"{money_sum('line_total')} AS receita_total"),
        )
        .orderBy(F.desc("ticket_medio"), "canal", "metodo_pagamento")
    )


def churn(
    fact: DataFrame, dim_tempo: DataFrame, dim_clientes: DataFrame, as_of: date | None = None, days: int = CHURN_DAYS
) -> DataFrame:
    """Q4: customers whose last sale lies more than ``days`` back."""
    last = (
        fact.where(SOLD).select("sk_cliente", "sk_tempo")
        .join(dim_tempo.select("sk_tempo", "dt_data"), "sk_tempo")
        .groupBy("sk_cliente").agg(F.max("dt_data").alias("dt_ultimo_pedido"))
    )
    return (
        last.join(dim_clientes.selectExpr("sk_cliente", "state AS estado"), "sk_cliente")
        .selectExpr(
            "sk_cliente",
            "estado",
            "dt_ultimo_pedido",
            f"datediff({_today(as_of)}, dt_ultimo_pedido) AS dias_desde_ultimo_pedido",
            f"if(datediff({_today(as_of)}, dt_ultimo_pedido) > {days}, 'churn', 'ativo') AS status_churn",
        )
        .orderBy(F.desc("dias_desde_ultimo_pedido"), "sk_cliente")
    )


def cohorts(fact: DataFrame, dim_tempo: DataFrame, wrap_months: bool = False) -> DataFrame:
    """Q5: active customers per month by month of first purchase.

    The fact is read once and cut to distinct customer-months; the first month is then a
    window over a customer's months, of which there are at most as many as calendar months.
    """
    months = (
        fact.where(SOLD).select("sk_cliente", "sk_tempo")
        .join(dim_tempo.selectExpr("sk_tempo", f"{month_start('dt_data')} AS mes_pedido"), "sk_tempo")
        .select("sk_cliente", "mes_pedido").distinct()
    )
    return (
        months.selectExpr("*", "min(mes_pedido) OVER (PARTITION BY sk_cliente) AS mes_coorte")
        .groupBy("mes_coorte", "mes_pedido").agg(F.expr("count(sk_cliente) AS clientes_ativos"))
        .selectExpr("*", f"{months_apart('mes_pedido', 'mes_coorte', wrap_months)} AS numero_mes")
        .orderBy("mes_coorte", "mes_pedido")
    )
