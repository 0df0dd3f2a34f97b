"""Exploratory views of the raw and Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopmart.functions.scalars import cents, lenient_timestamp, line_total_cents, money_sum
from shopmart.operators.skew import lookup_join
from shopmart.plans.hot import NO_HOT_KEYS, HotKeys


def monthly_orders(orders: DataFrame) -> DataFrame:
    """Orders and revenue per calendar month; orders without a date are left out."""
    month = f"date_format({lenient_timestamp('order_date')}, 'yyyy-MM') AS year_month"
    return (
        orders.selectExpr("*", month).where("year_month IS NOT NULL")
        .groupBy("year_month")
        .agg(F.expr("count(order_id) AS order_count"), F.expr(f"{money_sum('total_amount')} AS revenue"))
        .orderBy("year_month")
    )


def revenue_by_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Delivered revenue per category, smallest first.

    Lines meet the delivered orders first, so others are dropped unsummed; what is left is
    summed per product before it is shuffled again.
    """
    delivered = orders.where("status = 'delivered'").select("order_id")
    lines = items.selectExpr("order_id", "product_id", f"{cents('line_total')} AS amount")
    sold = lookup_join(lines, delivered, "order_id", "inner", hot.item_orders)
    per_product = sold.groupBy("product_id").agg(F.sum("amount").alias("amount"))
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category").agg(F.expr("sum(amount) / 100 AS revenue"))
        .orderBy("revenue", "category")
    )


def fact_preview(fact: DataFrame, n: int = 5) -> DataFrame:
    """First rows of the fact in key order."""
    return fact.orderBy("nk_order_id", "item_id", "payment_status", "method").limit(n)


def order_total_reconciliation(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order total against the sum of its line totals, in currency units."""
    sums = items.groupBy("order_id").agg(F.expr(f"sum({cents('line_total')}) AS items_cents"))
    total = cents("total_amount")
    return orders.select("order_id", "total_amount").join(sums, "order_id", "left").selectExpr(
        "order_id",
        "total_amount",
        "items_cents / 100 AS items_total",
        f"({total} - items_cents) / 100 AS difference",
        f"coalesce({total} = items_cents, false) AS matches",
    )


def line_total_reconciliation(items: DataFrame) -> DataFrame:
    """Line total against unit price, quantity and discount, per quantity: how many lines
    agree to the cent, and the largest difference."""
    due = line_total_cents(cents("unit_price"), "quantity", "discount")
    return (
        items.selectExpr("quantity", f"abs({due} - {cents('line_total')}) AS gap")
        .groupBy("quantity")
        .agg(
            F.expr("count(1) AS lines"),
            F.expr("count_if(gap = 0) AS equal_lines"),
            F.expr("max(gap) / 100 AS largest_gap"),
        )
        .orderBy("quantity")
    )
