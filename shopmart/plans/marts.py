"""Marts on the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.functions.scalars import cents
from shopmart.operators.scan import SEGMENT_ROWS, running, segment_count
from shopmart.operators.skew import HOT_SHARE, detail_join, lookup_join
from shopmart.plans.hot import NO_HOT_KEYS, HotKeys
from shopmart.session import scratch_scope
from shopmart.sources import tables

# Partition columns of each mart on disk.
PARTITIONS = {
    "orders_enriched": ("year", "month"),
    "items_enriched": (),
    "monthly_revenue": ("year", "month"),
    "customer_spend": (),
    "product_ratings": (),
}


def orders_enriched(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, hot: HotKeys = NO_HOT_KEYS
) -> DataFrame:
    """Orders with payment method and status, the customer's place, year and month.

    Payments join first: deduplicated orders are already spread by order id.
    """
    places = customers.select("customer_id", "city", "state")
    paid = payments.selectExpr("order_id", "method", "status AS payment_status")
    joined = detail_join(orders, paid, "order_id", hot=hot.payment_orders)
    return lookup_join(joined, places, "customer_id", hot=hot.order_customers).selectExpr(
        *orders.columns, "city", "state", "method", "payment_status",
        "year(order_date) AS year", "month(order_date) AS month",
    )


def items_enriched(items: DataFrame, products: DataFrame, hot: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """Items with the product's category and subcategory."""
    groups = products.select("product_id", "category", "subcategory")
    joined = lookup_join(items, groups, "product_id", hot=hot.item_products)
    return joined.select(*items.columns, "category", "subcategory")


def monthly_revenue(enriched_orders: DataFrame, enriched_items: DataFrame, hot: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """Delivered revenue, orders and customers per year, month and category.

    Lines are first summed per order and category, in place: the join has spread them by
    order id already. Counting orders is then counting rows, which leaves one distinct count
    (customers) instead of two and spares the threefold row expansion. An order must have
    one customer and one date, as after ``clean_orders``.
    """
    delivered = enriched_orders.where("status = 'delivered'").select("order_id", "customer_id", "year", "month")
    sold = enriched_items.select("order_id", "category", "line_total")
    lines = detail_join(delivered, sold, "order_id", hot=hot.item_orders)
    per_order = lines.groupBy("order_id", "customer_id", "year", "month", "category").agg(
        F.expr(f"sum({cents('line_total')}) AS amount")
    )
    return (
        per_order.groupBy("year", "month", "category")
        .agg(
            F.expr("sum(amount) / 100 AS revenue"),
            F.expr("count(order_id) AS order_count"),
            F.expr("count(DISTINCT customer_id) AS unique_customers"),
        )
        .orderBy("year", "month", F.desc("revenue"), "category")
    )


def customer_spend(orders: DataFrame, segments: int = 1) -> DataFrame:
    """Running total, rank and previous amount of each customer's orders, by date and id.

    With several ``segments`` no customer's orders have to fit into one task (see ``operators.scan``).
    """
    slim = orders.select("customer_id", "order_id", "order_date", "total_amount")
    return running(slim, "customer_id", ["order_date", "order_id"], "total_amount", segments).selectExpr(
        *slim.columns, "_run / 100 AS running_total", "_rank AS order_rank", "_prev AS prev_order_amount"
    )


def product_ratings(reviews: DataFrame) -> DataFrame:
    """Average rating and number of reviews per product."""
    return reviews.groupBy("product_id").agg(
        F.expr("avg(rating) AS avg_rating"), F.expr("count(review_id) AS review_count")
    )


def build_all(cleaned: dict[str, DataFrame], hot: HotKeys = NO_HOT_KEYS, segments: int = 1) -> dict[str, DataFrame]:
    orders = orders_enriched(cleaned["orders"], cleaned["customers"], cleaned["payments"], hot)
    items = items_enriched(cleaned["order_items"], cleaned["products"], hot)
    return {
        "orders_enriched": orders,
        "items_enriched": items,
        "monthly_revenue": monthly_revenue(orders, items, hot),
        "customer_spend": customer_spend(cleaned["orders"], segments),
        "product_ratings": product_ratings(cleaned["reviews"]),
    }


def spend_segments(rows: int, hot: HotKeys) -> int:
    """Segments for ``customer_spend``: one while no customer's orders, as measured, outgrow a segment.

    A plain window shuffles the orders once; segments shuffle them twice and store a copy.
    """
    return 1 if not hot.order_customers and rows * HOT_SHARE <= SEGMENT_ROWS else segment_count(rows)


def write_all(cleaned: dict[str, DataFrame], path: str) -> None:
    """Write the marts; revenue is computed from the two enriched tables as written."""
    spark = cleaned["orders"].sparkSession
    with scratch_scope(spark):
        _write_all(spark, cleaned, path)


def _write_all(spark: SparkSession, cleaned: dict[str, DataFrame], path: str) -> None:
    hot = HotKeys.detect(cleaned["orders"], cleaned["order_items"], cleaned["payments"])
    # Row counts of stored tables come from file footers.
    marts = build_all(cleaned, hot, spend_segments(cleaned["orders"].count(), hot))

    def store(name: str) -> None:
        tables.write_parquet(marts[name], f"{path}/{name}", PARTITIONS[name])

    tables.each(spark, ("orders_enriched", "items_enriched", "customer_spend", "product_ratings"), store)
    enriched = [spark.read.parquet(f"{path}/{name}") for name in ("orders_enriched", "items_enriched")]
    marts["monthly_revenue"] = monthly_revenue(*enriched, hot=hot)
    store("monthly_revenue")
