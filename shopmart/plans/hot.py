"""Which keys of the stored tables are hot enough to be salted."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from shopmart.operators.skew import HOT_SHARE, find_hot_keys


@dataclass(frozen=True)
class HotKeys:
    """Keys with at least a hundredth of a table's rows; empty lists mean plain joins."""

    order_customers: tuple[Any, ...] = ()
    item_orders: tuple[Any, ...] = ()
    item_products: tuple[Any, ...] = ()
    payment_orders: tuple[Any, ...] = ()

    @staticmethod
    def detect(
        orders: DataFrame,
        items: DataFrame,
        payments: DataFrame,
        customer_key: str = "customer_id",
        share: float = HOT_SHARE,
    ) -> HotKeys:
        """Measure stored tables (not plans: this runs jobs that read the key columns)."""

        def find(df: DataFrame, key: str) -> tuple[Any, ...]:
            return tuple(find_hot_keys(df, key, share))

        return HotKeys(
            order_customers=find(orders, customer_key),
            item_orders=find(items, "order_id"),
            item_products=find(items, "product_id"),
            payment_orders=find(payments, "order_id"),
        )


NO_HOT_KEYS = HotKeys()
