"""Table schemas, enumerations and column contracts.

Fixed values: column names, enumeration members and required-column lists are part of the
data contract and must stay as they are.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType, TimestampType

CHANNELS = ("web", "mobile", "marketplace")
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled", "returned")
PAYMENT_METHODS = ("credit_card", "debit_card", "pix", "boleto", "wallet")
PAYMENT_STATUSES = ("approved", "declined", "pending", "refunded")


_TYPES = {
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "STRING": StringType(),
    "TIMESTAMP": TimestampType(),
}


def _schema(columns: str) -> StructType:
    """Schema from "name TYPE, ..." text; unlike ``fromDDL`` it needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        name, dtype = column.split()
        schema.add(name, _TYPES[dtype])
    return schema


# Bronze: as delivered. Dates are text until Silver parses them.
RAW = {
    "customers": _schema(
        "customer_id BIGINT, name STRING, email STRING, phone STRING, city STRING, state STRING,"
        " birth_date STRING, created_at STRING"
    ),
    "products": _schema(
        "product_id BIGINT, name STRING, category STRING, subcategory STRING, price DOUBLE,"
        " cost DOUBLE, stock_qty INT, created_at STRING"
    ),
    "orders": _schema(
        "order_id BIGINT, customer_id BIGINT, order_date STRING, status STRING,"
        " total_amount DOUBLE, shipping_fee DOUBLE, channel STRING"
    ),
    "order_items": _schema(
        "item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, unit_price DOUBLE,"
        " discount DOUBLE, line_total DOUBLE"
    ),
    "payments": _schema(
        "payment_id BIGINT, order_id BIGINT, method STRING, status STRING, amount DOUBLE, paid_at STRING"
    ),
    "reviews": _schema(
        "review_id BIGINT, order_id BIGINT, customer_id BIGINT, product_id BIGINT, rating INT,"
        " comment STRING, created_at STRING"
    ),
}

# Silver: parsed and pseudonymised.
CLEANED = {
    "customers": _schema(
        "customer_id STRING, name STRING, email STRING, phone STRING, city STRING, state STRING,"
        " birth_date TIMESTAMP, created_at TIMESTAMP"
    ),
    "products": _schema(
        "product_id BIGINT, name STRING, category STRING, subcategory STRING, price DOUBLE,"
        " cost DOUBLE, stock_qty INT, created_at TIMESTAMP"
    ),
    "orders": _schema(
        "order_id BIGINT, customer_id STRING, order_date TIMESTAMP, status STRING,"
        " total_amount DOUBLE, shipping_fee DOUBLE, channel STRING"
    ),
    "order_items": RAW["order_items"],
    "payments": _schema(
        "payment_id BIGINT, order_id BIGINT, method STRING, status STRING, amount DOUBLE, paid_at TIMESTAMP"
    ),
    "reviews": _schema(
        "review_id BIGINT, order_id BIGINT, customer_id STRING, product_id BIGINT, rating INT,"
        " comment STRING, created_at STRING"
    ),
}

ORDER_EVENT = _schema(
    "order_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT, unit_price DOUBLE,"
    " channel STRING, event_time STRING"
)

# Columns the quality suite insists on.
REQUIRED_COLUMNS = {
    "customers": (
        "customer_id", "name", "email", "phone", "city", "state", "birth_date", "created_at",
    ),
    "products": ("product_id", "name", "category", "price", "cost"),
    "orders": ("order_id", "customer_id", "order_date", "status", "total_amount"),
    "order_items": (
        "item_id", "order_id", "product_id", "quantity", "unit_price", "discount", "line_total",
    ),
    "payments": ("payment_id", "order_id", "method", "status", "amount"),
    "reviews": ("review_id", "order_id", "customer_id", "product_id", "rating"),
}

# Date column that gives a Bronze table its year and month partitions; items carry none.
PARTITION_DATES = {
    "customers": "created_at",
    "products": "created_at",
    "orders": "order_date",
    "order_items": None,
    "payments": "paid_at",
    "reviews": "created_at",
}

FACT_COLUMNS = (
    "nk_order_id", "item_id", "sk_cliente", "sk_produto", "sk_tempo",
    "ds_status", "ds_canal", "payment_status", "method",
    "quantity", "unit_price", "discount", "line_total",
    "vl_total_pedido", "vl_frete", "year", "month",
)
