"""Silver layer: cleaned, pseudonymised tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from shopmart.functions.keys import pseudonym
from shopmart.functions.scalars import ISO, clip, lenient_money, lenient_number, moment_as
from shopmart.operators import dates as date_votes
from shopmart.operators.dedup import keep_first
from shopmart.operators.profile import aggregate
from shopmart.plans import bronze, marts
from shopmart.plans.bronze import LOAD_SEQUENCE
from shopmart.schemas import CLEANED
from shopmart.session import freed_shuffles
from shopmart.sources import tables

PII = ("customer_id", "name", "email")
# The text columns that hold moments.
DATES = {
    "customers": ("created_at", "birth_date"), "products": ("created_at",), "orders": ("order_date",), "payments": ("paid_at",),
}
Formats = Mapping[str, str]


def _moments(table: str, formats: Formats) -> dict[str, str]:
    return {name: moment_as(name, formats.get(name, ISO)) for name in DATES[table]}


def _conform(df: DataFrame, table: str, changes: dict[str, str]) -> DataFrame:
    """Contract columns in contract order and type, with ``changes`` applied, then the rest."""
    fields = {f.name: f.dataType.simpleString() for f in CLEANED[table].fields}
    known = [f"CAST({changes.get(c, c)} AS {dtype}) AS {c}" for c, dtype in fields.items() if c in df.columns]
    return df.selectExpr(*known, *[c for c in df.columns if c not in fields])


def clean_customers(df: DataFrame, hash_key: str, pii: Sequence[str] = PII, formats: Formats = {}) -> DataFrame:
    """Distinct rows with id and email; personal columns are hashed last, so keys still match."""
    present = df.dropDuplicates().na.drop(subset=["customer_id", "email"])
    return _conform(present, "customers", {
        **_moments("customers", formats),
        **{column: pseudonym(column, hash_key) for column in pii},
    })


def clean_products(df: DataFrame, order_by: Sequence[str] = (), formats: Formats = {}) -> DataFrame:
    """One row per product; positive amounts, cost at most price, missing stock is 0."""
    price, cost = f"abs({lenient_money('price')})", f"abs({lenient_money('cost')})"
    return _conform(keep_first(df, ["product_id"], order_by), "products", {
        "stock_qty": "coalesce(try_cast(stock_qty AS INT), 0)",
        "price": price,
        # A null on either side leaves the cost as it is (``least`` would fill it in).
        "cost": f"if({cost} > {price}, {price}, {cost})",
        **_moments("products", formats),
    })


def clean_orders(df: DataFrame, hash_key: str, order_by: Sequence[str] = (), formats: Formats = {}) -> DataFrame:
    """One row per order with a positive total."""
    total = lenient_money("total_amount")
    return _conform(keep_first(df, ["order_id"], order_by).where(f"{total} > 0"), "orders", {
        "customer_id": pseudonym("customer_id", hash_key),
        **_moments("orders", formats),
        "total_amount": total,
    })


def clean_order_items(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per item; positive amounts, discount within [0, 1]."""
    return _conform(keep_first(df, ["item_id"], order_by), "order_items", {
        "unit_price": f"abs({lenient_money('unit_price')})",
        "discount": clip(lenient_number("discount"), 0, 1),
        "line_total": f"abs({lenient_money('line_total')})",
    })


def clean_payments(df: DataFrame, order_by: Sequence[str] = (), formats: Formats = {}) -> DataFrame:
    """One row per payment; an order may still have several payments."""
    return _conform(keep_first(df, ["payment_id"], order_by), "payments", _moments("payments", formats))


def clean_reviews(df: DataFrame, hash_key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per review; rating within 1..5 or null."""
    return _conform(keep_first(df, ["review_id"], order_by), "reviews", {
        "rating": clip(lenient_number("rating"), 1, 5),
        "customer_id": pseudonym("customer_id", hash_key),
    })


def clean(table: str, df: DataFrame, hash_key: str, formats: Formats = {}) -> DataFrame:
    """Clean one raw table by name. Of several rows with one key the first delivered stays, by
    the load sequence if the table has one; the sequence itself goes. Dates are ISO unless
    ``formats`` names another form of a column (see ``operators.dates``)."""
    order_by = [LOAD_SEQUENCE] if LOAD_SEQUENCE in df.columns else []
    if table == "customers":
        found = clean_customers(df.drop(LOAD_SEQUENCE), hash_key, formats=formats)
    elif table == "products":
        found = clean_products(df, order_by, formats)
    elif table == "orders":
        found = clean_orders(df, hash_key, order_by, formats)
    elif table == "order_items":
        found = clean_order_items(df, order_by)
    elif table == "payments":
        found = clean_payments(df, order_by, formats)
    elif table == "reviews":
        found = clean_reviews(df, hash_key, order_by)
    else:
        raise KeyError(table)
    return found.drop(LOAD_SEQUENCE)


def coercion_losses(
    df: DataFrame, dataset: str, numbers: Sequence[str] = (), dates: Sequence[str] = (), money: Sequence[str] = (),
    formats: Formats = {},
) -> DataFrame:
    """One row per column: values that were present but did not parse, or as money were out of range."""
    parsed = {name: lenient_number(name) for name in numbers} | {name: moment_as(name, formats.get(name, ISO)) for name in dates}
    parsed |= {name: lenient_money(name) for name in money}
    lines = ", ".join(
        f"named_struct('column_name', '{name}', 'lost', count_if({name} IS NOT NULL AND {after} IS NULL))"
        for name, after in parsed.items()
    )
    return aggregate(df, [f"array({lines}) AS lines"]).selectExpr(f"'{dataset}' AS dataset", "inline(lines)")


def read_cleaned(spark: SparkSession, silver_path: str) -> dict[str, DataFrame]:
    return {
        name: tables.read_parquet(spark, f"{silver_path}/cleaned/{name}", schema)
        for name, schema in CLEANED.items()
    }


def run(spark: SparkSession, bronze_path: str, silver_path: str, hash_key: str) -> None:
    """Clean the ingested raw tables, write them, then write the marts built on the result.

    Each date column is read in the format that most of its values are in.
    """
    raw = bronze.read(spark, bronze_path, keep=[LOAD_SEQUENCE])

    def store(name: str) -> None:
        formats = date_votes.voted(raw[name], DATES[name]) if name in DATES else {}
        tables.write_parquet(clean(name, raw[name], hash_key, formats), f"{silver_path}/cleaned/{name}")

    with freed_shuffles(spark):
        tables.each(spark, raw, store)
        marts.write_all(read_cleaned(spark, silver_path), f"{silver_path}/spark")
