"""Adapter: the eight sales and event tables as the six raw e-commerce tables.

Raw feeds have faults, and the cleaners and checks exist for them. The adapter therefore
derives some from the keys, on the whole tables:

==============  ======================================================================
customers       key % 20 = 0 delivered twice; key % 50 = 7 without email;
                key % 97 = 0 with an unreadable birth date
products        key % 11 = 0 without stock; key % 13 = 0 with a negative price;
                key % 17 = 0 costing twice the price; key % 19 = 0 delivered twice, the
                second time with a smaller stock
orders          key % 53 = 0 delivered twice, the second time with a smaller fee; key % 101 = 0 with total 0;
                key % 103 = 0 of an unknown customer; key % 107 = 0 without a date
order_items     (order, line) repeats in the source; part % 23 = 0 with discount 1.5;
                supplier % 29 = 0 with a negative unit price;
                order % 109 = 0 of an unknown product
payments        key % 59 = 0 delivered twice, the second time paid earlier; key % 61 = 0 paid in two payments
reviews         event % 31 = 0 without rating; ratings run from 0 to 6;
                event % 43 = 0 with a comment of two padded lines
==============  ======================================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmart.functions.scalars import add_hours, cents, line_total_cents, percent_cents

UNKNOWN = 1_000_000_000  # added to a key to make it unknown, or to number a second payment

# Schemas of the given tables. Stating them spares a footer read per table.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _twice(df: DataFrame, condition: str) -> DataFrame:
    """Deliver some rows twice; ``copy`` numbers them. One scan, no union."""
    return df.selectExpr("*", f"explode(if({condition}, array(0, 1), array(0))) AS copy")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people, nation, region = (read(spark, sf_dir, name) for name in ("customer", "nation", "region"))
    placed = people.join(nation, people["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )
    return _twice(placed, "c_custkey % 20 = 0").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS name",
        "if(c_custkey % 50 = 7, NULL, lower(replace(c_name, '#', '_')) || '@example.com') AS email",
        "CAST(c_custkey AS STRING) AS phone",
        "n_name AS city",
        "upper(substr(r_name, 1, 2)) AS state",
        "if(c_custkey % 97 = 0, 'unknown', CAST(date_add(DATE '1950-01-01', CAST(c_custkey % 18000 AS INT)) AS STRING))"
        " AS birth_date",
        "CAST(date_add(DATE '1990-01-01', CAST(c_custkey % 1825 AS INT)) AS STRING) AS created_at",
        "copy AS load_seq",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = cents("p_retailprice")
    return _twice(read(spark, sf_dir, "part"), "p_partkey % 19 = 0").selectExpr(
        "p_partkey AS product_id",
        "p_name AS name",
        "p_type AS category",
        "p_brand AS subcategory",
        f"if(p_partkey % 13 = 0, -{price}, {price}) / 100 AS price",
        f"if(p_partkey % 17 = 0, {price} * 2, {percent_cents(price, '30 + p_partkey % 50')}) / 100 AS cost",
        "if(p_partkey % 11 = 0, NULL, p_size + 1 - copy) AS stock_qty",
        "CAST(date_add(DATE '1990-01-01', CAST(p_partkey % 1825 AS INT)) AS STRING) AS created_at",
        "copy AS load_seq",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice(read(spark, sf_dir, "orders"), "o_orderkey % 53 = 0").selectExpr(
        "o_orderkey AS order_id",
        f"o_custkey + if(o_orderkey % 103 = 0, {UNKNOWN}L, 0L) AS customer_id",
        "if(o_orderkey % 107 = 0, 'n/a', CAST(o_orderdate AS STRING)) AS order_date",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered'"
        " WHEN 'O' THEN element_at(array('shipped', 'pending'), CAST(o_orderkey % 2 AS INT) + 1)"
        " ELSE element_at(array('cancelled', 'returned', 'processing'), CAST(o_orderkey % 3 AS INT) + 1)"
        " END AS status",
        "if(o_orderkey % 101 = 0, 0D, o_totalprice) AS total_amount",
        "CAST(6 + o_orderkey % 46 - copy AS DOUBLE) AS shipping_fee",
        "element_at(array('web', 'mobile', 'marketplace'), CAST(o_custkey % 3 AS INT) + 1) AS channel",
        "copy AS load_seq",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = cents("l_extendedprice")
    unit = f"((2 * {amount} + CAST(l_quantity AS BIGINT)) DIV (2 * CAST(l_quantity AS BIGINT)))"
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS item_id",
        "l_orderkey AS order_id",
        f"l_partkey + if(l_orderkey % 109 = 0, {UNKNOWN}L, 0L) AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        f"if(l_suppkey % 29 = 0, -{unit}, {unit}) / 100 AS unit_price",
        "if(l_partkey % 23 = 0, 1.5D, l_discount) AS discount",
        f"{line_total_cents(amount, '1', 'l_discount')} / 100 AS line_total",
        "0 AS load_seq",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid_at = add_hours("o_orderdate", "o_orderkey % 49 + 1 - copy")
    return _twice(read(spark, sf_dir, "orders"), "o_orderkey % 59 = 0 OR o_orderkey % 61 = 0").selectExpr(
        f"o_orderkey + if(copy = 1 AND o_orderkey % 61 = 0, {UNKNOWN}L, 0L) AS payment_id",
        "o_orderkey AS order_id",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'"
        " WHEN '3-MEDIUM' THEN 'pix' WHEN '4-NOT SPECIFIED' THEN 'boleto' ELSE 'wallet' END AS method",
        "element_at(array('approved', 'declined', 'pending', 'refunded'), CAST(o_orderkey % 4 AS INT) + 1) AS status",
        "o_totalprice AS amount",
        f"CAST({paid_at} AS STRING) AS paid_at",
        "copy AS load_seq",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(
        "event_id AS review_id",
        "event_id % 1500 AS order_id",
        "user_id AS customer_id",
        "event_id % 200 AS product_id",
        "if(event_id % 31 = 0, NULL, CAST(floor(value) AS INT) % 7) AS rating",
        "if(event_id % 43 = 0, concat('  ', event_type, '\\n second line '), event_type) AS comment",
        "CAST(CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ) AS STRING) AS created_at",
        "0 AS load_seq",
    )


_BUILDERS = {build.__name__: build for build in (customers, products, orders, order_items, payments, reviews)}


def raw_table(spark: SparkSession, sf_dir: str, table: str, sequence: bool = False) -> DataFrame:
    """One raw table; with ``sequence`` also ``load_seq``, which orders copies by delivery."""
    df = _BUILDERS[table](spark, sf_dir)
    return df if sequence else df.drop("load_seq")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, sf_dir, name) for name in _BUILDERS}


def order_events(events: DataFrame) -> DataFrame:
    """Event rows as JSON order events, one text per row; event % 37 = 0 is cut short,
    event % 41 = 0 lacks its order id, event % 43 = 0 has a quantity that is no number and
    event % 47 = 0 a field that the schema does not know, as happens on a real feed."""
    text = (
        "to_json(named_struct('order_id', if(event_id % 41 = 0, NULL, event_id + 100000000L),"
        " 'customer_id', user_id, 'product_id', event_id % 200, 'quantity', CAST(event_id % 5 + 1 AS INT),"
        " 'unit_price', value,"
        " 'channel', element_at(array('web', 'mobile', 'marketplace'), CAST(event_id % 3 AS INT) + 1),"
        " 'event_time', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")))"
    )
    marked = f"if(event_id % 43 = 0, replace({text}, '\"quantity\":', '\"quantity\":\"few\",\"q\":'), {text})"
    longer = f"if(event_id % 47 = 0, concat(rtrim('}}', {marked}), ',\"coupon\":\"SAVE\"}}'), {marked})"
    return events.selectExpr(f"if(event_id % 37 = 0, substr({text}, 1, 25), {longer}) AS value")
