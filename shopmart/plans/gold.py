"""Gold layer: star schema with deterministic surrogate keys and unknown member 0."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.functions.keys import crc32_key
from shopmart.functions.scalars import half_even
from shopmart.operators.presence import KeyPresence, Reference
from shopmart.operators.profile import aggregate
from shopmart.operators.skew import detail_join, lookup_join
from shopmart.plans import silver
from shopmart.plans.hot import NO_HOT_KEYS, HotKeys
from shopmart.schemas import FACT_COLUMNS
from shopmart.session import freed_shuffles
from shopmart.sources import tables

UNKNOWN_MEMBER = 0
KeyFunction = Callable[[str], str]

# Natural and surrogate key of each dimension.
KEYS = {
    "dim_clientes": ("nk_customer_id", "sk_cliente"),
    "dim_produtos": ("nk_product_id", "sk_produto"),
    "dim_tempo": ("dt_data", "sk_tempo"),
}


def build_dim_clientes(customers: DataFrame, key: KeyFunction = crc32_key) -> DataFrame:
    return customers.selectExpr(
        f"{key('customer_id')} AS sk_cliente",
        "customer_id AS nk_customer_id",
        "city",
        "state",
        "created_at AS dt_criacao",
    )


def build_dim_produtos(products: DataFrame, key: KeyFunction = crc32_key) -> DataFrame:
    """Products with margin in percent; a null or zero price gives 0."""
    margin = half_even("coalesce(try_divide(price - cost, nullif(price, 0D)) * 100, 0D)", 2)
    return products.selectExpr(
        f"{key('product_id')} AS sk_produto",
        "product_id AS nk_product_id",
        "name AS nm_produto",
        "category",
        "subcategory",
        "price",
        "cost",
        f"{margin} AS margem_pct",
    )


def calendar_with(days: DataFrame, key: KeyFunction) -> DataFrame:
    """The calendar's columns for days (dt_data)."""
    iso_date = "date_format(dt_data, 'yyyy-MM-dd')"
    return days.selectExpr(
        f"{key(iso_date)} AS sk_tempo",
        "dt_data",
        "year(dt_data) AS ano",
        "month(dt_data) AS mes",
        "day(dt_data) AS dia",
        "quarter(dt_data) AS trimestre",
        "weekofyear(dt_data) AS semana_ano",
        "weekday(dt_data) AS dia_semana",
        "date_format(dt_data, 'EEEE') AS nm_dia_semana",
        "date_format(dt_data, 'MMMM') AS nm_mes",
        "weekday(dt_data) >= 5 AS fl_fimdesemana",
    )


def build_dim_tempo(spark: SparkSession, start: date, end: date, key: KeyFunction = crc32_key) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    if start > end:
        raise ValueError(f"start ({start}) must not be after end ({end})")
    days = (end - start).days + 1
    return calendar_with(spark.range(days).selectExpr(f"date_add(DATE '{start}', CAST(id AS INT)) AS dt_data"), key)


def calendar_of(orders: DataFrame, key: KeyFunction = crc32_key) -> DataFrame:
    """The date dimension from the first to the last order date, without a driver round trip.

    The span is cut into years before it is cut into days, so a mistyped year makes many short
    rows, which shuffle to as many tasks, and never one long array.
    """
    span = aggregate(orders, ["to_date(min(order_date)) AS first", "to_date(max(order_date)) AS last"])
    years = span.where("first IS NOT NULL").selectExpr("first", "last", "explode(sequence(year(first), year(last))) AS y")
    days = years.repartition("y").selectExpr(
        "explode(sequence(greatest(first, make_date(y, 1, 1)), least(last, make_date(y, 12, 31)))) AS dt_data"
    )
    return calendar_with(days, key)


def dates_outside(orders: DataFrame, start: date, end: date) -> DataFrame:
    """Orders per date that lies outside the stated span, as mistyped dates do."""
    day = orders.selectExpr("to_date(order_date) AS dt_data")
    return day.where(f"dt_data < DATE '{start}' OR dt_data > DATE '{end}'").groupBy("dt_data").count()


def _lookup(dimension: DataFrame, table: str, alias: str) -> DataFrame:
    """Natural to surrogate key, one row per natural key even where the dimension repeats one."""
    natural, surrogate = KEYS[table]
    pairs = dimension.selectExpr(f"{natural} AS {alias}", surrogate)
    return pairs.groupBy(alias).agg(F.max(surrogate).alias(surrogate))


def _or_unknown(surrogate: str) -> str:
    return f"coalesce({surrogate}, {UNKNOWN_MEMBER}L) AS {surrogate}"


def enforce_columns(df: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{name} lacks the columns {missing}")
    return df.select(*columns)


def build_fato_pedidos(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    dim_clientes: DataFrame,
    dim_produtos: DataFrame,
    dim_tempo: DataFrame,
    hot: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Order fact, one row per order item (and payment, where an order has several).

    Keys missing from a dimension get surrogate 0; an order without items keeps one row with
    null item columns. Year and month are taken from the order before rows multiply. Narrow
    orders and items visit the dimensions, and only then meet on the order id.
    """
    by_customer = _lookup(dim_clientes, "dim_clientes", "customer_id")
    by_day = _lookup(dim_tempo, "dim_tempo", "dt_data")
    by_product = _lookup(dim_produtos, "dim_produtos", "product_id")

    dated = orders.selectExpr("*", "to_date(order_date) AS dt_data")
    keyed = lookup_join(dated, by_customer, "customer_id", hot=hot.order_customers).join(by_day, "dt_data", "left")
    heads = keyed.selectExpr(
        "order_id AS nk_order_id",
        _or_unknown("sk_cliente"),
        _or_unknown("sk_tempo"),
        "status AS ds_status",
        "channel AS ds_canal",
        "total_amount AS vl_total_pedido",
        "shipping_fee AS vl_frete",
        "year(order_date) AS year",
        "month(order_date) AS month",
    )
    paid = payments.selectExpr("order_id AS nk_order_id", "method", "status AS payment_status")
    lines = lookup_join(items, by_product, "product_id", hot=hot.item_products).selectExpr(
        "order_id AS nk_order_id",
        "item_id",
        _or_unknown("sk_produto"),
        "quantity",
        "unit_price",
        "discount",
        "line_total",
    )
    fact = detail_join(
        detail_join(heads, paid, "nk_order_id", hot=hot.payment_orders), lines, "nk_order_id", hot=hot.item_orders
    )
    return enforce_columns(fact, FACT_COLUMNS, "fato_pedidos")


def orphan_counts(fact: DataFrame) -> DataFrame:
    """One row per surrogate key: fact rows and orders that point at the unknown member."""
    keys = [surrogate for _, surrogate in KEYS.values()]
    per_order = fact.groupBy("nk_order_id").agg(
        *[F.expr(f"count_if({k} = {UNKNOWN_MEMBER}) AS {k}") for k in keys]
    )
    lines = ", ".join(
        f"named_struct('surrogate_key', '{k}', 'orphan_rows', coalesce(sum({k}), 0L),"
        f" 'orphan_orders', count_if({k} > 0))"
        for k in keys
    )
    return aggregate(per_order, [f"array({lines}) AS lines"]).selectExpr("inline(lines)")


def key_collisions(dimension: DataFrame, table: str) -> DataFrame:
    """Surrogate keys that stand for several natural keys.

    CRC-32 has 32 bits: about n^2 / 2^33 pairs of n keys collide. Beyond some ten thousand
    members build the star with ``key=wide_key``.
    """
    natural, surrogate = KEYS[table]
    members = dimension.select(natural, surrogate).distinct().groupBy(surrogate).count()
    return members.withColumnRenamed("count", "members").where("members > 1")


def key_violations(star: dict[str, DataFrame]) -> DataFrame:
    """What the warehouse declares across rows: unique natural and surrogate keys of the
    dimensions, and fact keys that exist there (the unknown member always does).

    All rules follow from one presence aggregate, in which a key that fills much of the fact is one
    row from each task.
    """
    unique = [(table, key) for table, pair in KEYS.items() for key in pair]
    references = [Reference("fato_pedidos", key, table, key) for table, (_, key) in KEYS.items()]
    presence = KeyPresence(star, references, unique)
    rules = []
    for (domain, slot), (table, key) in zip(presence.unique, unique, strict=True):
        extra = f"if({presence.key(domain)} IS NULL, 0L, greatest(n{slot} - 1, 0L))"
        rules.append((table, f"{key} unique", domain, extra, f"n{slot}"))
    for (domain, child, parent), r in zip(presence.references, references, strict=True):
        key = presence.key(domain)
        missing = f"{key} IS NOT NULL AND {key} <> {UNKNOWN_MEMBER} AND n{parent} = 0"
        rules.append((r.child, f"{r.fk} references {r.parent}", domain, f"if({missing}, n{child}, 0L)", f"n{child}"))
    lines = ", ".join(
        f"named_struct('dataset', '{dataset}', 'rule', '{rule}',"
        f" 'violations', coalesce(sum(if(domain = {domain}, {broken}, 0L)), 0L),"
        f" 'rows_checked', coalesce(sum(if(domain = {domain}, {rows}, 0L)), 0L))"
        for dataset, rule, domain, broken, rows in rules
    )
    return aggregate(presence.frame, [f"array({lines}) AS lines"]).selectExpr("inline(lines)")


def collision_summary(dimension: DataFrame, table: str) -> DataFrame:
    """One row: surrogate keys of a dimension and how many natural keys had to share one."""
    natural, surrogate = KEYS[table]
    members = dimension.select(natural, surrogate).distinct().groupBy(surrogate).count()
    return aggregate(
        members, [f"'{table}' AS dimension", "count(1) AS keys", "coalesce(sum(count - 1), 0L) AS collisions"]
    )


def report_collisions(dimension: DataFrame, table: str, fail: bool = False) -> int:
    """Warn, or raise, when surrogate keys of a dimension collide."""
    extra = collision_summary(dimension, table).first()["collisions"]
    if extra:
        message = f"{extra} surrogate key collisions in {table}: use a wider key function"
        if fail:
            raise ValueError(message)
        warnings.warn(message, stacklevel=2)
    return extra


def build_dimensions(cleaned: dict[str, DataFrame], key: KeyFunction = crc32_key) -> dict[str, DataFrame]:
    return {
        "dim_clientes": build_dim_clientes(cleaned["customers"], key),
        "dim_produtos": build_dim_produtos(cleaned["products"], key),
        "dim_tempo": calendar_of(cleaned["orders"], key),
    }


def build_star(
    cleaned: dict[str, DataFrame], key: KeyFunction = crc32_key, hot: HotKeys = NO_HOT_KEYS
) -> dict[str, DataFrame]:
    dimensions = build_dimensions(cleaned, key)
    fact = build_fato_pedidos(cleaned["orders"], cleaned["order_items"], cleaned["payments"], **dimensions, hot=hot)
    return {**dimensions, "fato_pedidos": fact}


def run(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    key: KeyFunction = crc32_key,
    fail_on_collision: bool = True,
) -> None:
    """Build the star from the written Silver tables and write it.

    Dimensions are written first; the fact then looks keys up in the tables as written, whose
    sizes are known to the planner. Surrogate keys that collide would multiply rows, so the job
    fails on them unless ``fail_on_collision`` is off.
    """
    cleaned = silver.read_cleaned(spark, silver_path)
    dimensions = build_dimensions(cleaned, key)

    def store(name: str) -> None:
        tables.write_parquet(dimensions[name], f"{gold_path}/{name}")
        dimensions[name] = tables.read_parquet(spark, f"{gold_path}/{name}")
        report_collisions(dimensions[name], name, fail_on_collision)

    with freed_shuffles(spark):
        tables.each(spark, list(dimensions), store)
        hot = HotKeys.detect(cleaned["orders"], cleaned["order_items"], cleaned["payments"])
        fact = build_fato_pedidos(cleaned["orders"], cleaned["order_items"], cleaned["payments"], **dimensions, hot=hot)
        tables.write_parquet(fact, f"{gold_path}/fato_pedidos", ("year", "month"))


def read_star(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    names = (*KEYS, "fato_pedidos")
    return {name: tables.read_parquet(spark, f"{gold_path}/{name}") for name in names}
