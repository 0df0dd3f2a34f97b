"""Gold kept up to date: only the months that a change of Silver touches are written again.

For each order Gold keeps a digest of everything its fact rows are made of: the order, its items and
its payments. A run makes the digests of the new Silver, compares them by order with the kept ones,
and so knows the orders that came, went or changed. Their months, the old and the new alike,
are touched; so are the months of orders whose customer, product or day entered or left a dimension
or got another surrogate key. The fact of the touched months is built from the orders of those months
alone and replaces them; a month that has no rows any more is removed. Files of other months stay.

The digests are written last and by month too. A run that ends early is simply repeated: it
finds the same differences and writes the same months.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.functions.keys import crc32_key
from shopmart.functions.scalars import column_name
from shopmart.operators import keymap
from shopmart.plans import gold, silver
from shopmart.plans.hot import HotKeys
from shopmart.session import scratch_dir, scratch_scope
from shopmart.sources import tables

DIGESTS = "order_digests"
_PERIOD = ("year", "month")
_DIGEST_SCHEMA = "order_id BIGINT, hashes BIGINT, low_sum BIGINT, row_count BIGINT, year INT, month INT"


def order_digests(cleaned: dict[str, DataFrame]) -> DataFrame:
    """order_id, digest and month of every order: exclusive-or, sum and count of its rows' hashes."""

    def hashed(name: str, month: str) -> DataFrame:
        df = cleaned[name]
        columns = ", ".join(column_name(c) for c in df.columns)
        return df.selectExpr("order_id", f"xxhash64('{name}', {columns}) AS h", *month.split("|"))

    dated = "year(order_date) AS year|month(order_date) AS month|true AS is_order"
    plain = "CAST(NULL AS INT) AS year|CAST(NULL AS INT) AS month|false AS is_order"
    rows = [hashed("orders", dated), hashed("order_items", plain), hashed("payments", plain)]
    return (
        reduce(DataFrame.unionByName, rows).groupBy("order_id")
        .agg(*map(F.expr, [
            "bit_xor(h) AS hashes", "sum(h & 4294967295) AS low_sum", "count(1) AS row_count",
            "max(year) AS year", "max(month) AS month", "bool_or(is_order) AS is_order",
        ]))
        .where("is_order").drop("is_order")
    )


def changed_members(old: DataFrame, new: DataFrame, table: str) -> DataFrame:
    """Natural keys that one of two versions of a dimension lacks, or whose surrogate key differs."""
    natural, surrogate = gold.KEYS[table]
    before, after = (df.selectExpr(f"{natural} AS member", f"{surrogate} AS {name}").distinct() for df, name in ((old, "a"), (new, "b")))
    return before.join(after, "member", "full").where("NOT (a <=> b)").select("member").distinct()


def differing_months(kept: DataFrame, digests: DataFrame) -> DataFrame:
    """(year, month) of orders that came, went, moved or changed, before and after."""
    a, b = kept.alias("a"), digests.alias("b")
    same = " AND ".join(f"a.{c} <=> b.{c}" for c in ("hashes", "low_sum", "row_count"))
    differ = a.join(b, F.expr("a.order_id = b.order_id"), "full").where(f"NOT ({same})")
    periods = [differ.where(f"{side}.order_id IS NOT NULL").selectExpr(f"{side}.year", f"{side}.month") for side in "ab"]
    return reduce(DataFrame.union, periods).distinct()


def member_months(digests: DataFrame, cleaned: dict[str, DataFrame], members: dict[str, DataFrame]) -> DataFrame:
    """(year, month) of those of the orders in ``digests`` whose members changed."""
    periods = []
    orders, items = cleaned["orders"], cleaned["order_items"]
    by_member = [
        (orders, "customer_id", "dim_clientes"), (orders.withColumn("day", F.to_date("order_date")), "day", "dim_tempo"),
        (items, "product_id", "dim_produtos"),
    ]
    for rows, column, table in by_member:
        hit = rows.join(members[table].withColumnRenamed("member", column), column, "left_semi").select("order_id").distinct()
        periods.append(digests.join(hit, "order_id", "left_semi").select(*_PERIOD))
    return reduce(DataFrame.union, periods).distinct()


def _of_months(rows: DataFrame, months: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of the months, the missing month included; or of all others ("left_anti")."""
    wanted = months.selectExpr("year AS y", "month AS m")
    return rows.join(wanted, F.expr("year <=> y AND month <=> m"), how)


def _remove_partitions(spark: SparkSession, path: str, months: list) -> None:
    """Delete the folders of months without rows."""
    default = "__HIVE_DEFAULT_PARTITION__"
    for year, month in months:
        tables.remove(spark, f"{path}/year={default if year is None else year}/month={default if month is None else month}")


def replace_months(df: DataFrame, path: str, months: DataFrame) -> None:
    """Write the months' rows in place of those at ``path``; months is a stored table.

    The months of a plan of left joins follow from its left side alone, so Catalyst drops the joins there.
    """
    tables.write_parquet(df, path, _PERIOD, only_touched_partitions=True)
    written = df.select(*_PERIOD).distinct().selectExpr("year AS y", "month AS m")
    # A few hundred months, which are folders to remove, and not rows.
    empty = months.join(written, F.expr("year <=> y AND month <=> m"), "left_anti").select(*_PERIOD).collect()
    _remove_partitions(df.sparkSession, path, [tuple(row) for row in empty])


def mapped_dimensions(cleaned: dict[str, DataFrame], maps_path: str) -> dict[str, DataFrame]:
    """The dimensions with dense keys that stay, from maps kept below ``maps_path``."""
    days = gold.calendar_of(cleaned["orders"]).select("dt_data")
    sources = {
        "dim_clientes": (cleaned["customers"], "customer_id"), "dim_produtos": (cleaned["products"], "product_id"),
        "dim_tempo": (days, "dt_data"),
    }
    maps = {table: keymap.extend(df, natural, f"{maps_path}/{table}") for table, (df, natural) in sources.items()}
    mapped = "_mapped_key"
    keyed = {table: keymap.with_key(df, natural, maps[table], mapped) for table, (df, natural) in sources.items()}
    return {
        "dim_clientes": gold.build_dim_clientes(keyed["dim_clientes"], lambda _: mapped),
        "dim_produtos": gold.build_dim_produtos(keyed["dim_produtos"], lambda _: mapped),
        "dim_tempo": gold.calendar_with(keyed["dim_tempo"], lambda _: mapped),
    }


def run(spark: SparkSession, silver_path: str, gold_path: str, maps_path: str | None = None) -> DataFrame:
    """Bring Gold in line with Silver and return the months that were written or removed.

    The first run builds everything. With ``maps_path`` surrogate keys are the dense numbers of a
    kept map, otherwise CRC-32 as in ``gold.run``.
    """
    # The months are given back as a frame, so they outlive the scope of all else.
    months_path = scratch_dir(spark, "months")
    with scratch_scope(spark):
        return _run(spark, silver_path, gold_path, maps_path, months_path)


def _run(spark: SparkSession, silver_path: str, gold_path: str, maps_path: str | None, months_path: str) -> DataFrame:
    cleaned = silver.read_cleaned(spark, silver_path)
    fresh = mapped_dimensions(cleaned, maps_path) if maps_path else gold.build_dimensions(cleaned, crc32_key)
    work = scratch_dir(spark, "incremental")

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = name if name == months_path else f"{work}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    dimensions = {name: stored(df, name) for name, df in fresh.items()}
    digests = stored(order_digests(cleaned), "digests")
    if not tables.exists(spark, f"{gold_path}/{DIGESTS}"):
        months = stored(digests.select(*_PERIOD).distinct(), months_path)
    else:
        kept = spark.read.schema(_DIGEST_SCHEMA).parquet(f"{gold_path}/{DIGESTS}")
        differ = stored(differing_months(kept, digests), "differ")
        # Members need a look only for orders of months that no differing order touches.
        quiet = _of_months(digests, differ, "left_anti")
        found = differ
        if not quiet.isEmpty():
            before = {name: tables.read_parquet(spark, f"{gold_path}/{name}") for name in dimensions}
            members = {name: stored(changed_members(before[name], dimensions[name], name), f"members-{name}") for name in dimensions}
            found = differ.union(member_months(quiet, cleaned, members)).distinct()
        months = stored(found, months_path)

    orders = _of_months(cleaned["orders"].selectExpr("*", "year(order_date) AS year", "month(order_date) AS month"), months)
    orders, parts = orders.drop(*_PERIOD), {name: cleaned[name] for name in ("order_items", "payments")}
    # The fact's joins on the order drop rows of other orders. Sorting these out before costs a shuffle and a
    # copy of the rest, which pays only where most orders are left alone.
    if 2 * _of_months(digests, months).count() < digests.count():
        orders = stored(orders, "orders")
        ids = orders.select("order_id")
        parts = {name: stored(df.join(ids, "order_id", "left_semi"), name) for name, df in parts.items()}
        hot = HotKeys.detect(orders, parts["order_items"], parts["payments"])
    else:
        hot = HotKeys.detect(cleaned["orders"], parts["order_items"], parts["payments"])
    fact = gold.build_fato_pedidos(orders, parts["order_items"], parts["payments"], **dimensions, hot=hot)
    if hot.item_orders or hot.payment_orders:
        # Salted joins multiply the left side: its months are read from the fact as stored.
        fact = stored(fact, "fact")
    replace_months(fact, f"{gold_path}/fato_pedidos", months)
    for name, df in dimensions.items():
        tables.write_parquet(df, f"{gold_path}/{name}")
    replace_months(_of_months(digests, months), f"{gold_path}/{DIGESTS}", months)
    return months

