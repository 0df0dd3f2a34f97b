"""Entry points: the flagship query, every registered query, and their reference SQL.

``queries()[name](spark, sf_dir)`` runs the whole path from the given tables: raw adapter,
cleaners, star schema, question. ``oracle_sql()[name]`` is the same in DuckDB SQL.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

import oracle
from shopmart.functions.keys import pseudonym, wide_key
from shopmart.operators import checks, contracts, dates, keymap, profile, sampling, states
from shopmart.operators.skew import HOT_SHARE
from shopmart.plans import analytics, bronze, explore, gold, incremental, marts, quality, silver
from shopmart.plans.hot import HotKeys
from shopmart.schemas import FACT_COLUMNS
from shopmart.session import scratch_dir
from shopmart.sources import ddl, retail, tables
from shopmart.streaming import orders as feed

try:
    import corpus_pipeline  # noqa: F401
    import shopmart.llm.queries as text_queries
except ModuleNotFoundError as missing:
    # The text operators are an optional part; anything else missing is a fault.
    if missing.name not in ("corpus_pipeline", "shopmart.llm", "shopmart.llm.queries"):
        raise
    text_queries = None

# For these queries over public test tables only; a real job gets its key from a secret store.
HASH_KEY = "example-only-key-do-not-use-in-production-0001"
AS_OF = date(2001, 8, 1)  # last order date of the given tables
RUN_AT = datetime(2024, 2, 1)
LOW_SHARE = 0.0008  # of a table's rows: so that salted plans meet the reference SQL on small tables

Query = Callable[[SparkSession, str], DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@lru_cache(maxsize=None)
def _hot(spark: SparkSession, sf_dir: str, share: float = HOT_SHARE) -> HotKeys:
    """Hot keys measured on the stored tables, once per session and folder."""
    orders, lines = (retail.read(spark, sf_dir, name) for name in ("orders", "lineitem"))
    return HotKeys.detect(
        orders.selectExpr("o_custkey AS customer_id"),
        lines.selectExpr("l_orderkey AS order_id", "l_partkey AS product_id"),
        orders.selectExpr("o_orderkey AS order_id"),
        customer_key=pseudonym("customer_id", HASH_KEY),
        share=share,
    )


def _clean(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {
        name: silver.clean(name, retail.raw_table(spark, sf_dir, name, sequence=True), HASH_KEY) for name in names
    }


def _salted(spark: SparkSession, sf_dir: str) -> HotKeys:
    """Keys taken as hot at a share so low that the test tables have some, and a few orders
    besides: no order of theirs holds that share, and the list never changes a result."""
    return replace(_hot(spark, sf_dir, LOW_SHARE), item_orders=(1, 2, 3, 4), payment_orders=(1, 59, 61, 122))


def _star(spark: SparkSession, sf_dir: str, hot: HotKeys | None = None, **options) -> dict[str, DataFrame]:
    cleaned = _clean(spark, sf_dir, "customers", "products", "orders", "order_items", "payments")
    return gold.build_star(cleaned, hot=hot or _hot(spark, sf_dir), **options)


def _cleaned(name: str) -> Query:
    return lambda spark, sf_dir: _clean(spark, sf_dir, name)[name]


def dim_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_dim_clientes(_clean(spark, sf_dir, "customers")["customers"])


def dim_produtos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_dim_produtos(_clean(spark, sf_dir, "products")["products"])


def dim_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.calendar_of(_clean(spark, sf_dir, "orders")["orders"])


def fato_pedidos(spark: SparkSession, sf_dir: str, hot: HotKeys | None = None) -> DataFrame:
    return _star(spark, sf_dir, hot)["fato_pedidos"]


def fato_pedidos_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over wide surrogate keys: the keys' values are Spark's own, who is unknown is not."""
    fact = _star(spark, sf_dir, key=wide_key)["fato_pedidos"]
    return fact.selectExpr(
        "nk_order_id", "item_id", "method", "line_total", "vl_total_pedido", "year", "month",
        "sk_cliente = 0 AS unknown_customer", "sk_produto = 0 AS unknown_product", "sk_tempo = 0 AS unknown_day",
    )


def q1_monthly_revenue(spark: SparkSession, sf_dir: str, hot: HotKeys | None = None) -> DataFrame:
    hot_keys = hot or _hot(spark, sf_dir)
    star = _star(spark, sf_dir, hot_keys)
    products = [key for key in hot_keys.item_products if key is not None]
    # The fact holds CRC-32 keys, and its unknown products share key 0.
    hot = [0, *(zlib.crc32(str(key).encode()) or 1 for key in products)] if products else []
    return analytics.monthly_revenue(star["fato_pedidos"], star["dim_tempo"], star["dim_produtos"], hot)


def _top_products(keep_ties: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _star(spark, sf_dir)
        return analytics.top_products(star["fato_pedidos"], star["dim_produtos"], keep_ties=keep_ties)

    return query


def _ticket(days: int | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _star(spark, sf_dir)
        return analytics.ticket_by_channel(star["fato_pedidos"], star["dim_tempo"], AS_OF, days)

    return query


def q4_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return analytics.churn(star["fato_pedidos"], star["dim_tempo"], star["dim_clientes"], AS_OF)


def _cohort(wrap_months: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _star(spark, sf_dir)
        return analytics.cohorts(star["fato_pedidos"], star["dim_tempo"], wrap_months)

    return query


def orders_enriched(spark: SparkSession, sf_dir: str, hot: HotKeys | None = None) -> DataFrame:
    clean = _clean(spark, sf_dir, "orders", "customers", "payments")
    return marts.orders_enriched(clean["orders"], clean["customers"], clean["payments"], hot or _hot(spark, sf_dir))


def items_enriched(spark: SparkSession, sf_dir: str, hot: HotKeys | None = None) -> DataFrame:
    clean = _clean(spark, sf_dir, "order_items", "products")
    return marts.items_enriched(clean["order_items"], clean["products"], hot or _hot(spark, sf_dir))


def monthly_revenue(spark: SparkSession, sf_dir: str, hot: HotKeys | None = None) -> DataFrame:
    hot = hot or _hot(spark, sf_dir)
    return marts.monthly_revenue(orders_enriched(spark, sf_dir, hot), items_enriched(spark, sf_dir, hot), hot)


def _customer_spend(segments: int) -> Query:
    return lambda spark, sf_dir: marts.customer_spend(_clean(spark, sf_dir, "orders")["orders"], segments)


def _hot_form(query: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: query(spark, sf_dir, _salted(spark, sf_dir))


def product_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.product_ratings(_clean(spark, sf_dir, "reviews")["reviews"])


def fact_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.orphan_counts(_star(spark, sf_dir)["fato_pedidos"])


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimensions = gold.build_dimensions(_clean(spark, sf_dir, "customers", "products", "orders"))
    return _union([gold.collision_summary(df, name) for name, df in dimensions.items()])


def _per_table(check: Callable[[DataFrame, str], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _union([check(df, name) for name, df in retail.raw_tables(spark, sf_dir).items()])

    return query


def qc_numeric_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union([
        checks.table_checks(retail.raw_table(spark, sf_dir, name), name, ranges=ranges, checked_at=RUN_AT)
        for name, ranges in quality.RANGES.items()
    ])


def qc_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_suite(retail.raw_tables(spark, sf_dir), checked_at=RUN_AT)


def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the report, then read its totals back."""
    path = scratch_dir(spark, "report")
    quality.write_report(qc_suite(spark, sf_dir), path, RUN_AT)
    report = tables.read_report(spark, f"{path}/latest")
    return report.select(
        F.col("generated_at").cast("timestamp"), *[F.col(name) for name in quality.REPORT_FIELDS[1:]]
    )


def qc_failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "report")
    quality.write_report(qc_suite(spark, sf_dir), path, RUN_AT)
    return quality.failures_in_report(spark, path)


def report_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the report twice and read the archive, which has a line for each run."""
    path = scratch_dir(spark, "report")
    stored = quality.write_report(qc_suite(spark, sf_dir), path, RUN_AT)
    quality.write_report(stored, f"{path}/again", RUN_AT)
    archive = spark.read.json([f"{path}/archive", f"{path}/again/archive"])
    return archive.select(F.col("generated_at").cast("timestamp"), *quality.ARCHIVE_FIELDS[1:])


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without items."""
    orders, items = retail.raw_table(spark, sf_dir, "orders"), retail.raw_table(spark, sf_dir, "order_items")
    return checks.orphan_keys(orders, items, "order_id", "order_id")


def _contract(name: str) -> Query:
    return lambda spark, sf_dir: contracts.count_violations(
        retail.raw_table(spark, sf_dir, name), contracts.RAW_CONTRACTS[name]
    )


def _star_contracts(specs: dict[str, contracts.Contract]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _star(spark, sf_dir)
        return _union([contracts.count_violations(star[name], spec) for name, spec in specs.items()])

    return query


def quarantined_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = contracts.quarantined_rows(retail.raw_table(spark, sf_dir, "products"), contracts.RAW_CONTRACTS["products"])
    return bad.withColumn("violations", F.array_join("violations", ", "))


def coercion_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union([
        silver.coercion_losses(retail.raw_table(spark, sf_dir, "customers"), "customers", dates=["birth_date"]),
        silver.coercion_losses(retail.raw_table(spark, sf_dir, "orders"), "orders", dates=["order_date"]),
    ])


def bronze_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest all raw tables (CSV, then Parquet) and show the profile of what was stored."""
    stored = bronze.ingest(
        spark, retail.raw_tables(spark, sf_dir), scratch_dir(spark, "bronze"), enforce_contracts=False
    )
    return stored.select(
        "dataset", "rows", "columns", F.explode("null_pct_per_column").alias("column_name", "null_pct")
    )


def _bronze_trip(name: str, split: bool | None = None) -> Query:
    """A raw table after CSV write, CSV scan, partitioned Parquet write and Parquet scan."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_dir(spark, "bronze")
        tables.write_csv(retail.raw_table(spark, sf_dir, name), f"{path}/{name}")
        tables.csv_to_parquet(spark, f"{path}/{name}", f"{path}/parquet/{name}", name, split)
        return tables.read_parquet(spark, f"{path}/parquet/{name}")

    return query


def csv_orders_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from CSV with their date parsed by the reader."""
    path = scratch_dir(spark, "csv")
    tables.write_csv(retail.raw_table(spark, sf_dir, "orders"), path)
    return tables.read_csv(spark, path, "orders", dates=["order_date"])


def _jobs(spark: SparkSession, sf_dir: str) -> str:
    """Run the layered jobs up to Silver, below a fresh folder. Nothing reads its Bronze tables after that: they are freed."""
    path = scratch_dir(spark, "lake")
    raw = {name: retail.raw_table(spark, sf_dir, name, sequence=True) for name in retail.raw_tables(spark, sf_dir)}
    bronze.ingest(spark, raw, f"{path}/bronze", enforce_contracts=False)
    silver.run(spark, f"{path}/bronze", f"{path}/silver", HASH_KEY)
    tables.remove(spark, f"{path}/bronze")
    return path


def silver_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer spend as the Silver job wrote it."""
    stored = tables.read_parquet(spark, f"{_jobs(spark, sf_dir)}/silver/spark/customer_spend")
    return stored.select(*marts.customer_spend(_clean(spark, sf_dir, "orders")["orders"]).columns)


def gold_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as the Gold job wrote it."""
    path = _jobs(spark, sf_dir)
    gold.run(spark, f"{path}/silver", f"{path}/gold", fail_on_collision=False)  # a test key may collide
    return gold.read_star(spark, f"{path}/gold")["fato_pedidos"].select(*FACT_COLUMNS)


def dim_keys_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys after a load of some members and a second one of all."""
    maps, cleaned = scratch_dir(spark, "maps"), _clean(spark, sf_dir, "customers", "products")
    found = []
    for table, natural, early in (("customers", "customer_id", "CAST(phone AS BIGINT) % 3 <> 0"), ("products", "product_id", "product_id % 4 = 1")):
        path = f"{maps}/{table}"
        keymap.extend(cleaned[table].where(early), natural, path)
        keys = keymap.extend(cleaned[table], natural, path)
        found.append(keys.selectExpr(f"'{table}' AS dimension", "CAST(natural_key AS STRING) AS natural_key", "surrogate_key"))
    return _union(found)


#: What Silver looked like before its last delivery: orders came, went, moved and changed, and so did lines and members.
EARLIER = {
    "orders": lambda df: df.where("order_id % 7 <> 0").withColumns({
        "status": F.expr("if(order_id % 11 = 0, 'pending', status)"),
        "order_date": F.expr("if(order_id % 13 = 0, order_date + INTERVAL 40 DAYS, order_date)"),
    }).unionByName(df.where("order_id % 17 = 0").withColumns({
        "order_id": F.expr(f"order_id + {retail.UNKNOWN}L"), "order_date": F.expr("TIMESTAMP '2031-05-05 10:00:00'"),
    })),
    "order_items": lambda df: df.where("item_id % 19 <> 0"),
    "payments": lambda df: df.withColumn("status", F.expr("if(payment_id % 23 = 0, 'pending', status)")),
    "customers": lambda df: df.where("CAST(phone AS BIGINT) % 29 <> 0"),
    "products": lambda df: df.where("product_id % 31 <> 0"),
    "reviews": lambda df: df,
}


def _incremental_gold(spark: SparkSession, sf_dir: str, maps: bool) -> tuple[str, dict[str, DataFrame]]:
    """Gold after a first run on earlier Silver tables and a second on the present ones."""
    path, cleaned = scratch_dir(spark, "lake"), _clean(spark, sf_dir, *EARLIER)

    def deliver(name: str) -> None:
        """Clean a table once: store it for the second run, and what it was before for the first."""
        tables.write_parquet(cleaned[name], f"{path}/next/{name}")
        stored = tables.read_parquet(spark, f"{path}/next/{name}")
        tables.write_parquet(EARLIER[name](stored), f"{path}/silver/cleaned/{name}")

    tables.each(spark, EARLIER, deliver)
    for earlier in (True, False):
        if not earlier:
            for name in EARLIER:
                tables.replace(spark, f"{path}/next/{name}", f"{path}/silver/cleaned/{name}")
        incremental.run(spark, f"{path}/silver", f"{path}/gold", f"{path}/maps" if maps else None)
    return path, gold.read_star(spark, f"{path}/gold")


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental_gold(spark, sf_dir, maps=False)[1]["fato_pedidos"].select(*FACT_COLUMNS)


def _customers_from_states(period: str, months: int) -> Query:
    """Distinct customers of a period and category from stored monthly states of the sold lines."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, star = _incremental_gold(spark, sf_dir, maps=True)
        fact = star["fato_pedidos"].where(analytics.SOLD).join(star["dim_produtos"].select("sk_produto", "category"), "sk_produto")
        cells = states.distinct_states(fact, ["year", "month", "category"], "sk_cliente")
        tables.write_parquet(cells, f"{path}/states", ("year", "month"))
        stored = tables.read_parquet(spark, f"{path}/states").where("year IS NOT NULL")
        return states.counted(stored, ["year", F.expr(f"CAST(ceil(month / {months}) AS INT)").alias(period), "category"], "customers")

    return query


def _out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders some of whose totals no cents can hold."""
    return retail.raw_table(spark, sf_dir, "orders", sequence=True).withColumn("total_amount", F.expr(
        "CASE WHEN order_id % 43 = 0 THEN double('Infinity') WHEN order_id % 47 = 0 THEN double('-Infinity')"
        " WHEN order_id % 59 = 0 THEN 1E300D WHEN order_id % 61 = 0 THEN double('NaN') ELSE total_amount END"
    ))


def _mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders dated day first, but for some in ISO form and some without separators."""
    moment = "try_cast(order_date AS TIMESTAMP)"
    return retail.raw_table(spark, sf_dir, "orders", sequence=True).withColumn("order_date", F.expr(
        f"CASE order_id % 10 WHEN 0 THEN order_date WHEN 1 THEN date_format({moment}, 'yyyyMMdd')"
        f" ELSE coalesce(date_format({moment}, 'dd/MM/yyyy HH:mm:ss'), order_date) END"
    ))


def clean_orders_mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _mixed_dates(spark, sf_dir)
    return silver.clean("orders", raw, HASH_KEY, dates.voted(raw, silver.DATES["orders"]))


def date_format_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.votes(_mixed_dates(spark, sf_dir), "orders", ["order_date"])


def spend_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_spend(silver.clean("orders", _out_of_range(spark, sf_dir), HASH_KEY))


def losses_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.coercion_losses(_out_of_range(spark, sf_dir), "orders", money=["total_amount", "shipping_fee"])


def catalog_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after it was loaded into a catalog table, whose money is decimal, and read by SQL."""
    path = scratch_dir(spark, "catalog")
    database = f"dw_{path.rsplit('-', 1)[1]}"
    ddl.create_tables(spark, database, path)
    ddl.load_tables(_star(spark, sf_dir), database)
    return spark.sql(f"""
        SELECT nk_order_id, item_id, sk_cliente, sk_produto, sk_tempo, ds_status, ds_canal, payment_status, method,
          quantity, CAST(line_total AS DOUBLE) AS line_total, CAST(vl_total_pedido AS DOUBLE) AS vl_total_pedido,
          year, month
        FROM {database}.fato_pedidos""")


def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = [retail.raw_table(spark, sf_dir, name) for name in ("orders", "order_items", "products")]
    return explore.revenue_by_category(*raw, hot=_hot(spark, sf_dir))


def fact_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric summary of the stored fact; mean, deviation and quartiles to two decimals."""
    path = scratch_dir(spark, "fact")
    tables.write_parquet(_star(spark, sf_dir)["fato_pedidos"], path)
    summary = profile.numeric_summary(tables.read_parquet(spark, path))
    rounded = {name: F.round(F.col(name) * 100) / 100 for name in ("mean", "std", "p25", "p50", "p75")}
    return summary.withColumns(rounded)


def order_total_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir, "orders", "order_items")
    return explore.order_total_reconciliation(clean["orders"], clean["order_items"])


def _land_events(spark: SparkSession, sf_dir: str) -> str:
    """Stream the events as JSON order events into files until the source is drained."""
    path = scratch_dir(spark, "stream")
    # As a glob pattern the stream accepts one file or a folder of files under this name.
    events = spark.readStream.schema(retail.SCHEMAS["events"]).parquet(f"{sf_dir}/event[s].parquet")
    feed.run(retail.order_events(events), f"{path}/out", f"{path}/checkpoint")
    return f"{path}/out"


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.read_landed(spark, _land_events(spark, sf_dir))


def _land_text(spark: SparkSession, sf_dir: str, runs: int) -> str:
    """Write the events as text files, some before each run of the stream, and land them."""
    path = scratch_dir(spark, "stream")
    lines = retail.order_events(retail.read(spark, sf_dir, "events")).withColumn(
        "part", F.pmod(F.xxhash64("value"), F.lit(runs))
    )
    for run in range(runs):
        lines.where(F.col("part") == run).select("value").write.mode("append").text(f"{path}/in")
        feed.run(feed.read_files(spark, f"{path}/in"), f"{path}/out", f"{path}/checkpoint")
    return f"{path}/out"


def _text_stream(runs: int) -> Query:
    return lambda spark, sf_dir: feed.read_landed(spark, _land_text(spark, sf_dir, runs))


def _files_in_order(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The events as text files whose names and lines follow the events' numbers."""
    ordered = retail.read(spark, sf_dir, "events").repartitionByRange(3, "event_id").sortWithinPartitions("event_id")
    retail.order_events(ordered).write.text(path)


def stream_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 700 events: 300 in one run, in batches of 110, and the next 400 in another."""
    path = scratch_dir(spark, "stream")
    _files_in_order(spark, sf_dir, f"{path}/in")
    for n, per_batch in ((300, 110), (400, None)):
        feed.run_first(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", n, per_batch)
    return feed.read_landed(spark, f"{path}/out")


def stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered in two runs, some twice within a run and some again in the next."""
    path = scratch_dir(spark, "stream")
    events = retail.read(spark, sf_dir, "events").withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    lines = retail.order_events(events.where("part < 3").unionByName(events.where("part = 1")))
    again = retail.order_events(events.where("part > 1"))
    for delivery in (lines, again):
        delivery.write.mode("append").text(f"{path}/in")
        query = feed.start(feed.read_files(spark, f"{path}/in"), f"{path}/out", f"{path}/checkpoint", within="3650 days")
        query.awaitTermination()
    return feed.read_landed(spark, f"{path}/out")


def stream_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = feed.read_unknown_fields(spark, _land_events(spark, sf_dir))
    return found.where("get_json_object(raw, '$.coupon') IS NOT NULL").selectExpr(
        "order_id", "get_json_object(raw, '$.coupon') AS coupon"
    )


def stream_input_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that went in, against those that landed as valid and as rejected."""
    path = _land_events(spark, sf_dir)
    counts = {
        "input_lines": retail.read(spark, sf_dir, "events"), "rejected": feed.read_rejected(spark, path),
        "valid": feed.read_landed(spark, path),
    }
    return spark.range(1).select(*[df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in counts.items()])


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = feed.read_rejected(spark, _land_events(spark, sf_dir))
    whole = F.when(F.col("raw").contains('"order_id"'), "bad field").otherwise("without order id")
    fault = F.when(F.col("raw").endswith("}"), whole).otherwise("cut short")
    return rejected.groupBy(fault.alias("fault")).agg(F.count(F.lit(1)).alias("lines"))


def _zoneless(query: Query) -> Query:
    """Give timestamps as plain UTC date-times, the form the reference SQL has them in."""

    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.selectExpr(*[
            f"CAST(`{name}` AS TIMESTAMP_NTZ) AS `{name}`" if dtype == "timestamp" else f"`{name}`"
            for name, dtype in df.dtypes
        ])

    return wrapped


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue per category over the star schema built from the smallest tables."""
    return queries()["q1_monthly_revenue"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "q1_monthly_revenue": q1_monthly_revenue,
        "q2_top_products_limit": _top_products(keep_ties=False),
        "q2_top_products_ties": _top_products(keep_ties=True),
        "q3_ticket_channel_months": _ticket(days=None),
        "q3_ticket_channel_days": _ticket(days=365),
        "q4_churn": q4_churn,
        "q5_cohort": _cohort(wrap_months=False),
        "q5_cohort_wrapped": _cohort(wrap_months=True),
        **{
            f"clean_{name}": _cleaned(name)
            for name in ("customers", "products", "orders", "order_items", "payments", "reviews")
        },
        "orders_enriched": orders_enriched,
        "items_enriched": items_enriched,
        "monthly_revenue": monthly_revenue,
        "customer_spend": _customer_spend(segments=1),
        "customer_spend_hot": _customer_spend(segments=40),
        "product_ratings": product_ratings,
        "dim_clientes": dim_clientes,
        "dim_produtos": dim_produtos,
        "dim_tempo": dim_tempo,
        "fato_pedidos": fato_pedidos,
        "fact_orphans": fact_orphans,
        "key_collisions": key_collisions,
        "qc_schema": _per_table(
            lambda df, name: checks.check_schema(df, name, quality.REQUIRED_COLUMNS[name], RUN_AT)
        ),
        "qc_null_rate": _per_table(lambda df, name: checks.check_null_rate(df, name, 0.02, RUN_AT)),
        "qc_numeric_range": qc_numeric_range,
        "qc_referential": lambda spark, sf_dir: quality.referential_checks(retail.raw_tables(spark, sf_dir), RUN_AT),
        "qc_duplicates": lambda spark, sf_dir: quality.duplicate_checks(retail.raw_tables(spark, sf_dir), RUN_AT),
        "qc_suite": qc_suite,
        "qc_report": qc_report,
        "qc_failed_checks": qc_failed_checks,
        "orphan_keys": orphan_keys,
        **{f"contract_{name}": _contract(name) for name in contracts.RAW_CONTRACTS},
        "contract_dimensions": _star_contracts(contracts.DIMENSION_CONTRACTS),
        "contract_tables": _star_contracts(contracts.TABLE_CONSTRAINTS),
        "quarantined_products": quarantined_products,
        "coercion_losses": coercion_losses,
        "null_profile": _per_table(profile.null_profile),
        "table_sizes": lambda spark, sf_dir: profile.table_sizes(retail.raw_tables(spark, sf_dir)),
        "bronze_profile": bronze_profile,
        "bronze_orders": _bronze_trip("orders"),
        "bronze_reviews": _bronze_trip("reviews"),
        "bronze_reviews_split": _bronze_trip("reviews", split=True),
        "csv_orders_dated": csv_orders_dated,
        "dim_keys_second_load": dim_keys_second_load,
        "gold_incremental": gold_incremental,
        "monthly_customers_from_states": _customers_from_states("month", 1),
        "quarterly_customers_from_states": _customers_from_states("quarter", 3),
        "clean_orders_mixed_dates": clean_orders_mixed_dates,
        "date_format_losses": date_format_losses,
        "spend_out_of_range": spend_out_of_range,
        "losses_out_of_range": losses_out_of_range,
        "silver_job": silver_job,
        "gold_job": gold_job,
        "catalog_fact": catalog_fact,
        "fato_pedidos_wide": fato_pedidos_wide,
        "contract_keys": lambda spark, sf_dir: gold.key_violations(_star(spark, sf_dir)),
        "report_archive": report_archive,
        **{
            f"{query.__name__}_hot": _hot_form(query)
            for query in (q1_monthly_revenue, fato_pedidos, monthly_revenue)
        },
        "monthly_orders": lambda spark, sf_dir: explore.monthly_orders(retail.raw_table(spark, sf_dir, "orders")),
        "revenue_by_category": revenue_by_category,
        "rating_distribution": lambda spark, sf_dir: profile.value_counts(retail.raw_table(spark, sf_dir, "reviews"), "rating"),
        "payment_mix": lambda spark, sf_dir: profile.value_shares(retail.raw_table(spark, sf_dir, "payments"), "method"),
        "fact_preview": lambda spark, sf_dir: explore.fact_preview(_star(spark, sf_dir)["fato_pedidos"]),
        "fact_summary": fact_summary,
        "order_total_reconcile": order_total_reconcile,
        "line_total_reconcile": lambda spark, sf_dir: explore.line_total_reconciliation(
            _clean(spark, sf_dir, "order_items")["order_items"]
        ),
        "sample_orders_fraction": lambda spark, sf_dir: sampling.key_fraction(
            _clean(spark, sf_dir, "orders")["orders"], "order_id", 0.6
        ),
        "sample_orders_rows": lambda spark, sf_dir: sampling.n_rows(_clean(spark, sf_dir, "orders")["orders"], "order_id", 200),
        "stream_ingest": stream_ingest,
        "stream_rejected": stream_rejected,
        "stream_unknown_fields": stream_unknown_fields,
        "stream_input_lines": stream_input_lines,
        "stream_first_n": stream_first_n,
        "stream_deduplicated": stream_deduplicated,
        "stream_text_ingest": _text_stream(runs=1),
        "stream_restart": _text_stream(runs=2),
    }
    shown = {name: _zoneless(query) for name, query in registered.items()}
    return shown | (text_queries.queries() if text_queries else {})


def oracle_sql() -> dict[str, str]:
    statements = oracle.statements(HASH_KEY, f"DATE '{AS_OF}'", f"TIMESTAMP '{RUN_AT}'")
    return statements | (text_queries.oracle_sql() if text_queries else {})
