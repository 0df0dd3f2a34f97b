"""Catalog tables for the star schema, with declared types and comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Declared columns, types and comments of the warehouse tables. Surrogate keys
# are BIGINT, since an unsigned CRC-32 does not fit INT.
TABLES = {
    "dim_clientes": (
        "Customer dimension, personal data pseudonymised",
        (
            ("sk_cliente", "BIGINT", "surrogate key"),
            ("nk_customer_id", "STRING", "HMAC-SHA256 of the customer id"),
            ("city", "STRING", None),
            ("state", "STRING", "two letters"),
            ("dt_criacao", "TIMESTAMP", None),
            ("dt_carga", "TIMESTAMP", "load time"),
        ),
        (),
    ),
    "dim_produtos": (
        "Product dimension with category hierarchy and margin",
        (
            ("sk_produto", "BIGINT", "surrogate key"),
            ("nk_product_id", "BIGINT", "product id"),
            ("nm_produto", "STRING", None),
            ("category", "STRING", None),
            ("subcategory", "STRING", None),
            ("price", "DECIMAL(10,2)", None),
            ("cost", "DECIMAL(10,2)", None),
            ("margem_pct", "DECIMAL(6,2)", "margin in percent of the price"),
            ("dt_carga", "TIMESTAMP", "load time"),
        ),
        (),
    ),
    "dim_tempo": (
        "Date dimension over the whole order history",
        (
            ("sk_tempo", "BIGINT", "surrogate key"),
            ("dt_data", "DATE", None),
            ("ano", "SMALLINT", None),
            ("mes", "SMALLINT", None),
            ("dia", "SMALLINT", None),
            ("trimestre", "SMALLINT", None),
            ("semana_ano", "SMALLINT", "ISO week"),
            ("dia_semana", "SMALLINT", "Monday is 0"),
            ("nm_dia_semana", "STRING", None),
            ("nm_mes", "STRING", None),
            ("fl_fimdesemana", "BOOLEAN", None),
        ),
        (),
    ),
    "fato_pedidos": (
        "Order fact, one row per order item, partitioned by year and month",
        (
            ("nk_order_id", "BIGINT", "order id"),
            ("item_id", "BIGINT", None),
            ("sk_cliente", "BIGINT", None),
            ("sk_produto", "BIGINT", None),
            ("sk_tempo", "BIGINT", None),
            ("ds_status", "STRING", None),
            ("ds_canal", "STRING", None),
            ("payment_status", "STRING", None),
            ("method", "STRING", None),
            ("quantity", "SMALLINT", None),
            ("unit_price", "DECIMAL(10,2)", None),
            ("discount", "DECIMAL(5,4)", None),
            ("line_total", "DECIMAL(12,2)", None),
            ("vl_total_pedido", "DECIMAL(12,2)", None),
            ("vl_frete", "DECIMAL(8,2)", None),
            ("dt_carga", "TIMESTAMP", "load time"),
            ("year", "INT", None),
            ("month", "INT", None),
        ),
        ("year", "month"),
    ),
}


def create_statement(table: str, database: str, location: str | None = None) -> str:
    comment, columns, partitions = TABLES[table]
    lines = ",\n  ".join(f"{name} {dtype}" + (f" COMMENT '{note}'" if note else "") for name, dtype, note in columns)
    parts = [f"CREATE TABLE IF NOT EXISTS {database}.{table} (\n  {lines}\n)", "USING PARQUET"]
    if partitions:
        parts.append(f"PARTITIONED BY ({', '.join(partitions)})")
    if location:
        parts.append(f"LOCATION '{location}/{table}'")
    return "\n".join([*parts, f"COMMENT '{comment}'"])


def create_tables(spark: SparkSession, database: str = "dw", location: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES:
        spark.sql(create_statement(table, database, location))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast a Gold table to its declared types and stamp the load time."""
    stamped = df.withColumn("dt_carga", F.current_timestamp())
    return stamped.select(*[F.col(name).cast(dtype).alias(name) for name, dtype, _ in TABLES[table][1]])


def load_tables(star: dict[str, DataFrame], database: str = "dw") -> None:
    """Overwrite the catalog tables with the star schema."""
    for table, df in star.items():
        rows = conform(df, table)
        partitions = TABLES[table][2]
        if partitions:
            rows = rows.hint("rebalance", *[F.col(c) for c in partitions])
        rows.write.mode("overwrite").insertInto(f"{database}.{table}", overwrite=True)
