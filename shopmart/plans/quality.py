"""The quality suite over the six raw tables, its report and its archive."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.operators.checks import (
    DEFAULT_NULL_THRESHOLD,
    Range,
    check_schema,
    key_checks,
    missing_columns,
    table_checks,
)
from shopmart.operators.presence import Reference
from shopmart.operators.profile import aggregate
from shopmart.plans import bronze
from shopmart.schemas import REQUIRED_COLUMNS
from shopmart.sources import tables


# The checks of the standard suite.
RANGES: dict[str, tuple[Range, ...]] = {
    "products": (Range("price", low=0.01), Range("cost", low=0)),
    "orders": (Range("total_amount", low=0.01),),
    "order_items": (Range("quantity", low=1), Range("discount", low=0, high=1)),
    "reviews": (Range("rating", low=1, high=5),),
}
REFERENCES = (
    Reference("orders", "customer_id", "customers", "customer_id"),
    Reference("order_items", "order_id", "orders", "order_id"),
    Reference("order_items", "product_id", "products", "product_id"),
    Reference("payments", "order_id", "orders", "order_id"),
    Reference("reviews", "customer_id", "customers", "customer_id"),
)
UNIQUE_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "payments": "payment_id",
}

REPORT_FIELDS = ("generated_at", "total_checks", "passed", "failed", "overall_status")
ARCHIVE_FIELDS = ("generated_at", "overall_status", "passed", "failed")


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def referential_checks(raw: dict[str, DataFrame], checked_at: datetime | None = None) -> DataFrame:
    return key_checks(raw, REFERENCES, (), checked_at)


def duplicate_checks(raw: dict[str, DataFrame], checked_at: datetime | None = None) -> DataFrame:
    return key_checks(raw, (), list(UNIQUE_KEYS.items()), checked_at)


def run_suite(
    raw: dict[str, DataFrame],
    null_threshold: float = DEFAULT_NULL_THRESHOLD,
    checked_at: datetime | None = None,
) -> DataFrame:
    """All 27 checks as result rows.

    A table without its required columns ends the suite: the result then holds the schema
    checks up to and including the failed one. Each table is read once for its schema, null
    and range checks together, and once more for its keys, whose checks share one aggregate.
    """
    done = []
    for name, required in REQUIRED_COLUMNS.items():
        done.append(check_schema(raw[name], name, required, checked_at))
        if missing_columns(raw[name], required):
            return _stack(done)
    per_table = [
        table_checks(raw[name], name, required, null_threshold, RANGES.get(name, ()), checked_at)
        for name, required in REQUIRED_COLUMNS.items()
    ]
    return _stack([*per_table, key_checks(raw, REFERENCES, list(UNIQUE_KEYS.items()), checked_at)])


def summarise(results: DataFrame, generated_at: datetime | None = None) -> DataFrame:
    """One row: totals and overall status of a run."""
    stamp = f"TIMESTAMP '{generated_at}'" if generated_at else "current_timestamp()"
    return aggregate(results, [
        f"{stamp} AS generated_at",
        "count(1) AS total_checks",
        "count_if(status = 'PASS') AS passed",
        "count_if(status = 'FAIL') AS failed",
        "if(count_if(status = 'FAIL') = 0, 'PASS', 'FAIL') AS overall_status",
    ])


def failed_checks(results: DataFrame) -> DataFrame:
    return results.where("status = 'FAIL'").select("check", "dataset", "error_count").orderBy("check", "dataset")


def write_report(results: DataFrame, path: str, generated_at: datetime | None = None) -> DataFrame:
    """Overwrite ``path/latest``, append a line to ``path/archive``, return the result rows.

    Result rows are written first and reused, so the checks run once. The report is one row
    per run; a run has as many results as its suite has checks.
    """
    spark = results.sparkSession
    generated_at = generated_at or datetime.now(timezone.utc).replace(tzinfo=None)
    results.write.mode("overwrite").parquet(f"{path}/results")
    stored = spark.read.parquet(f"{path}/results")
    records = stored.agg(F.collect_list(F.struct(*stored.columns)).alias("checks"))
    summary = summarise(stored, generated_at).withColumn("checks", records.scalar())
    summary.write.mode("overwrite").json(f"{path}/latest")
    summary.select(*ARCHIVE_FIELDS).write.mode("append").json(f"{path}/archive")
    return stored


def failures_in_report(spark: SparkSession, path: str) -> DataFrame:
    """Failed checks of the latest report, read back from its JSON."""
    report = tables.read_report(spark, f"{path}/latest")
    return failed_checks(report.select(F.explode("checks").alias("c")).select("c.*"))


def run(
    spark: SparkSession,
    bronze_path: str,
    report_path: str,
    null_threshold: float = DEFAULT_NULL_THRESHOLD,
    fail: bool = False,
) -> DataFrame:
    """Check the ingested raw tables and write the report. Advisory unless ``fail`` is set."""
    results = write_report(run_suite(bronze.read(spark, bronze_path), null_threshold), report_path)
    if fail and not failed_checks(results).isEmpty():
        raise ValueError("quality checks failed; see the report")
    return results
