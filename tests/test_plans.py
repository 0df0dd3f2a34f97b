"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SMALL, plan_of
from shopmart.operators.dedup import keep_first
from shopmart.plans import gold, silver
from shopmart.sources import retail

# Queries that write tables and read them back, so that only the last read shows in their plan.
EAGER = {
    "qc_report", "qc_failed_checks", "report_archive", "bronze_profile", "bronze_orders", "bronze_reviews", "csv_orders_dated",
    "silver_job", "gold_job", "catalog_fact", "fact_summary", "stream_ingest", "stream_rejected", "stream_unknown_fields",
    "stream_input_lines", "stream_text_ingest", "stream_restart", "customer_spend_hot",
}
TEXT = set(entry.text_queries.queries()) if entry.text_queries else set()
LAZY = [name for name in entry.queries() if name not in EAGER | TEXT]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_dedup_cuts_before_the_shuffle(spark):
    plan = plan_of(keep_first(retail.orders(spark, SMALL), ["order_id"]))
    below_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_shuffle


def test_rank_filter_cuts_before_the_single_task(spark):
    plan = plan_of(entry.queries()["q2_top_products_ties"](spark, SMALL))
    assert "WindowGroupLimit" in plan.split("Exchange SinglePartition")[1]


def test_limit_form_takes_k_per_task(spark):
    assert "TakeOrderedAndProject(limit=20" in plan_of(entry.queries()["q2_top_products_limit"](spark, SMALL))


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(entry.queries()["payment_mix"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in plan


def test_filter_on_the_key_reaches_the_scan(spark):
    plan = plan_of(retail.order_items(spark, SMALL).where("order_id = 7"))
    assert "PushedFilters: [IsNotNull(l_orderkey), EqualTo(l_orderkey,7)]" in plan


def test_large_lookups_are_not_broadcast(spark):
    """Only sizes below the threshold broadcast; nothing is hinted."""
    raw = {n: retail.raw_table(spark, SMALL, n) for n in ("customers", "products", "orders", "order_items", "payments")}
    clean = {n: silver.clean(n, df, entry.HASH_KEY) for n, df in raw.items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = plan_of(gold.build_star(clean)["fato_pedidos"])
        assert "BroadcastHashJoin" not in plan
        assert plan.count("SortMergeJoin") == 5 + 2  # two of them join nation and region in the adapter
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["fato_pedidos", "monthly_revenue", "q1_monthly_revenue"])
def test_hot_keys_are_salted_at_any_table_size(spark, name):
    plain, salted = (plan_of(entry.queries()[query](spark, SMALL)) for query in (name, f"{name}_hot"))
    assert salted.count("_salt") > plain.count("_salt")


def test_running_totals_of_hot_customers_are_split(spark):
    plan = plan_of(entry.queries()["customer_spend_hot"](spark, SMALL))
    assert "hashpartitioning(_segment" in plan and "_sum_before" in plan
