"""Keys that stay, incremental Gold and mergeable counts."""

from __future__ import annotations

import os
import random
from contextlib import nullcontext
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of, rows
from shopmart.operators import keymap, states
from shopmart.plans import gold, incremental
from shopmart.plans.hot import HotKeys
from shopmart.plans.silver import read_cleaned
from shopmart.schemas import CLEANED, FACT_COLUMNS
from shopmart.sources import tables


def numbers(df):
    return {r["natural_key"]: r["surrogate_key"] for r in df.collect()}


def test_known_keys_stay_and_new_ones_are_gapless(spark, frame, tmp_path):
    path = str(tmp_path / "map")
    draw, seen, known = random.Random(1), set(), {}
    for _ in range(4):
        batch = [f"m{draw.randrange(400)}" for _ in range(150)]
        found = numbers(keymap.extend(frame([(v,) for v in [*batch, None]], "k STRING").repartition(5), "k", path))
        new = sorted(set(batch) - seen)
        assert {k: found[k] for k in known} == known
        assert [found[k] for k in new] == list(range(len(seen) + 1, len(seen) + len(new) + 1))
        seen |= set(batch)
        known = found
        assert set(found) == seen
    again = numbers(keymap.extend(frame([(v,) for v in seen], "k STRING"), "k", path))
    assert again == known


def test_a_map_without_members(frame, tmp_path):
    path = str(tmp_path / "map")
    assert numbers(keymap.extend(frame([(None,)], "k BIGINT"), "k", path)) == {}
    assert numbers(keymap.extend(frame([(9,), (-4,), (9,)], "k BIGINT"), "k", path)) == {-4: 1, 9: 2}


def test_numbers_do_not_depend_on_the_ranges(spark, tmp_path):
    members = spark.range(3000).selectExpr("id * 7 AS natural_key")
    few = numbers(keymap.numbered(members.coalesce(1), 11))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert numbers(keymap.numbered(members.repartition(6), 11)) == few == {i * 7: i + 11 for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def moment(month, day=3):
    return datetime(2024, month, day, 12)


BASE = {
    "customers": [(c, c, None, None, "x", "SP", None, None) for c in ("ana", "bob", "eve")],
    "products": [(p, f"p{p}", "cat", "sub", 10.0, 4.0, 1, None) for p in (1, 2, 3)],
    "orders": [(m * 10 + n, ("ana", "bob", "zoe")[n], moment(m, n + 1), "delivered", 50.0, 5.0, "web") for m in range(1, 7) for n in range(3)],
    "order_items": [(o * 10 + i, o, i + 2, 1, 10.0, 0.0, 10.0) for o in [m * 10 + n for m in range(1, 7) for n in range(3)] for i in range(2)],
    "payments": [(m * 10, m * 10, "pix", "approved", 50.0, None) for m in range(1, 7)],
    "reviews": [],
}


def silver(spark, path, changed=()):
    data = {**BASE, **dict(changed)}
    for name, schema in CLEANED.items():
        found = [row[: len(schema.fields)] for row in data[name]]
        tables.write_parquet(spark.createDataFrame(found, schema), f"{path}/cleaned/{name}")


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                full = os.path.join(folder, name)
                found[os.path.relpath(folder, path)] = found.get(os.path.relpath(folder, path), ()) + ((name, os.stat(full).st_mtime_ns),)
    return found


ORDERS = BASE["orders"]
MOVED = {41: lambda r: (*r[:3], "returned", *r[4:]), 20: lambda r: (*r[:2], moment(5, 20), *r[3:]), 21: lambda r: (*r[:2], None, *r[3:])}
#: New Silver tables, and the months that a run must touch; each step starts from where the one before ended.
STEPS = [
    ("a changed status, dates that moved and went", {"orders": [MOVED.get(r[0], lambda x: x)(r) for r in ORDERS]}, {2, 4, 5, None}),
    ("nothing", {"orders": [MOVED.get(r[0], lambda x: x)(r) for r in ORDERS]}, set()),
    ("back, with a late order, one gone and a customer without orders", {
        "orders": [*[r for r in ORDERS if r[0] != 31], (77, "bob", moment(3, 9), "pending", 1.0, 1.0, "web")],
        "customers": [*BASE["customers"], ("new", "new", None, None, "x", "SP", None, None)],
    }, {2, 3, 4, 5, None}),
    ("back, with items that came, went and repeat, and a payment that changed", {
        "order_items": [*BASE["order_items"][2:], (9999, 61, 1, 2, 5.0, 0.0, 10.0), *[BASE["order_items"][7]] * 2],
        "payments": [r if r[0] != 20 else (*r[:3], "declined", *r[4:]) for r in BASE["payments"]],
    }, {1, 2, 3, 6}),
    ("back, with a month that empties", {"orders": [r for r in ORDERS if r[2].month != 4]}, {1, 2, 4, 6}),
    ("the same, a customer who became known and a product that went", {
        "orders": [r for r in ORDERS if r[2].month != 4],
        "customers": [*BASE["customers"], ("zoe", "zoe", None, None, "x", "SP", None, None)], "products": BASE["products"][:2],
    }, {1, 2, 3, 5, 6}),
]


def test_incremental_equals_a_full_rebuild(spark, tmp_path):
    source, kept = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver(spark, source)
    assert incremental.run(spark, source, kept).count() == 6
    for name, changed, touched in STEPS:
        before = files(f"{kept}/fato_pedidos")
        silver(spark, source, changed)
        months = {r["month"] for r in incremental.run(spark, source, kept).collect()}
        assert months == touched, name
        full = gold.build_star(read_cleaned(spark, source))
        found = gold.read_star(spark, kept)
        for table, df in full.items():
            assert rows(found[table].select(*df.columns)) == rows(df), (name, table)
        after = files(f"{kept}/fato_pedidos")
        default = "__HIVE_DEFAULT_PARTITION__"
        for folder, there in before.items():
            month = folder.rsplit("=", 1)[1]
            if (None if month == default else int(month)) not in touched:
                assert after[folder] == there, (name, folder)


def test_a_run_that_ended_early_is_repeated(spark, tmp_path, monkeypatch):
    source, kept = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver(spark, source)
    incremental.run(spark, source, kept)
    silver(spark, source, {"orders": [r for r in ORDERS if r[2].month != 4]})
    whole = incremental.replace_months
    calls = []

    def ends(df, path, months):
        if calls.append(path) or len(calls) > 1:
            raise RuntimeError("lost")
        whole(df, path, months)

    monkeypatch.setattr(incremental, "replace_months", ends)
    with pytest.raises(RuntimeError):
        incremental.run(spark, source, kept)
    monkeypatch.setattr(incremental, "replace_months", whole)
    assert {r["month"] for r in incremental.run(spark, source, kept).collect()} == {4}
    assert tables.read_parquet(spark, f"{kept}/fato_pedidos").where("month = 4").count() == 0


def test_mapped_keys_stay_when_members_come_and_go(spark, tmp_path):
    source, kept, maps = (str(tmp_path / n) for n in ("silver", "gold", "maps"))
    silver(spark, source, {"customers": BASE["customers"][1:]})
    incremental.run(spark, source, kept, maps)
    first = {r["nk_customer_id"]: r["sk_cliente"] for r in tables.read_parquet(spark, f"{kept}/dim_clientes").collect()}
    silver(spark, source)
    incremental.run(spark, source, kept, maps)
    star = gold.read_star(spark, kept)
    second = {r["nk_customer_id"]: r["sk_cliente"] for r in star["dim_clientes"].collect()}
    assert first == {"bob": 1, "eve": 2} and second == {"bob": 1, "eve": 2, "ana": 3}
    assert {r["sk_cliente"] for r in star["fato_pedidos"].collect()} == {0, 1, 3}
    assert star["fato_pedidos"].select(*FACT_COLUMNS).count() == 36
    assert gold.key_violations(star).where("violations > 0").count() == 0


def test_states_merge_to_any_period(spark):
    draw = random.Random(2)
    data = [(draw.randrange(24), draw.choice("ab"), draw.choice([0, *range(1, 60), 40_000, 32_768, 32_769, 10**10])) for _ in range(900)]
    facts = spark.createDataFrame(data, "month INT, category STRING, who BIGINT").repartition(4)
    cells = states.distinct_states(facts, ["month", "category"], "who")
    late = states.distinct_states(spark.createDataFrame([(3, "a", 77), (3, "a", 1)], facts.schema), ["month", "category"], "who")
    data += [(3, "a", 77), (3, "a", 1)]
    every = cells.unionByName(late)

    def plain(period):
        found = {}
        for month, category, who in data:
            if who:
                found.setdefault((period(month), category), set()).add(who)
        return sorted((*cell, len(members)) for cell, members in found.items())

    for size in (1, 3, 12):
        period = F.expr(f"CAST(floor(month / {size}) AS INT)").alias("period")
        found = states.counted(every, [period, "category"], "n")
        assert sorted(map(tuple, found.select("period", "category", "n").collect())) == plain(lambda m: m // size)


def test_periods_are_counted_without_the_fact(spark, tmp_path):
    facts = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr("month(o_orderdate) AS month", "'x' AS category", "o_custkey AS who")
    path = str(tmp_path / "states")
    states.distinct_states(facts, ["month", "category"], "who").write.parquet(path)
    counted = states.counted(spark.read.parquet(path), ["category"], "n")
    assert counted.first()["n"] == facts.where("who > 0").select("who").distinct().count()
    assert "orders.parquet" not in plan_of(counted)


def scratch_of(monkeypatch, tmp_path, name):
    """Keep what runs store for themselves, below a known folder."""
    monkeypatch.setattr(incremental, "scratch_scope", lambda _: nullcontext())
    monkeypatch.setattr(incremental, "scratch_dir", lambda _, label: str(tmp_path / name / label))
    return tmp_path / name / "incremental"


def test_a_run_of_all_months_stores_no_copy_of_silver_or_the_fact(spark, tmp_path, monkeypatch):
    source, kept = str(tmp_path / "silver"), str(tmp_path / "gold")
    copies = {"orders", "order_items", "payments", "fact", "members-dim_clientes"}
    changed = {"orders": [(*r[:3], "returned", *r[4:]) for r in ORDERS]}
    monkeypatch.setattr(HotKeys, "detect", staticmethod(lambda *_: HotKeys()))
    for name, rows_ in (("first", {}), ("all", changed)):
        silver(spark, source, rows_)
        work = scratch_of(monkeypatch, tmp_path, name)
        assert incremental.run(spark, source, kept).count() == 6
        assert not copies & set(os.listdir(work))
    # Where few months are touched, rows of the others are still sorted out first.
    silver(spark, source, {"orders": [*changed["orders"][1:], (*ORDERS[0][:3], "lost", *ORDERS[0][4:])]})
    work = scratch_of(monkeypatch, tmp_path, "few")
    assert [r["month"] for r in incremental.run(spark, source, kept).collect()] == [1]
    assert {"orders", "order_items", "payments"} <= set(os.listdir(work))
    assert tables.read_parquet(spark, f"{work}/order_items").count() == 6


@pytest.mark.parametrize("hot", [HotKeys(), HotKeys(item_orders=(10, 11), payment_orders=(10,), item_products=(2,), order_customers=("bob",))])
def test_repeated_and_missing_ids_are_as_in_a_full_rebuild(spark, tmp_path, monkeypatch, hot):
    source, kept = str(tmp_path / "silver"), str(tmp_path / "gold")
    monkeypatch.setattr(HotKeys, "detect", staticmethod(lambda *_: hot))
    silver(spark, source, {
        "orders": [*ORDERS, ORDERS[0], (None, "bob", moment(2), "pending", 1.0, 1.0, "web"), (99, None, None, "pending", 1.0, 1.0, None)],
        "order_items": [*BASE["order_items"], BASE["order_items"][0], (None, None, None, 1, 1.0, 0.0, 1.0), (5, 5000, 1, 1, 1.0, 0.0, 1.0)],
        "payments": [*BASE["payments"], *BASE["payments"][:1], (None, None, "pix", None, None, None)],
    })
    incremental.run(spark, source, kept)
    full = gold.build_star(read_cleaned(spark, source))["fato_pedidos"]
    assert rows(tables.read_parquet(spark, f"{kept}/fato_pedidos").select(*full.columns)) == rows(full)


def test_months_of_the_fact_are_read_from_the_orders_alone(spark, tmp_path):
    source = str(tmp_path / "silver")
    silver(spark, source)
    months = gold.build_star(read_cleaned(spark, source))["fato_pedidos"].select("year", "month").distinct()
    plan = plan_of(months)
    assert "Join" not in plan and "cleaned/order_items" not in plan and months.count() == 6


def test_states_begin_one_bitmap_for_each_cell_and_range(spark):
    """Tasks hand on members as numbers; no task starts bitmaps of its own for cells that others hold too."""
    facts = spark.range(0, 4000, 1, 8).selectExpr("CAST(id % 3 AS INT) AS month", "if(id % 2 = 0, 'a', NULL) AS category", "id % 500 * 999 AS who")
    cells = states.distinct_states(facts, ["month", "category"], "who")
    partial = plan_of(cells).split("partial_bitmap_construct_agg", 1)
    assert "Exchange" in partial[1] and "Exchange" not in partial[0]
    assert cells.count() == cells.select("month", "category", "bucket").distinct().count()
    counted = {r["month"]: r["n"] for r in states.counted(cells, ["month"], "n").collect()}
    assert counted == {m: len({i % 500 for i in range(m, 4000, 3)} - {0}) for m in range(3)}
