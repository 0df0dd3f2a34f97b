"""Sources, sinks and the layered jobs."""

from __future__ import annotations

import os
import time
from datetime import datetime

import pytest

import __spark_entry__ as entry
from conftest import HASH_KEY, SMALL, only, rows
from shopmart.operators import contracts
from shopmart.plans import bronze, gold, marts, quality, silver
from shopmart.schemas import CLEANED, RAW
from shopmart.session import FREE_SHUFFLES, freed_shuffles, scratch_dir, scratch_scope
from shopmart.sources import retail, tables


def folders(path):
    return sorted(d for d in os.listdir(path) if "=" in d)


def test_csv_round_trip_keeps_awkward_text(spark, tmp_path):
    data = [(1, 1, 5, 10, 3, 'says "hi", again', "2023-01-01"), (2, 2, 5, 10, None, "São, Paulo", None),
            (3, 3, 5, 10, 4, "back\\slash", "2023-01-01"), (4, 4, 5, 10, 4, "two\nlines, \r\nthree", "2023-01-01"),
            (5, 5, 5, 10, 4, "  padded\t ", "2023-01-01"), (6, 6, 5, 10, 4, "", "2023-01-01"), (7, 7, 5, 10, 4, '"', None)]
    df = spark.createDataFrame(data, RAW["reviews"].simpleString().replace("struct<", "").rstrip(">"))
    tables.write_csv(df, f"{tmp_path}/reviews")
    assert rows(tables.read_csv(spark, f"{tmp_path}/reviews", "reviews").select(*df.columns).selectExpr(
        "review_id", "order_id", "customer_id", "product_id", "rating", "comment", "created_at")) == rows(df.selectExpr(
            "review_id", "order_id", "customer_id", "product_id", "rating", "comment", "created_at"))


def test_csv_values_that_do_not_fit_become_null(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,order_date,status,total_amount,shipping_fee,channel,note\n"
        "1,2,2023-05-01T10:00:00,delivered,12.5,x,web,n\nz,2,soon,delivered,1,1,web,\n"
    )
    df = tables.read_csv(spark, f"{tmp_path}/orders.csv", "orders", dates=["order_date"])
    found = {r["order_id"]: r for r in df.collect()}
    assert (found[1]["shipping_fee"], found[1]["order_date"], found[1]["note"]) == (None, datetime(2023, 5, 1, 10), "n")
    assert (found[None]["order_date"], found[None]["total_amount"]) == (None, 1.0)


def test_partitioned_write_overwrites(spark, tmp_path, frame):
    path = f"{tmp_path}/t"
    df = frame([(1, 2023, 1), (2, 2023, 2), (3, None, None)], "id INT, year INT, month INT")
    for _ in range(2):
        tables.write_parquet(df, path, ("year", "month"), sort_by=["id"])
        assert rows(spark.read.parquet(path)) == rows(df)
    assert folders(path) == ["year=2023", "year=__HIVE_DEFAULT_PARTITION__"]
    later = frame([(9, 2023, 2)], "id INT, year INT, month INT")
    tables.write_parquet(later, path, ("year", "month"), only_touched_partitions=True)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect() if r["id"]) == [1, 3, 9]
    tables.write_parquet(later, path, ("year", "month"))
    assert spark.read.parquet(path).count() == 1


def test_date_column(frame):
    df = frame([("a", "b")], "name STRING, paid_at STRING")
    assert tables.date_column(df) == "paid_at"
    assert tables.date_column(df.drop("paid_at")) is None
    assert tables.date_column(df, "customers") == "created_at"
    assert tables.date_column(df, "order_items") is None


class Session:
    """The two parts of a session that ``scratch_dir`` looks at."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = self
        self.master = master


def test_scratch_folder_lies_below_the_checkpoint_setting():
    shared = Session("yarn", **{"spark.checkpoint.dir": "s3://bucket/scratch/"})
    assert scratch_dir(shared, "x").startswith("s3://bucket/scratch/x-")
    assert scratch_dir(Session("local[2]"), "x") != scratch_dir(Session("local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("local-cluster[2,1,1024]"), "x")


def test_scratch_is_freed_with_its_scope(spark):
    """Inner scopes free their own, failing ones too; what was made outside stays."""
    def made(label):
        path = scratch_dir(spark, label)
        spark.range(1).write.parquet(path)
        return path

    outside = made("outside")
    with scratch_scope(spark):
        outer = made("outer")
        with pytest.raises(RuntimeError), scratch_scope(spark):
            inner, never_written = made("inner"), scratch_dir(spark, "never")
            raise RuntimeError
        assert tables.exists(spark, outer) and not tables.exists(spark, inner)
    after = made("after")
    assert [tables.exists(spark, p) for p in (outside, outer, never_written, after)] == [True, False, False, True]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """All layers of the smallest tables on disk."""
    path = str(tmp_path_factory.mktemp("lake"))
    profile = bronze.ingest(spark, retail.raw_tables(spark, SMALL), f"{path}/bronze", enforce_contracts=False)
    quality.run(spark, f"{path}/bronze", f"{path}/report")
    silver.run(spark, f"{path}/bronze", f"{path}/silver", HASH_KEY)
    gold.run(spark, f"{path}/silver", f"{path}/gold")
    return path, profile


def test_bronze(spark, lake):
    path, profile = lake
    raw = retail.raw_tables(spark, SMALL)
    assert {r["dataset"]: r["rows"] for r in profile.collect()} == {n: df.count() for n, df in raw.items()}
    for layout in ("parquet", "csv"):
        stored = bronze.read(spark, f"{path}/bronze", layout)
        for name, df in raw.items():
            assert rows(stored[name]) == rows(df), (layout, name)
    assert "year=1995" in folders(f"{path}/bronze/parquet/orders")
    assert folders(f"{path}/bronze/parquet/order_items") == []


def test_silver_and_gold_equal_the_direct_plans(spark, lake):
    path, _ = lake
    clean = {n: silver.clean(n, df, HASH_KEY) for n, df in retail.raw_tables(spark, SMALL).items()}
    for name, df in silver.read_cleaned(spark, f"{path}/silver").items():
        assert df.schema.simpleString() == CLEANED[name].simpleString()
        assert rows(df) == rows(clean[name]), name
    for name, df in marts.build_all(clean).items():
        stored = spark.read.parquet(f"{path}/silver/spark/{name}").select(*df.columns)
        assert rows(stored) == rows(df), name
    for name, df in gold.read_star(spark, f"{path}/gold").items():
        assert rows(df) == rows(gold.build_star(clean)[name].select(*df.columns)), name
    assert "year=1996" in folders(f"{path}/gold/fato_pedidos")


def test_layers_can_be_rerun(spark, lake):
    path, _ = lake
    before = gold.read_star(spark, f"{path}/gold")["fato_pedidos"].count()
    silver.run(spark, f"{path}/bronze", f"{path}/silver", HASH_KEY)
    gold.run(spark, f"{path}/silver", f"{path}/gold")
    assert gold.read_star(spark, f"{path}/gold")["fato_pedidos"].count() == before


def test_quality_is_advisory_unless_told(spark, lake):
    path, _ = lake
    assert only(tables.read_report(spark, f"{path}/report/latest").select("total_checks"))["total_checks"] == 27
    with pytest.raises(ValueError, match="quality checks failed"):
        quality.run(spark, f"{path}/bronze", f"{path}/report2", fail=True)


def test_ingest_quarantines_rows_off_contract(spark, tmp_path):
    raw = {"products": retail.products(spark, SMALL)}
    contract = contracts.RAW_CONTRACTS["products"]
    plain = raw["products"].drop("load_seq")
    for _ in range(2):
        profile = only(bronze.ingest(spark, raw, str(tmp_path), quarantine=True))
    bad = spark.read.parquet(f"{tmp_path}/quarantine/products")
    assert rows(bad.drop("load_seq")) == rows(contracts.quarantined_rows(plain, contract)) and bad.count() > 0
    good = contracts.valid_rows(plain, contract)
    for layout in ("parquet", "csv"):
        stored = tables.read_csv(spark, f"{tmp_path}/products", "products") if layout == "csv" else spark.read.parquet(f"{tmp_path}/parquet/products")
        assert rows(stored.select(*plain.columns)) == rows(good)
    assert profile["rows"] == good.count() and not (tmp_path / "_incoming" / "products").exists()


def test_a_refused_table_leaves_the_old_one(spark, tmp_path):
    good = {"products": spark.createDataFrame([(1, "n", "c", "s", 2.0, 1.0, 3, "2024-01-01")], RAW["products"])}
    profile = only(bronze.ingest(spark, good, str(tmp_path)))
    assert (profile["rows"], profile["columns"], set(profile["null_pct_per_column"].values())) == (1, 8, {0.0})
    with pytest.raises(ValueError, match="rows break the contract"):
        bronze.ingest(spark, {"products": good["products"].withColumn("price", -good["products"]["price"])}, str(tmp_path))
    assert tables.read_csv(spark, f"{tmp_path}/products", "products").first()["price"] == 2.0
    assert spark.read.parquet(f"{tmp_path}/parquet/products").first()["price"] == 2.0


def test_ingest_evaluates_a_table_once_a_form(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    row = (1, "n", "c", "s", 2.0, 1.0, 3, "2024-01-01")
    raw = {"products": spark.createDataFrame([row] * 10, RAW["products"]).mapInArrow(count, RAW["products"])}
    bronze.ingest(spark, raw, str(tmp_path)).collect()
    assert seen.value == 20


def test_ingest_can_refuse_rows_off_contract(spark, tmp_path):
    raw = {"products": retail.products(spark, SMALL)}
    with pytest.raises(ValueError, match="products: .* rows break the contract"):
        bronze.ingest(spark, raw, str(tmp_path))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {line.rsplit("/", 1)[1] for line in found.split("\n") if "/shuffle_" in line}


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    held = shuffle_files(spark)
    before = spark.conf.get(FREE_SHUFFLES)
    with pytest.raises(RuntimeError), freed_shuffles(spark):
        spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().write.parquet(str(tmp_path / "counts"))
        until = time.time() + 20
        while shuffle_files(spark) - held and time.time() < until:
            time.sleep(0.1)
        assert not shuffle_files(spark) - held
        raise RuntimeError
    assert spark.conf.get(FREE_SHUFFLES) == before != "true"


def test_layered_jobs_free_shuffles_and_their_bronze(spark, tmp_path, monkeypatch):
    settings, write = set(), tables.write_parquet

    def watched(*args, **options):
        settings.add(spark.conf.get(FREE_SHUFFLES))
        write(*args, **options)

    monkeypatch.setattr(tables, "write_parquet", watched)
    monkeypatch.setattr(entry, "scratch_dir", lambda *_: str(tmp_path / "lake"))
    found = entry.gold_job(spark, SMALL)
    assert settings == {"true"} and spark.conf.get(FREE_SHUFFLES) != "true"
    assert sorted(os.listdir(tmp_path / "lake")) == ["gold", "silver"]
    assert found.count() > 0
