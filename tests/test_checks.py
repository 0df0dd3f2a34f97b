"""Quality checks, contracts and profiles."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import HASH_KEY, only, rows
from shopmart.operators import checks, contracts, profile, sampling
from shopmart.plans import quality
from shopmart.schemas import RAW
from shopmart.sources import retail
from conftest import SMALL


def test_null_rate_names_the_column(frame):
    df = frame([("x", None, i) for i in range(3)] + [(None, "y", 7), ("x", "y", None), ("x", "y", 9), ("x", "y", 1)],
               "k STRING, note STRING, n INT")
    out = only(checks.check_null_rate(df, "t", 0.15))
    assert (out["status"], out["error_count"], json.loads(out["details"])) == ("FAIL", 1, {"note": 0.4286})


@pytest.mark.parametrize("nulls,status", [(1, "PASS"), (2, "FAIL")])
def test_null_rate_threshold_is_exclusive(frame, nulls, status):
    df = frame([(None if i < nulls else i,) for i in range(10)], "a INT")
    assert only(checks.check_null_rate(df, "t", 0.10))["status"] == status


def test_null_rate_counts_nan_and_passes_on_empty(frame):
    assert only(checks.check_null_rate(frame([(float("nan"),)], "a DOUBLE"), "t"))["status"] == "FAIL"
    assert only(checks.check_null_rate(frame([], "a DOUBLE"), "t"))["status"] == "PASS"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.floats(0.0, 1.0, allow_nan=False))
def test_any_threshold_gives_a_status(frame, threshold):
    df = frame([(1,), (2,), (None,)], "x INT")
    expected = "FAIL" if 1 / 3 > threshold else "PASS"
    assert only(checks.check_null_rate(df, "t", threshold))["status"] == expected


@pytest.mark.parametrize("values,low,high,status", [
    ([-2.5, 7.25], -2.5, 7.25, "PASS"),
    ([-2.5000001, 7.25], -2.5, 7.25, "FAIL"),
    ([-2.5, 7.2500001], -2.5, 7.25, "FAIL"),
    ([1e12, 4.0], 4, None, "PASS"),
    ([1e12, 3.9], 4, None, "FAIL"),
    ([-1e12, 4.0], None, 4, "PASS"),
    ([4.5], None, 4, "FAIL"),
    ([2.0, None], None, 4, "FAIL"),
    ([2.0, float("nan")], 1, None, "FAIL"),
    ([], 1, 2, "PASS"),
])
def test_numeric_range(frame, values, low, high, status):
    df = frame([(v,) for v in values], "v DOUBLE")
    assert only(checks.check_numeric_range(df, "t", "v", low, high))["status"] == status


def test_range_counts_text_that_is_no_number(frame):
    assert only(checks.check_numeric_range(frame([("1",), ("x",)], "v STRING"), "t", "v", 0))["error_count"] == 1


@pytest.mark.parametrize("call", [
    lambda df: checks.check_numeric_range(df, "t", "nope"),
    lambda df: checks.check_duplicates(df, "t", "nope"),
    lambda df: checks.check_referential_integrity(df, df, "nope", "a", "c", "p"),
])
def test_missing_column_raises(frame, call):
    with pytest.raises(ValueError, match="t lacks the columns|c lacks the columns"):
        call(frame([(1,)], "a INT"))


def integrity(child, parent):
    return only(checks.check_referential_integrity(child, parent, "fk", "pk", "child", "parent"))


def test_referential_integrity(frame):
    parent = frame([("a",), ("b",)], "pk STRING")
    assert integrity(frame([("a",), ("b",), ("a",)], "fk STRING"), parent)["status"] == "PASS"
    out = integrity(frame([("a",), ("z",), ("z",), (None,), (None,)], "fk STRING"), parent)
    assert (out["status"], out["error_count"]) == ("FAIL", 3)
    assert json.loads(out["details"]) == {"sample_orphans": ["z"], "null_fk_count": 2}


def test_referential_integrity_shows_twenty_orphans(frame):
    out = integrity(frame([(i,) for i in range(50)], "fk INT"), frame([(100,)], "pk INT"))
    assert out["error_count"] == 50
    assert json.loads(out["details"])["sample_orphans"] == list(range(20))


def test_numbers_never_match_text(frame):
    out = integrity(frame([(1,), (2,), (3,)], "fk BIGINT"), frame([("1",), ("2",), ("3",)], "pk STRING"))
    assert (out["status"], out["error_count"]) == ("FAIL", 3)


@pytest.mark.parametrize("ids,errors", [([40, 7, -3, 0], 0), ([9, 8, 9, 8, 9], 3), ([5], 0), ([], 0), ([None, 6, None, None], 2)])
def test_duplicates(frame, ids, errors):
    out = only(checks.check_duplicates(frame([(i,) for i in ids], "id INT"), "t", "id"))
    assert (out["error_count"], out["status"]) == (errors, "FAIL" if errors else "PASS")


def test_schema_check(frame):
    df = frame([(1,)], "a INT")
    assert only(checks.check_schema(df, "t", ["a"]))["status"] == "PASS"
    out = only(checks.check_schema(df, "t", ["a", "gone"]))
    assert (out["status"], json.loads(out["details"])) == ("FAIL", {"missing_columns": ["gone"]})


def test_suite_has_27_checks_and_a_report(spark, tmp_path):
    raw = retail.raw_tables(spark, SMALL)
    at = datetime(2024, 5, 6, 7, 8, 9)
    path = str(tmp_path)
    stored = quality.write_report(quality.run_suite(raw), path, at)
    assert stored.count() == 27
    quality.write_report(stored.where("status = 'PASS'"), path + "/second", at)
    quality.write_report(quality.run_suite(raw), path, at)
    archive = spark.read.json(f"{path}/archive")
    assert archive.count() == 2
    assert set(archive.columns) == set(quality.ARCHIVE_FIELDS)
    latest = only(spark.read.json(f"{path}/latest").drop("checks"))
    assert latest["total_checks"] == 27 == latest["passed"] + latest["failed"]
    assert latest["overall_status"] == "FAIL"
    assert quality.failures_in_report(spark, path).count() == latest["failed"]
    assert only(spark.read.json(f"{path}/second/latest").drop("checks"))["overall_status"] == "PASS"


def test_suite_stops_at_a_table_without_its_columns(spark):
    raw = retail.raw_tables(spark, SMALL)
    raw["products"] = raw["products"].drop("price")
    found = [(r["check"], r["dataset"], r["status"]) for r in quality.run_suite(raw).collect()]
    assert sorted(found) == [("schema", "customers", "PASS"), ("schema", "products", "FAIL")]


ORDER = RAW["orders"]
GOOD = (1, 1, "2023-01-01", "delivered", 10.0, 0.0, "web")


@pytest.mark.parametrize("row,rule", [
    ((0, *GOOD[1:]), "order_id whole 1.."),
    ((1, None, *GOOD[2:]), "customer_id whole 1.."),
    ((*GOOD[:2], None, *GOOD[3:]), "order_date present"),
    ((*GOOD[:3], "lost", *GOOD[4:]), "status in list"),
    ((*GOOD[:4], 0.0, *GOOD[5:]), "total_amount > 0"),
    ((*GOOD[:4], float("nan"), *GOOD[5:]), "total_amount > 0"),
    ((*GOOD[:5], -1.0, "web"), "shipping_fee >= 0"),
    ((*GOOD[:6], "shop"), "channel in list"),
])
def test_order_contract(spark, row, rule):
    contract = contracts.RAW_CONTRACTS["orders"]
    df = spark.createDataFrame([GOOD, row], ORDER)
    broken = {r["rule"]: r["violations"] for r in contracts.count_violations(df, contract).collect()}
    assert {name for name, n in broken.items() if n} == {rule}
    assert contracts.valid_rows(df, contract).count() == 1
    assert contracts.quarantined_rows(df, contract).first()["violations"] == [rule]
    with pytest.raises(ValueError, match="orders: .* rows break the contract"):
        contracts.validate(df, contract)


def test_contract_limits_columns(spark):
    contract = contracts.RAW_CONTRACTS["orders"]
    df = spark.createDataFrame([GOOD], ORDER)
    contracts.validate(df, contract)
    with pytest.raises(ValueError, match="unknown columns: ..extra"):
        contracts.count_violations(df.selectExpr("*", "1 AS extra"), contract)
    with pytest.raises(ValueError, match="missing columns: ..channel"):
        contracts.count_violations(df.drop("channel"), contract)


def test_declared_constraints_let_null_pass(frame):
    df = frame([(1, None, None, None, None), (None, 0, -1.0, 2.0, -1.0)],
               "nk_order_id BIGINT, quantity INT, unit_price DOUBLE, discount DOUBLE, line_total DOUBLE")
    counts = contracts.count_violations(df, contracts.TABLE_CONSTRAINTS["fato_pedidos"])
    assert {r["violations"] for r in counts.collect()} == {1}


def test_profile(frame):
    df = frame([(1, None), (2, "x"), (None, "y")], "a INT, b STRING")
    out = only(profile.table_profile(df, "t", datetime(2024, 1, 1)))
    assert (out["rows"], out["columns"], out["null_pct_per_column"]) == (3, 2, {"a": 33.33, "b": 33.33})
    assert only(profile.table_profile(df.where("false"), "t"))["null_pct_per_column"] == {"a": 0.0, "b": 0.0}
    assert [tuple(r) for r in profile.value_shares(df, "b").collect()] == [("x", 1, 50.0), ("y", 1, 50.0)]
    assert [tuple(r) for r in profile.value_counts(df, "a").collect()] == [(1, 1), (2, 1)]


def test_columns_of_any_name(frame):
    df = frame([(1.0, None), (None, "x"), (3.0, "y")], "`it's` DOUBLE, `a ``tick``, b` STRING")
    assert rows(profile.null_profile(df, "o'brien")) == [("o'brien", "a `tick`, b", 33.33), ("o'brien", "it's", 33.33)]
    out = only(checks.check_null_rate(df, "t", 0.1))
    assert json.loads(out["details"]) == {"it's": 0.3333, "a `tick`, b": 0.3333}
    assert only(checks.check_numeric_range(df, "t", "it's", 2))["error_count"] == 2
    assert only(profile.numeric_summary(df))["p50"] == 2.0


def test_numeric_summary(spark):
    out = only(profile.numeric_summary(spark.range(1, 102).withColumnRenamed("id", "v")))
    assert (out["count"], out["mean"], out["min"], out["p25"], out["p50"], out["p75"], out["max"]) == (
        101, 51.0, 1.0, 26.0, 51.0, 76.0, 101.0)


def test_samples_do_not_depend_on_layout(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    shuffled = df.repartition(7)
    assert rows(sampling.key_fraction(df, "k", 0.6)) == rows(sampling.key_fraction(shuffled, "k", 0.6))
    assert abs(sampling.key_fraction(df, "k", 0.6).count() - 3000) < 200
    picked = sampling.n_rows(shuffled, "k", 200)
    assert rows(picked) == rows(sampling.n_rows(df, "k", 200))
    assert picked.count() == 200 and picked.columns == ["k"]
    assert rows(sampling.n_rows(df, "k", 200, seed=7)) != rows(picked)


def test_hash_key_is_long_enough():
    assert len(HASH_KEY) >= 32
