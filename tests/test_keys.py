"""Pseudonyms and surrogate keys against the standard library."""

from __future__ import annotations

import binascii
import hashlib
import hmac

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import HASH_KEY
from shopmart.functions.keys import crc32_key, pseudonym, wide_key

SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
TEXTS = st.lists(st.text(max_size=200), min_size=60, max_size=80)
NUMBERS = st.lists(st.integers(-(2**63), 2**63 - 1), min_size=60, max_size=80)


def expected_hmac(value: object, key: str = HASH_KEY) -> str:
    text = "" if value is None else str(value)
    return hmac.new(key.encode(), text.encode(), hashlib.sha256).hexdigest()


def expected_crc(value: object) -> int:
    return binascii.crc32(str(value).encode()) or 1


def apply(spark, expression, values, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {dtype}")
    return [r["out"] for r in df.selectExpr("i", f"{expression} AS out").orderBy("i").collect()]


@SLOW
@given(TEXTS)
def test_pseudonym_of_any_text_equals_stdlib(spark, values):
    assert apply(spark, pseudonym("v", HASH_KEY), values, "STRING") == [expected_hmac(v) for v in values]


@SLOW
@given(NUMBERS)
def test_pseudonym_of_any_integer_equals_stdlib(spark, values):
    assert apply(spark, pseudonym("v", HASH_KEY), values, "BIGINT") == [expected_hmac(v) for v in values]


def test_null_has_the_pseudonym_of_the_empty_text(spark):
    digests = apply(spark, pseudonym("v", HASH_KEY), [None, ""], "STRING")
    assert digests[0] == digests[1] == expected_hmac(None)


def test_key_longer_than_a_block(spark):
    key = "k" * 100
    assert apply(spark, pseudonym("v", key), ["São Paulo"], "STRING") == [expected_hmac("São Paulo", key)]


def test_short_key_is_refused():
    with pytest.raises(ValueError, match="32"):
        pseudonym("v", "short")


@SLOW
@given(TEXTS)
def test_crc_key_of_any_text(spark, values):
    found = apply(spark, crc32_key("v"), values, "STRING")
    assert found == [expected_crc(v) for v in values]
    assert all(key > 0 for key in found)


@SLOW
@given(st.lists(st.integers(1, 10_000_000), min_size=60, max_size=80))
def test_crc_key_of_any_integer(spark, values):
    assert apply(spark, crc32_key("v"), values, "BIGINT") == [expected_crc(v) for v in values]


def test_wide_key_is_positive_and_distinct(spark):
    keys = spark.range(50_000).selectExpr(f"{wide_key('id')} AS k")
    assert keys.where("k <= 0").count() == 0
    assert keys.distinct().count() == 50_000


def test_plans_mask_the_key(spark, frame):
    df = frame([(1,)], "v INT").selectExpr(f"{pseudonym('v', HASH_KEY)} AS p")
    shown = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    inner = bytes(b ^ 0x36 for b in HASH_KEY.encode()).hex()
    assert inner not in shown.lower() and "redacted" in shown
