"""Samples that do not depend on how a table is laid out."""

from __future__ import annotations

from pyspark.sql import DataFrame

_HASHES = 1 << 32  # values of CRC-32


def _hash(key: str, seed: int) -> str:
    return f"crc32(CAST(concat_ws(':', CAST({key} AS STRING), '{seed}') AS BINARY))"


def key_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Rows whose hashed key falls in the first ``fraction`` of the hash range.

    The choice follows from key and seed alone, so reruns and other file layouts select the
    same rows and tables sampled on one key stay joinable. It is a filter: nothing moves.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    return df.where(f"{_hash(key, seed)} < {round(fraction * _HASHES)}")


def n_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in hash order of a key. Every task keeps only its best ``n`` before the merge."""
    order = ["_hash", *df.columns]
    return df.selectExpr("*", f"{_hash(key, seed)} AS _hash").orderBy(*order).limit(n).drop("_hash")
