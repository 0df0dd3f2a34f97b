"""The numbered queries that SQL can express, against DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest
from conftest import SMALL
from text_cases import documents, frame_of

from shopmart.llm import queries


def same(spark, name, folder):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        path = f"{folder}/{table}.parquet"
        file = path if os.path.isfile(path) else f"{path}/*.parquet"
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{file}'")
    theirs = duck.sql(queries.oracle_sql()[name])
    ours = queries.queries()[name](spark, folder)
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected = theirs.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(str, map(tuple, ours.select(*columns).collect()))) == sorted(map(str, expected))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_given_tables(spark, name):
    same(spark, name, SMALL)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_awkward_rows(spark, name, tmp_path):
    frame_of(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(i, [0.1 * (i % 7), -0.3, 1.0], 0) for i in range(230)] + [(300, None, 0), (400, [None, 1.0, 1.0], 0), (None, [1.0] * 3, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    items = [(i, text) for i, (_, text, *_) in enumerate(documents())] + [(3, "over"), (None, "rights reserved")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    same(spark, name, str(tmp_path))
