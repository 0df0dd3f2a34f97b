"""CSV files cut anywhere, also inside quoted line breaks, against Python's csv module."""

from __future__ import annotations

import csv
import random

import pytest

from conftest import plan_of, rows
from shopmart.schemas import RAW
from shopmart.sources import split_csv, tables

OPTIONS = {"escape": '"', "lineSep": "\n", "nullValue": "\u0000", "emptyValue": ""}
PIECES = ["a", " b ", "x\ny", "\n", "\n\n", 'say "hi"', '"', '""\n""', ",", "é\n𝄞", "long " * 9, ""]


def write(path, count, seed, header=("id", "text", "more")):
    draw = random.Random(seed)
    path.mkdir(exist_ok=True)
    data = []
    with open(path / f"{seed}.csv", "w", newline="") as file:
        out = csv.writer(file, lineterminator="\n", quoting=csv.QUOTE_NONNUMERIC)
        out.writerow(header)
        for i in range(count):
            row = [str(i), "".join(draw.choice(PIECES) for _ in range(draw.randrange(6))), draw.choice(PIECES)]
            data.append(tuple(row))
            out.writerow(row)
    return data


@pytest.fixture
def cut(spark):
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield at
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("size", [37, 100, 1000, 10**8])
def test_any_cut_gives_the_same_records(spark, tmp_path, cut, size):
    data = [row for seed in (1, 2) for row in write(tmp_path / "csv", 60, seed)]
    cut(size)
    read = split_csv.read(spark, str(tmp_path / "csv"), ["id", "text", "more"], OPTIONS)
    assert sorted(map(tuple, read.collect())) == sorted(data)


def test_a_field_over_many_ranges_and_files_of_one_line(spark, tmp_path, cut):
    folder = tmp_path / "csv"
    folder.mkdir()
    long = "line\n" * 200
    (folder / "a.csv").write_text(f'id,text\n1,"{long}"\n2,x\n3,"{long}"')
    (folder / "b.csv").write_text("id,text\n")
    (folder / "c.csv").write_text("")
    cut(50)
    read = split_csv.read(spark, str(folder), ["id", "text"], OPTIONS)
    assert sorted(map(tuple, read.collect())) == [("1", long), ("2", "x"), ("3", long)]


def test_more_tasks_than_files_and_another_header(spark, tmp_path, cut):
    write(tmp_path / "csv", 80, 1)
    cut(200)
    assert spark.read.text(str(tmp_path / "csv")).rdd.getNumPartitions() > 5
    write(tmp_path / "csv", 3, 9, header=("id", "text", "other"))
    with pytest.raises(Exception, match="another header"):
        split_csv.read(spark, str(tmp_path / "csv"), ["id", "text", "more"], OPTIONS).collect()


def test_large_files_are_split_by_themselves(spark, tmp_path, cut):
    reviews = [(i, i, i, i, i % 5, f"  two\nlines {i} \"q\" " if i % 3 else None, "2024-01-01") for i in range(400)]
    df = spark.createDataFrame(reviews, RAW["reviews"]).coalesce(1)
    path = str(tmp_path / "csv")
    tables.write_csv(df, path)
    whole = tables.read_csv(spark, path, "reviews")
    assert "BatchScan" in plan_of(whole) or "FileScan csv" in plan_of(whole)
    cut(2000)
    parted = tables.read_csv(spark, path, "reviews")
    assert "FileScan text" in plan_of(parted)
    assert rows(parted) == rows(whole) == rows(df)
    assert rows(tables.read_csv(spark, path, "reviews", split=False)) == rows(df)


def test_written_files_are_bounded(spark, tmp_path):
    path = tmp_path / "csv"
    df = spark.range(95).selectExpr("id AS order_id").coalesce(1)
    tables.write_csv(df, str(path), rows_per_file=20)
    assert len(list(path.glob("part-*.csv"))) == 5
    assert tables.read_csv(spark, str(path), "orders").count() == 95


def test_sizes():
    assert [tables._bytes(x) for x in ("134217728b", "128m", "1g", "7", "2K", "16MB")] == [1 << 27, 1 << 27, 1 << 30, 7, 2048, 16 << 20]
