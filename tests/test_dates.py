"""Dates in the format that their column votes for."""

from __future__ import annotations

from datetime import datetime

import pytest

from conftest import HASH_KEY, rows
from shopmart.operators import dates
from shopmart.plans import silver
from shopmart.schemas import RAW


def column(frame, values):
    return frame([(v,) for v in values], "at STRING")


@pytest.mark.parametrize("values,form,read", [
    (["2024-03-05", "2024-03-06 10:00:00"], "iso", [datetime(2024, 3, 5), datetime(2024, 3, 6, 10)]),
    (["05/03/2024", "25/03/2024"], "day/month/year", [datetime(2024, 3, 5), datetime(2024, 3, 25)]),
    (["05/03/2024", "05/23/2024", "x"], "month/day/year", [datetime(2024, 5, 3), datetime(2024, 5, 23)]),
    (["05/03/2024", "5/4/2024 7:05"], "month/day/year", [datetime(2024, 5, 3), datetime(2024, 5, 4, 7, 5)]),
    (["2024/03/05", "2024/3/6 10:11:12"], "year/month/day", [datetime(2024, 3, 5), datetime(2024, 3, 6, 10, 11, 12)]),
    (["20240305", "20241399"], "yearmonthday", [datetime(2024, 3, 5)]),
    (["Mar 5, 2024", "Dec 25, 2024"], "month name day, year", [datetime(2024, 3, 5), datetime(2024, 12, 25)]),
    (["5 Mar 2024"], "day month name year", [datetime(2024, 3, 5)]),
    (["25-03-2024", "01-02-2024"], "day-month-year", [datetime(2024, 2, 1), datetime(2024, 3, 25)]),
    ([" 25.03.2024 "], "day.month.year", [datetime(2024, 3, 25)]),
    (["n/a", None, ""], "iso", []),
    ([], "iso", []),
])
def test_votes(frame, values, form, read):
    df = column(frame, values)
    assert dates.voted(df, ["at"]) == {"at": form}
    moment = silver.moment_as("at", form)
    assert sorted(r[0] for r in df.selectExpr(f"{moment} AS m").where("m IS NOT NULL").collect()) == read
    lost = silver.coercion_losses(df, "t", dates=["at"], formats={"at": form}).first()["lost"]
    assert lost == sum(v is not None for v in values) - len(read)


def test_the_majority_decides_and_the_rest_is_counted(frame):
    df = column(frame, ["2024-01-01"] * 3 + ["13/01/2024"] * 4 + ["01/02/2024"] * 2 + [None])
    found = {r["format"]: (r["parsed"], r["lost"]) for r in dates.votes(df, "t", ["at"]).collect()}
    assert found["iso"] == (3, 6) and found["day/month/year"] == (6, 3) and found["month/day/year"] == (2, 7)
    assert dates.voted(df, ["at"]) == {"at": "day/month/year"}


def test_orders_are_cleaned_by_the_voted_format(spark):
    raw = spark.createDataFrame([(i, 1, f"{i:02d}/02/2024", "delivered", 5.0, 0.0, "web") for i in range(10, 16)], RAW["orders"])
    found = silver.clean("orders", raw, HASH_KEY, dates.voted(raw, silver.DATES["orders"]))
    assert rows(found.select("order_id", "order_date")) == [(i, datetime(2024, 2, i)) for i in range(10, 16)]
    assert found.schema["order_date"].dataType.simpleString() == "timestamp"
