"""The date format of a text column, voted by its values.

One aggregate over a table counts, for each date column and each known format, how many values the
format reads. The format that reads most is the column's; where day and month could be either way round, the
values with a day above 12 decide. A value in another format than the column's is lost, and counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from shopmart.functions.scalars import DATE_FORMATS, ISO, column_name, moment_as, text_literal
from shopmart.operators.profile import aggregate


def votes(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    """dataset, column_name, format, parsed, lost: for each column and format the values it reads and does not."""
    lines = []
    for name in columns:
        value = column_name(name)
        for form in DATE_FORMATS:
            lines.append(
                f"named_struct('column_name', {text_literal(name)}, 'format', '{form}',"
                f" 'parsed', count({moment_as(value, form)}), 'lost', count({value}) - count({moment_as(value, form)}))"
            )
    return aggregate(df, [f"array({', '.join(lines)}) AS lines"]).selectExpr(f"{text_literal(dataset)} AS dataset", "inline(lines)")


def voted(df: DataFrame, columns: Sequence[str]) -> Mapping[str, str]:
    """The format of each column. Brings a few counts for each column to the driver."""
    order = list(DATE_FORMATS)
    best: dict[str, tuple[int, int, str]] = {}
    for row in votes(df, "", columns).collect():
        vote = (row["parsed"], -order.index(row["format"]), row["format"])
        best[row["column_name"]] = max(best.get(row["column_name"], vote), vote)
    return {name: form if parsed else ISO for name, (parsed, _, form) in best.items()}
