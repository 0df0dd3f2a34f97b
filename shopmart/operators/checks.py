"""Data quality checks. Every check yields rows of one fixed result schema.

Null rates, ranges and key nulls of a table are folded into a single aggregate over it, and all
checks that compare keys across rows or tables follow from one presence aggregate over the key
columns. A suite so reads each table twice, once for its cells and once for its keys.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from shopmart.functions.scalars import column_name, lenient_number, text_literal
from shopmart.operators.presence import KeyPresence, Reference, violations
from shopmart.operators.profile import aggregate, null_counts

DEFAULT_NULL_THRESHOLD = 0.10

# Field order of a result record, the check's own parameters last.
_RESULT_FIELDS = {
    "check": "STRING",
    "dataset": "STRING",
    "status": "STRING",
    "error_count": "BIGINT",
    "details": "STRING",
    "checked_at": "TIMESTAMP",
    "threshold": "DOUBLE",
    "column": "STRING",
    "min_val": "DOUBLE",
    "max_val": "DOUBLE",
    "parent": "STRING",
    "fk_col": "STRING",
    "pk_col": "STRING",
}


@dataclass(frozen=True)
class Range:
    column: str
    low: float | None = None
    high: float | None = None


def require_columns(df: DataFrame, columns: Sequence[str], dataset: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{dataset} lacks the columns {missing}")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return "'{}'".format(value.replace("\\", "\\\\").replace("'", "\\'")) if isinstance(value, str) else str(value)


def result(
    check: str,
    dataset: str,
    errors: str,
    details: str = "'{}'",
    checked_at: datetime | None = None,
    **parameters: object,
) -> str:
    """One result record as a struct expression; a check passes when it found no errors.

    ``errors`` and ``details`` are SQL expressions, ``parameters`` plain values.
    """
    values = {
        "check": _literal(check),
        "dataset": _literal(dataset),
        "status": f"if({errors} = 0, 'PASS', 'FAIL')",
        "error_count": errors,
        "details": details,
        "checked_at": f"TIMESTAMP '{checked_at}'" if checked_at else "current_timestamp()",
        **{name: _literal(value) for name, value in parameters.items()},
    }
    fields = [f"'{name}', CAST({values.get(name, 'NULL')} AS {dtype})" for name, dtype in _RESULT_FIELDS.items()]
    return f"named_struct({', '.join(fields)})"


def schema_result(df: DataFrame, dataset: str, required: Sequence[str], checked_at: datetime | None = None) -> str:
    missing = missing_columns(df, required)
    details = json.dumps({"missing_columns": missing}, separators=(",", ":"))
    return result("schema", dataset, str(len(missing)), _literal(details), checked_at)


def _out_of_range(rule: Range) -> str:
    number = lenient_number(column_name(rule.column))
    bad = [f"{number} IS NULL"]
    if rule.low is not None:
        bad.append(f"{number} < {rule.low}")
    if rule.high is not None:
        bad.append(f"{number} > {rule.high}")
    return f"count_if({' OR '.join(bad)})"


def table_checks(
    df: DataFrame,
    dataset: str,
    required: Sequence[str] | None = None,
    null_threshold: float | None = None,
    ranges: Sequence[Range] = (),
    checked_at: datetime | None = None,
) -> DataFrame:
    """Schema, null-rate and range results of one table from one aggregate pass."""
    require_columns(df, [rule.column for rule in ranges], dataset)
    aggregates = ["count(1) AS rows"]
    results = []
    if required is not None:
        results.append(schema_result(df, dataset, required, checked_at))
    if null_threshold is not None:
        aggregates += null_counts(df)
        rates = ", ".join(
            f"named_struct('key', {text_literal(c)}, 'value', try_divide({column_name(f'nulls_{c}')}, rows))"
            for c in df.columns
        )
        # Over the threshold, not on it; an empty table has no rate and passes.
        over = f"filter(array({rates}), r -> coalesce(r.value > {null_threshold}D, false))"
        shown = f"transform({over}, r -> named_struct('key', r.key, 'value', round(r.value * 10000) / 10000))"
        results.append(
            result(
                "null_rate", dataset, f"size({over})", f"to_json(map_from_entries({shown}))", checked_at,
                threshold=float(null_threshold),
            )
        )
    for i, rule in enumerate(ranges):
        aggregates.append(f"{_out_of_range(rule)} AS range_{i}")
        results.append(
            result(
                "numeric_range", dataset, f"range_{i}", "'{}'", checked_at,
                column=rule.column, min_val=rule.low, max_val=rule.high,
            )
        )
    return aggregate(df, aggregates).selectExpr(f"inline(array({', '.join(results)}))")


def check_schema(df: DataFrame, dataset: str, required: Sequence[str], checked_at: datetime | None = None) -> DataFrame:
    return table_checks(df, dataset, required=required, checked_at=checked_at)


def check_null_rate(
    df: DataFrame, dataset: str, threshold: float = DEFAULT_NULL_THRESHOLD, checked_at: datetime | None = None
) -> DataFrame:
    return table_checks(df, dataset, null_threshold=threshold, checked_at=checked_at)


def check_numeric_range(
    df: DataFrame,
    dataset: str,
    column: str,
    min_val: float | None = None,
    max_val: float | None = None,
    checked_at: datetime | None = None,
) -> DataFrame:
    return table_checks(df, dataset, ranges=[Range(column, min_val, max_val)], checked_at=checked_at)


def key_checks(
    tables: Mapping[str, DataFrame],
    references: Sequence[Reference],
    unique: Sequence[tuple[str, str]] = (),
    checked_at: datetime | None = None,
) -> DataFrame:
    """Referential-integrity results, then duplicate results, all from one presence aggregate.

    Errors of a reference are distinct orphan keys plus rows with a null key; details show the
    smallest orphans. Errors of a unique key are rows that repeat an earlier key.
    """
    for r in references:
        require_columns(tables[r.child], [r.fk], r.child)
        require_columns(tables[r.parent], [r.pk], r.parent)
    for name, column in unique:
        require_columns(tables[name], [column], name)
    presence = KeyPresence(tables, references, unique)
    records = []
    for (domain, *_), r in zip(presence.references, references, strict=True):
        sample = presence.key(domain).replace("key", "sample")
        records.append(result(
            "referential_integrity", r.child, "orphans + null_keys",
            f"to_json(named_struct('sample_orphans', {sample}, 'null_fk_count', null_keys))", checked_at,
            parent=r.parent, fk_col=r.fk, pk_col=r.pk,
        ))
    records += [result("duplicates", name, "extra", "'{}'", checked_at, pk_col=column) for name, column in unique]
    cases = " ".join(f"WHEN {n} THEN {record}" for n, record in enumerate(records))
    return violations(presence).selectExpr(f"inline(array(CASE check {cases} END))")


def orphan_keys(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Distinct non-null child keys that the parent lacks, with the rows that carry them."""
    presence = KeyPresence({"child": child, "parent": parent}, [Reference("child", fk, "parent", pk)])
    domain, slot, known = presence.references[0]
    missing = f"n{slot} > 0" + (f" AND n{known} = 0" if known >= 0 else "")
    key = presence.key(domain)
    return presence.frame.where(f"domain = {domain} AND {key} IS NOT NULL AND {missing}").selectExpr(
        f"{key} AS key", f"n{slot} AS rows"
    )


def check_referential_integrity(
    child: DataFrame,
    parent: DataFrame,
    fk_col: str,
    pk_col: str,
    child_name: str,
    parent_name: str,
    checked_at: datetime | None = None,
) -> DataFrame:
    """One reference by itself; a suite checks all its references at once with ``key_checks``."""
    if child_name == parent_name and child is not parent:
        raise ValueError(f"two tables are named {child_name}")
    return key_checks(
        {child_name: child, parent_name: parent}, [Reference(child_name, fk_col, parent_name, pk_col)], (), checked_at
    )


def check_duplicates(df: DataFrame, dataset: str, pk_col: str, checked_at: datetime | None = None) -> DataFrame:
    return key_checks({dataset: df}, (), [(dataset, pk_col)], checked_at)
