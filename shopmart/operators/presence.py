"""Which tables hold a key: one aggregate from which all key checks of a data set follow.

Columns whose values are compared with each other form a domain, such as an order's id wherever it
stands. Every table is read once and gives a row (domain, slot, key) for each of its key columns;
the slot tells the table and column within the domain. One shuffle brings equal keys together
and counts them for each slot, copies being added up before the shuffle, so a key that fills a third
of a table is one row from each task. From the counts follow orphans (rows in the child's slot, none in the parent's),
repeated keys (more than one row in a slot), null keys (the domain's group without a key) and samples
of each. Nothing is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, NumericType

from shopmart.functions.scalars import column_name

SAMPLE_ORPHANS = 20


@dataclass(frozen=True)
class Reference:
    child: str
    fk: str
    parent: str
    pk: str


def common_type(a: DataType, b: DataType) -> str | None:
    """The type in which two columns are compared: numbers with numbers, otherwise equal types only."""
    if not (isinstance(a, NumericType) and isinstance(b, NumericType)):
        return a.simpleString() if a == b else None
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return "bigint"
    if any(isinstance(t, FractionalType) and not isinstance(t, DecimalType) for t in (a, b)):
        return "double"
    return f"decimal(38,{max(t.scale for t in (a, b) if isinstance(t, DecimalType))})"


class KeyPresence:
    """``frame`` has a row for each domain and key: the key in the column of its type, and n0, n1, ... rows by slot."""

    def __init__(
        self, tables: Mapping[str, DataFrame], references: Sequence[Reference], unique: Sequence[tuple[str, str]] = ()
    ):
        self.domains: list[str] = []  # the type of each domain
        self._slots: list[list[tuple[str, str]]] = []
        self._parents: dict[tuple[str, str, str], int] = {}
        self.references: list[tuple[int, int, int]] = []  # domain, the child's slot, the parent's (-1: not comparable)
        for r in references:
            child, parent = tables[r.child].schema[r.fk].dataType, tables[r.parent].schema[r.pk].dataType
            if (kind := common_type(child, parent)) is None:
                domain = self._domain(child.simpleString())
                self.references.append((domain, self._slot(domain, r.child, r.fk), -1))
                continue
            domain = self._domain_of(r.parent, r.pk, kind)
            self.references.append((domain, self._slot(domain, r.child, r.fk, second=True), 0))
        self.unique: list[tuple[int, int]] = []  # domain, slot
        for table, column in unique:
            kind = common_type(*[tables[table].schema[column].dataType] * 2)
            self.unique.append((self._domain_of(table, column, kind), 0))
        self.kinds = sorted(set(self.domains))
        self.width = max(map(len, self._slots))
        self.frame = self._count(tables)

    def _domain(self, kind: str) -> int:
        self.domains.append(kind)
        self._slots.append([])
        return len(self.domains) - 1

    def _domain_of(self, table: str, column: str, kind: str) -> int:
        """The domain whose first slot is this column, in this type."""
        if (table, column, kind) not in self._parents:
            domain = self._parents[table, column, kind] = self._domain(kind)
            self._slot(domain, table, column)
        return self._parents[table, column, kind]

    def _slot(self, domain: int, table: str, column: str, second: bool = False) -> int:
        """The slot of a column; a key that refers to itself has a second one beside the first."""
        slots = self._slots[domain]
        begin = 1 if second else 0
        if (table, column) in slots[begin:]:
            return slots.index((table, column), begin)
        slots.append((table, column))
        return len(slots) - 1

    def key(self, domain: int) -> str:
        """The column that holds a domain's keys."""
        return f"key{self.kinds.index(self.domains[domain])}"

    def _count(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        parts = []
        for name, df in tables.items():
            held = [
                (d, s, column) for d, slots in enumerate(self._slots) for s, (table, column) in enumerate(slots) if table == name
            ]
            if held:
                tagged = ", ".join(self._tagged(d, s, column) for d, s, column in held)
                parts.append(df.selectExpr(f"inline(array({tagged}))"))
        keys = [f"key{i}" for i in range(len(self.kinds))]
        counts = [f"count_if(slot = {s}) AS n{s}" for s in range(self.width)]
        return reduce(DataFrame.union, parts).groupBy("domain", *keys).agg(*map(F.expr, counts))

    def _tagged(self, domain: int, slot: int, column: str) -> str:
        keys = ", ".join(
            f"'key{i}', CAST({column_name(column) if kind == self.domains[domain] else 'NULL'} AS {kind})"
            for i, kind in enumerate(self.kinds)
        )
        return f"named_struct('domain', {domain}, 'slot', {slot}, {keys})"


def violations(presence: KeyPresence) -> DataFrame:
    """For each check (references first, then unique keys): orphans, null_keys, extra, and sample0, ... of orphans.

    ``orphans`` counts distinct keys, ``null_keys`` rows without a key, ``extra`` rows that repeat a
    key, the missing one included. A sample holds the smallest orphans of keys of one type.
    """
    checks: dict[int, list[str]] = {}
    for n, (domain, child, parent) in enumerate(presence.references):
        missing = f"n{child} > 0" + (f" AND n{parent} = 0" if parent >= 0 else "")
        key = presence.key(domain)
        checks.setdefault(domain, []).append(
            f"named_struct('check', {n}, 'orphans', CAST({key} IS NOT NULL AND {missing} AS BIGINT),"
            f" 'null_keys', if({key} IS NULL, n{child}, 0L), 'extra', 0L)"
        )
    for n, (domain, slot) in enumerate(presence.unique, len(presence.references)):
        checks.setdefault(domain, []).append(
            f"named_struct('check', {n}, 'orphans', 0L, 'null_keys', 0L, 'extra', greatest(n{slot} - 1, 0L))"
        )
    by_domain = " ".join(f"WHEN {domain} THEN array({', '.join(found)})" for domain, found in checks.items())
    # Only checks that the key fails leave this projection.
    failed = f"filter(CASE domain {by_domain} END, c -> c.orphans + c.null_keys + c.extra > 0)"
    keys = [f"key{i}" for i in range(len(presence.kinds))]
    found = presence.frame.selectExpr(*keys, f"inline({failed})")
    numbers = ("orphans", "null_keys", "extra")
    counts = found.groupBy("check").agg(*[F.expr(f"sum({c}) AS {c}") for c in numbers])
    no_keys = [f"CAST(NULL AS {kind}) AS {key}" for key, kind in zip(keys, presence.kinds, strict=True)]
    # Each task keeps its smallest orphans of a check, so what is sorted never grows with the tables.
    place = f"row_number() OVER (PARTITION BY check ORDER BY {', '.join(keys)}) AS place"
    sample = found.where("orphans > 0").selectExpr("check", *keys, place).where(f"place <= {SAMPLE_ORPHANS}")
    every = presence.frame.sparkSession.range(len(presence.references) + len(presence.unique))
    parts = [
        counts.selectExpr("check", *numbers, *no_keys),
        sample.selectExpr("check", *[f"0L AS {c}" for c in numbers], *keys),
        every.selectExpr("CAST(id AS INT) AS check", *[f"0L AS {c}" for c in numbers], *no_keys),
    ]
    samples = [f"sort_array(collect_list({key})) AS sample{i}" for i, key in enumerate(keys)]
    return reduce(DataFrame.union, parts).groupBy("check").agg(*map(F.expr, [*[f"sum({c}) AS {c}" for c in numbers], *samples]))
