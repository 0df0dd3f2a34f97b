"""Row contracts: named conditions on a table, counted or used to split it.

A contract is data: rules with a SQL condition each. Where a required value is null or does
not parse, the condition is null and the row breaks the rule. All rules of a table are
counted in one pass over it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from shopmart.operators.profile import aggregate
from shopmart.schemas import CHANNELS, ORDER_STATUSES, PAYMENT_METHODS, PAYMENT_STATUSES


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    null_passes: bool = False

    def broken(self) -> str:
        return f"NOT coalesce({self.condition}, {str(self.null_passes).lower()})"


@dataclass(frozen=True)
class Contract:
    dataset: str
    columns: tuple[str, ...]
    rules: tuple[Rule, ...]
    closed: bool = True  # no columns beyond the listed ones


def _whole(name: str, low: int | None = None, high: int | None = None) -> Rule:
    number = f"try_cast({name} AS DOUBLE)"
    parts = [f"{number} = floor({number})"]
    if low is not None:
        parts.append(f"{number} >= {low}")
    if high is not None:
        parts.append(f"{number} <= {high}")
    span = f"{'' if low is None else low}..{'' if high is None else high}"
    return Rule(f"{name} whole {span}", " AND ".join(parts))


def _number(name: str, test: str) -> Rule:
    number = f"try_cast({name} AS DOUBLE)"
    return Rule(f"{name} {test}", f"NOT isnan({number}) AND {number} {test}")


def _text(name: str) -> Rule:
    return Rule(f"{name} present", f"{name} IS NOT NULL")


def _one_of(name: str, values: tuple[str, ...]) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"{name} in list", f"{name} IN ({listed})")


def _contract(dataset: str, *rules: Rule, closed: bool = True) -> Contract:
    columns = tuple(dict.fromkeys(rule.name.split(" ")[0] for rule in rules))
    return Contract(dataset, columns, rules, closed)


RAW_CONTRACTS = {
    contract.dataset: contract
    for contract in (
        _contract(
            "customers", _whole("customer_id", 1), _text("name"), _text("email"), _text("phone"), _text("city"),
            Rule("state length 2", "length(state) = 2"), _text("birth_date"), _text("created_at"),
        ),
        _contract(
            "products", _whole("product_id", 1), _text("name"), _text("category"), _text("subcategory"),
            _number("price", "> 0"), _number("cost", ">= 0"), _whole("stock_qty", 0), _text("created_at"),
            Rule("cost up to price", "try_cast(cost AS DOUBLE) <= try_cast(price AS DOUBLE)"),
        ),
        _contract(
            "orders", _whole("order_id", 1), _whole("customer_id", 1), _text("order_date"),
            _one_of("status", ORDER_STATUSES), _number("total_amount", "> 0"), _number("shipping_fee", ">= 0"),
            _one_of("channel", CHANNELS),
        ),
        _contract(
            "order_items", _whole("item_id", 1), _whole("order_id", 1), _whole("product_id", 1),
            _whole("quantity", 1), _number("unit_price", "> 0"), _number("discount", "BETWEEN 0 AND 1"),
            _number("line_total", ">= 0"),
        ),
        _contract(
            "payments", _whole("payment_id", 1), _whole("order_id", 1), _one_of("method", PAYMENT_METHODS),
            _one_of("status", PAYMENT_STATUSES), _number("amount", "> 0"), _text("paid_at"),
        ),
        _contract(
            "reviews", _whole("review_id", 1), _whole("order_id", 1), _whole("customer_id", 1),
            _whole("product_id", 1), _whole("rating", 1, 5), _text("comment"), _text("created_at"),
        ),
    )
}

DIMENSION_CONTRACTS = {
    contract.dataset: contract
    for contract in (
        _contract(
            "dim_clientes", _whole("sk_cliente", 1), _text("nk_customer_id"), _text("city"), _text("state"),
            closed=False,
        ),
        _contract(
            "dim_produtos", _whole("sk_produto", 1), _whole("nk_product_id", 1), _text("nm_produto"),
            _text("category"), _text("subcategory"), _number("price", "> 0"), _number("cost", ">= 0"),
            _text("margem_pct"), closed=False,
        ),
        _contract(
            "dim_tempo", _whole("sk_tempo", 1), _text("dt_data"), _whole("ano"), _whole("mes", 1, 12),
            _whole("dia", 1, 31), _whole("trimestre", 1, 4), _whole("semana_ano"), _whole("dia_semana", 0, 6),
            _text("nm_dia_semana"), _text("nm_mes"), _text("fl_fimdesemana"), closed=False,
        ),
    )
}


def _check(name: str, condition: str) -> Rule:
    return Rule(f"{name} check", condition, null_passes=True)


# What the warehouse DDL declares: a CHECK lets null pass, NOT NULL does not.
TABLE_CONSTRAINTS = {
    contract.dataset: contract
    for contract in (
        _contract("dim_clientes", _text("nk_customer_id"), closed=False),
        _contract(
            "dim_produtos", _text("nk_product_id"), _text("nm_produto"), _check("price", "price >= 0"),
            _check("cost", "cost >= 0"), closed=False,
        ),
        _contract(
            "dim_tempo", _text("dt_data"), _text("ano"), _text("mes"), _text("dia"), _text("trimestre"),
            _check("mes", "mes BETWEEN 1 AND 12"), _check("dia", "dia BETWEEN 1 AND 31"),
            _check("trimestre", "trimestre BETWEEN 1 AND 4"), _check("dia_semana", "dia_semana BETWEEN 0 AND 6"),
            closed=False,
        ),
        _contract(
            "fato_pedidos", _text("nk_order_id"), _check("quantity", "quantity > 0"),
            _check("unit_price", "unit_price >= 0"), _check("discount", "discount BETWEEN 0 AND 1"),
            _check("line_total", "line_total >= 0"), closed=False,
        ),
    )
}


def check_columns(df: DataFrame, contract: Contract) -> None:
    missing = [c for c in contract.columns if c not in df.columns]
    extra = [c for c in df.columns if c not in contract.columns] if contract.closed else []
    if missing or extra:
        raise ValueError(f"[{contract.dataset}] missing columns: {missing}, unknown columns: {extra}")


def count_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per rule: broken rows and rows checked."""
    check_columns(df, contract)
    counts = [f"count_if({rule.broken()}) AS r{i}" for i, rule in enumerate(contract.rules)]
    lines = ", ".join(
        f"named_struct('rule', '{rule.name}', 'violations', r{i})" for i, rule in enumerate(contract.rules)
    )
    return aggregate(df, ["count(1) AS rows", *counts]).selectExpr("rows", f"inline(array({lines}))").selectExpr(
        f"'{contract.dataset}' AS dataset", "rule", "violations", "rows AS rows_checked"
    )


def with_violations(df: DataFrame, contract: Contract, also: Sequence[str] = ()) -> DataFrame:
    """Add ``violations``, the names of the rules a row breaks; ``also`` names columns beyond the contract."""
    check_columns(df.drop(*also), contract)
    names = ", ".join(f"if({rule.broken()}, '{rule.name}', NULL)" for rule in contract.rules)
    return df.selectExpr("*", f"array_compact(array({names})) AS violations")


def valid_rows(df: DataFrame, contract: Contract) -> DataFrame:
    return with_violations(df, contract).where("size(violations) = 0").drop("violations")


def quarantined_rows(df: DataFrame, contract: Contract) -> DataFrame:
    return with_violations(df, contract).where("size(violations) > 0")


def validate(df: DataFrame, contract: Contract) -> None:
    """Raise ValueError with the count and three examples if any row of the table breaks the contract."""
    bad = quarantined_rows(df, contract)
    first = [row.asDict() for row in bad.limit(3).collect()]
    if first:
        raise ValueError(f"{contract.dataset}: {bad.count()} rows break the contract, such as {first}")
