"""Reference SQL for DuckDB: what each registered query must return.

Every statement is built from common table expressions over the given tables. They restate
the raw adapter, the cleaners and the star schema independently of the Spark code.
"""

from __future__ import annotations

import hashlib

from shopmart.operators.checks import DEFAULT_NULL_THRESHOLD

UNKNOWN = 1_000_000_000


def _crc_table() -> str:
    """Byte table of the reflected CRC-32 polynomial, as a list literal."""
    entries = []
    for byte in range(256):
        value = byte
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        entries.append(str(value))
    return "[" + ",".join(entries) + "]::BIGINT[]"


def crc(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = f"xor(a >> 8, list_extract({_crc_table()}, (xor(a, b) & 255) + 1))"
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {step}), 4294967295::BIGINT)"
    )


def crc_key(text: str) -> str:
    return f"greatest({crc(text)}, 1)"


def hmac(value: str, key: str) -> str:
    raw = key.encode()
    if len(raw) > 64:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in raw).hex()
    outer = bytes(b ^ 0x5C for b in raw).hex()
    message = f"encode(coalesce(CAST({value} AS VARCHAR), ''))"
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || {message})))"


def cents(value: str) -> str:
    return f"CAST(round({value} * 100) AS BIGINT)"


def first_by(table: str, key: str, others: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in others.split(","))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn"
        f" FROM {table}) WHERE rn = 1"
    )


COPIES = "(VALUES (0), (1)) AS v(copy)"
NOT_SOLD = "('cancelled', 'returned')"


def ctes(key: str) -> dict[str, str]:
    return {
        "raw_customers": f"""
            SELECT c_custkey AS customer_id, c_name AS name,
              CASE WHEN c_custkey % 50 <> 7 THEN lower(replace(c_name, '#', '_')) || '@example.com' END AS email,
              CAST(c_custkey AS VARCHAR) AS phone, n_name AS city, upper(substr(r_name, 1, 2)) AS state,
              CASE WHEN c_custkey % 97 = 0 THEN 'unknown'
                ELSE CAST(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS VARCHAR) END AS birth_date,
              CAST(DATE '1990-01-01' + CAST(c_custkey % 1825 AS INTEGER) AS VARCHAR) AS created_at
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, {COPIES}
            WHERE copy = 0 OR c_custkey % 20 = 0""",
        # The raw tables with the order of delivery, by which the first row of a key is kept.
        "seq_products": f"""
            SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS subcategory,
              CASE WHEN p_partkey % 13 = 0 THEN -pc ELSE pc END / 100.0::DOUBLE AS price,
              CASE WHEN p_partkey % 17 = 0 THEN pc * 2 ELSE pc * (30 + p_partkey % 50) // 100 END / 100.0::DOUBLE AS cost,
              CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size + 1 - copy AS INTEGER) END AS stock_qty,
              CAST(DATE '1990-01-01' + CAST(p_partkey % 1825 AS INTEGER) AS VARCHAR) AS created_at, copy AS load_seq
            FROM (SELECT *, {cents("p_retailprice")} AS pc FROM part), {COPIES}
            WHERE copy = 0 OR p_partkey % 19 = 0""",
        "seq_orders": f"""
            SELECT o_orderkey AS order_id,
              o_custkey + CASE WHEN o_orderkey % 103 = 0 THEN {UNKNOWN} ELSE 0 END AS customer_id,
              CASE WHEN o_orderkey % 107 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS order_date,
              CASE o_orderstatus WHEN 'F' THEN 'delivered'
                WHEN 'O' THEN CASE o_orderkey % 2 WHEN 0 THEN 'shipped' ELSE 'pending' END
                ELSE CASE o_orderkey % 3 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'returned' ELSE 'processing' END
              END AS status,
              CASE WHEN o_orderkey % 101 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS total_amount,
              CAST(6 + o_orderkey % 46 - copy AS DOUBLE) AS shipping_fee,
              CASE o_custkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'marketplace' END AS channel,
              copy AS load_seq
            FROM orders, {COPIES} WHERE copy = 0 OR o_orderkey % 53 = 0""",
        "raw_order_items": f"""
            SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id,
              l_partkey + CASE WHEN l_orderkey % 109 = 0 THEN {UNKNOWN} ELSE 0 END AS product_id,
              CAST(l_quantity AS INTEGER) AS quantity,
              CASE WHEN l_suppkey % 29 = 0 THEN -1 ELSE 1 END * ((2 * ec + q) // (2 * q)) / 100.0::DOUBLE AS unit_price,
              CASE WHEN l_partkey % 23 = 0 THEN 1.5::DOUBLE ELSE l_discount END AS discount,
              ec * (100 - {cents("l_discount")}) // 100 / 100.0::DOUBLE AS line_total
            FROM (SELECT *, {cents("l_extendedprice")} AS ec, CAST(l_quantity AS BIGINT) AS q FROM lineitem)""",
        "seq_payments": f"""
            SELECT o_orderkey + CASE WHEN copy = 1 AND o_orderkey % 61 = 0 THEN {UNKNOWN} ELSE 0 END AS payment_id,
              o_orderkey AS order_id,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'
                WHEN '3-MEDIUM' THEN 'pix' WHEN '4-NOT SPECIFIED' THEN 'boleto' ELSE 'wallet' END AS method,
              CASE o_orderkey % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'declined' WHEN 2 THEN 'pending'
                ELSE 'refunded' END AS status,
              o_totalprice AS amount,
              CAST(o_orderdate + to_hours(o_orderkey % 49 + 1 - copy) AS VARCHAR) AS paid_at, copy AS load_seq
            FROM orders, {COPIES} WHERE copy = 0 OR o_orderkey % 59 = 0 OR o_orderkey % 61 = 0""",
        **{f"raw_{t}": f"SELECT * EXCLUDE (load_seq) FROM seq_{t}" for t in ("products", "orders", "payments")},
        "raw_reviews": """
            SELECT event_id AS review_id, event_id % 1500 AS order_id, user_id AS customer_id,
              event_id % 200 AS product_id,
              CASE WHEN event_id % 31 <> 0 THEN CAST(floor(value) AS INTEGER) % 7 END AS rating,
              CASE WHEN event_id % 43 = 0 THEN '  ' || event_type || chr(10) || ' second line ' ELSE event_type END AS comment,
              CAST(date_trunc('second', ts) AS VARCHAR) AS created_at
            FROM events""",
        "customers": f"""
            SELECT {hmac("customer_id", key)} AS customer_id, {hmac("name", key)} AS name,
              {hmac("email", key)} AS email, phone, city, state,
              try_cast(birth_date AS TIMESTAMP) AS birth_date, try_cast(created_at AS TIMESTAMP) AS created_at
            FROM (SELECT DISTINCT * FROM raw_customers) WHERE customer_id IS NOT NULL AND email IS NOT NULL""",
        "products": f"""
            SELECT product_id, name, category, subcategory, price,
              CASE WHEN cost > price THEN price ELSE cost END AS cost, stock_qty, created_at
            FROM (SELECT product_id, name, category, subcategory, abs(price) AS price, abs(cost) AS cost,
                coalesce(stock_qty, 0) AS stock_qty, try_cast(created_at AS TIMESTAMP) AS created_at
              FROM ({first_by("seq_products", "product_id",
                              "load_seq, name, category, subcategory, price, cost, stock_qty, created_at")}))""",
        "clean_orders": f"""
            SELECT order_id, {hmac("customer_id", key)} AS customer_id,
              try_cast(order_date AS TIMESTAMP) AS order_date, status, total_amount, shipping_fee, channel
            FROM ({first_by("seq_orders", "order_id",
                            "load_seq, customer_id, order_date, status, total_amount, shipping_fee, channel")})
            WHERE total_amount > 0""",
        "order_items": f"""
            SELECT item_id, order_id, product_id, quantity, abs(unit_price) AS unit_price,
              CASE WHEN discount < 0 THEN 0.0::DOUBLE WHEN discount > 1 THEN 1.0::DOUBLE
                ELSE discount + 0.0::DOUBLE END AS discount, abs(line_total) AS line_total
            FROM ({first_by("raw_order_items", "item_id",
                            "order_id, product_id, quantity, unit_price, discount, line_total")})""",
        "payments": f"""
            SELECT payment_id, order_id, method, status, amount, try_cast(paid_at AS TIMESTAMP) AS paid_at
            FROM ({first_by("seq_payments", "payment_id", "load_seq, order_id, method, status, amount, paid_at")})""",
        "reviews": f"""
            SELECT review_id, order_id, {hmac("customer_id", key)} AS customer_id, product_id,
              CASE WHEN rating < 1 THEN 1 WHEN rating > 5 THEN 5 ELSE rating END AS rating, comment, created_at
            FROM ({first_by("raw_reviews", "review_id",
                            "order_id, customer_id, product_id, rating, comment, created_at")})""",
        "orders_enriched": """
            SELECT o.*, c.city, c.state, p.method, p.status AS payment_status,
              CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month
            FROM clean_orders o LEFT JOIN customers c USING (customer_id) LEFT JOIN payments p USING (order_id)""",
        "items_enriched": """
            SELECT i.*, p.category, p.subcategory FROM order_items i LEFT JOIN products p USING (product_id)""",
        "dim_clientes": f"""
            SELECT {crc_key("customer_id")} AS sk_cliente, customer_id AS nk_customer_id, city, state,
              created_at AS dt_criacao FROM customers""",
        "dim_produtos": f"""
            SELECT {crc_key("CAST(product_id AS VARCHAR)")} AS sk_produto, product_id AS nk_product_id,
              name AS nm_produto, category, subcategory, price, cost,
              round_even(coalesce((price - cost) / nullif(price, 0) * 100, 0) * 100, 0) / 100 AS margem_pct
            FROM products""",
        "dim_tempo": f"""
            SELECT {crc_key("strftime(d, '%Y-%m-%d')")} AS sk_tempo, d AS dt_data,
              CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia,
              CAST(quarter(d) AS INTEGER) AS trimestre, CAST(weekofyear(d) AS INTEGER) AS semana_ano,
              CAST(isodow(d) - 1 AS INTEGER) AS dia_semana, dayname(d) AS nm_dia_semana, monthname(d) AS nm_mes,
              isodow(d) >= 6 AS fl_fimdesemana
            FROM (SELECT CAST(unnest(generate_series(CAST(min(order_date) AS DATE)::TIMESTAMP,
                CAST(max(order_date) AS DATE)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d FROM clean_orders)""",
        "fato_pedidos": """
            SELECT o.order_id AS nk_order_id, i.item_id, coalesce(c.sk_cliente, 0) AS sk_cliente,
              i.sk_produto, coalesce(t.sk_tempo, 0) AS sk_tempo, o.status AS ds_status, o.channel AS ds_canal,
              p.status AS payment_status, p.method, i.quantity, i.unit_price, i.discount, i.line_total,
              o.total_amount AS vl_total_pedido, o.shipping_fee AS vl_frete,
              CAST(year(o.order_date) AS INTEGER) AS year, CAST(month(o.order_date) AS INTEGER) AS month
            FROM clean_orders o
            LEFT JOIN (SELECT DISTINCT nk_customer_id, sk_cliente FROM dim_clientes) c
              ON c.nk_customer_id = o.customer_id
            LEFT JOIN dim_tempo t ON t.dt_data = CAST(o.order_date AS DATE)
            LEFT JOIN payments p ON p.order_id = o.order_id
            LEFT JOIN (SELECT oi.*, coalesce(d.sk_produto, 0) AS sk_produto FROM order_items oi
              LEFT JOIN dim_produtos d ON d.nk_product_id = oi.product_id) i ON i.order_id = o.order_id""",
        "sold": f"SELECT * FROM fato_pedidos WHERE ds_status NOT IN {NOT_SOLD}",
    }


def money(expr: str) -> str:
    return f"CAST(sum({cents(expr)}) AS BIGINT) / 100.0::DOUBLE"


def _q2(tail: str) -> str:
    return f"""SELECT * FROM (
        SELECT p.nk_product_id, p.nm_produto, p.category AS categoria,
          CAST(sum(f.quantity) AS BIGINT) AS unidades_vendidas, {money("f.line_total")} AS receita_total,
          CAST(rank() OVER (ORDER BY {money("f.line_total")} DESC) AS INTEGER) AS ranking_receita
        FROM sold f JOIN dim_produtos p USING (sk_produto) GROUP BY ALL) {tail}"""


def _q3(start: str) -> str:
    return f"""SELECT ds_canal AS canal, method AS metodo_pagamento, count(DISTINCT nk_order_id) AS qtd_pedidos,
          round(CAST(sum({cents("vl_total_pedido")}) AS BIGINT) / count(vl_total_pedido)::DOUBLE) / 100
            AS ticket_medio,
          {money("line_total")} AS receita_total
        FROM sold JOIN dim_tempo USING (sk_tempo) WHERE dt_data >= {start} GROUP BY 1, 2"""


def _result(check: str, dataset: str, errors: str, details: str, stamp: str, **params: str) -> str:
    """Select list of one result record; ``params`` are SQL expressions."""
    fields = {"threshold": "DOUBLE", "column": "VARCHAR", "min_val": "DOUBLE", "max_val": "DOUBLE",
              "parent": "VARCHAR", "fk_col": "VARCHAR", "pk_col": "VARCHAR"}
    extra = ", ".join(f'CAST({params.get(n, "NULL")} AS {t}) AS "{n}"' for n, t in fields.items())
    return (
        f"'{check}' AS \"check\", '{dataset}' AS dataset, CASE WHEN {errors} = 0 THEN 'PASS' ELSE 'FAIL' END AS status,"
        f" CAST({errors} AS BIGINT) AS error_count, {details} AS details, {stamp} AS checked_at, {extra}"
    )


RAW_COLUMNS = {
    "customers": "customer_id name email phone city state birth_date created_at".split(),
    "products": "product_id name category subcategory price cost stock_qty created_at".split(),
    "orders": "order_id customer_id order_date status total_amount shipping_fee channel".split(),
    "order_items": "item_id order_id product_id quantity unit_price discount line_total".split(),
    "payments": "payment_id order_id method status amount paid_at".split(),
    "reviews": "review_id order_id customer_id product_id rating comment created_at".split(),
}


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def qc_schema(stamp: str) -> str:
    details = "'{\"missing_columns\":[]}'"
    return _union([f"SELECT {_result('schema', t, '0', details, stamp)}" for t in RAW_COLUMNS])


def qc_null_rate(threshold: float, stamp: str) -> str:
    parts = []
    for table, columns in RAW_COLUMNS.items():
        rates = _union([
            f"SELECT {i} AS i, '{c}' AS c, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM raw_{table}"
            for i, c in enumerate(columns)
        ])
        shown = "coalesce(string_agg('\"' || c || '\":' || CAST(round(r * 10000) / 10000 AS VARCHAR), ',' ORDER BY i), '')"
        details = "'{' || " + shown + " || '}'"
        result = _result("null_rate", table, "count(*)", details, stamp, threshold=str(threshold))
        parts.append(f"SELECT {result} FROM ({rates}) WHERE r > {threshold}")
    return _union(parts)


def qc_numeric_range(stamp: str) -> str:
    checks = [("products", "price", 0.01, None), ("products", "cost", 0, None), ("orders", "total_amount", 0.01, None),
              ("order_items", "quantity", 1, None), ("order_items", "discount", 0, 1), ("reviews", "rating", 1, 5)]
    parts = []
    for table, column, low, high in checks:
        bad = f"{column} IS NULL OR {column} < {low}" + ("" if high is None else f" OR {column} > {high}")
        result = _result(
            "numeric_range", table, f"count(*) FILTER (WHERE {bad})", "'{}'", stamp,
            column=f"'{column}'", min_val=str(low), max_val="NULL" if high is None else str(high),
        )
        parts.append(f"SELECT {result} FROM raw_{table}")
    return _union(parts)


def reference_check(child: str, parent: str, key: str, stamp: str) -> str:
    orphans = f"(SELECT DISTINCT {key} AS k FROM raw_{child} WHERE {key} NOT IN (SELECT {key} FROM raw_{parent}))"
    nulls = f"(SELECT count(*) FROM raw_{child} WHERE {key} IS NULL)"
    sample = f"(SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT k FROM {orphans} ORDER BY k LIMIT 20))"
    details = (
        f"'{{\"sample_orphans\":[' || coalesce({sample}, '') || '],\"null_fk_count\":' || {nulls} || '}}'"
    )
    result = _result(
        "referential_integrity", child, f"((SELECT count(*) FROM {orphans}) + {nulls})", details, stamp,
        parent=f"'{parent}'", fk_col=f"'{key}'", pk_col=f"'{key}'",
    )
    return f"SELECT {result}"


def qc_referential(stamp: str) -> str:
    checks = [("orders", "customers", "customer_id"), ("order_items", "orders", "order_id"),
              ("order_items", "products", "product_id"), ("payments", "orders", "order_id"),
              ("reviews", "customers", "customer_id")]
    return _union([reference_check(*c, stamp) for c in checks])


def qc_duplicates(stamp: str) -> str:
    keys = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "payments": "payment_id"}
    return _union([
        f"SELECT {_result('duplicates', t, f'(count(*) - count(DISTINCT {k}))', chr(39) + '{}' + chr(39), stamp, pk_col=chr(39) + k + chr(39))} FROM raw_{t}"
        for t, k in keys.items()
    ])


def qc_suite(stamp: str) -> str:
    return _union([
        qc_schema(stamp), qc_null_rate(DEFAULT_NULL_THRESHOLD, stamp), qc_numeric_range(stamp), qc_referential(stamp),
        qc_duplicates(stamp),
    ])


def _violations(dataset: str, relation: str, rules: dict[str, str]) -> str:
    """``rules``: name to the condition under which a row breaks it."""
    return _union([
        f"SELECT '{dataset}' AS dataset, '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS violations,"
        f" count(*) AS rows_checked FROM {relation}"
        for name, bad in rules.items()
    ])


def _below(c: str, low: int) -> str:
    return f"{c} IS NULL OR {c} < {low}"


def _outside(c: str, low: int, high: int) -> str:
    return f"{c} IS NULL OR {c} < {low} OR {c} > {high}"


CONTRACTS = {
    "customers": {
        "customer_id whole 1..": _below("customer_id", 1), "name present": "name IS NULL",
        "email present": "email IS NULL", "phone present": "phone IS NULL", "city present": "city IS NULL",
        "state length 2": "state IS NULL OR length(state) <> 2", "birth_date present": "birth_date IS NULL",
        "created_at present": "created_at IS NULL",
    },
    "products": {
        "product_id whole 1..": _below("product_id", 1), "name present": "name IS NULL",
        "category present": "category IS NULL", "subcategory present": "subcategory IS NULL",
        "price > 0": "price IS NULL OR price <= 0", "cost >= 0": "cost IS NULL OR cost < 0",
        "stock_qty whole 0..": _below("stock_qty", 0), "created_at present": "created_at IS NULL",
        "cost up to price": "cost IS NULL OR price IS NULL OR cost > price",
    },
    "orders": {
        "order_id whole 1..": _below("order_id", 1), "customer_id whole 1..": _below("customer_id", 1),
        "order_date present": "order_date IS NULL",
        "status in list": "status IS NULL OR status NOT IN"
        " ('pending', 'processing', 'shipped', 'delivered', 'cancelled', 'returned')",
        "total_amount > 0": "total_amount IS NULL OR total_amount <= 0",
        "shipping_fee >= 0": "shipping_fee IS NULL OR shipping_fee < 0",
        "channel in list": "channel IS NULL OR channel NOT IN ('web', 'mobile', 'marketplace')",
    },
    "order_items": {
        "item_id whole 1..": _below("item_id", 1), "order_id whole 1..": _below("order_id", 1),
        "product_id whole 1..": _below("product_id", 1), "quantity whole 1..": _below("quantity", 1),
        "unit_price > 0": "unit_price IS NULL OR unit_price <= 0",
        "discount BETWEEN 0 AND 1": "discount IS NULL OR discount < 0 OR discount > 1",
        "line_total >= 0": "line_total IS NULL OR line_total < 0",
    },
    "payments": {
        "payment_id whole 1..": _below("payment_id", 1), "order_id whole 1..": _below("order_id", 1),
        "method in list": "method IS NULL OR method NOT IN ('credit_card', 'debit_card', 'pix', 'boleto', 'wallet')",
        "status in list": "status IS NULL OR status NOT IN ('approved', 'declined', 'pending', 'refunded')",
        "amount > 0": "amount IS NULL OR amount <= 0", "paid_at present": "paid_at IS NULL",
    },
    "reviews": {
        "review_id whole 1..": _below("review_id", 1), "order_id whole 1..": _below("order_id", 1),
        "customer_id whole 1..": _below("customer_id", 1), "product_id whole 1..": _below("product_id", 1),
        "rating whole 1..5": _outside("rating", 1, 5), "comment present": "comment IS NULL",
        "created_at present": "created_at IS NULL",
    },
}


def contract_dimensions() -> str:
    return _union([
        _violations("dim_clientes", "dim_clientes", {
            "sk_cliente whole 1..": _below("sk_cliente", 1), "nk_customer_id present": "nk_customer_id IS NULL",
            "city present": "city IS NULL", "state present": "state IS NULL",
        }),
        _violations("dim_produtos", "dim_produtos", {
            "sk_produto whole 1..": _below("sk_produto", 1), "nk_product_id whole 1..": _below("nk_product_id", 1),
            "nm_produto present": "nm_produto IS NULL", "category present": "category IS NULL",
            "subcategory present": "subcategory IS NULL", "price > 0": "price IS NULL OR price <= 0",
            "cost >= 0": "cost IS NULL OR cost < 0", "margem_pct present": "margem_pct IS NULL",
        }),
        _violations("dim_tempo", "dim_tempo", {
            "sk_tempo whole 1..": _below("sk_tempo", 1), "dt_data present": "dt_data IS NULL",
            "ano whole ..": "ano IS NULL", "mes whole 1..12": _outside("mes", 1, 12),
            "dia whole 1..31": _outside("dia", 1, 31), "trimestre whole 1..4": _outside("trimestre", 1, 4),
            "semana_ano whole ..": "semana_ano IS NULL", "dia_semana whole 0..6": _outside("dia_semana", 0, 6),
            "nm_dia_semana present": "nm_dia_semana IS NULL", "nm_mes present": "nm_mes IS NULL",
            "fl_fimdesemana present": "fl_fimdesemana IS NULL",
        }),
    ])


def contract_tables() -> str:
    return _union([
        _violations("dim_clientes", "dim_clientes", {"nk_customer_id present": "nk_customer_id IS NULL"}),
        _violations("dim_produtos", "dim_produtos", {
            "nk_product_id present": "nk_product_id IS NULL", "nm_produto present": "nm_produto IS NULL",
            "price check": "price < 0", "cost check": "cost < 0",
        }),
        _violations("dim_tempo", "dim_tempo", {
            "dt_data present": "dt_data IS NULL", "ano present": "ano IS NULL", "mes present": "mes IS NULL",
            "dia present": "dia IS NULL", "trimestre present": "trimestre IS NULL",
            "mes check": "mes NOT BETWEEN 1 AND 12", "dia check": "dia NOT BETWEEN 1 AND 31",
            "trimestre check": "trimestre NOT BETWEEN 1 AND 4", "dia_semana check": "dia_semana NOT BETWEEN 0 AND 6",
        }),
        _violations("fato_pedidos", "fato_pedidos", {
            "nk_order_id present": "nk_order_id IS NULL", "quantity check": "quantity <= 0",
            "unit_price check": "unit_price < 0", "discount check": "discount NOT BETWEEN 0 AND 1",
            "line_total check": "line_total < 0",
        }),
    ])


def contract_keys() -> str:
    def unique(table: str, key: str) -> str:
        return (
            f"SELECT '{table}' AS dataset, '{key} unique' AS rule, count({key}) - count(DISTINCT {key}) AS violations,"
            f" count(*) AS rows_checked FROM {table}"
        )

    def reference(key: str, table: str) -> str:
        missing = f"{key} IS NOT NULL AND {key} <> 0 AND {key} NOT IN (SELECT {key} FROM {table})"
        return (
            f"SELECT 'fato_pedidos' AS dataset, '{key} references {table}' AS rule,"
            f" count(*) FILTER (WHERE {missing}) AS violations, count(*) AS rows_checked FROM fato_pedidos"
        )

    keys = {"dim_clientes": ("nk_customer_id", "sk_cliente"), "dim_produtos": ("nk_product_id", "sk_produto"),
            "dim_tempo": ("dt_data", "sk_tempo")}
    return _union([
        *[unique(table, key) for table, pair in keys.items() for key in pair],
        *[reference(surrogate, table) for table, (_, surrogate) in keys.items()],
    ])


def null_profile() -> str:
    return _union([
        f"SELECT '{table}' AS dataset, '{c}' AS column_name,"
        f" round(count(*) FILTER (WHERE {c} IS NULL) * 10000 / count(*)::DOUBLE) / 100 AS null_pct FROM raw_{table}"
        for table, columns in RAW_COLUMNS.items() for c in columns
    ])


FACT_NUMBERS = (
    "nk_order_id item_id sk_cliente sk_produto sk_tempo quantity unit_price discount line_total"
    " vl_total_pedido vl_frete year month"
).split()


def fact_summary() -> str:
    return _union([
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}::DOUBLE) * 100) / 100 AS mean,"
        f" round(stddev_samp({c}::DOUBLE) * 100) / 100 AS std, min({c})::DOUBLE AS min,"
        f" round(quantile_cont({c}::DOUBLE, 0.25) * 100) / 100 AS p25, round(quantile_cont({c}::DOUBLE, 0.5) * 100) / 100 AS p50,"
        f" round(quantile_cont({c}::DOUBLE, 0.75) * 100) / 100 AS p75, max({c})::DOUBLE AS max FROM fato_pedidos"
        for c in FACT_NUMBERS
    ])


def statements(key: str, as_of: str, stamp: str) -> dict[str, str]:
    """SQL per query name. ``as_of`` is a SQL date, ``stamp`` a SQL timestamp."""
    shared = ctes(key)
    queries = {
        "q1_monthly_revenue": f"""
            SELECT ano, mes, category AS categoria, {money("line_total")} AS receita,
              count(DISTINCT nk_order_id) AS qtd_pedidos,
              round(CAST(sum({cents("line_total")}) AS BIGINT) / count(DISTINCT nk_order_id)::DOUBLE) / 100
                AS ticket_medio
            FROM fato_pedidos JOIN dim_tempo USING (sk_tempo) JOIN dim_produtos USING (sk_produto)
            WHERE ds_status = 'delivered' GROUP BY 1, 2, 3""",
        "q2_top_products_limit": _q2("ORDER BY receita_total DESC, nk_product_id LIMIT 20"),
        "q2_top_products_ties": _q2("WHERE ranking_receita <= 20"),
        "q3_ticket_channel_months": _q3(f"{as_of} - INTERVAL '12 months'"),
        "q3_ticket_channel_days": _q3(f"{as_of} - 365"),
        "q4_churn": f"""
            SELECT sk_cliente, state AS estado, dt_ultimo_pedido,
              CAST({as_of} - dt_ultimo_pedido AS INTEGER) AS dias_desde_ultimo_pedido,
              CASE WHEN {as_of} - dt_ultimo_pedido > 90 THEN 'churn' ELSE 'ativo' END AS status_churn
            FROM (SELECT sk_cliente, max(dt_data) AS dt_ultimo_pedido FROM sold JOIN dim_tempo USING (sk_tempo)
              GROUP BY 1) JOIN dim_clientes USING (sk_cliente)""",
        "q5_cohort": """
            SELECT mes_coorte, mes_pedido, clientes_ativos,
              CAST(datediff('month', mes_coorte, mes_pedido) AS INTEGER) AS numero_mes
            FROM (SELECT mes_coorte, CAST(date_trunc('month', dt_data) AS DATE) AS mes_pedido,
                count(DISTINCT sk_cliente) AS clientes_ativos
              FROM sold JOIN dim_tempo USING (sk_tempo) JOIN (
                SELECT sk_cliente, CAST(date_trunc('month', min(dt_data)) AS DATE) AS mes_coorte
                FROM sold JOIN dim_tempo USING (sk_tempo) GROUP BY 1) USING (sk_cliente)
              GROUP BY 1, 2)""",
        "clean_customers": "SELECT * FROM customers",
        "clean_products": "SELECT * FROM products",
        "clean_orders": "SELECT * FROM clean_orders",
        "clean_order_items": "SELECT * FROM order_items",
        "clean_payments": "SELECT * FROM payments",
        "clean_reviews": "SELECT * FROM reviews",
        "orders_enriched": "SELECT * FROM orders_enriched",
        "items_enriched": "SELECT * FROM items_enriched",
        "monthly_revenue": f"""
            SELECT year, month, category, {money("line_total")} AS revenue, count(DISTINCT order_id) AS order_count,
              count(DISTINCT customer_id) AS unique_customers
            FROM orders_enriched LEFT JOIN items_enriched USING (order_id)
            WHERE status = 'delivered' GROUP BY 1, 2, 3""",
        "customer_spend": f"""
            SELECT customer_id, order_id, order_date, total_amount,
              CAST(sum({cents("total_amount")}) OVER w AS BIGINT) / 100.0::DOUBLE AS running_total,
              CAST(rank() OVER w AS INTEGER) AS order_rank, lag(total_amount) OVER w AS prev_order_amount
            FROM clean_orders WINDOW w AS (PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id)""",
        **{
            f"{name}_customers_from_states": f"""
            SELECT o.year, CAST(ceil(o.month / {months}.0) AS INTEGER) AS {period}, category, count(DISTINCT customer_id) AS customers
            FROM orders_enriched o JOIN items_enriched i USING (order_id)
            WHERE customer_id IN (SELECT customer_id FROM customers) AND o.status NOT IN {NOT_SOLD} AND o.year IS NOT NULL
              AND product_id IN (SELECT product_id FROM products) GROUP BY ALL"""
            for name, period, months in (("monthly", "month", 1), ("quarterly", "quarter", 3))
        },
        "clean_orders_mixed_dates": """
            SELECT * REPLACE (CASE WHEN order_id % 10 > 1 THEN date_trunc('second', order_date) END AS order_date) FROM clean_orders""",
        "date_format_losses": """
            SELECT 'orders' AS dataset, 'order_date' AS column_name, format,
              count(*) FILTER (WHERE reads) AS parsed, count(*) FILTER (WHERE NOT reads AND (moment IS NOT NULL OR kind <> 1)) AS lost
            FROM (SELECT format, kind, moment, coalesce(moment IS NOT NULL AND CASE format
                WHEN 'iso' THEN kind = 0 WHEN 'yearmonthday' THEN kind = 1 WHEN 'day/month/year' THEN kind > 1
                WHEN 'month/day/year' THEN kind > 1 AND day(moment) <= 12 ELSE false END, false) AS reads
              FROM (SELECT order_id % 10 AS kind, try_cast(order_date AS TIMESTAMP) AS moment FROM raw_orders),
                (VALUES ('iso'), ('month/day/year'), ('day/month/year'), ('year/month/day'), ('yearmonthday'), ('month-day-year'),
                  ('day-month-year'), ('day.month.year'), ('month name day, year'), ('day month name year')) AS f(format))
            GROUP BY format""",
        "dim_keys_second_load": """
            SELECT 'customers' AS dimension, customer_id AS natural_key,
              row_number() OVER (ORDER BY min(CAST(phone AS BIGINT) % 3) = 0, customer_id) AS surrogate_key
            FROM customers GROUP BY customer_id
            UNION ALL SELECT 'products', CAST(product_id AS VARCHAR), row_number() OVER (ORDER BY product_id % 4 <> 1, product_id)
            FROM products""",
        "gold_incremental": "SELECT * FROM fato_pedidos",
        "spend_out_of_range": f"""
            SELECT customer_id, order_id, order_date, total_amount,
              CAST(sum({cents("total_amount")}) OVER w AS BIGINT) / 100.0::DOUBLE AS running_total,
              CAST(rank() OVER w AS INTEGER) AS order_rank, lag(total_amount) OVER w AS prev_order_amount
            FROM clean_orders WHERE order_id % 43 <> 0 AND order_id % 47 <> 0 AND order_id % 59 <> 0 AND order_id % 61 <> 0
            WINDOW w AS (PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id)""",
        "losses_out_of_range": """
            SELECT 'orders' AS dataset, 'total_amount' AS column_name, count(*) FILTER (
              WHERE order_id % 43 = 0 OR order_id % 47 = 0 OR order_id % 59 = 0 OR order_id % 61 = 0) AS lost FROM raw_orders
            UNION ALL SELECT 'orders', 'shipping_fee', 0""",
        "product_ratings": """
            SELECT product_id, avg(rating) AS avg_rating, count(review_id) AS review_count FROM reviews GROUP BY 1""",
        "dim_clientes": "SELECT * FROM dim_clientes",
        "dim_produtos": "SELECT * FROM dim_produtos",
        "dim_tempo": "SELECT * FROM dim_tempo",
        "fato_pedidos": "SELECT * FROM fato_pedidos",
        "fact_orphans": _union([
            f"SELECT '{k}' AS surrogate_key, count(*) AS orphan_rows, count(DISTINCT nk_order_id) AS orphan_orders"
            f" FROM fato_pedidos WHERE {k} = 0" for k in ("sk_cliente", "sk_produto", "sk_tempo")
        ]),
        "key_collisions": _union([
            f"SELECT '{t}' AS dimension, count(*) AS keys, coalesce(sum(n - 1), 0)::BIGINT AS collisions"
            f" FROM (SELECT {s}, count(DISTINCT {n}) AS n FROM {t} GROUP BY 1)"
            for t, n, s in (("dim_clientes", "nk_customer_id", "sk_cliente"),
                            ("dim_produtos", "nk_product_id", "sk_produto"), ("dim_tempo", "dt_data", "sk_tempo"))
        ]),
        "qc_schema": qc_schema(stamp),
        "qc_null_rate": qc_null_rate(0.02, stamp),
        "qc_numeric_range": qc_numeric_range(stamp),
        "qc_referential": qc_referential(stamp),
        "qc_duplicates": qc_duplicates(stamp),
        "qc_suite": qc_suite(stamp),
        "qc_report": f"""
            SELECT {stamp} AS generated_at, count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
              count(*) FILTER (WHERE status = 'FAIL') AS failed,
              CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status
            FROM ({qc_suite(stamp)})""",
        "qc_failed_checks": f"""
            SELECT "check", dataset, error_count FROM ({qc_suite(stamp)}) WHERE status = 'FAIL'""",
        "orphan_keys": """
            SELECT order_id AS key, count(*) AS rows FROM raw_orders
            WHERE order_id NOT IN (SELECT order_id FROM raw_order_items) GROUP BY 1""",
        **{f"contract_{t}": _violations(t, f"raw_{t}", rules) for t, rules in CONTRACTS.items()},
        "contract_dimensions": contract_dimensions(),
        "contract_tables": contract_tables(),
        "quarantined_products": """
            SELECT * FROM (SELECT *, concat_ws(', ',
                CASE WHEN product_id < 1 THEN 'product_id whole 1..' END, CASE WHEN price <= 0 THEN 'price > 0' END,
                CASE WHEN stock_qty IS NULL OR stock_qty < 0 THEN 'stock_qty whole 0..' END,
                CASE WHEN cost > price THEN 'cost up to price' END) AS violations
              FROM raw_products) WHERE violations <> ''""",
        "coercion_losses": """
            SELECT 'customers' AS dataset, 'birth_date' AS column_name,
              count(*) FILTER (WHERE birth_date IS NOT NULL AND try_cast(birth_date AS TIMESTAMP) IS NULL) AS lost
              FROM raw_customers
            UNION ALL SELECT 'orders', 'order_date',
              count(*) FILTER (WHERE order_date IS NOT NULL AND try_cast(order_date AS TIMESTAMP) IS NULL)
              FROM raw_orders""",
        "null_profile": null_profile(),
        "table_sizes": _union([
            f"SELECT '{t}' AS dataset, count(*) AS rows, {len(c)}::BIGINT AS columns FROM raw_{t}"
            for t, c in RAW_COLUMNS.items()
        ]),
        "bronze_profile": _union([
            f"SELECT p.dataset, (SELECT count(*) FROM raw_{t}) AS rows, {len(c)}::BIGINT AS columns,"
            f" p.column_name, p.null_pct FROM ({null_profile()}) p WHERE p.dataset = '{t}'"
            for t, c in RAW_COLUMNS.items()
        ]),
        "bronze_orders": """
            SELECT *, CAST(year(try_cast(order_date AS TIMESTAMP)) AS INTEGER) AS year,
              CAST(month(try_cast(order_date AS TIMESTAMP)) AS INTEGER) AS month FROM raw_orders""",
        "monthly_orders": f"""
            SELECT strftime(try_cast(order_date AS TIMESTAMP), '%Y-%m') AS year_month, count(order_id) AS order_count,
              {money("total_amount")} AS revenue
            FROM raw_orders WHERE try_cast(order_date AS TIMESTAMP) IS NOT NULL GROUP BY 1""",
        "revenue_by_category": f"""
            SELECT category, {money("line_total")} AS revenue
            FROM raw_order_items JOIN raw_products USING (product_id) JOIN raw_orders USING (order_id)
            WHERE status = 'delivered' GROUP BY 1""",
        "rating_distribution": """
            SELECT rating, count(*) AS count FROM raw_reviews WHERE rating IS NOT NULL GROUP BY 1""",
        "payment_mix": """
            SELECT method, count(*) AS count,
              round(count(*) * 1000 / (SELECT count(method) FROM raw_payments)::DOUBLE) / 10 AS share_pct
            FROM raw_payments WHERE method IS NOT NULL GROUP BY 1""",
        "fact_preview": """
            SELECT * FROM fato_pedidos
            ORDER BY nk_order_id NULLS FIRST, item_id NULLS FIRST, payment_status NULLS FIRST, method NULLS FIRST
            LIMIT 5""",
        "fact_summary": fact_summary(),
        "order_total_reconcile": f"""
            SELECT order_id, total_amount, ic / 100.0::DOUBLE AS items_total,
              ({cents("total_amount")} - ic) / 100.0::DOUBLE AS difference,
              coalesce({cents("total_amount")} = ic, false) AS matches
            FROM clean_orders LEFT JOIN (SELECT order_id, CAST(sum({cents("line_total")}) AS BIGINT) AS ic
              FROM order_items GROUP BY 1) USING (order_id)""",
        "line_total_reconcile": f"""
            SELECT quantity, count(*) AS lines, count(*) FILTER (WHERE gap = 0) AS equal_lines,
              max(gap) / 100.0::DOUBLE AS largest_gap
            FROM (SELECT quantity, abs({cents("unit_price")} * quantity * (100 - {cents("discount")}) // 100
                - {cents("line_total")}) AS gap FROM order_items) GROUP BY 1""",
        "sample_orders_fraction": f"""
            SELECT * FROM clean_orders WHERE {crc("CAST(order_id AS VARCHAR) || ':42'")} < 2576980378""",
        "sample_orders_rows": f"""
            SELECT * FROM clean_orders ORDER BY {crc("CAST(order_id AS VARCHAR) || ':42'")}, order_id LIMIT 200""",
        "stream_ingest": """
            SELECT event_id + 100000000 AS order_id, user_id AS customer_id, event_id % 200 AS product_id,
              CAST(event_id % 5 + 1 AS INTEGER) AS quantity, value AS unit_price,
              CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'marketplace' END AS channel,
              strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_time
            FROM events WHERE event_id % 37 <> 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0""",
        "stream_rejected": """
            SELECT CASE WHEN event_id % 37 = 0 THEN 'cut short' WHEN event_id % 41 = 0 THEN 'without order id'
                ELSE 'bad field' END AS fault,
              count(*) AS lines FROM events WHERE event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0
            GROUP BY 1""",
        "stream_unknown_fields": """
            SELECT event_id + 100000000 AS order_id, 'SAVE' AS coupon FROM events
            WHERE event_id % 47 = 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0""",
        "stream_input_lines": """
            SELECT count(*) AS input_lines, count(*) FILTER (WHERE bad) AS rejected,
              count(*) FILTER (WHERE NOT bad) AS valid
            FROM (SELECT event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0 AS bad FROM events)""",
        "bronze_reviews": """
            SELECT *, CAST(year(try_cast(created_at AS TIMESTAMP)) AS INTEGER) AS year,
              CAST(month(try_cast(created_at AS TIMESTAMP)) AS INTEGER) AS month FROM raw_reviews""",
        "csv_orders_dated": """
            SELECT order_id, customer_id, try_cast(order_date AS TIMESTAMP) AS order_date, status, total_amount,
              shipping_fee, channel FROM raw_orders""",
        "report_archive": f"""
            SELECT {stamp} AS generated_at, CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS'
              ELSE 'FAIL' END AS overall_status, count(*) FILTER (WHERE status = 'PASS') AS passed,
              count(*) FILTER (WHERE status = 'FAIL') AS failed
            FROM ({qc_suite(stamp)}), (VALUES (1), (2)) AS runs(n) GROUP BY n""",
        "silver_job": f"""
            SELECT customer_id, order_id, order_date, total_amount,
              CAST(sum({cents("total_amount")}) OVER w AS BIGINT) / 100.0::DOUBLE AS running_total,
              CAST(rank() OVER w AS INTEGER) AS order_rank, lag(total_amount) OVER w AS prev_order_amount
            FROM clean_orders WINDOW w AS (PARTITION BY customer_id ORDER BY order_date NULLS FIRST, order_id)""",
        "gold_job": "SELECT * FROM fato_pedidos",
        "contract_keys": contract_keys(),
        "q5_cohort_wrapped": """
            SELECT mes_coorte, mes_pedido, clientes_ativos,
              CAST(datediff('month', mes_coorte, mes_pedido) % 12 AS INTEGER) AS numero_mes
            FROM (SELECT mes_coorte, CAST(date_trunc('month', dt_data) AS DATE) AS mes_pedido,
                count(DISTINCT sk_cliente) AS clientes_ativos
              FROM sold JOIN dim_tempo USING (sk_tempo) JOIN (
                SELECT sk_cliente, CAST(date_trunc('month', min(dt_data)) AS DATE) AS mes_coorte
                FROM sold JOIN dim_tempo USING (sk_tempo) GROUP BY 1) USING (sk_cliente)
              GROUP BY 1, 2)""",
        "fato_pedidos_wide": """
            SELECT nk_order_id, item_id, method, line_total, vl_total_pedido, year, month,
              sk_cliente = 0 AS unknown_customer, sk_produto = 0 AS unknown_product, sk_tempo = 0 AS unknown_day
            FROM fato_pedidos""",
        "catalog_fact": """
            SELECT nk_order_id, item_id, sk_cliente, sk_produto, sk_tempo, ds_status, ds_canal, payment_status, method,
              quantity, round(line_total::DOUBLE, 2) AS line_total, round(vl_total_pedido::DOUBLE, 2) AS vl_total_pedido, year, month
            FROM fato_pedidos""",
    }
    queries["stream_text_ingest"] = queries["stream_restart"] = queries["stream_deduplicated"] = queries["stream_ingest"]
    queries["stream_first_n"] = queries["stream_ingest"] + " AND event_id IN (SELECT event_id FROM events ORDER BY event_id LIMIT 700)"
    queries["bronze_reviews_split"] = queries["bronze_reviews"]
    for name in ("q1_monthly_revenue", "fato_pedidos", "monthly_revenue", "customer_spend"):
        queries[f"{name}_hot"] = queries[name]
    prefix = "WITH " + ", ".join(f"{name} AS ({body})" for name, body in shared.items())
    return {name: f"{prefix} {sql}" for name, sql in queries.items()}
