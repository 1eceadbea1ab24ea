"""DuckDB statements that state independently what each registered query returns.

Every statement starts from the driver's tables through the fixture rules in
``FIXTURES.md``. Output types are levelled with the Spark side: money and means
as DOUBLE, whole numbers as BIGINT, dates as text.
"""

from __future__ import annotations

AS_OF = "2001-12-31"
INCREMENTAL_SINCE = "2001-07-01"
RECENT_AS_OF = "2001-07-20"

_TWO_PLACES = (
    "CAST(CAST({n} AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))"
)


# Fixed values: (upper bound, whether it belongs, label) in rising order; the last label
# is for all above, and for NULL.
_LADDERS = {
    "customer_segment": ((90, True, "New"), (365, True, "Regular"), "Veteran"),
    "price_tier": ((50, False, "Budget"), (200, False, "Mid-Range"), "Premium"),
    "stock_status": ((0, True, "Out of Stock"), (10, False, "Low Stock"), "In Stock"),
    "customer_value_tier": (
        (0, True, "No Orders"),
        (500, False, "Low Value"),
        (2000, False, "Mid Value"),
        "High Value",
    ),
}


def _ladder(name: str, value: str) -> str:
    *steps, above = _LADDERS[name]
    arms = " ".join(
        f"WHEN {value} {'<=' if belongs else '<'} {bound} THEN '{label}'"
        for bound, belongs, label in steps
    )
    return f"CASE WHEN {value} IS NULL THEN '{above}' {arms} ELSE '{above}' END AS {name}"


def _raw_customers(dirty: bool) -> str:
    if dirty:
        name = (
            "CASE WHEN c_custkey % 307 = 5 THEN NULL "
            "WHEN c_custkey % 13 = 0 THEN '  ' || c_name || ' ' ELSE c_name END"
        )
        email = (
            "CASE WHEN c_custkey % 211 = 1 THEN NULL "
            "ELSE ' ' || c_name || '@Example.COM' END"
        )
    else:
        name, email = "c_name", "c_name || '@example.com'"
    day = (
        "CAST(DATE '2000-01-01' + CAST(c_custkey * 37 % 730 AS INTEGER) AS VARCHAR)"
    )
    if dirty:
        day = f"CASE WHEN c_custkey % 311 <> 7 THEN {day} END"
    return f"""raw_customers AS (
        SELECT c_custkey AS customer_id, {name} AS name, {email} AS email,
               'City ' || (c_custkey % 40) AS city, n_name AS state,
               {day} AS created_at
        FROM customer, nation WHERE c_nationkey = n_nationkey)"""


def _raw_products(dirty: bool) -> str:
    category = "CASE WHEN p_partkey % 97 = 3 THEN NULL ELSE p_type END" if dirty else "p_type"
    stock = "CAST(p_size - 1 AS BIGINT)"
    if dirty:
        stock = f"CASE WHEN p_partkey % 89 <> 5 THEN {stock} END"
    return f"""raw_products AS (
        SELECT p_partkey AS product_id, p_name AS name, {category} AS category,
               {_TWO_PLACES.format(n='((p_partkey * 37) % 50000)')} AS price,
               {stock} AS stock
        FROM part)"""


def _raw_orders(dirty: bool) -> str:
    amount = _TWO_PLACES.format(n="(CAST(floor(o_totalprice) AS BIGINT) % 50000)")
    buyer, day = "o_custkey", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
    status = (
        "CASE o_orderkey % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'pending' "
        "WHEN 2 THEN 'cancelled' ELSE 'refunded' END"
    )
    if dirty:
        day = f"CASE WHEN o_orderkey % 1019 <> 3 THEN {day} END"
        buyer = "CASE WHEN o_orderkey % 1013 = 2 THEN NULL ELSE o_custkey END"
        amount = (
            "CASE WHEN o_orderkey % 1009 = 0 THEN NULL "
            f"WHEN o_orderkey % 997 = 0 THEN 0 ELSE {amount} END"
        )
        status = (
            "CASE WHEN o_orderkey % 991 = 7 THEN NULL "
            "WHEN o_orderkey % 40 = 0 THEN 'COMPLETED' "
            f"WHEN o_orderkey % 40 = 4 THEN ' completed ' ELSE {status} END"
        )
    return f"""raw_orders AS (
        SELECT o_orderkey AS order_id, {buyer} AS customer_id,
               lines.product_id, lines.quantity,
               CAST({amount} AS DECIMAL(10,2)) AS amount, {status} AS status,
               {day} AS order_date
        FROM orders LEFT JOIN (
            SELECT l_orderkey, min(l_partkey) AS product_id,
                   CAST(max(l_quantity) AS BIGINT) AS quantity
            FROM lineitem GROUP BY l_orderkey) AS lines ON l_orderkey = o_orderkey)"""


def _raw(dirty: bool = True) -> str:
    return ", ".join((_raw_customers(dirty), _raw_products(dirty), _raw_orders(dirty)))


def _staging(variant: str, dirty: bool = True) -> str:
    core = variant == "core"
    age = f"(DATE '{AS_OF}' - CAST(created_at AS DATE))"
    return f"""{_raw(dirty)},
    stg_orders AS (
        SELECT CAST(order_id AS INTEGER) AS order_id,
               CAST(customer_id AS INTEGER) AS customer_id,
               CAST(product_id AS INTEGER) AS product_id,
               CAST(quantity AS INTEGER) AS quantity, amount,
               lower(trim(status)) AS status,
               CAST(order_date AS DATE) AS order_date,
               CAST(substr(order_date, 1, 4) AS BIGINT) AS order_year,
               CAST(substr(order_date, 6, 2) AS BIGINT) AS order_month,
               coalesce(lower(status) = 'completed', false) AS is_completed,
               coalesce(lower(status) = 'cancelled', false) AS is_cancelled,
               CASE WHEN lower(status) = 'completed' THEN amount ELSE 0 END
                   AS completed_revenue
        FROM raw_orders
        WHERE amount > 0 AND order_id IS NOT NULL
              {'AND customer_id IS NOT NULL' if core else ''}),
    stg_customers AS (
        SELECT CAST(customer_id AS INTEGER) AS customer_id,
               trim(name) AS customer_name, lower(trim(email)) AS email,
               trim(city) AS city, trim(state) AS state,
               CAST(created_at AS DATE) AS created_at,
               {age} AS days_since_signup,
               {_ladder("customer_segment", age)}
        FROM raw_customers
        WHERE customer_id IS NOT NULL
              {'AND name IS NOT NULL AND email IS NOT NULL' if core else ''}),
    stg_products AS (
        SELECT CAST(product_id AS INTEGER) AS product_id, trim(name) AS product_name,
               trim(category) AS category, price, CAST(stock AS INTEGER) AS stock,
               {_ladder("price_tier", "price")}
               {"," + _ladder("stock_status", "stock") if core else ''}
        FROM raw_products WHERE price > 0 AND product_id IS NOT NULL)"""


def _marts(variant: str, dirty: bool = True) -> str:
    core = variant == "core"
    sales_extra = (
        """, stock_status,
               sum(completed_revenue) OVER same_category AS category_total_revenue,
               rank() OVER (same_category ORDER BY amount DESC NULLS LAST)
                   AS rank_in_category"""
        if core
        else ""
    )
    window = "WINDOW same_category AS (PARTITION BY category)" if core else ""
    sales = f"""mart_sales AS (
        SELECT order_id, order_date, order_year, order_month, quantity, amount, status,
               is_completed, is_cancelled, completed_revenue, buyer.customer_id,
               customer_name, city, state, customer_segment, item.product_id,
               product_name, category, price, price_tier {sales_extra}
        FROM stg_orders AS sale
        LEFT JOIN stg_products AS item ON item.product_id = sale.product_id
        LEFT JOIN stg_customers AS buyer ON buyer.customer_id = sale.customer_id
        {window})"""
    # count(order_id) and the sums see no rows for a customer without orders.
    measures = """count(sale.order_id) AS total_orders,
               coalesce(sum(completed_revenue), 0) AS total_completed_spend,
               coalesce(CAST(sum(amount) AS DOUBLE) / count(amount), 0)
                   AS avg_order_value"""
    if core:
        measures += """,
               count(*) FILTER (WHERE is_completed) AS completed_orders,
               count(*) FILTER (WHERE is_cancelled) AS cancelled_orders,
               coalesce(sum(amount), 0) AS total_spend,
               min(order_date) AS first_order_date, max(order_date) AS last_order_date,
               coalesce(max(order_date) - min(order_date), 0) AS customer_lifespan_days"""
    customers = f"""spend AS (
        SELECT buyer.customer_id, customer_name, email, city, state, created_at,
               customer_segment, days_since_signup, {measures}
        FROM stg_customers AS buyer
        LEFT JOIN stg_orders AS sale ON sale.customer_id = buyer.customer_id
        GROUP BY ALL),
    mart_customers AS (
        SELECT *, {_ladder("customer_value_tier", "total_completed_spend")} FROM spend)"""
    return f"{_staging(variant, dirty)}, {sales}, {customers}"


_LEVEL = {
    "i": "CAST({c} AS BIGINT) AS {c}",
    "m": "CAST({c} AS DOUBLE) AS {c}",
    "a": "round(CAST({c} AS DOUBLE), 6) AS {c}",
    "d": "CAST({c} AS VARCHAR) AS {c}",
    "x": "{c}",
}


def _columns(spec: str) -> str:
    """``name:kind`` words to a select list (i whole, m money, a mean, d date)."""
    parts = (word.partition(":") for word in spec.split())
    return ", ".join(_LEVEL[kind or "x"].format(c=name) for name, _, kind in parts)


_RAW_ORDER = "order_id:i customer_id:i product_id:i quantity:i amount:m status order_date"
_RAW_CUSTOMER = "customer_id:i name email city state created_at"
_RAW_PRODUCT = "product_id:i name category price:m stock:i"
_STG_ORDER = (
    "order_id:i customer_id:i product_id:i quantity:i amount:m status order_date:d "
    "order_year:i order_month:i is_completed is_cancelled completed_revenue:m"
)
_STG_CUSTOMER = (
    "customer_id:i customer_name email city state created_at:d days_since_signup:i "
    "customer_segment"
)
_STG_PRODUCT = "product_id:i product_name category price:m stock:i price_tier"
_SALES = (
    "order_id:i order_date:d order_year:i order_month:i quantity:i amount:m status "
    "is_completed is_cancelled completed_revenue:m customer_id:i customer_name city "
    "state customer_segment product_id:i product_name category price:m price_tier"
)
_SALES_CORE = _SALES + " stock_status category_total_revenue:m rank_in_category:i"
_CUSTOMERS = (
    _STG_CUSTOMER
    + " total_orders:i total_completed_spend:m avg_order_value:a customer_value_tier"
)
_CUSTOMERS_CORE = (
    _CUSTOMERS + " completed_orders:i cancelled_orders:i total_spend:m "
    "first_order_date:d last_order_date:d customer_lifespan_days:i"
)


def _from(ctes: str, spec: str, source: str) -> str:
    return f"WITH {ctes} SELECT {_columns(spec)} FROM {source}"


def _reports(variant: str) -> dict[str, str]:
    marts = _marts(variant)
    suffix = "" if variant == "core" else "_lite"
    found = {
        "kpis": """
            SELECT count(DISTINCT order_id) AS total_orders,
                   count(DISTINCT customer_id) AS total_customers,
                   CAST(sum(completed_revenue) AS DOUBLE) AS total_revenue,
                   round(CAST(sum(amount) FILTER (WHERE is_completed) AS DOUBLE)
                         / count(*) FILTER (WHERE is_completed), 2) AS avg_order_value,
                   count(DISTINCT order_id) FILTER (WHERE is_completed)
                       AS completed_orders,
                   count(DISTINCT order_id) FILTER (WHERE is_cancelled)
                       AS cancelled_orders
            FROM mart_sales""",
        "revenue_by_month": """
            SELECT strftime(order_date, '%Y-%m') AS month,
                   CAST(sum(completed_revenue) AS DOUBLE) AS revenue
            FROM mart_sales WHERE is_completed GROUP BY 1""",
        "revenue_by_category": """
            SELECT category, CAST(sum(completed_revenue) AS DOUBLE) AS revenue
            FROM mart_sales WHERE is_completed AND category IS NOT NULL GROUP BY 1""",
        "customers_by_tier": """
            SELECT customer_value_tier, count(*) AS customers
            FROM mart_customers GROUP BY 1""",
        "top_customers": """
            SELECT customer_name, city, state, total_orders,
                   CAST(total_completed_spend AS DOUBLE) AS total_spend,
                   customer_value_tier
            FROM mart_customers WHERE total_orders > 0
            ORDER BY total_completed_spend DESC, customer_id LIMIT 10""",
        "top_states": """
            SELECT state, count(DISTINCT order_id) AS orders,
                   CAST(sum(completed_revenue) AS DOUBLE) AS revenue
            FROM mart_sales WHERE is_completed AND state IS NOT NULL GROUP BY 1
            ORDER BY sum(completed_revenue) DESC, state LIMIT 10""",
    }
    return {f"{name}{suffix}": f"WITH {marts} {sql}" for name, sql in found.items()}


# Fixed values: (model, column, test, accepted values) of the whole suite.
_TESTS = [
    ("stg_orders", "order_id", "unique", ()),
    ("stg_orders", "order_id", "not_null", ()),
    ("stg_orders", "customer_id", "not_null", ()),
    ("stg_orders", "amount", "not_null", ()),
    ("stg_orders", "status", "not_null", ()),
    (
        "stg_orders",
        "status",
        "accepted_values",
        ("completed", "pending", "cancelled", "refunded"),
    ),
    ("stg_customers", "customer_id", "unique", ()),
    ("stg_customers", "customer_id", "not_null", ()),
    ("stg_customers", "email", "unique", ()),
    ("stg_customers", "email", "not_null", ()),
    ("stg_customers", "customer_segment", "not_null", ()),
    (
        "stg_customers",
        "customer_segment",
        "accepted_values",
        ("New", "Regular", "Veteran"),
    ),
    ("stg_products", "product_id", "unique", ()),
    ("stg_products", "product_id", "not_null", ()),
    ("stg_products", "price_tier", "accepted_values", ("Budget", "Mid-Range", "Premium")),
    (
        "stg_products",
        "stock_status",
        "accepted_values",
        ("In Stock", "Low Stock", "Out of Stock"),
    ),
    ("mart_sales", "order_id", "unique", ()),
    ("mart_sales", "order_id", "not_null", ()),
    ("mart_sales", "customer_id", "not_null", ()),
    ("mart_sales", "amount", "not_null", ()),
    ("mart_customers", "customer_id", "unique", ()),
    ("mart_customers", "customer_id", "not_null", ()),
    ("mart_customers", "customer_value_tier", "not_null", ()),
    (
        "mart_customers",
        "customer_value_tier",
        "accepted_values",
        ("High Value", "Mid Value", "Low Value", "No Orders"),
    ),
]


# Columns of messy raw tables: key, and the text that gets blanks.
_MESSY = {
    "customers": ("customer_id", "name", _RAW_CUSTOMER),
    "products": ("product_id", "category", _RAW_PRODUCT),
    "orders": ("order_id", "status", _RAW_ORDER),
}
_SPACE = "' ' || chr(9) || chr(10)"


def _names(spec: str) -> list[str]:
    return [word.partition(":")[0] for word in spec.split()]


def _messy() -> str:
    """CTEs messy_*: blanks, repeated rows and rows of NULLs planted."""
    parts = [_raw()]
    for name, (key, text, spec) in _MESSY.items():
        padded = ", ".join(
            f"CASE WHEN {key} % 41 = 0 THEN ' ' || chr(9) "
            f"WHEN {key} % 43 = 0 THEN coalesce(chr(10) || ' ' || {text} || '  ', {text}) "
            f"ELSE {text} END AS {c}"
            if c == text
            else c
            for c in _names(spec)
        )
        nothing = ", ".join(f"NULL AS {c}" for c in _names(spec))
        parts.append(
            f"""padded_{name} AS (SELECT {padded} FROM raw_{name}),
    messy_{name} AS (
        SELECT * FROM padded_{name}
        UNION ALL SELECT * FROM padded_{name} WHERE {key} % 47 = 1
        UNION ALL SELECT {nothing} FROM raw_{name} WHERE {key} % 53 = 2)"""
        )
    return ", ".join(parts)


def _stripped(spec: str) -> str:
    """Columns with white space taken off all texts, levelled."""
    return ", ".join(
        f"trim({word}, {_SPACE}) AS {word}"
        if ":" not in word
        else _columns(word)
        for word in spec.split()
    )


def _clean_reports() -> str:
    parts = []
    for name, (_, _, spec) in _MESSY.items():
        names = _names(spec)
        some = " OR ".join(f"{c} IS NOT NULL" for c in names)
        text = [w for w in spec.split() if ":" not in w]
        columns = ", ".join(f"trim({c}, {_SPACE}) AS {c}" if c in text else c for c in names)
        parts.append(
            f"""SELECT '{name}' AS source, (SELECT count(*) FROM messy_{name}) AS rows_in,
            (SELECT count(*) FROM messy_{name} WHERE NOT ({some})) AS empty_removed,
            (SELECT count(*) FROM messy_{name} WHERE {some})
              - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM messy_{name}
                 WHERE {some})) AS duplicates_removed,
            (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM messy_{name}
                 WHERE {some})) AS rows_out,
            CAST({len(names)} AS BIGINT) AS columns_out"""
        )
    return f"WITH {_messy()} " + " UNION ALL ".join(parts)


# Faults planted for the quality suite: (column, one in so many keys, value).
_FAULTS = {
    "stg_orders": ("order_id", (("status", 301, "'unknown'"), ("amount", 401, "NULL"))),
    "stg_customers": (
        "customer_id",
        (("customer_segment", 61, "'Former'"), ("email", 71, "NULL")),
    ),
    "stg_products": (
        "product_id",
        (("price_tier", 31, "'Luxury'"), ("stock_status", 37, "'Lost'")),
    ),
    "mart_sales": ("order_id", (("amount", 503, "NULL"),)),
    "mart_customers": ("customer_id", (("customer_value_tier", 67, "'Unknown'"),)),
}


def _faulty() -> str:
    """CTEs faulty_*: the models with faults and repeated rows planted."""
    parts = [_marts("core")]
    for name, (key, faults) in _FAULTS.items():
        changed = ", ".join(
            f"CASE WHEN {key} % {every} = 3 THEN {value} ELSE {column} END AS {column}"
            for column, every, value in faults
        )
        parts.append(
            f"""planted_{name} AS (SELECT * REPLACE ({changed}) FROM {name}),
    faulty_{name} AS (
        SELECT * FROM planted_{name}
        UNION ALL SELECT * FROM planted_{name} WHERE {key} % 89 = 4)"""
        )
    return ", ".join(parts)


def _failing_values() -> str:
    allowed = ", ".join(f"'{v}'" for v in _TESTS[5][3])

    def counted(test: str, model: str, column: str, which: str) -> str:
        return (
            f"SELECT '{test}' AS test, CAST({column} AS VARCHAR) AS value, "
            f"count(*) AS n_records FROM faulty_{model} WHERE {which}"
        )

    return f"WITH {_faulty()} " + " UNION ALL ".join(
        (
            counted("unique", "stg_orders", "order_id", "order_id IS NOT NULL")
            + " GROUP BY order_id HAVING count(*) > 1",
            counted("unique", "stg_customers", "email", "email IS NOT NULL")
            + " GROUP BY email HAVING count(*) > 1",
            counted(
                "accepted_values", "stg_orders", "status", f"status NOT IN ({allowed})"
            )
            + " GROUP BY status",
            "SELECT 'not_null', CAST(order_id AS VARCHAR), 1 FROM faulty_stg_orders "
            "WHERE amount IS NULL",
        )
    )


def _suite(
    tests: tuple[str, ...], dirty: bool = True, models: str | None = None, prefix: str = ""
) -> str:
    parts = []
    for name, column, test, values in _TESTS:
        if test not in tests:
            continue
        model = prefix + name
        if test == "unique":
            failures = (
                f"(SELECT count(*) FROM (SELECT 1 FROM {model} WHERE {column} IS NOT NULL "
                f"GROUP BY {column} HAVING count(*) > 1) AS repeated)"
            )
        elif test == "not_null":
            failures = f"(SELECT count(*) - count({column}) FROM {model})"
        else:
            allowed = ", ".join(f"'{v}'" for v in values)
            failures = (
                f"(SELECT count(DISTINCT {column}) FROM {model} "
                f"WHERE {column} NOT IN ({allowed}))"
            )
        parts.append(
            f"SELECT '{name}' AS model, '{column}' AS column_name, '{test}' AS test, "
            f"{failures} AS failures, {failures} = 0 AS passed"
        )
    return f"WITH {models or _marts('core', dirty)} " + " UNION ALL ".join(parts)


def _csv_malformed() -> str:
    """Rows of the planted lines that fit their header, as texts."""

    def changed(name: str) -> str:
        text = f"CAST({name} AS VARCHAR)"
        if name == "amount":
            return f"CASE WHEN order_id % 19 = 1 THEN NULL ELSE {text} END"
        if name == "status":
            return f"""CASE WHEN order_id % 19 = 1 THEN NULL
                WHEN order_id % 23 = 1 THEN ' "' || coalesce(status, '') || '", so ,'
                WHEN order_id % 29 = 1 AND order_id // 5000 % 2 = 1
                    THEN coalesce(status, '') || chr(10) || 'and "more"'
                ELSE status END"""
        return text

    names = _names(_RAW_ORDER)
    columns = ", ".join(
        f"CAST({name} AS VARCHAR) AS {name}"
        if place < 3
        else f"CASE WHEN order_id % 17 <> 1 THEN {changed(name)} END AS {name}"
        for place, name in enumerate(names)
    )
    return f"""WITH {_raw()} SELECT {columns} FROM raw_orders
        WHERE order_id % 17 = 1 OR (order_id % 11 <> 1 AND order_id % 13 <> 1)"""


_ALL_TESTS = ("unique", "not_null", "accepted_values")


def build() -> dict[str, str]:
    """One statement per registered query."""
    raw = _raw()
    messy = _messy()
    some_product = " OR ".join(f"{c} IS NOT NULL" for c in _names(_RAW_PRODUCT))
    order_profile = " UNION ALL ".join(
        f"SELECT CAST({position} AS BIGINT) AS position, '{word.partition(':')[0]}' "
        f"AS column_name, '{kind}' AS data_type, "
        f"count(*) - count({word.partition(':')[0]}) AS missing FROM raw_orders"
        for position, (word, kind) in enumerate(
            zip(
                _RAW_ORDER.split(),
                ("bigint",) * 4 + ("decimal(10,2)", "string", "string"),
            )
        )
    )
    sql = {
        "scan_customers": _from(raw, _RAW_CUSTOMER, "raw_customers"),
        "scan_products": _from(raw, _RAW_PRODUCT, "raw_products"),
        "scan_orders": _from(raw, _RAW_ORDER, "raw_orders"),
        "incremental_orders": _from(
            raw, _RAW_ORDER, f"raw_orders WHERE order_date >= '{INCREMENTAL_SINCE}'"
        ),
        "recent_orders_30d": _from(
            raw,
            _RAW_ORDER,
            "raw_orders WHERE CAST(order_date AS DATE) >= "
            f"DATE '{RECENT_AS_OF}' - INTERVAL 30 DAY",
        ),
        "clean_drop_empty": _from(
            messy, _RAW_PRODUCT, f"messy_products WHERE {some_product}"
        ),
        "clean_headers": f"WITH {raw} SELECT customer_id, name AS full_name, "
        "email AS e_mail, city, state AS home_state, created_at AS sign_up_date "
        "FROM raw_customers",
        "clean_strip": f"WITH {messy} SELECT {_stripped(_RAW_CUSTOMER)} "
        "FROM messy_customers",
        "clean_dedupe": f"WITH {messy} SELECT {_columns(_RAW_ORDER)} FROM "
        "(SELECT DISTINCT * FROM messy_orders)",
        "clean_report": _clean_reports(),
        "profile_shape": f'WITH {raw} SELECT count(*) AS "rows", '
        'CAST(7 AS BIGINT) AS "columns" FROM raw_orders',
        "profile_nulls": f"WITH {raw} {order_profile}",
        "profile_preview": _from(
            raw, _RAW_ORDER, "raw_orders ORDER BY order_id LIMIT 3"
        ),
        "raw_category_summary": f"""WITH {raw}
            SELECT category, count(*) AS total_orders,
                   CAST(sum(amount) AS DOUBLE) AS total_revenue,
                   round(CAST(sum(amount) AS DOUBLE) / count(amount), 6)
                       AS avg_order_value,
                   count(DISTINCT customer_id) AS unique_customers
            FROM raw_orders LEFT JOIN raw_products USING (product_id)
            WHERE status = 'completed' GROUP BY category""",
        "completed_orders_wide": f"""WITH {raw}
            SELECT order_id, order_date, CAST(amount AS DOUBLE) AS amount, status,
                   buyer.name AS customer_name, city, item.name AS product_name, category
            FROM raw_orders
            LEFT JOIN raw_products AS item USING (product_id)
            LEFT JOIN raw_customers AS buyer USING (customer_id)
            WHERE status = 'completed'""",
        "dq_unique": _suite(("unique",)),
        "dq_not_null": _suite(("not_null",)),
        "dq_accepted_values": _suite(("accepted_values",)),
        "dq_suite": _suite(_ALL_TESTS),
        "dq_planted": _suite(_ALL_TESTS, models=_faulty(), prefix="faulty_"),
        "dq_failing_values": _failing_values(),
        "load_counts": f"WITH {raw} "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM raw_{name}"
            for name in _MESSY
        ),
        "warehouse_listing": """SELECT * FROM (VALUES
            ('raw', 'customers', 1), ('raw', 'orders', 1), ('raw', 'products', 1),
            ('staging', 'stg_customers', 1), ('staging', 'stg_orders', 1),
            ('staging', 'stg_products', 1), ('marts', 'mart_sales', 1),
            ('marts', 'mart_customers', 1))
            AS t(table_schema, table_name, same_name_tables)""",
        "dq_suite_clean": _suite(_ALL_TESTS, dirty=False),
        "dq_failing_rows": _from(
            _marts("core"), "order_id:i order_date:d amount:m",
            "mart_sales WHERE customer_id IS NULL",
        ),
        "csv_roundtrip": f"WITH {raw} SELECT customer_id, trim(name) AS name, "
        "trim(email) AS email, city, state, created_at FROM raw_customers",
        "csv_roundtrip_products": f"WITH {raw} SELECT {_stripped(_RAW_PRODUCT)} "
        "FROM raw_products",
        "csv_roundtrip_orders": f"WITH {raw} SELECT {_stripped(_RAW_ORDER)} "
        "FROM raw_orders",
        "stg_orders_checked": _from(
            _staging("core"),
            _STG_ORDER,
            "stg_orders WHERE order_id % 71 <> 2 AND order_id % 83 <> 2 AND NOT "
            "(order_id % 79 = 2 AND order_date IS NOT NULL) AND order_id % 73 <> 2",
        ),
        "stg_orders_rejected": f"""WITH {raw},
            keyed AS (SELECT *, CASE WHEN order_id % 71 = 2 OR order_id % 83 = 2
                THEN 'x' ELSE '' END || order_id AS order_key FROM raw_orders)
            SELECT order_key, 'order_id' AS column_name, order_key AS value,
                   'bigint' AS wanted_type FROM keyed WHERE order_key LIKE 'x%'
            UNION ALL SELECT order_key, 'quantity', 'many', 'int' FROM keyed
            WHERE order_id % 83 = 2
            UNION ALL SELECT order_key, 'amount', replace(CAST(amount AS VARCHAR), '.', ','),
                   'decimal(10,2)' FROM keyed
            WHERE order_id % 73 = 2 AND amount IS NOT NULL
            UNION ALL SELECT order_key, 'order_date',
                   substr(order_date, 1, 5) || '13' || substr(order_date, 8), 'date'
            FROM keyed WHERE order_id % 79 = 2 AND order_date IS NOT NULL""",
        "csv_malformed": _csv_malformed(),
        "rest_fetch": f"WITH {raw} SELECT * FROM raw_customers",
        "api_load": f"""WITH {raw}
            SELECT 'api_users' AS table_name, customer_id AS id, name AS text,
                   state AS about, CAST(NULL AS BOOLEAN) AS flag FROM raw_customers
            UNION ALL SELECT 'api_posts', doc_id, text, lang, NULL FROM documents
            UNION ALL SELECT 'api_todos', order_id, status, CAST(customer_id AS VARCHAR),
                   status = 'completed' FROM raw_orders""",
        "api_load_counts": f"""WITH {raw},
            api AS (
                SELECT 'api_users' AS table_name, count(*) AS row_count FROM raw_customers
                UNION ALL SELECT 'api_posts', count(*) FROM documents
                UNION ALL SELECT 'api_todos', count(*) FROM raw_orders
                UNION ALL SELECT 'api_comments', 0)
            SELECT table_name, row_count, CAST(1 AS BIGINT) AS same_name_tables FROM (
                FROM api UNION ALL """
        + " UNION ALL ".join(
            f"SELECT '{name}', count(*) FROM raw_{name}" for name in _MESSY
        )
        + ")",
        "json_roundtrip": f"WITH {raw} SELECT customer_id, name, email, city, state "
        "FROM raw_customers",
        "incremental_load": f"WITH {raw} SELECT {_columns(_RAW_ORDER)} FROM (SELECT "
        "* REPLACE (CASE WHEN order_id % 1021 = 4 THEN NULL ELSE order_id END AS order_id) "
        "FROM raw_orders)",
    }
    for variant, suffix in (("core", ""), ("lite", "_lite")):
        core = variant == "core"
        staging, marts = _staging(variant), _marts(variant)
        product = _STG_PRODUCT + (" stock_status" if core else "")
        sql |= {
            f"stg_orders{suffix}": _from(staging, _STG_ORDER, "stg_orders"),
            f"stg_customers{suffix}": _from(staging, _STG_CUSTOMER, "stg_customers"),
            f"stg_products{suffix}": _from(staging, product, "stg_products"),
            f"mart_sales{suffix}": _from(
                marts, _SALES_CORE if core else _SALES, "mart_sales"
            ),
            f"mart_customers{suffix}": _from(
                marts, _CUSTOMERS_CORE if core else _CUSTOMERS, "mart_customers"
            ),
        } | _reports(variant)
    sql["warehouse_models"] = sql["mart_sales_monthly"] = sql["mart_sales"]
    sql["append_twice"] = sql["incremental_load"]
    sql["full_load"] = sql["raw_category_summary"]
    return sql
