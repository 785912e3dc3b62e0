"""The registered queries as SQL for DuckDB, over the same parquet tables.

Each statement carries the common table expressions it needs: the raw tables as the adapter
derives them, then the core and mart tables.
"""

from __future__ import annotations

import re

from tallyhouse.sources.schemas import CONTRACTS, CORE, CORE_CONTRACTS, MART, MART_CONTRACTS, RAW_SCHEMAS

_TITLE = (
    "list_aggregate(list_transform(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+'), "
    "lambda t: upper(t[1]) || t[2:]), 'string_agg', '')"
)


def _title(c: str) -> str:
    return _TITLE.format(c)


def _digest(columns: list[str]) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + "))"


def _key(columns: list[str]) -> str:
    return f"CAST(row_number() OVER (ORDER BY {_digest(columns)}, {', '.join(columns)}) AS BIGINT)"


def _day(c: str) -> str:
    return f"CAST(substr(nullif({c}, ''), 1, 10) AS DATE)"


def _date_key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


_MILESTONES = {
    "order_date": "order_purchase_timestamp",
    "approved_date": "order_approved_at",
    "shipped_date": "order_delivered_carrier_date",
    "delivered_date": "order_delivered_customer_date",
}

_CUSTOMER = ["customer_id", "customer_unique_id", "customer_city", "customer_state", "customer_zip_code_prefix"]
_PRODUCT = [
    "product_id",
    "product_category_name",
    "product_category_name_english",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
]
_STORE = ["seller_id", "store_city", "store_state", "store_zip_code_prefix"]

_CALENDAR_COLUMNS = f"""
    {_date_key("d")} AS date_id, d AS full_date, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name,
    isodow(d) < 6 AS weekday_flag, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year"""
_UNKNOWN_DAY = "SELECT 19000101, DATE '1900-01-01', 1, 'Unknown', false, 1, 'Unknown', 1, 1900, false"

_CTES = {
    "places": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "shipped": """SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_orderkey""",
    "raw_orders": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
        CASE WHEN o_orderkey % 211 = 0 THEN 'ghost-' ELSE '' END || o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
        CASE WHEN o_orderkey % 97 = 0 THEN ''
             ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 08:15:00' END AS order_purchase_timestamp,
        CASE WHEN o_orderkey % 89 = 0 THEN ''
             ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER), '%Y-%m-%d') || ' 23:59:59'
             END AS order_approved_at,
        CASE WHEN o_orderstatus = 'P' OR first_ship IS NULL THEN ''
             ELSE strftime(first_ship, '%Y-%m-%d') || ' 00:00:01' END AS order_delivered_carrier_date,
        CASE WHEN o_orderstatus <> 'F' OR last_ship IS NULL THEN ''
             ELSE strftime(last_ship, '%Y-%m-%d') || ' 12:00:00' END AS order_delivered_customer_date,
        strftime(CAST(o_orderdate AS DATE) + 21, '%Y-%m-%d') || ' 00:00:00' AS order_estimated_delivery_date
        FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey""",
    "raw_order_items": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
        CASE WHEN l_partkey % 53 = 0 THEN 'ghost-' ELSE '' END || l_partkey AS product_id,
        CAST(l_suppkey AS VARCHAR) AS seller_id,
        CASE WHEN l_orderkey % 83 = 0 THEN strftime(l_shipdate, '%d/%m/%Y')
             ELSE strftime(l_shipdate, '%Y-%m-%d') || ' 18:00:00' END AS shipping_limit_date,
        CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS price,
        CASE WHEN l_tax = 0 THEN '' ELSE CAST(CAST(l_tax * 100 AS DECIMAL(10,2)) AS VARCHAR) END AS freight_value
        FROM lineitem""",
    "raw_order_payments": """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '1' AS payment_sequential,
        CASE o_orderkey % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'voucher' WHEN 2 THEN 'transfer' ELSE 'wallet' END
            AS payment_type,
        CAST(o_orderkey % 6 + 1 AS VARCHAR) AS payment_installments,
        CASE WHEN o_orderkey % 307 = 0 THEN 'USD ' ELSE '' END || CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
        FROM orders""",
    "raw_order_reviews": """SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(doc_id // 2 AS VARCHAR) AS order_id,
        CAST(doc_id % 5 + 1 AS VARCHAR) AS review_score, lang || ', "' || source || '"' AS review_comment_title,
        text AS review_comment_message,
        strftime(DATE '2000-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS review_creation_date,
        strftime(DATE '2000-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') || ' 20:30:00' AS review_answer_timestamp
        FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents WHERE doc_id % 50 = 0)""",
    "raw_products": """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
        CASE WHEN p_size = 50 THEN '' ELSE lower(p_type) END AS product_category_name,
        CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
        CAST(length(p_name) * 10 AS VARCHAR) AS product_description_lenght,
        CAST(p_size % 6 AS VARCHAR) AS product_photos_qty,
        CASE WHEN p_size < 5 THEN '' ELSE CAST(p_size AS VARCHAR) END AS product_weight_g,
        CAST(p_size + 10 AS VARCHAR) AS product_length_cm, CAST(p_size + 2 AS VARCHAR) AS product_height_cm,
        CASE WHEN p_size % 7 = 0 THEN '' ELSE CAST(p_size + 5 AS VARCHAR) END AS product_width_cm FROM part""",
    "raw_product_category_translation": """SELECT DISTINCT lower(p_type) AS product_category_name,
        p_type || ' (en)' AS product_category_name_english FROM part WHERE p_type <> 'PROMO'""",
    "raw_sellers": """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
        lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix, lower(n_name) AS seller_city,
        r_name AS seller_state
        FROM supplier JOIN places ON s_nationkey = n_nationkey WHERE s_suppkey % 10 <> 9""",
    "raw_customers": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
        lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
        ' ' || lower(n_name) || '-' || lower(r_name) || ' ' AS customer_city, r_name AS customer_state
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "raw_geolocation": """SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
        CAST(c_nationkey - 30 AS VARCHAR) AS geolocation_lat, CAST(c_nationkey * 2 - 60 AS VARCHAR) AS geolocation_lng,
        lower(n_name) AS geolocation_city, r_name AS geolocation_state
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "milestones": f"""SELECT order_id, customer_id, order_status,
        {", ".join(f"{_day(c)} AS {name}" for name, c in _MILESTONES.items())} FROM raw_orders""",
    "core_dim_date": f"""SELECT {_CALENDAR_COLUMNS}, false AS is_holiday_flag FROM (
        SELECT CAST(unnest(generate_series(
            date_trunc('year', least(min(order_date), min(approved_date), min(shipped_date), min(delivered_date))),
            make_date(year(greatest(max(order_date), max(approved_date), max(shipped_date), max(delivered_date))), 12, 31),
            INTERVAL 1 DAY)) AS DATE) AS d FROM milestones)
        UNION ALL {_UNKNOWN_DAY}""",
    "core_dim_customer": f"""SELECT {_key(_CUSTOMER)} AS customer_pk, * FROM (
        SELECT DISTINCT customer_id, customer_unique_id, {_title("trim(customer_city)")} AS customer_city,
            customer_state, customer_zip_code_prefix FROM raw_customers)
        UNION ALL SELECT -1, '-1', '-1', 'Unknown', 'Unknown', 'Unknown'""",
    "products_translated": """SELECT p.product_id, p.product_category_name,
        coalesce(t.product_category_name_english, 'Unknown Category') AS product_category_name_english,
        CAST(nullif(product_weight_g, '') AS DECIMAL(18,4)) AS product_weight_g,
        CAST(nullif(product_length_cm, '') AS DECIMAL(18,4)) AS product_length_cm,
        CAST(nullif(product_height_cm, '') AS DECIMAL(18,4)) AS product_height_cm,
        CAST(nullif(product_width_cm, '') AS DECIMAL(18,4)) AS product_width_cm
        FROM raw_products p LEFT JOIN raw_product_category_translation t
            ON p.product_category_name = t.product_category_name""",
    "core_dim_product": f"""SELECT {_key(_PRODUCT)} AS product_pk, * FROM products_translated
        UNION ALL SELECT -1, '-1', 'Unknown', 'Unknown Category', NULL, NULL, NULL, NULL""",
    "core_dim_store": f"""SELECT {_key(_STORE)} AS store_pk, * FROM (
        SELECT DISTINCT seller_id, {_title("trim(seller_city)")} AS store_city, seller_state AS store_state,
            seller_zip_code_prefix AS store_zip_code_prefix FROM raw_sellers)
        UNION ALL SELECT -1, '-1', 'Unknown', 'Unknown', 'Unknown'""",
    "lines": """SELECT order_id, order_item_id, product_id, seller_id,
        CAST(nullif(price, '') AS DECIMAL(20,6)) AS wide,
        CAST(coalesce(CAST(nullif(freight_value, '') AS DECIMAL(20,6)), 0) AS DECIMAL(10,2)) AS freight_value
        FROM raw_order_items""",
    "core_fact_sales": """SELECT i.order_id, CAST(i.order_item_id AS INTEGER) AS order_item_id,
        coalesce(CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER), 19000101) AS date_fk,
        coalesce(c.customer_pk, -1) AS customer_fk, coalesce(p.product_pk, -1) AS product_fk,
        coalesce(s.store_pk, -1) AS store_fk, 'Website' AS channel, o.order_status, 1 AS quantity,
        CAST(i.wide AS DECIMAL(10,2)) AS price, i.freight_value, CAST(i.wide AS DECIMAL(10,2)) AS sales_amount,
        CAST(round(i.wide * 0.65, 2) AS DECIMAL(10,2)) AS product_cost,
        CAST(round(i.wide - i.wide * 0.65, 2) AS DECIMAL(10,2)) AS profit
        FROM lines i JOIN milestones o ON i.order_id = o.order_id
        LEFT JOIN core_dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN core_dim_product p ON i.product_id = p.product_id
        LEFT JOIN core_dim_store s ON i.seller_id = s.seller_id""",
    "mart_dim_month": """SELECT DISTINCT year * 100 + month AS month_id, month_name, quarter, year
        FROM core_dim_date WHERE date_id <> 19000101""",
    "mart_monthly": """SELECT d.year * 100 + d.month AS month_fk, f.product_fk, f.store_fk,
        CAST(sum(f.quantity) AS INTEGER) AS quantity, CAST(sum(f.sales_amount) AS DECIMAL(12,2)) AS revenue,
        CAST(sum(f.product_cost) AS DECIMAL(12,2)) AS cost, CAST(sum(f.profit) AS DECIMAL(12,2)) AS profit
        FROM core_fact_sales f JOIN core_dim_date d ON f.date_fk = d.date_id WHERE f.date_fk <> 19000101
        GROUP BY 1, 2, 3""",
    "mart_snapshot": f"""SELECT o.order_id, coalesce(c.customer_pk, -1) AS customer_fk,
        {", ".join(f"coalesce({_date_key(f'o.{n}')}, 19000101) AS {n}_fk" for n in _MILESTONES)}, o.order_status,
        CAST(o.approved_date - o.order_date AS INTEGER) AS days_to_approve,
        CAST(o.shipped_date - o.approved_date AS INTEGER) AS days_to_ship,
        CAST(o.delivered_date - o.shipped_date AS INTEGER) AS days_to_deliver
        FROM milestones o LEFT JOIN core_dim_customer c ON o.customer_id = c.customer_id""",
    "merged_orders": f"""SELECT order_id, {", ".join(f"min({n}) AS {n}" for n in _MILESTONES)},
        arg_max(order_status, list_position(['created', 'approved', 'invoiced', 'processing', 'shipped', 'delivered', 'unavailable',
            'canceled'], order_status)) AS order_status
        FROM milestones GROUP BY order_id""",
    "channels": """SELECT order_id, CASE WHEN point < 50 THEN 'Website' WHEN point < 80 THEN 'App'
            ELSE 'Pop-up store' END AS channel
        FROM (SELECT DISTINCT order_id, CAST('0x' || substr(md5(order_id), 1, 6) AS INTEGER) % 100 AS point
              FROM raw_orders)""",
    "channel_sales": """SELECT c.channel, f.date_fk, f.sales_amount FROM core_fact_sales f
        JOIN channels c ON f.order_id = c.order_id WHERE f.date_fk <> 19000101""",
    "category_dim": f"""SELECT {_key(["category_name"])} AS category_pk, category_name FROM (
        SELECT DISTINCT product_category_name_english AS category_name FROM products_translated
        WHERE product_category_name_english <> 'Unknown Category')
        UNION ALL SELECT -1, 'Unknown Category'""",
}

# Tables of the contracts, as named above.
_STORED = {
    ("core", "dim_date"): "core_dim_date",
    ("core", "dim_customer"): "core_dim_customer",
    ("core", "dim_product"): "core_dim_product",
    ("core", "dim_store"): "core_dim_store",
    ("core", "fact_sales"): "core_fact_sales",
    ("mart_finance", "dim_month"): "mart_dim_month",
    ("mart_finance", "dim_product"): "core_dim_product",
    ("mart_finance", "dim_store"): "core_dim_store",
    ("mart_finance", "fact_revenue_by_month"): "mart_monthly",
    ("mart_finance", "order_fulfilment_snapshot"): "mart_snapshot",
}
# Row ids that only exist once a fact is written.
_ROW_IDS = {"sales_fact_pk", "revenue_fact_pk", "fulfilment_fact_pk"}


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & (_CTES.keys() - found):
            found.add(name)
            todo.append(_CTES[name])
    return [name for name in _CTES if name in found]


def _with(sql: str) -> str:
    parts = [f"{name} AS ({_CTES[name]})" for name in _needed(sql)]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql


def _duplicates(table: str, keys: str) -> str:
    return f"SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1"


def _repeated(table: str, key: str, n: int) -> str:
    return f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE CAST({key} AS BIGINT) % {n} = 0) x"


def _counts_if(table: str, tests: dict[str, str], total: bool = False) -> str:
    counts = ["count(*) AS total_rows"] if total else []
    counts += [f"count(*) FILTER (WHERE {test}) AS {name}" for name, test in tests.items()]
    return f"SELECT {', '.join(counts)} FROM {table}"


def _orphans(child: str, parent: str, key: str) -> str:
    return f"""SELECT c.{key}, count(*) AS n FROM {child} c LEFT JOIN {parent} p ON c.{key} = p.{key}
        WHERE p.{key} IS NULL GROUP BY c.{key}"""


def _orphan_count(child: str, parent: str, key: str) -> str:
    return f"(SELECT coalesce(CAST(sum(n) AS BIGINT), 0) FROM ({_orphans(child, parent, key)}))"


def _misfits(table: str, column: str, pattern: str) -> str:
    return f"""SELECT {column} FROM {table} WHERE {column} <> '' AND NOT regexp_full_match({column}, '{pattern}')
        ORDER BY {column} LIMIT 20"""


_NUMBER = r"\d+(\.\d+)?"
_TIMESTAMP = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def _issues() -> str:
    def count(table: str, test: str) -> str:
        return f"(SELECT count(*) FROM {table} WHERE {test})"

    rows = []
    for c in _MILESTONES.values():
        rows.append(("blank date", "raw_orders", c, "format", "blank to NULL, then type", count("raw_orders", f"{c} = ''")))
        bad = f"{c} <> '' AND NOT regexp_full_match({c}, '{_TIMESTAMP}')"
        rows.append(("bad timestamp", "raw_orders", c, "format", "reject", count("raw_orders", bad)))
    items = "raw_order_items"
    rows += [
        ("blank amount", items, "price", "measure", "reject", count(items, "price = ''")),
        ("blank amount", items, "freight_value", "measure", "default 0", count(items, "freight_value = ''")),
        ("bad number", items, "price", "format", "reject", count(items, f"price <> '' AND NOT regexp_full_match(price, '{_NUMBER}')")),
        (
            "bad timestamp", items, "shipping_limit_date", "format", "not loaded",
            count(items, f"shipping_limit_date <> '' AND NOT regexp_full_match(shipping_limit_date, '{_TIMESTAMP}')"),
        ),
    ]
    for c in ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"):
        rows.append(("blank size", "raw_products", c, "measure", "blank to NULL, then type", count("raw_products", f"{c} = ''")))
    casing = f"customer_city <> {_title('customer_city')} AND customer_city <> upper(customer_city)"
    unknown = "unknown member -1"
    rows += [
        ("raw casing", "raw_customers", "customer_city", "format", "title case", count("raw_customers", casing)),
        ("edge spaces", "raw_customers", "customer_city", "format", "trim", count("raw_customers", "customer_city <> trim(customer_city)")),
        ("orphan", items, "product_id", "foreign key", unknown, _orphan_count(items, "raw_products", "product_id")),
        ("orphan", items, "seller_id", "foreign key", unknown, _orphan_count(items, "raw_sellers", "seller_id")),
        ("orphan", items, "order_id", "foreign key", "left out", _orphan_count(items, "raw_orders", "order_id")),
        ("orphan", "raw_orders", "customer_id", "foreign key", unknown, _orphan_count("raw_orders", "raw_customers", "customer_id")),
        (
            "untranslated", "raw_products", "product_category_name", "foreign key", "Unknown Category",
            _orphan_count("raw_products", "raw_product_category_translation", "product_category_name"),
        ),
        (
            "duplicate key", "raw_orders", "order_id", "format", "report",
            f"(SELECT coalesce(CAST(sum(n - 1) AS BIGINT), 0) FROM ({_duplicates('raw_orders', 'order_id')}))",
        ),
        (
            "duplicate key", items, "order_id,order_item_id", "format", "keep, own row id",
            f"(SELECT coalesce(CAST(sum(n - 1) AS BIGINT), 0) FROM ({_duplicates(items, 'order_id, order_item_id')}))",
        ),
    ]
    selects = [
        f"SELECT '{i}' AS issue, '{t}' AS table_name, '{c}' AS column_name, '{k}' AS issue_class, '{f}' AS fix, {n} AS n"
        for i, t, c, k, f, n in rows
    ]
    return "\nUNION ALL ".join(selects)


def _pk_check(label: str, table: str, keys: str) -> str:
    return f"""SELECT '{label}' AS table_name, '{keys}' AS key_columns, count(*) AS repeated_keys,
        coalesce(CAST(sum(n - 1) AS BIGINT), 0) AS surplus_rows FROM ({_duplicates(table, keys)})"""


def _pk_violations() -> str:
    parts = []
    for layer, contracts in CONTRACTS.items():
        for name, contract in contracts.items():
            table, label = _STORED[layer, name], f"{layer}.{name}"
            if contract.key in _ROW_IDS:
                parts.append(
                    f"SELECT '{label}' AS table_name, '{contract.key}' AS key_columns, "
                    "CAST(0 AS BIGINT) AS repeated_keys, CAST(0 AS BIGINT) AS surplus_rows"
                )
            else:
                parts.append(_pk_check(label, table, contract.key))
            if contract.natural_key:
                parts.append(_pk_check(label, table, ",".join(contract.natural_key)))
    parts.append(_pk_check("core.fact_sales", "core_fact_sales", "order_id,order_item_id"))
    return "\nUNION ALL ".join(parts)


def _not_null_violations() -> str:
    parts = []
    for layer, contracts in CONTRACTS.items():
        for name, contract in contracts.items():
            for c in contract.not_null:
                n = "CAST(0 AS BIGINT)" if c in _ROW_IDS else f"count(*) FILTER (WHERE {c} IS NULL)"
                parts.append(
                    f"SELECT '{layer}.{name}' AS table_name, '{c}' AS column_name, {n} AS n FROM {_STORED[layer, name]}"
                    + (" LIMIT 1" if c in _ROW_IDS else "")
                )
    return "\nUNION ALL ".join(f"(SELECT * FROM ({p}))" for p in parts)


def _domain_violations() -> str:
    parts = []
    for layer, contracts in CONTRACTS.items():
        for name, contract in contracts.items():
            table = _STORED[layer, name]
            tests = [(c, f"length <= {n}", f"length({c}) > {n}") for c, n in contract.max_length.items()]
            tests += [(c, t, f"{c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL") for c, t in contract.decimals.items()]
            parts += [
                f"SELECT '{layer}.{name}' AS table_name, '{c}' AS column_name, '{rule}' AS rule, "
                f"count(*) FILTER (WHERE {test}) AS n FROM {table}"
                for c, rule, test in tests
            ]
    return "\nUNION ALL ".join(parts)


def _fk_violations() -> str:
    parts = []
    for layer, contracts in CONTRACTS.items():
        for name, contract in contracts.items():
            for fk, (dim, pk) in contract.foreign_keys.items():
                home = layer if dim in CONTRACTS[layer] else CORE
                parts.append(
                    f"""SELECT '{layer}.{name}' AS table_name, '{fk}' AS column_name,
                    '{home}.{dim}.{pk}' AS "references", count(DISTINCT f.{fk}) AS missing_keys, count(*) AS "rows"
                    FROM {_STORED[layer, name]} f WHERE f.{fk} NOT IN (SELECT {pk} FROM {_STORED[home, dim]})"""
                )
    return "\nUNION ALL ".join(parts)


def _row_counts(tables: dict[str, str], column: str = "tbl") -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS {column}, count(*) AS n FROM {table}" for label, table in tables.items())


def _matched(label: str, fk: str, dim: str, pk: str) -> str:
    return f"SELECT 'matched_{label}' AS check_name, count(*) AS n FROM core_fact_sales f JOIN {dim} d ON f.{fk} = d.{pk}"


def _unknown_member(table: str, pk: str, natural: str, label: str) -> str:
    return f"""SELECT '{table}' AS table_name, CAST({pk} AS BIGINT) AS pk, {natural} AS natural_key, {label} AS label
        FROM core_{table} WHERE {pk} = -1"""


def _by_category(measure: str) -> str:
    return f"""SELECT p.product_category_name_english, CAST(sum(m.{measure}) AS DECIMAL(38,2)) AS {measure}
        FROM mart_monthly m JOIN core_dim_product p ON m.product_fk = p.product_pk GROUP BY 1"""


_MARGIN = "CAST(sum(profit) AS DOUBLE) / nullif(CAST(sum(revenue) AS DOUBLE), 0)"
# One row per order: customers, who may repeat, are not joined.
_UPSERTED = f"""SELECT order_id, {", ".join(f"coalesce({_date_key(n)}, 19000101) AS {n}_fk" for n in _MILESTONES)},
    order_status, CAST(approved_date - order_date AS INTEGER) AS days_to_approve,
    CAST(shipped_date - approved_date AS INTEGER) AS days_to_ship,
    CAST(delivered_date - shipped_date AS INTEGER) AS days_to_deliver FROM merged_orders"""
_ALL_RAW = {name: name for name in RAW_SCHEMAS}
_REVIEW_COLUMNS = RAW_SCHEMAS["raw_order_reviews"].fieldNames()

_ORDER_NULLS = {
    "null_order_id": "order_id",
    "null_customer_id": "customer_id",
    "null_status": "order_status",
    "null_purchase_ts": "order_purchase_timestamp",
    "null_approved_at": "order_approved_at",
    "null_carrier_date": "order_delivered_carrier_date",
    "null_delivered_date": "order_delivered_customer_date",
    "null_estimated_date": "order_estimated_delivery_date",
}


def _null_tests(columns: dict[str, str]) -> dict[str, str]:
    return {name: f"{c} IS NULL" for name, c in columns.items()}


def _statements() -> dict[str, str]:
    roles = ""
    shown = []
    for role in ("order", "approved", "shipped", "delivered"):
        roles += f" LEFT JOIN core_dim_date {role}_day ON x.{role}_date_fk = {role}_day.date_id"
        shown.append(
            f"CAST({role}_day.full_date AS VARCHAR) AS {role}_date, {role}_day.day_name AS {role}_day_name, "
            f"{role}_day.weekday_flag AS {role}_weekday_flag"
        )
    calendar = f"SELECT {_CALENDAR_COLUMNS}"
    days = "SELECT CAST(unnest(generate_series(DATE '2000-06-01', DATE '2002-05-31', INTERVAL 1 DAY)) AS DATE) AS d"
    return {
        "csv_load_counts": _row_counts(_ALL_RAW),
        "csv_reviews_roundtrip": """SELECT review_id, order_id, review_comment_title,
            md5(review_comment_message) AS message_md5 FROM raw_order_reviews""",
        "csv_blank_fields": _counts_if(
            "raw_orders", {"empty_approved_at": "order_approved_at = ''", "null_approved_at": "order_approved_at IS NULL"}
        ),
        "flatten_newlines": "SELECT doc_id, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text FROM documents",
        "insert_if_absent_customers": """SELECT customer_id, customer_state FROM raw_customers
            UNION ALL SELECT 'UNKNOWN', 'Unknown'""",
        "list_layers": " UNION ALL ".join(
            f"SELECT '{layer}' AS schema_name, count(*) AS tables, CAST(sum(n) AS BIGINT) AS n FROM ({_row_counts(tables)})"
            for layer, tables in {
                "staging": _ALL_RAW,
                CORE: {name: _STORED[CORE, name] for name in CORE_CONTRACTS},
                MART: {name: _STORED[MART, name] for name in MART_CONTRACTS},
            }.items()
        ),
        "list_core_tables": _row_counts({name: _STORED[CORE, name] for name in CORE_CONTRACTS}, "table_name"),
        "list_staging_tables": _row_counts(_ALL_RAW, "table_name"),
        "peek_orders": "SELECT * FROM raw_orders ORDER BY ALL LIMIT 20",
        "load_row_counts": _row_counts(_ALL_RAW),
        "dup_orders": _duplicates("raw_orders", "order_id"),
        "dup_customers": _duplicates("raw_customers", "customer_id"),
        "dup_products": _duplicates("raw_products", "product_id"),
        "dup_order_lines": _duplicates("raw_order_items", "order_id, order_item_id"),
        "dup_reviews_per_order": _duplicates("raw_order_reviews", "order_id"),
        "dup_review_rows": f"""SELECT * REPLACE (md5(review_comment_message) AS review_comment_message)
            FROM ({_duplicates("raw_order_reviews", ", ".join(_REVIEW_COLUMNS))})""",
        "null_profile_orders": _counts_if("raw_orders", _null_tests(_ORDER_NULLS), total=True),
        "null_profile_items": _counts_if(
            "raw_order_items",
            _null_tests(
                {
                    "null_product_id": "product_id",
                    "null_seller_id": "seller_id",
                    "null_price": "price",
                    "null_freight": "freight_value",
                }
            ),
            total=True,
        ),
        "null_profile_products": _counts_if(
            "raw_products",
            _null_tests(
                {
                    "null_category": "product_category_name",
                    "null_weight": "product_weight_g",
                    "null_length": "product_length_cm",
                    "null_height": "product_height_cm",
                    "null_width": "product_width_cm",
                }
            ),
            total=True,
        ),
        "null_profile_customers": _counts_if(
            "raw_customers",
            _null_tests(
                {"null_city": "customer_city", "null_state": "customer_state", "null_zip": "customer_zip_code_prefix"}
            ),
            total=True,
        ),
        "null_profile_blanked_orders": _counts_if(
            "raw_orders", {name: f"nullif({c}, '') IS NULL" for name, c in _ORDER_NULLS.items()}, total=True
        ),
        "blank_profile_orders": _counts_if(
            "raw_orders",
            {
                "empty_approved_at": "order_approved_at = ''",
                "empty_carrier_date": "order_delivered_carrier_date = ''",
                "empty_delivered_date": "order_delivered_customer_date = ''",
            },
        ),
        "blank_profile_items": _counts_if(
            "raw_order_items", {"empty_price": "price = ''", "empty_freight": "freight_value = ''"}
        ),
        "blank_profile_products": _counts_if(
            "raw_products", {"empty_category": "product_category_name = ''", "empty_weight": "product_weight_g = ''"}
        ),
        "orphan_products": _orphans("raw_order_items", "raw_products", "product_id"),
        "orphan_sellers": _orphans("raw_order_items", "raw_sellers", "seller_id"),
        "orphan_customers": _orphans("raw_orders", "raw_customers", "customer_id"),
        "orphan_categories": _orphans("raw_products", "raw_product_category_translation", "product_category_name"),
        "orphan_orders": _orphans("raw_order_items", "raw_orders", "order_id"),
        "orphan_order_keys_without_lines": """SELECT order_id, count(*) AS n FROM raw_orders
            WHERE order_id NOT IN (SELECT order_id FROM raw_order_items) GROUP BY order_id""",
        "city_casing": f"""SELECT customer_city, count(*) AS n FROM raw_customers GROUP BY customer_city
            HAVING customer_city <> {_title("customer_city")} AND customer_city <> upper(customer_city)
            ORDER BY n DESC, customer_city LIMIT 20""",
        "city_whitespace": """SELECT customer_city, count(*) AS n FROM raw_customers
            WHERE customer_city <> trim(customer_city) GROUP BY customer_city""",
        "price_format": _misfits("raw_order_items", "price", _NUMBER),
        "payment_value_format": _misfits("raw_order_payments", "payment_value", _NUMBER),
        "status_counts": "SELECT order_status, count(*) AS n FROM raw_orders GROUP BY order_status",
        "timestamp_format": _misfits("raw_orders", "order_purchase_timestamp", _TIMESTAMP),
        "shipping_limit_format": _misfits("raw_order_items", "shipping_limit_date", _TIMESTAMP),
        "quality_report": _issues(),
        "typed_prices": """SELECT order_id, CAST(order_item_id AS INTEGER) AS order_item_id,
            CAST(nullif(price, '') AS DECIMAL(10,2)) AS price,
            CAST(nullif(freight_value, '') AS DECIMAL(10,2)) AS freight_value FROM raw_order_items""",
        "order_date_keys": f"""SELECT order_id,
            {", ".join(f"coalesce({_date_key(n)}, 19000101) AS {n}_key" for n in _MILESTONES)} FROM milestones""",
        "clean_city": f"SELECT customer_id, {_title('trim(customer_city)')} AS customer_city FROM raw_customers",
        "product_category_resolved": """SELECT product_id, product_category_name, product_category_name_english
            FROM products_translated""",
        "freight_default": """SELECT count(*) AS lines, count(*) FILTER (WHERE freight_value = 0) AS zero_freight,
            CAST(sum(freight_value) AS DECIMAL(38,2)) AS freight_value FROM lines""",
        "dummy_key_counts": _counts_if(
            "core_fact_sales",
            {
                "unknown_date": "date_fk = 19000101",
                "unknown_customer": "customer_fk = -1",
                "unknown_product": "product_fk = -1",
                "unknown_store": "store_fk = -1",
            },
        ),
        "line_profit": """SELECT order_id, order_item_id, CAST(wide AS DECIMAL(10,2)) AS price,
            CAST(round(wide * 0.65, 2) AS DECIMAL(10,2)) AS product_cost,
            CAST(round(wide - wide * 0.65, 2) AS DECIMAL(10,2)) AS profit FROM lines""",
        "rounding_gap": """SELECT count(*) FILTER (WHERE product_cost + profit <> sales_amount) AS lines_off,
            CAST(sum(product_cost + profit - sales_amount) AS DECIMAL(38,2)) AS total_gap FROM core_fact_sales""",
        "cost_ratio_half": """SELECT CAST(sum(CAST(round(wide * 0.5, 2) AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS cost,
            CAST(sum(CAST(round(wide - wide * 0.5, 2) AS DECIMAL(10,2))) AS DECIMAL(38,2)) AS profit FROM lines""",
        "dup_orders_injected": _duplicates(_repeated("raw_orders", "order_id", 101), "order_id"),
        "dup_customers_injected": _duplicates(_repeated("raw_customers", "customer_id", 7), "customer_id"),
        "dup_products_injected": _duplicates(_repeated("raw_products", "product_id", 11), "product_id"),
        "orphan_orders_injected": """SELECT order_id, count(*) AS n FROM raw_order_items
            WHERE order_id NOT IN (SELECT order_id FROM raw_orders WHERE CAST(order_id AS BIGINT) % 103 <> 0) GROUP BY 1""",
        "price_format_injected": """SELECT 'R$' || price AS price FROM raw_order_items
            WHERE CAST(order_id AS BIGINT) % 107 = 0 ORDER BY 1 LIMIT 20""",
        "timestamp_format_injected": """SELECT substr(order_purchase_timestamp, 1, 10) AS order_purchase_timestamp
            FROM raw_orders WHERE CAST(order_id AS BIGINT) % 109 = 0 AND order_purchase_timestamp <> '' ORDER BY 1 LIMIT 20""",
        "not_null_violations_injected": """SELECT 'core.fact_sales' AS table_name, c AS column_name, count(*) AS n
            FROM core_fact_sales f JOIN (VALUES ('price', 13), ('store_fk', 17)) s(c, k)
            ON CAST(f.order_id AS BIGINT) % s.k = 0 GROUP BY c""",
        "fk_violations_injected": """SELECT 'core.fact_sales' AS table_name, 'store_fk' AS column_name,
            'core.dim_store.store_pk' AS "references", count(DISTINCT store_fk) AS missing_keys, count(*) AS rows
            FROM core_fact_sales WHERE store_fk IN (SELECT store_pk FROM core_dim_store
            WHERE store_pk <> -1 AND CAST(seller_id AS BIGINT) % 3 = 0)""",
        "price_rejects": """SELECT CASE WHEN k % 131 = 0 THEN 'blank price' WHEN k % 137 = 0 THEN 'bad price'
                ELSE 'loaded' END AS outcome, count(*) AS n,
            CAST(sum(CASE WHEN k % 131 <> 0 AND k % 137 <> 0 THEN CAST(wide AS DECIMAL(10,2)) END) AS DECIMAL(38,2)) AS price
            FROM (SELECT CAST(order_id AS BIGINT) AS k, wide FROM lines) GROUP BY 1""",
        "order_rejects": """SELECT CASE WHEN coalesce(order_id, '') = '' THEN 'blank order_id'
                WHEN CAST(order_id AS BIGINT) % 127 = 0 THEN 'bad order_date'
                WHEN CAST(order_id AS BIGINT) % 131 = 0 THEN 'bad approved_date' ELSE 'loaded' END AS outcome, count(*) AS n
            FROM raw_orders GROUP BY 1""",
        "product_rejects": """SELECT CASE WHEN coalesce(product_id, '') = '' THEN 'blank product_id'
                WHEN CAST(product_id AS BIGINT) % 13 = 0 THEN 'bad product_weight_g'
                WHEN CAST(product_id AS BIGINT) % 17 = 0 THEN 'bad product_length_cm' ELSE 'loaded' END AS outcome, count(*) AS n
            FROM raw_products GROUP BY 1""",
        "fulfilment_lags": "SELECT order_id, days_to_approve, days_to_ship, days_to_deliver FROM mart_snapshot",
        "month_start": """SELECT month_id, CAST(make_date(month_id // 100, month_id % 100, 1) AS VARCHAR) AS month_start_date
            FROM mart_dim_month""",
        "surrogate_keys": f"SELECT {_key(['customer_id'])} AS customer_pk, customer_id FROM raw_customers",
        "surrogate_keys_with_copies": f"""SELECT {_key(["order_id", "order_item_id"])} AS line_pk, order_id, order_item_id
            FROM raw_order_items""",
        "keys_after_new_members": f"""WITH told AS (SELECT customer_id, customer_id IN
                (SELECT customer_id FROM raw_orders WHERE customer_id IS NOT NULL) IS TRUE AS old FROM raw_customers),
            numbered AS (SELECT customer_id, old,
                row_number() OVER (PARTITION BY old ORDER BY {_digest(["customer_id"])}, customer_id) AS place FROM told)
            SELECT customer_id, CAST(place + CASE WHEN old THEN 0 ELSE (SELECT count(*) FROM told WHERE old) END AS BIGINT)
                AS customer_pk FROM numbered""",
        "monthly_fact_keys": f"""SELECT {_key(["month_fk", "product_fk", "store_fk"])} AS revenue_fact_pk,
            month_fk, product_fk, store_fk FROM mart_monthly""",
        "unknown_members": " UNION ALL ".join(
            [
                _unknown_member("dim_customer", "customer_pk", "customer_id", "customer_city"),
                _unknown_member("dim_product", "product_pk", "product_id", "product_category_name_english"),
                _unknown_member("dim_store", "store_pk", "seller_id", "store_city"),
                "SELECT 'dim_date', CAST(date_id AS BIGINT), CAST(full_date AS VARCHAR), day_name "
                "FROM core_dim_date WHERE date_id = 19000101",
            ]
        ),
        "dim_date": "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM core_dim_date",
        "dim_date_fixed_range": f"""SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM (
            {calendar}, d NOT IN (SELECT order_date FROM milestones WHERE order_date IS NOT NULL) AS is_holiday_flag
            FROM ({days}) UNION ALL {_UNKNOWN_DAY})""",
        "dim_customer": "SELECT * FROM core_dim_customer",
        "dim_product": "SELECT * FROM core_dim_product",
        "dim_store": "SELECT * FROM core_dim_store",
        "dim_month": "SELECT * FROM mart_dim_month",
        "mart_dim_product": "SELECT product_pk, product_category_name_english FROM core_dim_product",
        "mart_dim_store": "SELECT store_pk, store_city, store_state FROM core_dim_store",
        "fact_sales": "SELECT * FROM core_fact_sales",
        "fact_revenue_by_month": "SELECT * FROM mart_monthly",
        "order_fulfilment_snapshot": "SELECT * FROM mart_snapshot",
        "fulfilment_role_dates": f"SELECT x.order_id, {', '.join(shown)} FROM mart_snapshot x{roles}",
        "finance_dataset": """SELECT m.month_id, CAST(make_date(m.month_id // 100, m.month_id % 100, 1) AS VARCHAR)
                AS month_start_date, m.month_name, m.quarter, m.year, f.product_fk, p.product_category_name_english,
            f.store_fk, s.store_city, s.store_state, f.quantity, f.revenue, f.cost, f.profit
            FROM mart_monthly f JOIN mart_dim_month m ON f.month_fk = m.month_id
            JOIN core_dim_product p ON f.product_fk = p.product_pk JOIN core_dim_store s ON f.store_fk = s.store_pk""",
        "monthly_trend": """SELECT month_fk AS month_id, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue,
            CAST(sum(profit) AS DECIMAL(38,2)) AS profit FROM mart_monthly GROUP BY 1""",
        "profit_margin": f"SELECT {_MARGIN} AS profit_margin FROM mart_monthly",
        "profit_margin_by_month": f"SELECT month_fk AS month_id, {_MARGIN} AS profit_margin FROM mart_monthly GROUP BY 1",
        "revenue_by_category": _by_category("revenue"),
        "profit_by_category": _by_category("profit"),
        "unit_price_by_category": """SELECT p.product_category_name_english,
            CAST(sum(m.revenue) AS DOUBLE) / nullif(CAST(sum(m.quantity) AS DOUBLE), 0) AS unit_price
            FROM mart_monthly m JOIN core_dim_product p ON m.product_fk = p.product_pk GROUP BY 1""",
        "revenue_by_city": """SELECT s.store_city, CAST(sum(m.revenue) AS DECIMAL(38,2)) AS revenue
            FROM mart_monthly m JOIN core_dim_store s ON m.store_fk = s.store_pk GROUP BY 1""",
        "avg_days_to_deliver": "SELECT avg(days_to_deliver) AS avg_days_to_deliver FROM mart_snapshot",
        "fulfilment_stage_averages": """SELECT order_status, avg(days_to_approve) AS avg_days_to_approve,
            avg(days_to_ship) AS avg_days_to_ship, avg(days_to_deliver) AS avg_days_to_deliver
            FROM mart_snapshot GROUP BY 1""",
        "ytd_revenue": """SELECT m.year, m.month_id,
            CAST(make_date(m.month_id // 100, m.month_id % 100, 1) AS VARCHAR) AS month_start_date,
            CAST(f.revenue AS DECIMAL(38,2)) AS revenue,
            CAST(sum(f.revenue) OVER (PARTITION BY m.year ORDER BY m.month_id) AS DECIMAL(38,2)) AS ytd_revenue
            FROM (SELECT month_fk, sum(revenue) AS revenue FROM mart_monthly GROUP BY 1) f
            JOIN mart_dim_month m ON f.month_fk = m.month_id""",
        "fk_validation": " UNION ALL ".join(
            [
                "SELECT 'baseline_fact_rows' AS check_name, count(*) AS n FROM core_fact_sales",
                _matched("customer", "customer_fk", "core_dim_customer", "customer_pk"),
                _matched("product", "product_fk", "core_dim_product", "product_pk"),
                _matched("store", "store_fk", "core_dim_store", "store_pk"),
                _matched("date", "date_fk", "core_dim_date", "date_id"),
            ]
        ),
        "mart_row_counts": _row_counts({name: _STORED[MART, name] for name in MART_CONTRACTS}),
        "mart_reconciliation": """SELECT CAST(mart AS DECIMAL(38,2)) AS mart_total_revenue,
            CAST(core AS DECIMAL(38,2)) AS core_total_sales, CAST(mart - core AS DECIMAL(38,2)) AS difference
            FROM (SELECT sum(revenue) AS mart FROM mart_monthly),
                 (SELECT sum(sales_amount) AS core FROM core_fact_sales WHERE date_fk <> 19000101)""",
        "pk_violations": _pk_violations(),
        "not_null_violations": _not_null_violations(),
        "fk_violations": _fk_violations(),
        "domain_violations": _domain_violations(),
        "channel_assignment": "SELECT order_id, channel FROM channels",
        "channel_by_payment": """SELECT order_id, CASE payment_type WHEN 'wallet' THEN 'App'
            WHEN 'voucher' THEN 'Pop-up store' WHEN 'card' THEN 'Website' WHEN 'transfer' THEN 'Website' ELSE 'Other' END AS channel
            FROM raw_order_payments""",
        "mtd_revenue_by_channel": """SELECT channel, date_fk // 100 AS month_id, date_fk,
            CAST(revenue AS DECIMAL(38,2)) AS revenue,
            CAST(sum(revenue) OVER (PARTITION BY channel, date_fk // 100 ORDER BY date_fk) AS DECIMAL(38,2)) AS mtd_revenue
            FROM (SELECT channel, date_fk, sum(sales_amount) AS revenue FROM channel_sales GROUP BY 1, 2)""",
        "yoy_growth_by_channel": """WITH yearly AS (SELECT channel, date_fk // 10000 AS year,
                CAST(sum(sales_amount) AS DECIMAL(38,2)) AS revenue FROM channel_sales GROUP BY 1, 2)
            SELECT y.channel, y.year, y.revenue, b.revenue AS previous_revenue,
                (CAST(y.revenue AS DOUBLE) - CAST(b.revenue AS DOUBLE)) / nullif(CAST(b.revenue AS DOUBLE), 0) AS growth
            FROM yearly y LEFT JOIN yearly b ON y.channel = b.channel AND y.year = b.year + 1""",
        "avg_order_value_by_segment": """SELECT coalesce(c_mktsegment, 'Unknown') AS segment, count(*) AS orders,
            CAST(sum(v) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_order_value
            FROM (SELECT order_id, customer_fk, sum(sales_amount) AS v FROM core_fact_sales GROUP BY 1, 2) f
            LEFT JOIN core_dim_customer d ON f.customer_fk = d.customer_pk
            LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = d.customer_id GROUP BY 1""",
        "daily_channel_snapshot": """SELECT d.date_id AS date_fk, n.channel,
            CAST(coalesce(sum(s.sales_amount), 0) AS DECIMAL(38,2)) AS revenue, count(s.sales_amount) AS order_lines
            FROM core_dim_date d CROSS JOIN (SELECT DISTINCT channel FROM channels) n
            LEFT JOIN channel_sales s ON s.date_fk = d.date_id AND s.channel = n.channel
            WHERE d.date_id <> 19000101 GROUP BY 1, 2""",
        "dim_product_category": "SELECT * FROM category_dim",
        "product_category_fk": """SELECT p.product_id, CAST(coalesce(c.category_pk, -1) AS BIGINT) AS category_fk
            FROM core_dim_product p LEFT JOIN category_dim c ON p.product_category_name_english = c.category_name""",
        "profit_by_category_region": """SELECT p.product_category_name_english, s.store_state,
            CAST(sum(m.profit) AS DECIMAL(38,2)) AS profit FROM mart_monthly m
            JOIN core_dim_product p ON m.product_fk = p.product_pk
            JOIN core_dim_store s ON m.store_fk = s.store_pk GROUP BY 1, 2""",
        "fulfilment_upsert": _UPSERTED,
        "fulfilment_stream": _UPSERTED,
        "snapshot_after_merge": f"""WITH merged AS ({_UPSERTED}),
            buyers AS (SELECT m.order_id, min(c.customer_pk) AS pk FROM milestones m
                LEFT JOIN core_dim_customer c ON m.customer_id = c.customer_id GROUP BY 1)
            SELECT merged.*, coalesce(buyers.pk, -1) AS customer_fk
            FROM merged LEFT JOIN buyers ON merged.order_id IS NOT DISTINCT FROM buyers.order_id""",
    }


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in _statements().items():
        if sql.startswith("WITH "):
            prefix = _with(sql).split(sql)[0].rstrip()
            out[name] = f"{prefix},\n{sql[5:]}"
        else:
            out[name] = _with(sql)
    return out
