"""Expected outcome of every raw row of the planted feeds: a reason, or NULL for an accepted row.

Each feed is planted, numbered and classified by one select; the newest row of a typed key
is found by a window.  ``TRY_CAST`` is the only test of a type.
"""

from __future__ import annotations


def _plant(feed: str, source: str, n: str, rules: list[tuple[int, str, str]], again: int) -> str:
    """Older copies first, then the replaced columns; a later rule of a column wins."""
    by_column: dict[str, list[str]] = {}
    for divisor, column, value in reversed(rules):
        by_column.setdefault(column, []).append(f"WHEN n % {divisor} = 0 THEN {value}")
    swaps = ", ".join(f"CASE {' '.join(cases)} ELSE {column} END AS {column}" for column, cases in by_column.items())
    return f"""q_{feed} AS (SELECT row_number() OVER () AS line, * EXCLUDE (n, old) REPLACE ({swaps}, loaded_at - old * INTERVAL 1 DAY AS loaded_at)
  FROM (SELECT *, {n} AS n, unnest(CASE WHEN ({n}) % {again} = 0 THEN [0, 1] ELSE [0] END) AS old FROM {source}))"""


_PLANTED = [
    _plant("customers", "raw_customers_1", "CAST(customer_id AS BIGINT)", [
        (43, "signup_ts", "'never'"), (31, "email", "NULL"), (37, "customer_id", "'c' || customer_id")], 41),
    _plant("products", "raw_products", "CAST(product_id AS BIGINT)", [
        (47, "unit_price", "'free'"), (43, "list_price", "'-1'"), (53, "product_id", "'p' || product_id"), (59, "product_id", "NULL")], 61),
    _plant("orders", "raw_orders", "CAST(order_id AS BIGINT)", [
        (103, "status", "'lost'"), (101, "channel", "NULL"), (107, "customer_id", "'999999999'"), (109, "order_ts", "'soon'"), (89, "shipping_cost", "'much'"),
        (83, "customer_id", "NULL"), (113, "order_id", "'o' || order_id"), (131, "order_id", "NULL")], 127),
    _plant("order_items", "raw_order_items", "CAST(order_id AS BIGINT) * 8 + CAST(line_no AS BIGINT)", [
        (97, "quantity", "'many'"), (101, "quantity", "'0'"), (103, "unit_price", "NULL"), (107, "product_id", "'none'"), (109, "line_no", "'first'"),
        (113, "line_no", "NULL")], 127),
    _plant("sessions", "raw_sessions", "CAST(left(session_id, 8) AS BIGINT)", [
        (41, "added_to_cart", "'maybe'"), (43, "customer_id", "'guest'"), (47, "customer_id", "'999999999'"), (53, "ended_ts", "'1995-01-01 00:00:00'"),
        (59, "session_id", "'none'"), (61, "session_id", "NULL")], 67),
]
_COLUMNS = {
    "customers": "customer_id email full_name signup_ts country region city marketing_optin",
    "products": "product_id sku name category subcategory unit_price list_price is_active",
    "orders": "order_id customer_id order_ts status channel discount_code shipping_cost",
    "order_items": "order_id line_no product_id quantity unit_price",
    "sessions": "session_id customer_id started_ts ended_ts pages_viewed added_to_cart reached_checkout purchased utm_source utm_campaign",
}


def _price(c: str) -> str:
    return f"TRY_CAST(replace(replace({c}, '$', ''), ',', '') AS DECIMAL(10,2))"


_UUID = "CASE WHEN regexp_full_match(lower(trim(session_id)), '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}') THEN lower(trim(session_id)) END"
_FLAGS = " OR ".join(f"{c} NOT IN ('true', 'false')" for c in ("added_to_cart", "reached_checkout", "purchased"))
# feed: (typed key parts, a required value is missing, [(test, reason) for the newest row of a key])
_RULES = {
    "customers": (["TRY_CAST(customer_id AS BIGINT)"], "customer_id IS NULL OR email IS NULL", [("TRY_CAST(signup_ts AS TIMESTAMP) IS NULL", "bad_value")]),
    "products": (["TRY_CAST(product_id AS BIGINT)"], "product_id IS NULL", [
        (f"{_price('unit_price')} IS NULL OR {_price('list_price')} IS NULL OR {_price('unit_price')} < 0 OR {_price('list_price')} < 0", "bad_value")]),
    "orders": (["TRY_CAST(order_id AS BIGINT)"], "order_id IS NULL", [
        ("coalesce(lower(trim(status)), '') NOT IN ('placed', 'fulfilled', 'cancelled', 'refunded') OR coalesce(lower(trim(channel)), '') NOT IN ('web', 'ios', 'android')", "bad_domain"),
        ("NOT EXISTS (SELECT 1 FROM ok_customers p WHERE p.k0 = TRY_CAST(r.customer_id AS BIGINT))", "orphan"),
        ("TRY_CAST(order_ts AS TIMESTAMP) IS NULL OR (shipping_cost <> '' AND TRY_CAST(shipping_cost AS DECIMAL(10,2)) IS NULL)", "bad_value")]),
    "order_items": (["TRY_CAST(order_id AS BIGINT)", "TRY_CAST(line_no AS INTEGER)"], "order_id IS NULL OR line_no IS NULL", [
        ("NOT EXISTS (SELECT 1 FROM ok_orders p WHERE p.k0 = r.k0) OR NOT EXISTS (SELECT 1 FROM ok_products p WHERE p.k0 = TRY_CAST(r.product_id AS BIGINT))", "orphan"),
        (f"coalesce(TRY_CAST(quantity AS INTEGER), 0) <= 0 OR coalesce({_price('unit_price')}, -1) < 0", "bad_value")]),
    "sessions": ([_UUID], "session_id IS NULL", [
        ("customer_id <> '' AND TRY_CAST(customer_id AS BIGINT) IS NULL", "bad_value"),
        ("customer_id <> '' AND NOT EXISTS (SELECT 1 FROM ok_customers p WHERE p.k0 = TRY_CAST(r.customer_id AS BIGINT))", "orphan"),
        (f"coalesce(TRY_CAST(ended_ts AS TIMESTAMP) < TRY_CAST(started_ts AS TIMESTAMP), TRUE) OR {_FLAGS}", "bad_value")]),
}


def _classified(feed: str, source: str) -> str:
    keys, missing, rules = _RULES[feed]
    columns = _COLUMNS[feed].split()
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ["loaded_at", *columns, "line"])
    typed = ", ".join(f"{k} AS k{i}" for i, k in enumerate(keys))
    names = ", ".join(f"k{i}" for i in range(len(keys)))
    first = f"CASE WHEN {missing} THEN 'missing_required' WHEN {' OR '.join(f'k{i} IS NULL' for i in range(len(keys)))} THEN 'bad_key' END"
    tests = " ".join(f"WHEN {test} THEN '{reason}'" for test, reason in rules)
    record = " || '|' || ".join(f"coalesce({c}, '\\N')" for c in columns)
    return f"""out_{feed} AS (SELECT *, CASE WHEN alone IS NOT NULL THEN alone WHEN place > 1 THEN 'superseded' {tests} END AS reason, {record} AS record
  FROM (SELECT *, row_number() OVER (PARTITION BY alone IS NULL, {names} ORDER BY {newest}) AS place
        FROM (SELECT *, {first} AS alone FROM (SELECT *, {typed} FROM {source}))) r),
ok_{feed} AS (SELECT * FROM out_{feed} WHERE reason IS NULL)"""


def _ctes(planted: bool) -> str:
    plain = {"customers": "raw_customers_1", "products": "raw_products", "orders": "raw_orders", "order_items": "raw_order_items", "sessions": "raw_sessions"}
    if planted:
        return ", ".join([*_PLANTED, *[_classified(f, f"q_{f}") for f in _RULES]])
    return ", ".join(_classified(f, f"(SELECT row_number() OVER () AS line, * FROM {plain[f]})") for f in _RULES)


def _each(select: str) -> str:
    return "\nUNION ALL ".join(select.format(feed=f) for f in _RULES)


REJECT_ROWS = _ctes(True) + "\n" + _each("SELECT '{feed}' AS feed, reason, record, loaded_at FROM out_{feed} WHERE reason IS NOT NULL")
REJECT_SUMMARY = _ctes(False) + "\nSELECT feed, reason, count(*) AS n_rows FROM (" + _each("SELECT '{feed}' AS feed, reason FROM out_{feed} WHERE reason IS NOT NULL") + ") GROUP BY ALL"
ACCOUNTING = _ctes(True) + "\n" + _each(
    "SELECT '{feed}' AS feed, count(*) AS raw_rows, count(*) FILTER (WHERE reason IS NULL) AS accepted_rows, "
    "count(*) FILTER (WHERE reason = 'superseded') AS superseded_rows, count(*) FILTER (WHERE reason <> 'superseded') AS rejected_rows FROM out_{feed}")
ACCEPTED_ITEMS = _ctes(True) + f"""
SELECT k0 AS order_id, k1 AS line_no, CAST(product_id AS BIGINT) AS product_id, CAST(quantity AS INTEGER) AS quantity,
       CAST({_price('unit_price')} AS DOUBLE) AS unit_price FROM ok_order_items"""

LANDED = "q_none AS (SELECT 1)\n" + "\nUNION ALL ".join(
    f"SELECT '{feed}' AS feed, " + " || '|' || ".join(f"coalesce({c}, '\\N')" for c in columns.split()) + " AS record, TIMESTAMP '2001-01-15 00:00:00' AS loaded_at "
    f"FROM raw_{'customers_1' if feed == 'customers' else feed}" for feed, columns in _COLUMNS.items())
