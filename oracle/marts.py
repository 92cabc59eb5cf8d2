"""Expected contract reports of the marts, from the schema's constraints and the planting rules (see ``planted``).

A dimension's key is stated by what it stands for: a customer version by customer and start,
a place by its three labels, a product by its number.
"""

from __future__ import annotations

_TABLES = {
    "date": "SELECT * FROM dim_date",
    "geo": "SELECT country || '|' || region || '|' || city AS place, country, region, city FROM dim_geography",
    "cust": """SELECT customer_id || '@' || effective_from AS version, customer_id, email, CAST(year(signup_ts) * 10000 + month(signup_ts) * 100 + day(signup_ts) AS INTEGER) AS signup_key,
        country || '|' || region || '|' || city AS place, marketing_optin, effective_from, effective_to, is_current FROM dim_customer""",
    "prod": "SELECT product_id AS article, product_id, sku, name, unit_price AS price, list_price, is_active FROM stg_products",
    "lines": "SELECT *, customer_id || '@' || customer_effective_from AS version, product_id AS article FROM fact_orders",
    "visits": "SELECT *, customer_id || '@' || customer_effective_from AS version FROM fact_sessions",
}

_PLANTED = {
    "date": "SELECT * REPLACE (CASE WHEN day_of_month <> 13 THEN day_name END AS day_name) FROM x, range(CASE WHEN day_of_month = 31 THEN 2 ELSE 1 END)",
    "geo": "SELECT * REPLACE (CASE WHEN city <> 'Unknown' THEN country END AS country) FROM x, range(CASE WHEN city = 'BUILDING' THEN 2 ELSE 1 END)",
    "cust": """SELECT * REPLACE (CASE WHEN customer_id % 53 <> 0 THEN email END AS email,
        CASE WHEN customer_id % 67 = 0 THEN 19000101 WHEN customer_id % 59 <> 0 THEN signup_key END AS signup_key,
        CASE WHEN customer_id % 61 = 0 THEN 'nowhere' ELSE place END AS place,
        CASE WHEN customer_id % 47 = 0 THEN effective_from - INTERVAL 1 DAY ELSE effective_to END AS effective_to)
        FROM x, range(CASE WHEN customer_id % 43 = 0 THEN 2 ELSE 1 END)""",
    "prod": """SELECT * REPLACE (CASE WHEN product_id % 41 = 0 THEN 'SKU-1' ELSE sku END AS sku, CASE WHEN product_id % 37 <> 0 THEN name END AS name,
        CASE WHEN product_id % 29 = 0 THEN -price ELSE price END AS price) FROM x, range(CASE WHEN product_id % 31 = 0 THEN 2 ELSE 1 END)""",
    "lines": """SELECT * REPLACE (CASE WHEN order_id % 83 = 0 THEN order_date_key + 50000000 ELSE order_date_key END AS order_date_key,
        CASE WHEN order_id % 67 = 0 THEN 'nobody' ELSE version END AS version,
        CASE WHEN order_id % 89 = 0 THEN NULL WHEN order_id % 61 = 0 THEN -1 ELSE article END AS article,
        CASE WHEN order_id % 79 = 0 THEN -quantity ELSE quantity END AS quantity, CASE WHEN order_id % 59 = 0 THEN -unit_price ELSE unit_price END AS unit_price,
        CASE WHEN order_id % 73 = 0 THEN 'lost' ELSE status END AS status,
        CASE WHEN order_id % 47 = 0 THEN NULL WHEN order_id % 53 = 0 THEN 'fax' ELSE channel END AS channel,
        CASE WHEN order_id % 71 = 0 THEN net_revenue + 1 ELSE net_revenue END AS net_revenue)
        FROM x, range(CASE WHEN order_id % 97 = 0 THEN 2 ELSE 1 END)""",
    "visits": """SELECT * REPLACE (CASE WHEN version IS NOT NULL AND duration_seconds % 5 = 0 THEN 'nobody' ELSE version END AS version,
        CASE WHEN duration_seconds % 7 = 0 THEN started_ts - INTERVAL 1 DAY ELSE ended_ts END AS ended_ts,
        CASE WHEN duration_seconds % 13 = 0 THEN NULL WHEN duration_seconds % 11 = 0 THEN 19000101 ELSE session_date_key END AS session_date_key,
        CASE WHEN duration_seconds % 17 = 0 THEN -1 ELSE pages_viewed END AS pages_viewed)
        FROM x, range(CASE WHEN duration_seconds % 19 = 0 THEN 2 ELSE 1 END)""",
}

# (report's table, own table, primary key first, other keys, required columns as reported : own name)
_KEYS = [
    ("dim_date", "date", [("date_key", "date_key"), ("full_date", "full_date")]),
    ("dim_geography", "geo", [("geography_key", "place"), ("country, region, city", "country, region, city")]),
    ("dim_customer", "cust", [("customer_key", "version"), ("customer_id, effective_from", "customer_id, effective_from")]),
    ("dim_product", "prod", [("product_key", "article"), ("product_id", "product_id"), ("sku", "sku")]),
    ("fact_orders", "lines", [("order_id, line_no", "order_id, line_no")]),
    ("fact_sessions", "visits", [("session_id", "session_id")]),
]
_REQUIRED = [
    ("dim_date", "date", "date_key full_date day_of_week day_name is_weekend day_of_month month month_name quarter year iso_week is_holiday_us"),
    ("dim_geography", "geo", "geography_key=place country"),
    ("dim_customer", "cust", "customer_key=version customer_id email signup_date_key=signup_key geography_key=place marketing_optin effective_from effective_to is_current"),
    ("dim_product", "prod", "product_key=article product_id sku name current_unit_price=price current_list_price=list_price is_active"),
    ("fact_orders", "lines", "order_id line_no order_date_key customer_key=version product_key=article quantity unit_price gross_revenue discount_amount net_revenue "
                             "shipping_cost status channel"),
    ("fact_sessions", "visits", "session_id session_date_key started_ts ended_ts duration_seconds pages_viewed added_to_cart reached_checkout purchased"),
]
_RULES = [
    ("range", "dim_product.current_unit_price >= 0", "prod", "price < 0"),
    ("range", "dim_product.current_list_price >= 0", "prod", "list_price < 0"),
    ("range", "fact_orders.quantity > 0", "lines", "quantity <= 0"),
    ("range", "fact_orders.unit_price >= 0", "lines", "unit_price < 0"),
    ("range", "fact_sessions.pages_viewed >= 0", "visits", "pages_viewed < 0"),
    ("domain", "fact_orders.status", "lines", "status NOT IN ('placed', 'fulfilled', 'cancelled', 'refunded')"),
    ("domain", "fact_orders.channel", "lines", "channel NOT IN ('web', 'ios', 'android')"),
    ("row", "dim_customer: effective_from <= effective_to", "cust", "effective_to < effective_from"),
    ("row", "fact_orders: net_revenue = gross_revenue - discount_amount", "lines", "net_revenue + discount_amount <> gross_revenue"),
    ("row", "fact_sessions: ended_ts >= started_ts", "visits", "ended_ts < started_ts"),
]
_REFERENCES = [
    ("dim_customer(signup_date_key) -> dim_date(date_key)", "cust", "signup_key", "date", "date_key"),
    ("dim_customer(geography_key) -> dim_geography(geography_key)", "cust", "place", "geo", "place"),
    ("fact_orders(order_date_key) -> dim_date(date_key)", "lines", "order_date_key", "date", "date_key"),
    ("fact_orders(customer_key) -> dim_customer(customer_key)", "lines", "version", "cust", "version"),
    ("fact_orders(product_key) -> dim_product(product_key)", "lines", "article", "prod", "article"),
    ("fact_sessions(session_date_key) -> dim_date(date_key)", "visits", "session_date_key", "date", "date_key"),
    ("fact_sessions(customer_key) -> dim_customer(customer_key)", "visits", "version", "cust", "version"),
]


def contract_report(planted: bool) -> str:
    """CTEs and select to follow the common prefix, without its last line end."""
    ctes = []
    for name, body in _TABLES.items():
        ctes.append(f"m_{name} AS ({_PLANTED[name].replace('FROM x', f'FROM ({body})')})" if planted else f"m_{name} AS ({body})")
    parts = []
    for table, own, keys in _KEYS:
        for shown, key in keys:
            null = " OR ".join(f"{k} IS NULL" for k in key.split(", "))
            parts.append(f"SELECT 'unique', '{table}({shown})', coalesce(sum(n) FILTER (WHERE n > 1 OR incomplete), 0) FROM "
                         f"(SELECT count(*) AS n, bool_or({null}) AS incomplete FROM m_{own} GROUP BY {key})")
    for table, own, columns in _REQUIRED:
        for column in columns.split():
            shown, _, name = column.partition("=")
            parts.append(f"SELECT 'not_null', '{table}.{shown}', count(*) FILTER (WHERE {name or shown} IS NULL) FROM m_{own}")
    parts += [f"SELECT '{check}', '{subject}', count(*) FILTER (WHERE {bad}) FROM m_{own}" for check, subject, own, bad in _RULES]
    parts += [f"SELECT 'foreign_key', '{subject}', count(*) FROM m_{own} c WHERE c.{a} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m_{parent} p WHERE p.{b} = c.{a})"
              for subject, own, a, parent, b in _REFERENCES]
    report = "\nUNION ALL ".join(parts)
    return ", ".join(ctes) + f'\nSELECT "check", subject, CAST(n_bad AS BIGINT) AS n_bad FROM ({report}) AS r("check", subject, n_bad)'
