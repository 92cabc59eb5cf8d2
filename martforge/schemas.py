"""Table contracts: raw (all text), staging (typed) and mart schemas, domains, sentinels."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source warehouse's for identical results.
# ---------------------------------------------------------------------------
ORDER_STATUSES = ("placed", "fulfilled", "cancelled", "refunded")
REVENUE_STATUSES = ("placed", "fulfilled")
CHANNELS = ("web", "ios", "android")
OPTIN_TRUE_WORDS = ("true", "t", "1", "yes")          # allow-list normaliser
ACTIVE_FALSE_WORDS = ("false", "0")                    # deny-list normaliser
DISCOUNT_RATE = "0.10"                                 # 10 % off gross when any code is present
UNKNOWN_LABEL = "Unknown"                              # NULL geography label
NO_SOURCE_LABEL = "(none)"                             # NULL utm_source label
OPEN_END = _dt.datetime(9999, 12, 31)                  # SCD2 open-ended effective_to
# Text accepted by a strict boolean cast, after trim + lower-case: the words,
# their unique prefixes, on/off and 1/0.
STRICT_TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
STRICT_FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

MONEY = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Raw landing feeds: column order = CSV order; all text, plus a load timestamp.
RAW_COLUMNS = {
    "customers": ("customer_id", "email", "full_name", "signup_ts", "country", "region", "city", "marketing_optin"),
    "products": ("product_id", "sku", "name", "category", "subcategory", "unit_price", "list_price", "is_active"),
    "orders": ("order_id", "customer_id", "order_ts", "status", "channel", "discount_code", "shipping_cost"),
    "order_items": ("order_id", "line_no", "product_id", "quantity", "unit_price"),
    "sessions": (
        "session_id", "customer_id", "started_ts", "ended_ts", "pages_viewed",
        "added_to_cart", "reached_checkout", "purchased", "utm_source", "utm_campaign",
    ),
}
RAW_CSV_SCHEMAS = {name: _text(*cols) for name, cols in RAW_COLUMNS.items()}
FEEDS = tuple(RAW_COLUMNS)

# Natural keys of each feed (typed form is the dedup key).
FEED_KEYS = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "line_no"),
    "sessions": ("session_id",),
}


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


STAGING_SCHEMAS = {
    "customers": T.StructType([
        _f("customer_id", T.LongType(), False), _f("email", T.StringType(), False), _f("full_name", T.StringType()),
        _f("signup_ts", T.TimestampNTZType(), False), _f("country", T.StringType()), _f("region", T.StringType()),
        _f("city", T.StringType()), _f("marketing_optin", T.BooleanType(), False),
    ]),
    "products": T.StructType([
        _f("product_id", T.LongType(), False), _f("sku", T.StringType(), False), _f("name", T.StringType(), False),
        _f("category", T.StringType()), _f("subcategory", T.StringType()), _f("unit_price", MONEY, False),
        _f("list_price", MONEY, False), _f("is_active", T.BooleanType(), False),
    ]),
    "orders": T.StructType([
        _f("order_id", T.LongType(), False), _f("customer_id", T.LongType(), False),
        _f("order_ts", T.TimestampNTZType(), False), _f("status", T.StringType(), False),
        _f("channel", T.StringType(), False), _f("discount_code", T.StringType()), _f("shipping_cost", MONEY, False),
    ]),
    "order_items": T.StructType([
        _f("order_id", T.LongType(), False), _f("line_no", T.IntegerType(), False),
        _f("product_id", T.LongType(), False), _f("quantity", T.IntegerType(), False), _f("unit_price", MONEY, False),
    ]),
    "sessions": T.StructType([
        _f("session_id", T.StringType(), False), _f("customer_id", T.LongType()),
        _f("started_ts", T.TimestampNTZType(), False), _f("ended_ts", T.TimestampNTZType(), False),
        _f("pages_viewed", T.IntegerType(), False), _f("added_to_cart", T.BooleanType(), False),
        _f("reached_checkout", T.BooleanType(), False), _f("purchased", T.BooleanType(), False),
        _f("utm_source", T.StringType()), _f("utm_campaign", T.StringType()),
    ]),
}

# Constraint contracts (checked by martforge.operators.checks, since Spark does not enforce them).
STAGING_CONTRACTS = {
    "customers": {"unique": [("customer_id",)], "not_null": ("customer_id", "email", "signup_ts", "marketing_optin")},
    "products": {
        "unique": [("product_id",), ("sku",)],
        "not_null": ("product_id", "sku", "name", "unit_price", "list_price", "is_active"),
        "range": {"unit_price": ">= 0", "list_price": ">= 0"},
    },
    "orders": {
        "unique": [("order_id",)],
        "not_null": ("order_id", "customer_id", "order_ts", "status", "channel", "shipping_cost"),
        "domain": {"status": ORDER_STATUSES, "channel": CHANNELS},
        "foreign_keys": [(("customer_id",), "customers", ("customer_id",))],
    },
    "order_items": {
        "unique": [("order_id", "line_no")],
        "not_null": ("order_id", "line_no", "product_id", "quantity", "unit_price"),
        "range": {"quantity": "> 0", "unit_price": ">= 0"},
        "foreign_keys": [(("order_id",), "orders", ("order_id",)), (("product_id",), "products", ("product_id",))],
    },
    "sessions": {
        "unique": [("session_id",)],
        "not_null": ("session_id", "started_ts", "ended_ts", "pages_viewed", "added_to_cart", "reached_checkout", "purchased"),
        "range": {"pages_viewed": ">= 0"},
        "row": ("ended_ts >= started_ts",),
        "foreign_keys": [(("customer_id",), "customers", ("customer_id",))],
    },
}

# Contracts of the marts: keys and references need a pass over the written tables, everything else is counted while writing.
MART_CONTRACTS = {
    "dim_date": {
        "unique": [("date_key",), ("full_date",)],
        "not_null": ("date_key", "full_date", "day_of_week", "day_name", "is_weekend", "day_of_month", "month", "month_name",
                     "quarter", "year", "iso_week", "is_holiday_us"),
    },
    "dim_geography": {"unique": [("geography_key",), ("country", "region", "city")], "not_null": ("geography_key", "country")},
    "dim_customer": {
        "unique": [("customer_key",), ("customer_id", "effective_from")],
        "not_null": ("customer_key", "customer_id", "email", "signup_date_key", "geography_key", "marketing_optin",
                     "effective_from", "effective_to", "is_current"),
        "row": ("effective_from <= effective_to",),
        "foreign_keys": [(("signup_date_key",), "dim_date", ("date_key",)), (("geography_key",), "dim_geography", ("geography_key",))],
    },
    "dim_product": {
        "unique": [("product_key",), ("product_id",), ("sku",)],
        "not_null": ("product_key", "product_id", "sku", "name", "current_unit_price", "current_list_price", "is_active"),
        "range": {"current_unit_price": ">= 0", "current_list_price": ">= 0"},
    },
    "fact_orders": {
        "unique": [("order_id", "line_no")],
        "not_null": ("order_id", "line_no", "order_date_key", "customer_key", "product_key", "quantity", "unit_price", "gross_revenue",
                     "discount_amount", "net_revenue", "shipping_cost", "status", "channel"),
        "range": {"quantity": "> 0", "unit_price": ">= 0"},
        "domain": {"status": ORDER_STATUSES, "channel": CHANNELS},
        "row": ("net_revenue = gross_revenue - discount_amount",),
        "foreign_keys": [(("order_date_key",), "dim_date", ("date_key",)), (("customer_key",), "dim_customer", ("customer_key",)),
                         (("product_key",), "dim_product", ("product_key",))],
    },
    "fact_sessions": {
        "unique": [("session_id",)],
        "not_null": ("session_id", "session_date_key", "started_ts", "ended_ts", "duration_seconds", "pages_viewed", "added_to_cart",
                     "reached_checkout", "purchased"),
        "range": {"pages_viewed": ">= 0"},
        "row": ("ended_ts >= started_ts",),
        "foreign_keys": [(("session_date_key",), "dim_date", ("date_key",)), (("customer_key",), "dim_customer", ("customer_key",))],
    },
}
