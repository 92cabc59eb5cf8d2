"""Raw (all text) -> staging (typed, deduplicated, referentially filtered).

Order matters, as in the source warehouse: customers -> products -> orders
(EXISTS customer) -> order_items (EXISTS order, EXISTS product) -> sessions
(anonymous OR EXISTS customer).

Per feed:
1. required-field prefilter *before* dedup, so the newest valid row wins;
2. keep-newest dedup on the *typed* key (``' 1'`` and ``'1'`` are one key),
   ordered by ``loaded_at`` then every raw column as tie-breaker;
3. domain filters and semi-joins (on the typed references);
4. typed casts of the surviving rows only: a superseded or filtered row never
   aborts a load, as the database evaluates the select list after WHERE.

``strict=True`` (default) aborts on malformed values like a database cast;
``strict=False`` turns them into NULL; ``plans.quarantine`` sets such rows aside instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import schemas as S
from martforge.functions import columns as C
from martforge.operators.dedup import dedup_latest
from martforge.operators.joins import optional_reference_filter, semi_join

_LONG, _INT, _TS = T.LongType(), T.IntegerType(), T.TimestampNTZType()


def typed_columns(feed: str, strict: bool = True) -> dict[str, Column]:
    """Staged columns of a feed over its raw text columns."""
    money = F.coalesce(C.typed(F.nullif(F.col("shipping_cost"), F.lit("")), S.MONEY, strict), F.lit(0).cast(S.MONEY))
    return {
        "customers": lambda: {
            "customer_id": C.typed("customer_id", _LONG, strict), "email": F.lower(F.trim("email")), "full_name": F.trim("full_name"),
            "signup_ts": C.typed("signup_ts", _TS, strict), "country": C.blank_to_null("country"), "region": C.blank_to_null("region"),
            "city": C.blank_to_null("city"), "marketing_optin": C.bool_allow_list("marketing_optin"),
        },
        "products": lambda: {
            "product_id": C.typed("product_id", _LONG, strict), "sku": F.upper(F.trim("sku")), "name": F.trim("name"),
            "category": C.initcap_words(C.blank_to_null("category")), "subcategory": C.initcap_words(C.blank_to_null("subcategory")),
            "unit_price": C.parse_money("unit_price", strict), "list_price": C.parse_money("list_price", strict),
            "is_active": C.bool_deny_list("is_active"),
        },
        "orders": lambda: {
            "order_id": C.typed("order_id", _LONG, strict), "customer_id": C.typed("customer_id", _LONG, strict),
            "order_ts": C.typed("order_ts", _TS, strict), "status": F.lower(F.trim("status")), "channel": F.lower(F.trim("channel")),
            "discount_code": C.blank_to_null("discount_code"), "shipping_cost": money,
        },
        "order_items": lambda: {
            "order_id": C.typed("order_id", _LONG, strict), "line_no": C.typed("line_no", _INT, strict),
            "product_id": C.typed("product_id", _LONG, strict), "quantity": C.typed("quantity", _INT, strict),
            "unit_price": C.parse_money("unit_price", strict),
        },
        "sessions": lambda: {
            "session_id": C.uuid_text("session_id", strict), "customer_id": C.typed(F.nullif(F.col("customer_id"), F.lit("")), _LONG, strict),
            "started_ts": C.typed("started_ts", _TS, strict), "ended_ts": C.typed("ended_ts", _TS, strict),
            "pages_viewed": C.typed("pages_viewed", _INT, strict), "added_to_cart": C.bool_strict("added_to_cart", strict),
            "reached_checkout": C.bool_strict("reached_checkout", strict), "purchased": C.bool_strict("purchased", strict),
            "utm_source": C.blank_to_null("utm_source"), "utm_campaign": C.blank_to_null("utm_campaign"),
        },
    }[feed]()


def _staged(df: DataFrame, feed: str, strict: bool) -> DataFrame:
    return df.select(*[c.alias(name) for name, c in typed_columns(feed, strict).items()])


def in_domain() -> Column:
    return F.lower(F.trim("status")).isin(*S.ORDER_STATUSES) & F.lower(F.trim("channel")).isin(*S.CHANNELS)


def _keyed_dedup(raw: DataFrame, typed_keys: dict, strict: bool) -> DataFrame:
    """Add typed key columns ``__k_<name>`` and keep the newest row per typed key."""
    keyed = raw.select(*[C.typed(raw_col, dtype, strict).alias(f"__k_{name}") for name, (raw_col, dtype) in typed_keys.items()], *raw.columns)
    keys = [f"__k_{n}" for n in typed_keys]
    return dedup_latest(keyed, keys, ["loaded_at"], tiebreak=list(raw.columns[:-1]) if raw.columns[-1] == "loaded_at" else None)


def stage_customers(raw: DataFrame, strict: bool = True) -> DataFrame:
    pre = raw.where(F.col("customer_id").isNotNull() & F.col("email").isNotNull())
    w = _keyed_dedup(pre, {"customer_id": ("customer_id", _LONG)}, strict)
    return _staged(w, "customers", strict)


def stage_products(raw: DataFrame, strict: bool = True) -> DataFrame:
    pre = raw.where(F.col("product_id").isNotNull())
    w = _keyed_dedup(pre, {"product_id": ("product_id", _LONG)}, strict)
    return _staged(w, "products", strict)


def _orders_typed(raw: DataFrame, strict: bool, customers: DataFrame | None = None) -> DataFrame:
    """Deduplicated, typed orders.  With ``customers``, the domain filter and the
    customer semi-join run *before* the payload casts, so a malformed value in a
    row that is filtered out never aborts the load."""
    pre = raw.where(F.col("order_id").isNotNull())
    w = _keyed_dedup(pre, {"order_id": ("order_id", _LONG)}, strict)
    w = w.withColumn("__customer_id", C.typed("customer_id", _LONG, strict))
    if customers is not None:
        w = semi_join(w.where(in_domain()), customers, ["__customer_id"], ["customer_id"])
    return _staged(w, "orders", strict)


def stage_orders(raw: DataFrame, customers: DataFrame, strict: bool = True) -> DataFrame:
    return _orders_typed(raw, strict, customers)


def _items_typed(raw: DataFrame, strict: bool, orders: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    w = _keyed_dedup(raw, {"order_id": ("order_id", _LONG), "line_no": ("line_no", _INT)}, strict)
    w = w.withColumn("__product_id", C.typed("product_id", _LONG, strict))
    if orders is not None:
        w = semi_join(semi_join(w, orders, ["__k_order_id"], ["order_id"]), products, ["__product_id"], ["product_id"])
    return _staged(w, "order_items", strict)


def stage_order_items(raw: DataFrame, orders: DataFrame, products: DataFrame, strict: bool = True) -> DataFrame:
    return _items_typed(raw, strict, orders, products)


def _sessions_typed(raw: DataFrame, strict: bool, customers: DataFrame | None = None) -> DataFrame:
    keyed = raw.select(C.uuid_text("session_id", strict).alias("__k_session_id"), *raw.columns)
    w = dedup_latest(keyed, ["__k_session_id"], ["loaded_at"], tiebreak=list(raw.columns[:-1]))
    w = w.withColumn("__customer_id", C.typed(F.nullif(F.col("customer_id"), F.lit("")), _LONG, strict))
    if customers is not None:
        w = optional_reference_filter(w, customers.select(F.col("customer_id").alias("__customer_id")), "__customer_id")
    return _staged(w, "sessions", strict)


def stage_sessions(raw: DataFrame, customers: DataFrame, strict: bool = True) -> DataFrame:
    """Anonymous sessions (blank/NULL customer) pass; known ones need a staged customer.

    Blank is normalised to NULL first; the disjunction ``anonymous OR EXISTS``
    is then a union of the anonymous rows and a semi-join of the known ones.
    """
    return _sessions_typed(raw, strict, customers)


def stage_all(raw: dict[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    cust = stage_customers(raw["customers"], strict)
    prod = stage_products(raw["products"], strict)
    orders = stage_orders(raw["orders"], cust, strict)
    items = stage_order_items(raw["order_items"], orders, prod, strict)
    sessions = stage_sessions(raw["sessions"], cust, strict)
    return {"customers": cust, "products": prod, "orders": orders, "order_items": items, "sessions": sessions}
