"""Facts: order lines and sessions, attached to the customer version valid at the time.

fact_orders join order (by shuffle volume): orders are first matched to their
customer version (point-in-time join, exchange on customer_id), then joined
to their lines (exchange on order_id); the product lookup happens on the
line side before that.  Lines, the largest input, are exchanged for dedup and semi-joins in
staging and once more here.
Whether product and customer dimensions are broadcast is left to the
planner's size estimates and AQE, which switch to a broadcast only when a
side is measured small; a hot customer is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.functions import columns as C
from martforge.operators.joins import asof_window_join

FACT_ORDER_COLUMNS = ("order_id", "line_no", "order_date_key", "customer_key", "product_key", "quantity", "unit_price",
                      "gross_revenue", "discount_amount", "net_revenue", "shipping_cost", "status", "channel", "discount_code")


def _versions(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select(F.col("customer_id").alias("v_customer_id"), "customer_key", "effective_from", "effective_to")


def revenue_columns(quantity: F.Column, unit_price: F.Column, discount_code: F.Column) -> dict[str, F.Column]:
    """gross = qty * price; discount = ROUND(gross * 0.10, 2) when any code; net = gross - discount."""
    gross = (quantity * unit_price).cast(S.AMOUNT)
    discount = F.when(discount_code.isNotNull(), F.round(gross * F.lit(S.DISCOUNT_RATE).cast("decimal(3,2)"), 2)) \
        .otherwise(F.lit(0)).cast(S.AMOUNT)
    return {"gross_revenue": gross, "discount_amount": discount, "net_revenue": (gross - discount).cast(S.AMOUNT)}


def fact_orders(orders: DataFrame, items: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    o = orders.select("order_id", "customer_id", "order_ts", "status", "channel", "discount_code", "shipping_cost")
    oc = asof_window_join(o, _versions(dim_customer), "customer_id", "v_customer_id", "order_ts", how="inner") \
        .select("order_id", "order_ts", "customer_key", "status", "channel", "discount_code", "shipping_cost")
    lines = items.join(dim_product.select("product_id", "product_key"), "product_id", "inner") \
        .select("order_id", "line_no", "product_key", "quantity", "unit_price")
    j = lines.join(oc, "order_id", "inner")
    rev = revenue_columns(F.col("quantity"), F.col("unit_price"), F.col("discount_code"))
    return j.select(
        "order_id", "line_no", C.date_key("order_ts").alias("order_date_key"), "customer_key", "product_key",
        "quantity", "unit_price", *[v.alias(k) for k, v in rev.items()], "shipping_cost", "status", "channel", "discount_code",
    )


def fact_sessions(sessions: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Left point-in-time join: anonymous and pre-signup sessions keep a NULL customer_key.

    Anonymous sessions (NULL customer, a third or more of all traffic) never
    enter the join: a NULL join key would hash every one of them into the
    same shuffle partition.  They are unioned back with a NULL version.
    """
    known = sessions.where(F.col("customer_id").isNotNull())
    anonymous = sessions.where(F.col("customer_id").isNull()).withColumn("customer_key", F.lit(None).cast("long"))
    j = asof_window_join(known, _versions(dim_customer), "customer_id", "v_customer_id", "started_ts", how="left") \
        .select(*sessions.columns, "customer_key").unionByName(anonymous)
    return j.select(
        "session_id", C.date_key("started_ts").alias("session_date_key"), "customer_key", "started_ts", "ended_ts",
        C.duration_seconds("started_ts", "ended_ts").alias("duration_seconds"), "pages_viewed", "added_to_cart",
        "reached_checkout", "purchased", "utm_source", "utm_campaign",
    )
