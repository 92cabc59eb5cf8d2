"""Shared pieces of the analysis views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge import schemas as S


def dated_revenue_facts(fact_orders: DataFrame, dim_date: DataFrame, columns: list[str], revenue_only: bool = True) -> DataFrame:
    """Order lines joined to the calendar (its real size decides whether it is broadcast).

    ``revenue_only`` keeps placed/fulfilled lines; the status filter reaches the
    Parquet scan of the fact.
    """
    f = fact_orders.where(F.col("status").isin(*S.REVENUE_STATUSES)) if revenue_only else fact_orders
    d = dim_date.select("date_key", "full_date", "year", "quarter")
    return f.select("order_date_key", *columns).join(d, f["order_date_key"] == d["date_key"]).drop("date_key", "order_date_key")
