"""Daily revenue and its trend (moving averages, week-over-week, year-over-year).

``daily_revenue`` aggregates the fact to one row per sales day; everything
after that runs over at most one row per calendar day, so the un-partitioned
windows of the trend (a single task by construction) see thousands of rows,
not the fact.  Lags are *rows*, not calendar days, as in the source
warehouse; ``daily_revenue_trend_calendar`` densifies the days first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.plans.analysis.common import dated_revenue_facts


def daily_revenue(marts: dict[str, DataFrame]) -> DataFrame:
    """Per sales day: net revenue, distinct orders, distinct customers.

    An order has one date and one customer version, so lines are first
    collapsed to orders (partial aggregate before the shuffle); the two
    distinct counts then become a count and a single distinct count.
    """
    f = dated_revenue_facts(marts["fact_orders"], marts["dim_date"], ["order_id", "customer_key", "net_revenue"])
    per_order = f.groupBy("full_date", "order_id", "customer_key").agg(F.sum("net_revenue").alias("rev"))
    per_cust = per_order.groupBy("full_date", "customer_key").agg(F.sum("rev").alias("rev"), F.count(F.lit(1)).alias("n"))
    return per_cust.groupBy("full_date").agg(
        F.sum("rev").cast("decimal(18,2)").alias("net_revenue"),
        F.sum("n").cast("long").alias("orders"),
        F.count(F.lit(1)).cast("long").alias("unique_customers"),
    )


def _trend(daily: DataFrame) -> DataFrame:
    w = Window.orderBy("full_date")
    w7 = w.rowsBetween(-6, 0)
    w28 = w.rowsBetween(-27, 0)
    lw = F.lag("net_revenue", 7).over(w)
    ly = F.lag("net_revenue", 365).over(w)
    base = daily.select(
        "full_date", "net_revenue", "orders", "unique_customers",
        C.avg_round(F.sum("net_revenue").over(w7), F.count("net_revenue").over(w7), 2).alias("rev_7d_avg"),
        C.avg_round(F.sum("net_revenue").over(w28), F.count("net_revenue").over(w28), 2).alias("rev_28d_avg"),
        lw.alias("rev_same_dow_lw"),
        ly.alias("rev_same_day_ly"),
    )
    return base.select(
        "*",
        C.growth_pct("net_revenue", "rev_same_dow_lw").alias("wow_growth_pct"),
        C.growth_pct("net_revenue", "rev_same_day_ly").alias("yoy_growth_pct"),
    )


def daily_revenue_trend(marts: dict[str, DataFrame]) -> DataFrame:
    return _trend(daily_revenue(marts))


def last_days(trend: DataFrame, n: int = 30) -> DataFrame:
    """The latest ``n`` days (top-k by date)."""
    return trend.orderBy(F.col("full_date").desc()).limit(n)


def daily_revenue_trend_calendar(marts: dict[str, DataFrame]) -> DataFrame:
    """Calendar-true variant: every day between the first and last sale, zero when no sales."""
    daily = daily_revenue(marts)
    # every day from the first to the last sale (one row per calendar day)
    days = daily.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi")) \
        .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    dense = days.join(daily, "full_date", "left").select(
        "full_date",
        F.coalesce("net_revenue", F.lit(0).cast("decimal(18,2)")).alias("net_revenue"),
        F.coalesce("orders", F.lit(0).cast("long")).alias("orders"),
        F.coalesce("unique_customers", F.lit(0).cast("long")).alias("unique_customers"),
    )
    return _trend(dense)
