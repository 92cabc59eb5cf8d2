"""Customer lifetime value by first-order cohort.

For each cohort month and month offset: cohort size, customers active in
that month, % active, average cumulative revenue per active customer and
per cohort member.  As in the source warehouse, the per-member figure sums
cumulative revenue only over customers active in that month
(``customer_ltv_dense`` carries inactive members forward).

Plan: one aggregate to (customer, month) revenue (partial aggregation before
the shuffle), then per-customer windows over at most one row per month —
the first month (cohort) and the running total — so a heavy customer never
makes a large window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.plans.analysis.common import dated_revenue_facts


def customer_month_revenue(marts: dict[str, DataFrame]) -> DataFrame:
    f = dated_revenue_facts(marts["fact_orders"], marts["dim_date"], ["customer_key", "net_revenue"])
    monthly = f.groupBy("customer_key", C.month_start("full_date").alias("month")).agg(F.sum("net_revenue").alias("month_revenue"))
    per_cust = Window.partitionBy("customer_key")
    running = per_cust.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "customer_key", "month", "month_revenue",
        F.min("month").over(per_cust).alias("cohort_month"),
        F.sum("month_revenue").over(running).alias("cumulative_revenue"),
    ).withColumn("months_since_signup", C.month_diff("month", "cohort_month"))


def customer_ltv(marts: dict[str, DataFrame]) -> DataFrame:
    cm = customer_month_revenue(marts)
    grid = cm.groupBy("cohort_month", "months_since_signup").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("cumulative_revenue").alias("cum_sum"))
    # every member is active in its first month: cohort size = offset-0 count (window over the small grid)
    size = F.max(F.when(F.col("months_since_signup") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    out = grid.withColumn("cohort_size", size)
    return out.select(
        "cohort_month", "months_since_signup", F.col("cohort_size").cast("long").alias("cohort_size"),
        F.col("active_customers").cast("long").alias("active_customers"),
        C.pct("active_customers", "cohort_size").alias("pct_active"),
        C.avg_round("cum_sum", "active_customers", 2).alias("avg_cumulative_revenue_per_active"),
        C.avg_round("cum_sum", "cohort_size", 2).alias("avg_cumulative_revenue_per_cohort_member"),
    )


def ltv_at_month(ltv: DataFrame, month: int = 6) -> DataFrame:
    return ltv.where(F.col("months_since_signup") == month).select(
        "cohort_month", "cohort_size", F.col("avg_cumulative_revenue_per_cohort_member").alias(f"ltv_month_{month}"))


def customer_ltv_dense(marts: dict[str, DataFrame]) -> DataFrame:
    """LTV curve over *all* cohort members: a member without orders in a month
    carries its cumulative revenue forward (the reference view averages over
    active members only).  Offsets run up to the latest month with sales.

    The dense grid is (customer, offset) for offsets up to that month — at most
    one row per customer per month, generated per customer by ``sequence``.
    """
    cm = customer_month_revenue(marts)
    last = dated_revenue_facts(marts["fact_orders"], marts["dim_date"], []).agg(F.max("full_date").alias("d")).first()["d"]
    if last is None:
        return customer_ltv(marts).select("cohort_month", "months_since_signup", "cohort_size", "active_customers",
                                          "pct_active", "avg_cumulative_revenue_per_cohort_member")
    horizon = C.month_start(F.lit(last.isoformat()).cast("date"))
    firsts = cm.where(F.col("months_since_signup") == 0).select("customer_key", "cohort_month")
    grid = firsts.select(
        "customer_key", "cohort_month",
        F.explode(F.sequence(F.lit(0), C.month_diff(horizon, "cohort_month"))).alias("months_since_signup"))
    dense = grid.join(cm.select("customer_key", "months_since_signup", "month_revenue"),
                      ["customer_key", "months_since_signup"], "left")
    running = Window.partitionBy("customer_key").orderBy("months_since_signup").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = dense.withColumn("cumulative_revenue", F.sum(F.coalesce("month_revenue", F.lit(0))).over(running))
    out = carried.groupBy("cohort_month", "months_since_signup").agg(
        F.count(F.lit(1)).alias("cohort_size"), F.count("month_revenue").alias("active_customers"),
        F.sum("cumulative_revenue").alias("cum_sum"))
    return out.select(
        "cohort_month", "months_since_signup", F.col("cohort_size").cast("long"), F.col("active_customers").cast("long"),
        C.pct("active_customers", "cohort_size").alias("pct_active"),
        C.avg_round("cum_sum", "cohort_size", 2).alias("avg_cumulative_revenue_per_cohort_member"),
    )
