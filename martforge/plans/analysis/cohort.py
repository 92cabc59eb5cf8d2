"""Monthly cohort retention.

cohort = month of a customer's first placed/fulfilled order; per (cohort,
months since that first order): cohort size, active customers, retention %.
Customers are identified by ``customer_key`` — a *version* — as in the
source warehouse (``by="customer"`` counts natural customers instead).

Plan: activity is pre-aggregated to distinct (customer, month) with a
partial aggregate before any shuffle; per (cohort, offset) each customer
appears once, so the distinct count is a plain count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions import columns as C
from martforge.plans.analysis.common import dated_revenue_facts


def _who(by: str) -> str:
    return "customer_key" if by == "version" else "customer_id"


def customer_activity(marts: dict[str, DataFrame], by: str = "version") -> DataFrame:
    """Distinct (customer, activity_month) of placed/fulfilled orders."""
    f = marts["fact_orders"]
    if by == "customer":
        f = f.join(marts["dim_customer"].select("customer_key", "customer_id"), "customer_key")
    who = _who(by)
    return dated_revenue_facts(f, marts["dim_date"], [who]).select(who, C.month_start("full_date").alias("activity_month")).distinct()


def first_order_month(marts: dict[str, DataFrame], by: str = "version") -> DataFrame:
    """(customer, cohort_month): month of the first placed/fulfilled order."""
    who = _who(by)
    return customer_activity(marts, by).groupBy(who).agg(F.min("activity_month").alias("cohort_month"))


def cohort_sizes(first_order: DataFrame) -> DataFrame:
    return first_order.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("n_customers"))


def cohort_retention(marts: dict[str, DataFrame], by: str = "version") -> DataFrame:
    """One scan of the fact.

    The first month is a window minimum over a customer's distinct active
    months (at most one row per month per customer, so no large window
    partition even for a heavy customer).  Every member is active in its
    cohort month, so the cohort size is the offset-0 count, taken with a
    window over the small (cohort x offset) grid instead of a second scan.
    """
    who = _who(by)
    activity = customer_activity(marts, by)
    with_cohort = activity.withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy(who)))
    grid = with_cohort.groupBy("cohort_month", C.month_diff("activity_month", "cohort_month").alias("months_since_signup")) \
        .agg(F.count(F.lit(1)).alias("active_customers"))
    size = F.max(F.when(F.col("months_since_signup") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    return grid.select(
        "cohort_month", size.alias("cohort_size"), "months_since_signup", "active_customers",
    ).withColumn("retention_pct", C.pct("active_customers", "cohort_size"))


def recent_cohorts(retention: DataFrame, months_back: int = 6) -> DataFrame:
    """Cohorts from (latest cohort - 6 months) on.

    The latest cohort is a window maximum over the retention grid, which has
    at most one row per (cohort month, offset): small by construction.
    """
    latest = F.max("cohort_month").over(Window.partitionBy(F.lit(1)))
    return retention.withColumn("__latest", latest).where(F.col("cohort_month") >= F.add_months("__latest", -months_back)).drop("__latest")
